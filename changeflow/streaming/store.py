"""What streams keep in the shared folder: committed batches, and tables in hash buckets.

A batch writes into a folder of its own attempt and then adds a commit record that names it. Readers follow records, never
folders, so what a failed batch left behind is not seen, and a batch that runs again after its commit changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

BATCH, ATTEMPT, BUCKET = "batch_id", "__attempt", "__bucket"
#: A record of every so many batches lists the folders of all batches before it.
FOLD = 100


class Files:
    """Small files and folders of the file system that holds ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        folder, _, last = name.rpartition("/")
        draft = f"{folder}/.{last}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft))
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._fs.rename(self._at(draft), self._at(name)):
            raise RuntimeError(f"{name} is there already")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class Commits:
    """Commit records ``path/_commits/N``, one per batch id, and the schema of what they name."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)

    def _record(self, batch_id: int | str) -> str:
        return f"{self.path}/_commits/{batch_id}"

    def ids(self, below: int | None = None) -> list[int]:
        found = sorted(int(n) for n in self.files.names(f"{self.path}/_commits") if n.isdigit())
        return [n for n in found if below is None or n < below]

    def get(self, batch_id: int) -> dict:
        return json.loads(self.files.read(self._record(batch_id)))

    def begin(self, schema: StructType) -> None:
        """Note the schema before the first batch, so that a reader finds an empty table. A later schema replaces it."""
        name, text = self._record("schema"), schema.json()
        if self.files.exists(name):
            if self.files.read(name) == text:
                return
            self.files.remove(name)
        self.files.write(name, text)

    def schema(self) -> StructType:
        if not self.files.exists(self._record("schema")):
            raise ValueError(f"no stream has written to {self.path}")
        return StructType.fromJson(json.loads(self.files.read(self._record("schema"))))

    def committed(self, batch_id: int, query: str) -> bool:
        """Whether this batch of this query is in; a folder takes the batches of one query only."""
        if not self.files.exists(self._record(batch_id)):
            return False
        if self.get(batch_id)["query"] != query:
            raise ValueError(f"{self.path} holds batches of another query; take a new folder or its checkpoint")
        return True

    def attempt(self, batch_id: int, kind: str = "") -> str:
        """A fresh folder, relative to ``path``; what earlier attempts left goes."""
        folder = f"{kind}{BATCH}={batch_id}"
        self.files.remove(f"{self.path}/{folder}")
        return f"{folder}/{ATTEMPT}=a{uuid.uuid4().hex}"

    def commit(self, batch_id: int, query: str, **record) -> None:
        self.files.write(self._record(batch_id), json.dumps({"query": query, **record}))

    def add(self, batch_id: int, query: str, folder: str) -> None:
        """Commit a batch whose rows all stay."""
        before = {"before": self.folders(batch_id)} if batch_id % FOLD == 0 else {}
        self.commit(batch_id, query, folder=folder, **before)

    def folders(self, below: int | None = None) -> list[str]:
        """Folders of the committed batches; at most ``FOLD`` records are opened."""
        found: list[str] = []
        for n in reversed(self.ids(below)):
            record = self.get(n)
            found.append(record["folder"])
            if "before" in record:
                return record["before"] + found[::-1]
        return found[::-1]

    def rows(self, below: int | None = None) -> DataFrame:
        """Rows of the committed batches, of those below a batch id if one is given."""
        schema = StructType([*self.schema(), StructField(BATCH, IntegerType()), StructField(ATTEMPT, StringType())])
        return read(self.spark, self.path, self.folders(below), schema).drop(ATTEMPT)


def read(spark: SparkSession, path: str, folders: list[str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps over restarts."""
    name = f"{checkpoint.rstrip('/')}/metadata"
    return json.loads(Files(spark, name).read(name))["id"]


@dataclass(frozen=True)
class BucketTable:
    """One row per key, in hash buckets of the key, as deltas of single batches and bases of single buckets.

    ``fold`` makes one row per key of many. A batch adds a delta of its own rows and folds those buckets whose turn it is, each
    of them once in ``period`` batches, so a batch neither reads nor writes the whole table and no bucket has more than
    ``2 * period`` deltas. A version is a small dict: the deltas, the bases, and the batch up to which each bucket is folded.
    """

    commits: Commits
    name: str
    key: list[str]
    schema: StructType
    fold: Callable[[DataFrame], DataFrame]
    buckets: int = 16
    period: int = 50

    EMPTY = {"deltas": {}, "bases": {}, "upto": None}

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _read(self, folders: dict[str, str], wanted: list[int] | None) -> DataFrame:
        parts = [StructField(BATCH, LongType()), StructField(ATTEMPT, StringType()), StructField(BUCKET, IntegerType())]
        rows = read(self.commits.spark, f"{self.commits.path}/{self.name}", [f.split("/", 1)[1] for f in folders.values()], StructType([*self.schema, *parts]))
        return rows if wanted is None else rows.filter(F.col(BUCKET).isin(wanted))

    def parts(self, version: dict | None, wanted: list[int] | None = None) -> DataFrame:
        """Rows of a version before the fold, of the ``wanted`` buckets only: other folders are not read."""
        version = version or self.EMPTY
        upto = version["upto"] or [-1] * self.buckets
        folded = F.element_at(F.array(*[F.lit(n).cast("long") for n in upto]), F.col(BUCKET) + 1)
        deltas = self._read(version["deltas"], wanted).filter(F.col(BATCH) > folded)
        bases = self._read(version["bases"], wanted).filter(F.col(BATCH) == folded)
        return deltas.unionByName(bases).select(*self.schema.names)

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows, at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def _write(self, rows: DataFrame, kind: str, batch_id: int) -> str:
        folder = self.commits.attempt(batch_id, f"{self.name}/{kind}/")
        dealt = rows.select(*self.schema.names, self.bucket().alias(BUCKET)).hint("rebalance", BUCKET)
        dealt.write.partitionBy(BUCKET).parquet(f"{self.commits.path}/{folder}")
        return folder

    def next(self, version: dict | None, rows: DataFrame, batch_id: int) -> dict:
        """Write the rows of a batch and fold the buckets whose turn it is; returns the version to commit."""
        version = version or self.EMPTY
        upto = list(version["upto"] or [-1] * self.buckets)
        if len(upto) != self.buckets:
            raise ValueError(f"{self.commits.path}/{self.name} has {len(upto)} buckets")
        new = {"deltas": {**version["deltas"], str(batch_id): self._write(rows, "delta", batch_id)}, "bases": dict(version["bases"]), "upto": upto}
        # a first delta of one row per key is folded already
        turn = [b for b in range(self.buckets) if b % self.period == batch_id % self.period] if version["upto"] or self.period == 1 else []
        if turn:
            new["bases"][str(batch_id)] = self._write(self.fold(self.parts(new, turn)), "base", batch_id)
            for b in turn:
                upto[b] = batch_id
        new["deltas"] = {n: f for n, f in new["deltas"].items() if int(n) > min(upto)}
        new["bases"] = {n: f for n, f in new["bases"].items() if int(n) in upto}
        return new

    def retire(self, old: dict, kept: list[dict]) -> None:
        """Remove the folders of a version that no kept one names."""
        named = {f for v in kept for kind in ("deltas", "bases") for f in v[kind].values()}
        for kind in ("deltas", "bases"):
            for folder in set(old[kind].values()) - named:
                self.commits.files.remove(f"{self.commits.path}/{folder.rpartition('/')[0]}")


class State:
    """Bucket tables that a stream commits together, batch by batch; ``retain`` versions stay readable."""

    def __init__(self, commits: Commits, tables: list[BucketTable], retain: int = 10) -> None:
        self.commits, self.tables, self.retain = commits, tables, max(retain, 2)

    def version(self, table: BucketTable, below: int | None = None) -> dict | None:
        ids = self.commits.ids(below)
        return self.commits.get(ids[-1])["tables"][table.name] if ids else None

    def advance(self, batch_id: int, query: str, rows: dict[str, DataFrame]) -> None:
        """Add the rows of a batch to the tables. A batch that is in is left as it is."""
        if self.commits.committed(batch_id, query):
            return
        new = {t.name: t.next(self.version(t, batch_id), rows[t.name], batch_id) for t in self.tables}
        self.commits.commit(batch_id, query, tables=new)
        ids = self.commits.ids()
        old, kept = ids[: -self.retain], [self.commits.get(n)["tables"] for n in ids[-self.retain :]]
        for n in old:
            record = self.commits.get(n)["tables"]
            for table in self.tables:
                table.retire(record[table.name], [k[table.name] for k in kept])
            self.commits.files.remove(f"{self.commits.path}/_commits/{n}")
