"""Sinks of streaming queries. Every batch is committed once (``store``): one that runs again after a failure replaces its
own output, and readers see committed batches only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from changeflow.model import POSITION_FIELDS, position
from changeflow.operators import apply
from changeflow.operators.image import Key
from changeflow.session import freed_shuffles
from changeflow.streaming.store import BucketTable, Commits, State, query_id


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _committed(path: str, checkpoint: str, write: Callable[[DataFrame, int, str], None]) -> Callable[[DataFrame, int], None]:
    """``write`` fills the folder it is given; a batch that is committed is not written again."""

    def batch_run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits, query = Commits(spark, path), query_id(spark, checkpoint)
        if not commits.committed(batch_id, query):
            folder = commits.attempt(batch_id)
            write(batch, batch_id, f"{commits.path}/{folder}")
            commits.add(batch_id, query, folder)

    return batch_run


def write_changes(
    stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, available_now: bool = False
) -> StreamingQuery:
    """Exactly-once file sink: folder ``batch_id=N`` per micro-batch, read by ``read_changes``. ``path`` takes the batches of
    one query; with a new checkpoint it raises, as batch numbers would start again."""

    def write(batch: DataFrame, batch_id: int, folder: str) -> None:
        out = batch.write
        if partition_by:
            out = out.partitionBy(*partition_by)
        out.parquet(folder)

    Commits(stream.sparkSession, path).begin(stream.schema)
    with freed_shuffles(stream.sparkSession):  # a batch is written once
        return _start(stream.writeStream.foreachBatch(_committed(path, checkpoint, write)), checkpoint, available_now)


def read_changes(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """Rows of the committed batches with their ``batch_id``, of those below a batch id if one is given. Before the first
    batch the table is empty."""
    return Commits(spark, path).rows(below)


def _progress(batch: DataFrame) -> DataFrame:
    return batch.agg(
        F.count("*").alias("rows"),
        F.min(position()).alias("first_pos"),
        F.max(position()).alias("last_pos"),
        F.max("commit_ts").alias("last_commit_ts"),
    ).withColumn("processed_at", F.current_timestamp())


def _empty(stream: DataFrame) -> DataFrame:
    return stream.sparkSession.createDataFrame([], stream.schema)


def progress_rows(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """One row per processed batch: rows, first and last position, last commit time."""

    def write(batch: DataFrame, batch_id: int, folder: str) -> None:
        _progress(batch).write.parquet(folder)

    Commits(stream.sparkSession, path).begin(_progress(_empty(stream)).schema)
    return _start(stream.writeStream.foreachBatch(_committed(path, checkpoint, write)), checkpoint, available_now)


# ---------------------------------------------------------------- order guard


def order_guard(
    stream: DataFrame, key: list[str], path: str, state: str, checkpoint: str, compact_every: int = 50,
    available_now: bool = False, buckets: int = 16,
) -> StreamingQuery:
    """Deliver rows above the highest applied position of their key; rows at or below it, and copies inside a batch, go to
    the partition ``late=true`` of the same batch folder. A key with a null in it has no mark.

    The marks are a table in hash buckets below ``state`` (more ``buckets`` for more keys: one is folded as a whole), of which a batch reads those that its keys fall into, and folds
    those whose turn it is. It is joined to each batch: a hot key is a skewed join that adaptive execution splits, and few
    keys are a broadcast. Python sees no rows.
    """

    def applied(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*key).agg(F.max(position()).alias("applied_pos"))

    def fold(marks: DataFrame) -> DataFrame:
        return marks.groupBy(*key).agg(F.max("applied_pos").alias("applied_pos"))

    schema = applied(_empty(stream)).schema

    def write(batch: DataFrame, batch_id: int, folder: str) -> None:
        spark = batch.sparkSession
        kept = State(Commits(spark, state), [BucketTable(Commits(spark, state), "marks", key, schema, fold, buckets, compact_every)])
        marks = kept.tables[0]
        version = kept.version(marks, below=batch_id)
        if version:
            batch.persist()  # read for its buckets, and for its rows
        known = fold(marks.parts(version, marks.touched(batch) if version else None))
        copies = Window.partitionBy("lcr_type", "dml", "schema_name", "table_name", *POSITION_FIELDS).orderBy(*key)
        old = F.coalesce(position() <= F.col("applied_pos"), F.lit(False))
        rows = batch.withColumn("__copy", F.row_number().over(copies)).join(known, key, "left")
        rows = rows.withColumn("late", old | (F.col("__copy") > 1)).drop("applied_pos", "__copy")
        rows.write.partitionBy("late").parquet(folder)
        # only keys and positions are read back
        kept.advance(batch_id, query_id(spark, checkpoint), {"marks": applied(spark.read.schema(batch.schema).parquet(folder))})
        batch.unpersist()

    Commits(stream.sparkSession, path).begin(StructType([*stream.schema, StructField("late", BooleanType())]))
    return _start(stream.writeStream.foreachBatch(_committed(path, checkpoint, write)), checkpoint, available_now)


def read_guarded(spark: SparkSession, path: str) -> DataFrame:
    """What ``order_guard`` delivered in committed batches, with ``late``."""
    return read_changes(spark, path)


# ---------------------------------------------------------------- table content kept by a stream


def _floors(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*apply.TABLE).agg(F.max("floor").alias("floor"))


def _content(commits: Commits, rows: StructType, floors: StructType, buckets: int, period: int) -> list[BucketTable]:
    return [
        BucketTable(commits, "rows", [*apply.TABLE, "key"], rows, apply.latest_rows, buckets, period),
        BucketTable(commits, "floors", apply.TABLE, floors, _floors, 1, period),
    ]


def current_state_stream(
    stream: DataFrame, pk: Key, path: str, checkpoint: str, compact_every: int = 50, available_now: bool = False,
    buckets: int = 16, retain: int = 10,
) -> StreamingQuery:
    """Keep the content of the captured tables below ``path``.

    A batch writes its own last event per key (``rows``) and its truncates (``floors``), in hash buckets of the key, and folds
    the buckets whose turn it is, each once in ``compact_every`` batches: the cost follows the batch and a fixed share of
    the table. Both tables have one commit record, so a reader never sees a truncate without the rows of its batch. Deletes
    stay as rows, so that an older event cannot bring one back. ``retain`` versions can be read, the folders of older
    ones are removed.
    """

    def events(log: DataFrame) -> dict[str, DataFrame]:
        return {"rows": apply.latest_rows(apply.change_events(log, pk)), "floors": apply.truncate_floor(log)}

    schemas = {name: rows.schema for name, rows in events(_empty(stream)).items()}

    def write(batch: DataFrame, batch_id: int) -> None:
        commits = Commits(batch.sparkSession, path)
        kept = State(commits, _content(commits, schemas["rows"], schemas["floors"], buckets, compact_every), retain)
        kept.advance(batch_id, query_id(batch.sparkSession, checkpoint), events(batch))

    Commits(stream.sparkSession, path).begin(StructType([StructField(name, schema) for name, schema in schemas.items()]))
    return _start(stream.writeStream.foreachBatch(write), checkpoint, available_now)


def read_state(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """Live rows of the last committed batch, or of the last one below a batch id, without deleted and truncated rows.
    Before the first batch there are none."""
    commits = Commits(spark, path)
    schema = commits.schema()
    ids = commits.ids(below)
    version = commits.get(ids[-1])["tables"] if ids else {}
    buckets = len(version["rows"]["upto"]) if version else 1
    rows, floors = (t.fold(t.parts(version.get(t.name))) for t in _content(commits, schema["rows"].dataType, schema["floors"].dataType, buckets, 1))
    return apply.drop_truncated(rows, floors).filter(F.col("op") != "d")
