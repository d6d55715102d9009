"""What the operators share: reading tables, staging between jobs, row keys, text normal form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changeflow.session import shared_dir

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, **settings: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: later jobs neither recompute it nor need its executors.

    The shuffle files of the step are freed when it is written. ``settings`` hold while it is written.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    settings = {CLEAN: "true", **settings}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Remove tables written by ``stage`` that no later step reads."""
    for df in staged:
        spark = df.sparkSession
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def one_space(text: Column) -> Column:
    """Each run of white space as one space, null as empty. The pattern skips runs that are one space already."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"\x20{SPACE}+|[\x09-\x0D]{SPACE}*", " ")


def documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns ``doc_id``, ``text`` (null: empty) and ``key``.

    Rows that repeat an id are told apart by ``key``, a hash of the text: (doc_id, key) names a document, and rows that
    share both are the same document given twice.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("key"))


def same_document(a: DataFrame, b: DataFrame) -> Column:
    """Join condition for (doc_id, key); a missing id equals a missing id."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["key"] == b["key"])
