"""Change-log tables, read in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changeflow.model import LCR_SCHEMA
from changeflow.operators.position import resume_filter


def changelog_read(spark: SparkSession, path: str, from_pos: dict | None = None) -> DataFrame:
    """A stored log; the start position reaches the scan."""
    log = spark.read.schema(LCR_SCHEMA).parquet(path)
    return resume_filter(log, from_pos) if from_pos else log


def changelog_stream(spark: SparkSession, path: str, from_pos: dict | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """The same log as an unbounded source. The checkpoint keeps the place between runs;
    ``from_pos`` is where the very first run starts."""
    log = spark.readStream.schema(LCR_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return resume_filter(log, from_pos) if from_pos else log


def changelog_write(log: DataFrame, path: str) -> None:
    """Store a log by record kind, so that readers of one kind skip the rest. Columns that ``log`` lacks are null."""
    have = set(log.columns)
    fields = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in LCR_SCHEMA.fields]
    log.select(*fields).write.mode("overwrite").partitionBy("lcr_type").parquet(path)
