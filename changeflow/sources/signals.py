"""Snapshot requests written as rows of a signal table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SIGNAL_DATA = (
    "struct<`data-collections`:array<string>,`type`:string,"
    "`additional-conditions`:array<struct<`data-collection`:string,`filter`:string>>>"
)


def collection_name(name: Column) -> Column:
    """``database.schema.table`` as ``SCHEMA.TABLE``."""
    return F.upper(F.substring_index(F.trim(name), ".", -2))


def signal_read(signals: DataFrame, kind: str | None = None) -> DataFrame:
    """One row per requested table: id, request type, table, extra condition. Other signals are left out."""
    data = F.from_json("data", SIGNAL_DATA)
    rows = signals.filter(F.col("type") == "execute-snapshot").select("id", data.alias("d"))
    asked = rows.select(
        "id",
        F.lower(F.coalesce("d.type", F.lit("incremental"))).alias("snapshot_type"),
        F.col("d.additional-conditions").alias("conditions"),
        F.explode("d.data-collections").alias("name"),
    ).withColumn("table", collection_name(F.col("name")))
    own = F.filter("conditions", lambda c: collection_name(c["data-collection"]) == F.col("table"))
    out = asked.select("id", "snapshot_type", "table", F.get(own, 0)["filter"].alias("condition"))
    return out.filter(F.col("snapshot_type") == kind) if kind else out


def signals_from_log(log: DataFrame, signal_table: str) -> DataFrame:
    """Signal rows out of a change log: inserts into the signal table (``schema.table``)."""
    hit = F.upper(F.concat_ws(".", "schema_name", "table_name")) == collection_name(F.lit(signal_table))
    low = F.transform_keys("after", lambda k, v: F.lower(k))
    return log.filter((F.col("lcr_type") == "DML") & (F.col("dml") == "INSERT") & hit).select(
        low["id"].alias("id"), low["type"].alias("type"), low["data"].alias("data")
    )
