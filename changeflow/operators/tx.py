"""Transactions: boundaries, order inside them, and which of them are complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.model import position, table_name
from changeflow.operators.ranges import row_number_in_group


def tx_boundaries(log: DataFrame) -> DataFrame:
    """BEGIN and END rows from the log's transaction records; END carries the event count in all and per table.

    A transaction without a commit record has no END; a committed one without row changes has a count of 0.
    Counts are folded per (transaction, table) before they meet, so a huge transaction is cheap.
    """
    marks = log.filter((F.col("lcr_type") == "XACT") & F.col("dml").isin("BEGIN", "COMMIT")).withColumn("pos", position())
    # a record delivered again has the same position
    marks = marks.groupBy("tx_id", F.when(F.col("dml") == "BEGIN", "BEGIN").otherwise("END").alias("status")).agg(
        F.min("pos").alias("pos"), F.max("commit_ts").alias("commit_ts")
    )
    per_table = log.filter(F.col("lcr_type") == "DML").groupBy("tx_id", table_name().alias("data_collection")).agg(F.count("*").alias("n"))
    counts = per_table.groupBy("tx_id").agg(
        F.sum("n").alias("event_count"),
        # one entry per table of the source
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("data_collection", "n")))).alias("data_collections"),
    )
    ends = F.col("status") == "END"
    none = F.create_map().cast("map<string,bigint>")
    return marks.join(counts, "tx_id", "left").select(
        "tx_id", "status", "pos",
        F.when(ends, F.coalesce("event_count", F.lit(0).cast("long"))).alias("event_count"),
        F.when(ends, F.coalesce("data_collections", none)).alias("data_collections"),
        "commit_ts",
    )


def tx_order(events: DataFrame, parts: int | None = None) -> DataFrame:
    """``total_order`` and ``data_collection_order`` of every event inside its transaction."""
    order = ["position_scn", "group_lsn", "group_offset", "batch_row_id"]
    if "sub" in events.columns:
        order.append("sub")
    numbered = row_number_in_group(events, ["tx_id"], order, "total_order", parts)
    return row_number_in_group(
        numbered, ["tx_id", "schema_name", "table_name"], order, "data_collection_order", parts
    )


def tx_complete(log: DataFrame) -> DataFrame:
    """Row changes of transactions whose commit record is in the log at or below the safe point."""
    threads = log.filter(F.col("redo_thread").isNotNull()).groupBy("redo_thread").agg(F.max("position_scn").alias("m"))
    safe = threads.agg(F.min("m").alias("safe_scn")).withColumn("__k", F.lit(1))
    commits = log.filter((F.col("lcr_type") == "XACT") & (F.col("dml") == "COMMIT"))
    done = (
        commits.withColumn("__k", F.lit(1))
        .join(F.broadcast(safe), "__k")
        .filter(F.col("position_scn") <= F.col("safe_scn"))
        .select("tx_id")
        .distinct()
    )
    return log.filter(F.col("lcr_type") == "DML").join(done, "tx_id", "left_semi")
