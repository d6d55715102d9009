"""Numbers about a capture: counts per table, lag, snapshot progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.operators.position import scn_to_time

TABLE = ["schema_name", "table_name"]


def capture_metrics(events: DataFrame, ddl: DataFrame | None = None, failed: str | None = None) -> DataFrame:
    """Per table: rows by operation, transactions, failures, biggest transaction, last SCN.

    The transaction numbers come from a fold per (table, transaction), so no distinct set is
    gathered in one place. ``ddl`` adds the statements not understood per table.
    """
    bad = F.count_if(F.size(failed) > 0) if failed else F.lit(0).cast("long")
    per_tx = events.groupBy(*TABLE, "tx_id").agg(
        *[F.count_if(F.col("op") == op).alias(f"op_{op}") for op in "crudt"],
        F.count("*").alias("rows"),
        F.count_if(F.col("op").isNull()).alias("errors"),
        bad.alias("warnings") if failed else F.max(bad).alias("warnings"),
        F.max("position_scn").alias("last_scn"),
    )
    out = per_tx.groupBy(*TABLE).agg(
        *[F.sum(f"op_{op}").alias(f"op_{op}") for op in "crudt"],
        F.sum("rows").alias("processed_rows"),
        F.count("tx_id").alias("transactions"),
        F.max("rows").alias("max_tx_rows"),
        F.sum("errors").alias("errors"),
        F.sum("warnings").alias("warnings"),
        F.max("last_scn").alias("last_scn"),
    )
    if ddl is not None:
        from changeflow.operators.history import ddl_quarantine

        _, unread = ddl_quarantine(ddl)
        counts = unread.groupBy(*TABLE).agg(F.count("*").alias("unparsable_ddl"))
        out = out.join(counts, TABLE, "left").fillna(0, ["unparsable_ddl"])
    return out


def lag_report(events: DataFrame, clock: DataFrame, processed_ts: str, **how) -> DataFrame:
    """Per table: event-time lag (ms percentiles, maximum) and the SCN distance to the head of the clock."""
    head = clock.agg(F.max("scn").alias("head_scn")).withColumn("__k", F.lit(1))
    timed = scn_to_time(events, clock, "position_scn", "event_ts", **how)
    lag = (F.unix_micros(processed_ts) - F.unix_micros("event_ts")) / 1000
    return (
        timed.withColumn("lag_ms", lag)
        .groupBy(*TABLE)
        .agg(
            F.max("lag_ms").alias("max_lag_ms"),
            F.percentile_approx("lag_ms", F.array(F.lit(0.5), F.lit(0.99)), 10_000).alias("lag_ms_p"),
            F.max("position_scn").alias("last_scn"),
            F.count("*").alias("events"),
        )
        .withColumn("__k", F.lit(1))
        .join(F.broadcast(head), "__k")
        .withColumn("scn_distance", F.col("head_scn") - F.col("last_scn"))
        .drop("__k")
    )


def snapshot_progress(events: DataFrame, planned: DataFrame | None = None) -> DataFrame:
    """Per table: rows and chunks done; ``planned`` (table, chunks) adds what remains."""
    read = events.filter(F.col("op") == "r")
    chunk = F.col("chunk_id") if "chunk_id" in events.columns else F.lit(0)
    per_chunk = read.groupBy(*TABLE, chunk.alias("chunk_id")).agg(F.count("*").alias("n"))
    done = per_chunk.groupBy(*TABLE).agg(F.sum("n").alias("rows"), F.count("*").alias("chunks"))
    if planned is None:
        return done
    return planned.join(done, TABLE, "left").fillna(0, ["rows", "chunks"]).withColumn(
        "remaining_chunks", F.col("planned_chunks") - F.col("chunks")
    )
