"""Ordering, replay filtering, de-duplication and resume positions of a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.functions import scn as scnf
from changeflow.model import POSITION_FIELDS, REPLAY_EXEMPT_TYPES, position
from changeflow.operators.ranges import asof_join


def with_position(log: DataFrame) -> DataFrame:
    """Add the comparable ``pos`` struct."""
    return log.withColumn("pos", position())


def position_literal(pos: dict) -> Column:
    """A stored position as a literal comparable with ``pos``; missing parts are lowest."""
    types = {"position_scn": "long", "group_lsn": "long"}
    return F.struct(
        *[F.lit(pos.get(f)).cast(types.get(f, "int")).alias(f) for f in POSITION_FIELDS]
    )


def resume_filter(log: DataFrame, from_pos: dict) -> DataFrame:
    """Drop records below the stored position; the equal one is processed again.

    Begin, metadata and chunk records always pass. The plain SCN test in front is implied
    by the struct test and is the part a Parquet scan can use to skip row groups.
    """
    exempt = F.col("lcr_type").isin(*REPLAY_EXEMPT_TYPES) | (
        (F.col("lcr_type") == "XACT") & F.col("dml").eqNullSafe("BEGIN")
    )
    start = from_pos.get("position_scn")
    keep = position() >= position_literal(from_pos)
    if start is not None:
        keep = (F.col("position_scn") >= F.lit(start).cast("long")) & keep
    return log.filter(exempt | keep)


def dedup_replay(log: DataFrame) -> DataFrame:
    """One record per position and kind, and per chunk of a large object: removes re-delivered records."""
    chunk = [c for c in ("chunk_col", "chunk_no") if c in log.columns]
    return log.dropDuplicates(["lcr_type", "dml", "table_name", "schema_name", *POSITION_FIELDS, *chunk])


def order_guard_batch(log: DataFrame, applied: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split a batch into rows above the last applied position of their key, and late rows.

    ``applied`` has one row per key with ``applied_pos``.
    """
    marked = with_position(log).join(applied.select(*key, "applied_pos"), key, "left")
    late = F.coalesce(F.col("pos") <= F.col("applied_pos"), F.lit(False))
    return marked.filter(~late).drop("applied_pos"), marked.filter(late).drop("applied_pos")


def applied_positions(log: DataFrame, key: list[str]) -> DataFrame:
    return with_position(log).groupBy(*key).agg(F.max("pos").alias("applied_pos"))


def resume_position(log: DataFrame, recover: dict | None = None, by: tuple[str, ...] = ("instance_id",)) -> DataFrame:
    """Highest processed position per partition, only if above the recover position."""
    best = log.groupBy(*by).agg(F.max(position()).alias("pos"))
    if recover is not None:
        best = best.filter(F.col("pos") > position_literal(recover))
    return best


def commit_watermark(log: DataFrame, at: Column | None = None) -> DataFrame:
    """Per redo thread the highest commit SCN, with the maximum and the safe point over threads.

    ``vs`` compares the set of threads with ``at`` the way the safe point does.
    """
    threads = log.groupBy("redo_thread").agg(F.max("position_scn").alias("commit_scn"))
    total = threads.agg(F.max("commit_scn").alias("max_scn"), F.min("commit_scn").alias("safe_scn"))
    # one total row, joined by a constant key
    out = threads.withColumn("__k", F.lit(1)).join(F.broadcast(total.withColumn("__k", F.lit(1))), "__k").drop("__k")
    if at is not None:
        out = out.withColumn("vs", scnf.scn_cmp(F.col("safe_scn"), at))
    return out


def safe_point(log: DataFrame) -> DataFrame:
    """One row: safe point and maximum; both null (lowest) for an empty log."""
    threads = log.groupBy("redo_thread").agg(F.max("position_scn").alias("commit_scn"))
    return threads.agg(
        F.min("commit_scn").alias("safe_scn"), F.max("commit_scn").alias("max_scn"), F.count("*").alias("threads")
    )


def parse_commit_scn(df: DataFrame, column: str = "commit_scn") -> DataFrame:
    """One row per redo thread entry of a ``scn:thread:tx-tx,...`` text.

    Entries whose form is not known keep their text in ``bad_entry`` and have no numbers.
    """
    entries = df.select("*", F.posexplode(F.split(column, ",", -1)).alias("entry_no", "entry"))
    fields = scnf.commit_entry(F.col("entry"))
    return entries.withColumn("__e", fields).select(
        *[c for c in entries.columns if c not in ("entry", column)],
        F.col("__e.redo_thread").alias("redo_thread"),
        F.col("__e.scn").alias("scn"),
        F.col("__e.tx_ids").alias("tx_ids"),
        F.when(F.col("__e").isNull(), F.col("entry")).alias("bad_entry"),
    )


def format_commit_scn(df: DataFrame, by: list[str]) -> DataFrame:
    """Inverse of ``parse_commit_scn``: threads in order, transaction ids sorted.

    A thread given twice keeps the entry that came last.
    """
    one = df.filter(F.col("bad_entry").isNull()).groupBy(*by, "redo_thread").agg(
        F.max_by(F.struct("scn", "tx_ids"), "entry_no").alias("e")
    )
    text = F.concat_ws(
        ":",
        F.coalesce(F.col("e.scn").cast("string"), F.lit("null")),
        F.col("redo_thread").cast("string"),
        F.array_join(F.array_sort(F.array_distinct("e.tx_ids")), "-"),
    )
    # at most one entry per redo thread of the source
    entries = F.array_sort(F.collect_list(F.struct("redo_thread", text.alias("text"))))
    return one.groupBy(*by).agg(F.array_join(F.transform(entries, lambda x: x["text"]), ",").alias("commit_scn"))


def pending_tx(df: DataFrame, column: str = "pending") -> DataFrame:
    """``tx:scn,tx:scn`` text as a map and the earliest SCN in it; blank entries are ignored."""
    return df.withColumn("pending_map", scnf.pending_map(F.col(column))).withColumn(
        "earliest_scn", F.array_min(F.map_values("pending_map"))
    )


def scn_to_time(df: DataFrame, clock: DataFrame, scn_col: str = "scn", out: str = "scn_ts", **how) -> DataFrame:
    """Latest clock time at or before each SCN."""
    right = clock.select(F.col("scn").alias("clock_scn"), F.col("ts").alias(out))
    return asof_join(df, right, [], scn_col, "clock_scn", [out], **how)


def time_to_scn(df: DataFrame, clock: DataFrame, ts_col: str = "ts", out: str = "time_scn", **how) -> DataFrame:
    """Latest clock SCN at or before each time."""
    left = df.withColumn("__us", F.unix_micros(ts_col))
    right = clock.groupBy(F.unix_micros("ts").alias("clock_us")).agg(F.max("scn").alias(out))
    return asof_join(left, right, [], "__us", "clock_us", [out], **how).drop("__us")


def same_time(df: DataFrame, clock: DataFrame, a: str, b: str, out: str = "same_time", **how) -> DataFrame:
    """True when both SCNs map to the same clock time; false when one is missing."""
    timed = scn_to_time(scn_to_time(df, clock, a, "__ta", **how), clock, b, "__tb", **how)
    return timed.withColumn(out, F.coalesce(F.col("__ta") == F.col("__tb"), F.lit(False))).drop("__ta", "__tb")


def handover_point(log: DataFrame, ddl: DataFrame, captured: DataFrame, clock: DataFrame) -> DataFrame:
    """Flash point F, an SCN above the latest DDL of a captured table with another time, and stream start F+1.

    Times do not go back, so the head of the log is such an SCN, or there is none yet and F is null: the caller
    asks again later. ``start_scn`` is the head. One row; both tables are only aggregated, and two SCNs looked up.
    """
    names = ["schema_name", "table_name"]
    last_ddl = ddl.join(captured.select(*names).distinct(), names, "left_semi").agg(F.max("scn").alias("latest_ddl_scn"))
    head = log.agg(F.max("position_scn").alias("start_scn"))
    one = head.withColumn("__k", F.lit(1)).join(last_ddl.withColumn("__k", F.lit(1)), "__k").drop("__k")
    known = clock.select("scn", "ts")
    time_at = lambda c: F.max_by("ts", F.when(F.col("scn") <= F.col(c), F.col("scn")))
    # two rows' worth of bounds meet the clock by a constant, and one pass finds both times
    timed = known.withColumn("__k", F.lit(1)).join(F.broadcast(one.withColumn("__k", F.lit(1))), "__k").agg(
        time_at("start_scn").alias("head_ts"), time_at("latest_ddl_scn").alias("ddl_ts"))
    both = one.withColumn("__k", F.lit(1)).join(F.broadcast(timed.withColumn("__k", F.lit(1))), "__k").drop("__k")
    differs = ~F.col("head_ts").eqNullSafe(F.col("ddl_ts")) | F.col("ddl_ts").isNull()
    above = F.col("latest_ddl_scn").isNull() | (F.col("start_scn") > F.col("latest_ddl_scn"))
    flash = F.when(differs & above, F.col("start_scn"))
    return both.select(flash.alias("flash_scn"), "latest_ddl_scn", "start_scn", (flash + 1).alias("stream_scn"))


def at_or_before(history: DataFrame, pos: dict, default_scn: int = 0) -> DataFrame:
    """History rows valid at ``pos``: by position where the row has one, else by SCN."""
    target = F.lit(pos.get("position_scn", default_scn)).cast("long")
    whole = all(pos.get(f) is not None for f in POSITION_FIELDS)
    by_scn = F.coalesce(F.col("position_scn"), F.lit(default_scn).cast("long")) <= target
    if not whole:
        return history.filter(by_scn)
    has_pos = F.col("group_lsn").isNotNull()
    return history.filter(F.when(has_pos, position() <= position_literal(pos)).otherwise(by_scn))
