"""Chunked snapshots of live tables, merged with the changes that happen meanwhile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.operators.apply import TABLE, change_events, scn_position
from changeflow.session import broadcast_if_small, cut_lineage
from changeflow.sources.keyset import chunk_bounds, keyset_chunks
from changeflow.sources.signals import signal_read


#: rows of a plan that one task puts out
PLAN_ROWS = 2_000_000
#: positions of a key that are folded into one row; a wider bucket would make longer lists of one hot key
SCN_BUCKET = 1 << 16


def chunk_plan(signals: DataFrame, tables: dict[str, tuple[DataFrame, list[str]]], n: int) -> DataFrame:
    """Requested tables x chunks of ``n`` rows: signal id, table, condition, chunk bounds.

    ``tables``: name -> (frame, key columns). Equal requests share one chunking. Key bounds are
    returned as JSON, since key types differ by table. A result has a row per request and chunk, while few
    tables and conditions tell requests apart: the requests are dealt out, and the chunks go to each task.
    """
    wanted = {t.upper(): t for t in tables}
    asked = signal_read(signals, "incremental").filter(F.col("table").isin(*wanted))
    # one entry per distinct condition an operator wrote for a known table
    kinds = asked.groupBy("table", "condition").agg(F.count("*").alias("requests")).collect()
    plans = []
    for r in kinds:
        df, key = tables[wanted[r["table"]]]
        part = df.filter(r["condition"]) if r["condition"] else df
        bounds = chunk_bounds(keyset_chunks(part, key, n), key)
        plans.append(
            bounds.select(
                F.lit(r["table"]).alias("table"), F.lit(r["condition"]).cast("string").alias("condition"), "chunk_id",
                F.to_json("low_key").alias("low_key"), F.to_json("high_key").alias("high_key"), "rows",
            )
        )
    if not plans:
        return asked.join(asked.select("id").limit(0), "id", "left_semi")
    plan = cut_lineage(reduce(DataFrame.unionByName, plans))
    chunks = {(r["table"], r["condition"]): r["count"] for r in plan.groupBy("table", "condition").count().collect()}
    size = sum(r["requests"] * chunks.get((r["table"], r["condition"]), 0) for r in kinds)
    tasks = max(plan.sparkSession.sparkContext.defaultParallelism, -(-size // PLAN_ROWS))
    ids = asked.select("id", "table", F.coalesce("condition", F.lit("")).alias("__c")).distinct().repartition(tasks)
    small, _ = broadcast_if_small(plan.withColumn("__c", F.coalesce("condition", F.lit(""))))
    return ids.join(small, ["table", "__c"]).select(*plan.columns, "id")


def _in_window(low: str | int, high: str | int):
    col = lambda v: F.col(v) if isinstance(v, str) else F.lit(v)
    return (F.col("position_scn") >= col(low)) & (F.col("position_scn") <= col(high))


def window_merge(chunk: DataFrame, log: DataFrame, low: int, high: int, pk: list[str]) -> DataFrame:
    """One chunk read between two marks: live events inside the window beat chunk rows of their key.

    ``chunk`` holds read events with ``key``. A key change counts for its old and its new key.
    Chunk rows that survive take the position of the high mark.
    """
    live = change_events(log.filter(_in_window(low, high)), pk)
    touched = live.select(*TABLE, "key").distinct()
    kept = chunk.join(touched, [*TABLE, "key"], "left_anti")
    kept = kept.withColumn("position_scn", F.lit(high).cast("long")).withColumn("sub", F.lit(0))
    cols = [*TABLE, "op", "key", "after", "position_scn", "sub"]
    return live.select(*cols).unionByName(kept.select(*cols))


def incremental_snapshot(
    table: DataFrame, name: str, log: DataFrame, n: int, pk: list[str], marks: DataFrame | None = None,
    low: int | Column | None = None, high: int | Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All chunks of a table merged with the log in one job: events, and one progress row per chunk.

    Each chunk has a window: ``marks`` (chunk_id, low, high), or ``low`` and ``high`` as numbers or as expressions of
    ``chunk_id``. The events are every change of the log (``chunk_id`` null) and the surviving chunk rows with their
    ``chunk_id`` at their high mark; folding them with ``apply.latest_rows`` gives the table. A chunk row survives if its key
    has no change inside its chunk's window: one join by key, with the window as its range condition.
    """
    schema_name, table_name = name.split(".", 1)
    chunks = keyset_chunks(table, pk, n)
    image = F.create_map(*[x for c in table.columns for x in (F.lit(c), F.col(c).cast("string"))])
    rows = chunks.select(
        F.lit(schema_name).alias("schema_name"), F.lit(table_name).alias("table_name"), F.lit("r").alias("op"),
        F.array(*[F.col(c).cast("string") for c in pk]).alias("key"), image.alias("after"), "chunk_id",
    )
    if marks is not None:
        small, _ = broadcast_if_small(marks.select("chunk_id", "low", "high"))
        rows = rows.join(small, "chunk_id")
    else:
        bound = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("long")
        rows = rows.withColumn("low", bound(low)).withColumn("high", bound(high))
    events = change_events(log, pk)
    # changes of a key inside a bucket of positions are one row, folded before the shuffle; a bucket holds a bounded number of them
    near = events.groupBy(*TABLE, "key", F.floor(F.col("position_scn") / SCN_BUCKET).alias("bucket")).agg(
        F.min("position_scn").alias("from_scn"), F.max("position_scn").alias("to_scn"), F.array_sort(F.collect_set("position_scn")).alias("scns"))
    inside = (F.col("c.low") <= F.col("e.to_scn")) & (F.col("c.high") >= F.col("e.from_scn")) & F.exists(
        "e.scns", lambda scn: (scn >= F.col("c.low")) & (scn <= F.col("c.high")))
    same = [F.col(f"c.{k}") == F.col(f"e.{k}") for k in (*TABLE, "key")]
    kept = rows.alias("c").join(near.alias("e"), reduce(Column.__and__, [*same, inside]), "left_anti")
    cols = [*TABLE, "op", "key", "after", "pos", "sub", "chunk_id"]
    kept_events = kept.withColumn("pos", scn_position(F.col("high"))).withColumn("sub", F.lit(0))
    merged = events.withColumn("chunk_id", F.lit(None).cast("long")).select(*cols).unionByName(kept_events.select(*cols))
    progress = chunk_bounds(chunks, pk).select(
        "chunk_id", "rows", F.to_json("high_key").alias("last_key")
    )
    return merged, progress
