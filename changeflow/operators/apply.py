"""Folding change events into table content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.model import IMAGE, position
from changeflow.operators import image
from changeflow.operators.image import Key
from changeflow.operators.ranges import lead_in_group
from changeflow.session import broadcast_if_small

TABLE = ["schema_name", "table_name"]


def change_events(log: DataFrame, pk: Key) -> DataFrame:
    """Ordered events with complete images and one key per row."""
    dml = log.filter(F.col("lcr_type") == "DML").withColumn("pos", position())
    events = image.complete_after(image.map_op(dml).filter(F.col("op").isNotNull()))
    return image.split_key_change(events, pk)


def snapshot_events(snapshot: DataFrame, schema_name: str, table_name: str, pk: list[str], scn: int) -> DataFrame:
    """Snapshot rows as read events at position ``scn``."""
    cols = [F.lit(c) for c in snapshot.columns]
    row = F.create_map(*[x for c, n in zip(snapshot.columns, cols) for x in (n, F.col(c).cast("string"))])
    return snapshot.select(
        F.lit(schema_name).alias("schema_name"),
        F.lit(table_name).alias("table_name"),
        F.lit("r").alias("op"),
        F.array(*[F.col(c).cast("string") for c in pk]).alias("key"),
        row.alias("after"),
        scn_position(F.lit(scn)).alias("pos"),
        F.lit(0).alias("sub"),
    )


def scn_position(scn: Column) -> Column:
    """The highest position of an SCN: a snapshot at F holds every change of F."""
    top = 2**31 - 1
    return F.struct(
        scn.cast("long").alias("position_scn"),
        F.lit(2**63 - 1).cast("long").alias("group_lsn"),
        F.lit(top).alias("group_offset"),
        F.lit(top).alias("batch_row_id"),
        F.lit(top).alias("instance_id"),
    )


def latest_rows(events: DataFrame) -> DataFrame:
    """Last event per key. The fold is partial before the shuffle, so a hot key is one row per
    task by then, and a re-delivered event cannot change it: no de-duplication is needed."""
    return (
        events.groupBy(*TABLE, "key")
        .agg(F.max_by(F.struct("op", "after", "pos", "sub"), F.struct("pos", "sub")).alias("last"))
        .select(*TABLE, "key", "last.*")
    )


def truncate_floor(log: DataFrame) -> DataFrame:
    """Position of the last truncate per table."""
    return image.truncate_events(log).groupBy(*TABLE).agg(F.max(position()).alias("floor"))


def drop_truncated(rows: DataFrame, floors: DataFrame) -> DataFrame:
    """Remove rows whose last event is not after the table's last truncate."""
    floors, _ = broadcast_if_small(floors)
    kept = rows.join(floors, TABLE, "left")
    return kept.filter(F.col("floor").isNull() | (F.col("pos") > F.col("floor"))).drop("floor")


def current_state(
    log: DataFrame,
    pk: Key,
    snapshot: DataFrame | None = None,
    floors: DataFrame | None = None,
    from_scn: int | None = None,
) -> DataFrame:
    """One row per live key: snapshot events up to F, then the log from F+1.

    ``snapshot`` comes from ``snapshot_events``; ``floors`` from ``truncate_floor``.
    """
    if from_scn is not None:
        log = log.filter(F.col("position_scn") >= from_scn)
    events = change_events(log, pk).select(*TABLE, "op", "key", "after", "pos", "sub")
    if snapshot is not None:
        events = snapshot.select(*events.columns).unionByName(events)
    rows = latest_rows(events)
    if floors is not None:
        rows = drop_truncated(rows, floors)
    return rows.filter(F.col("op") != "d")


def as_of_scn(log: DataFrame, pk: Key, scn: int, **kw) -> DataFrame:
    """Table content as of an SCN; the bound reaches the scan."""
    return current_state(log.filter(F.col("position_scn") <= scn), pk, **kw)


def history_scd(log: DataFrame, pk: Key, parts: int | None = None) -> DataFrame:
    """Versions per key with the SCN range in which each was valid."""
    events = change_events(log, pk).withColumn("key_text", F.to_json("key"))
    once = events.dropDuplicates([*TABLE, "key_text", "position_scn", "group_lsn", "group_offset", "batch_row_id", "sub"])
    order = ["position_scn", "group_lsn", "group_offset", "batch_row_id", "sub"]
    chained = lead_in_group(once, [*TABLE, "key_text"], order, "position_scn", "valid_to", parts)
    return chained.filter(F.col("op") != "d").select(
        *TABLE, "key", "op", "after", F.col("position_scn").alias("valid_from"), "valid_to"
    )


def typed(rows: DataFrame, columns: dict[str, str], image_col: str = "after") -> DataFrame:
    """Image keys as typed columns."""
    return rows.select(*[F.col(image_col)[c].cast(t).alias(c) for c, t in columns.items()])
