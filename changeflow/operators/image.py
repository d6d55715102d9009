"""Row images: which record means what, and what the row looked like before and after."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.functions.ddl import clean, path_names, statement_kind
from changeflow.model import IMAGE, position, table_name
from changeflow.session import broadcast_if_small

Key = list[str] | dict[str, list[str]]


def split_records(log: DataFrame) -> dict[str, DataFrame]:
    """The log by record kind. Each branch is a filter that reaches the scan."""
    kinds = ("DML", "DDL", "XACT", "CHUNK", "METADATA")
    return {kind: log.filter(F.col("lcr_type") == kind) for kind in kinds}


def map_op(log: DataFrame) -> DataFrame:
    """``op`` c/u/d/r/t; a record of any other kind gets no op and a reason in ``op_error``."""
    op = (
        F.when(F.col("dml") == "INSERT", "c")
        .when(F.col("dml") == "UPDATE", "u")
        .when(F.col("dml") == "DELETE", "d")
        .when(F.col("dml") == "READ", "r")
        .when(F.col("dml") == "TRUNCATE", "t")
    )
    return log.withColumn("op", op).withColumn(
        "op_error", F.when(op.isNull(), F.concat(F.lit("unexpected command: "), F.coalesce("dml", F.lit("none"))))
    )


def align_columns(log: DataFrame, schemas: DataFrame) -> DataFrame:
    """Images reduced to the table's columns, with names the schema does not know in ``drift``.

    ``schemas``: schema_name, table_name, columns (ordered names), deleted (names to ignore).
    """
    known, _ = broadcast_if_small(schemas.select("schema_name", "table_name", "columns", "deleted"))
    joined = log.join(known, ["schema_name", "table_name"], "left")
    names = F.array_union(
        F.coalesce(F.map_keys("before"), F.array().cast("array<string>")),
        F.coalesce(F.map_keys("after"), F.array().cast("array<string>")),
    )
    drift = F.array_except(F.array_except(names, F.col("deleted")), F.col("columns"))
    keep = lambda c, v: F.array_contains("columns", c)
    ordered = lambda image: F.map_from_entries(
        F.transform(
            F.filter(F.col("columns"), lambda c: F.map_contains_key(image, c)),
            lambda c: F.struct(c, image[c]),
        )
    )
    return (
        joined.withColumn("drift", drift)
        .withColumn("before", ordered(F.map_filter("before", keep)))
        .withColumn("after", ordered(F.map_filter("after", keep)))
        .drop("columns", "deleted")
    )


def complete_image(before: Column, after: Column, presence_known: bool = True) -> Column:
    """The after-image with untouched columns taken from the before-image.

    When presence is unknown a null after-value counts as untouched.
    """
    old = F.coalesce(before, F.create_map().cast(IMAGE))
    new = F.coalesce(after, F.create_map().cast(IMAGE))
    if not presence_known:
        new = F.map_filter(new, lambda c, v: v.isNotNull())
    kept = F.map_filter(old, lambda c, v: ~F.map_contains_key(new, c))
    return F.map_concat(kept, new)


def complete_after(log: DataFrame, presence_known: bool = True) -> DataFrame:
    full = complete_image(F.col("before"), F.col("after"), presence_known)
    is_delete = F.col("op") == "d" if "op" in log.columns else F.col("dml") == "DELETE"
    return log.withColumn("after", F.when(~is_delete, full))


def key_of(image: Column, pk: Key) -> Column:
    """Key values in key order; null without an image or without a key."""
    if isinstance(pk, dict):
        tables = F.create_map(
            *[x for t, cols in pk.items() for x in (F.lit(t), F.array(*[F.lit(c) for c in cols]))]
        )
        names = tables[table_name()]
        key = F.transform(names, lambda c: image[c])
        return F.when(image.isNotNull() & (F.size(names) > 0), key)
    if not pk:
        return F.lit(None).cast("array<string>")
    return F.when(image.isNotNull(), F.array(*[image[c] for c in pk]))


def with_key(events: DataFrame, pk: Key) -> DataFrame:
    return events.withColumn(
        "key", F.when(F.col("op") == "d", key_of(F.col("before"), pk)).otherwise(key_of(F.col("after"), pk))
    )


def split_key_change(events: DataFrame, pk: Key) -> DataFrame:
    """An update that changes the key becomes delete(old key) and create(new key).

    Both share one position; ``sub`` 0 and 1 keeps their order. Input needs complete images.
    """
    old, new = key_of(F.col("before"), pk), key_of(F.col("after"), pk)
    moved = (F.col("op") == "u") & old.isNotNull() & ~old.eqNullSafe(new)
    none = F.lit(None).cast(IMAGE)

    def part(op: Column, key: Column, before: Column, after: Column, sub: int) -> Column:
        return F.struct(
            op.alias("op"), key.alias("key"), before.alias("before"), after.alias("after"), F.lit(sub).alias("sub")
        )

    same_key = F.when(F.col("op") == "d", old).otherwise(new)
    parts = F.when(
        moved,
        F.array(
            part(F.lit("d"), old, F.col("before"), none, 0),
            part(F.lit("c"), new, none, F.col("after"), 1),
        ),
    ).otherwise(F.array(part(F.col("op"), same_key, F.col("before"), F.col("after"), 0)))
    rest = [c for c in events.columns if c not in ("op", "key", "before", "after", "sub")]
    # never empty: the outer form spares a test of the whole expression before the explode
    return events.select(*rest, F.explode_outer(parts).alias("__p")).select(*rest, "__p.*")


def drop_empty_updates(events: DataFrame) -> DataFrame:
    """Skip updates that carry no new values. Apply before ``complete_after``."""
    empty = (F.col("op") == "u") & (F.coalesce(F.size("after"), F.lit(0)) <= 0)
    return events.filter(~empty)


def same_image(a: Column, b: Column) -> Column:
    """Maps have no equality in Spark; sorted entries do."""
    return F.array_sort(F.map_entries(a)).eqNullSafe(F.array_sort(F.map_entries(b)))


def drop_unchanged(events: DataFrame) -> DataFrame:
    """Skip updates whose complete after-image equals the before-image."""
    return events.filter(~((F.col("op") == "u") & same_image(F.col("before"), F.col("after"))))


def truncate_events(log: DataFrame) -> DataFrame:
    """Truncate statements as ``op='t'`` events without images."""
    # the cheap word test first: few statements are left for the full one
    ddl = log.filter((F.col("lcr_type") == "DDL") & F.col("ddl_text").rlike("(?i)TRUNCATE"))
    text = clean(F.col("ddl_text"))
    ddl = ddl.filter(statement_kind(text) == "truncate").withColumn("__path", path_names(text))
    n = F.size("__path")
    return (
        ddl.withColumn("schema_name", F.coalesce(F.get("__path", n - 2), F.col("schema_name")))
        .withColumn("table_name", F.get("__path", n - 1))
        .drop("__path")
        .withColumn("op", F.lit("t"))
        .withColumn("before", F.lit(None).cast(IMAGE))
        .withColumn("after", F.lit(None).cast(IMAGE))
    )


def build_source(
    events: DataFrame, server: str, maker: Callable[[DataFrame], Column] | None = None, snapshot: str = "false"
) -> DataFrame:
    """Add the ``source`` struct. ``maker`` replaces the built-in one.

    ``table_ids`` (array of schema/table structs), when present, names several tables.
    """
    if maker is not None:
        return events.withColumn("source", maker(events))
    if "table_ids" in events.columns:
        ids = F.filter("table_ids", lambda t: t.isNotNull())
        schemas = F.nullif(
            F.array_join(F.array_distinct(F.transform(ids, lambda t: t["schema_name"])), ","), F.lit("")
        )
        tables = F.nullif(F.array_join(F.transform(ids, lambda t: t["table_name"]), ","), F.lit(""))
    else:
        schemas, tables = F.col("schema_name"), F.col("table_name")
    have = set(events.columns)
    pick = lambda c, t: (F.col(c) if c in have else F.lit(None)).cast(t)
    source = F.struct(
        F.lit(server).alias("name"),
        F.unix_millis("commit_ts").alias("ts_ms"),
        F.lit(snapshot).alias("snapshot"),
        schemas.alias("schema"),
        tables.alias("table"),
        pick("tx_id", "string").alias("txId"),
        F.col("position_scn").cast("string").alias("scn"),
        pick("commit_scn", "string").alias("commit_scn"),
        lcr_position().alias("lcr_position"),
        *[pick(c, t).alias(c) for c, t in (
            ("batch_row_id", "int"), ("position_scn", "long"), ("group_lsn", "long"), ("group_offset", "int"),
            ("instance_id", "int"), ("rs_id", "string"), ("ssn", "int"), ("redo_thread", "int"), ("user_name", "string"),
        )],
    )
    return events.withColumn("source", source)


def lcr_position() -> Column:
    """Printable position ``scn.lsn.offset.row.instance``; null when the record has none."""
    parts = [F.col(c).cast("string") for c in ("position_scn", "group_lsn", "group_offset", "batch_row_id", "instance_id")]
    return F.concat(*[x for p in parts for x in (p, F.lit("."))][:-1])


def build_envelope(events: DataFrame, ts: Column | None = None) -> DataFrame:
    """``value`` = before, after, source, op, ts_ms. The processing time defaults to the commit time."""
    ts = F.col("commit_ts") if ts is None else ts
    gone = F.col("op").isin("d", "t")
    first = F.col("op").isin("c", "r", "t")
    return events.withColumn(
        "value",
        F.struct(
            F.when(~first, F.col("before")).alias("before"),
            F.when(~gone, F.col("after")).alias("after"),
            F.col("source"),
            F.col("op"),
            F.unix_millis(ts).alias("ts_ms"),
        ),
    )


def event_metadata(events: DataFrame) -> DataFrame:
    """Event time, SCN and transaction id read out of an envelope; a null event gives nulls."""
    return events.select(
        *[c for c in events.columns if c != "value"],
        F.timestamp_millis(F.col("value.source.ts_ms")).alias("event_ts"),
        F.when(F.col("value").isNotNull(), F.coalesce(F.col("value.source.scn"), F.lit("null"))).alias("event_scn"),
        F.col("value.source.txId").alias("event_tx"),
    )


def drift_report(log: DataFrame, schemas: DataFrame) -> DataFrame:
    """Per table: columns only in events, columns never seen in events, and affected rows.

    Only distinct names per table leave the map side.
    """
    known, _ = broadcast_if_small(schemas.select("schema_name", "table_name", "columns"))
    # the (few) distinct column sets are found first, so that a hot table does not funnel all its rows
    names = F.array_sort(
        F.array_union(
            F.coalesce(F.map_keys("before"), F.array().cast("array<string>")),
            F.coalesce(F.map_keys("after"), F.array().cast("array<string>")),
        )
    )
    sets = (
        log.filter(F.col("lcr_type") == "DML")
        .groupBy("schema_name", "table_name", names.alias("names"))
        .agg(F.count(F.lit(1)).alias("events"))
        .join(known, ["schema_name", "table_name"], "left")
    )
    unknown = F.array_except("names", F.coalesce("columns", F.array().cast("array<string>")))
    return (
        sets.groupBy("schema_name", "table_name")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(unknown)))).alias("unknown_columns"),
            F.array_distinct(F.flatten(F.collect_set("names"))).alias("__seen"),
            F.first("columns").alias("columns"),
            F.sum("events").alias("events"),
            F.sum(F.when(F.size(unknown) > 0, F.col("events")).otherwise(0)).alias("drift_events"),
        )
        .withColumn("missing_columns", F.array_sort(F.array_except("columns", "__seen")))
        .drop("__seen", "columns")
    )
