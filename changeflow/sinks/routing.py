"""Shaping events for delivery: topics, keys, tombstones, outbox messages, CloudEvents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.operators.image import Key, key_of


def route_by_table(events: DataFrame, prefix: str) -> DataFrame:
    """``topic`` = prefix.schema.table; the column a Kafka sink reads, or a partition column."""
    return events.withColumn("topic", F.concat_ws(".", F.lit(prefix), "schema_name", "table_name"))


def write_by_topic(events: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per topic. Rows stay in their partitions: a hot topic is written by many tasks."""
    events.write.mode(mode).partitionBy("topic").parquet(path)


def event_key(events: DataFrame, pk: Key, key_map: dict[str, list[str]] | None = None) -> DataFrame:
    """``event_key``, a JSON object of the key columns; null without a key. ``key_map`` overrides
    the key columns of tables by name."""
    if isinstance(pk, dict):
        names = {**pk, **(key_map or {})}
    elif key_map:
        table = F.concat_ws(".", "schema_name", "table_name")
        own = None
        for t, cols in key_map.items():
            test = table == t
            own = F.when(test, _json_key(cols)) if own is None else own.when(test, _json_key(cols))
        return events.withColumn("event_key", own.otherwise(_json_key(pk)))
    else:
        return events.withColumn("event_key", _json_key(pk))
    table = F.concat_ws(".", "schema_name", "table_name")
    expr = F.lit(None).cast("string")
    for t, cols in names.items():
        expr = F.when(table == t, _json_key(cols)).otherwise(expr)
    return events.withColumn("event_key", expr)


def _json_key(cols: list[str]) -> Column:
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    if not cols:
        return F.lit(None).cast("string")
    pairs = F.create_map(*[x for c in cols for x in (F.lit(c), image[c])])
    return F.when(image.isNotNull(), F.to_json(pairs))


def tombstones(events: DataFrame, value_col: str = "value") -> DataFrame:
    """After each delete a row with the same key and a null value."""
    kind = events.schema[value_col].dataType
    copies = F.when(F.col("op") == "d", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    out = events.withColumn("tombstone", F.explode_outer(copies))
    return out.withColumn(value_col, F.when(~F.col("tombstone"), F.col(value_col)).otherwise(F.lit(None).cast(kind)))


# Outbox settings and the columns they default to, in upper case.
OUTBOX_FIELDS = {
    "event_id": "ID",
    "event_key": "AGGREGATEID",
    "event_timestamp": None,
    "payload": "PAYLOAD",
    "route_by_field": "AGGREGATETYPE",
}


def outbox_route(
    events: DataFrame, table: str, cfg: dict[str, str] | None = None, topic: str = "outbox.event.${routedByValue}",
    payload_schema: str | None = None,
) -> DataFrame:
    """Inserts of the outbox table as messages: id, key, timestamp, payload, topic.

    Column names given in ``cfg`` win over the defaults. Without a timestamp column the event's own
    time counts. ``payload_schema`` expands a JSON payload.
    """
    names = {**OUTBOX_FIELDS, **(cfg or {})}
    own = F.upper(F.concat_ws(".", "schema_name", "table_name")) == table.upper()
    after = F.col("after")
    ts = after[names["event_timestamp"]].try_cast("timestamp") if names["event_timestamp"] else F.col("commit_ts")
    route = after[names["route_by_field"]]
    payload = after[names["payload"]]
    head, _, tail = topic.partition("${routedByValue}")
    return events.filter((F.col("op") == "c") & own).select(
        after[names["event_id"]].alias("message_id"),
        after[names["event_key"]].alias("message_key"),
        ts.alias("message_ts"),
        (F.from_json(payload, payload_schema) if payload_schema else payload).alias("payload"),
        route.alias("routed_by"),
        F.concat(F.lit(head), route, F.lit(tail)).alias("topic"),
    )


def cloud_events(events: DataFrame, source_uri: str) -> DataFrame:
    """CloudEvents fields of enveloped events; a missing part of the id is the text ``null``."""
    text = lambda c: F.coalesce(F.col(f"value.source.{c}").cast("string"), F.lit("null"))
    identity = F.concat(
        F.lit("name:"), text("name"), F.lit(";scn:"), text("scn"), F.lit(";commit_scn:"), text("commit_scn"),
        F.lit(";lcr_position:"), text("lcr_position"),
    )
    return events.select(
        identity.alias("id"),
        F.lit(source_uri).alias("source"),
        F.lit("1.0").alias("specversion"),
        F.lit("DataChangeEvent").alias("type"),
        F.timestamp_millis(F.col("value.source.ts_ms")).alias("time"),
        F.lit("application/json").alias("datacontenttype"),
        *[F.col(f"value.source.{c}").cast("string").alias(f"ext_{c}") for c in ("scn", "commit_scn", "lcr_position")],
        F.to_json("value", {"ignoreNullFields": "false"}).alias("data"),
    )


def valid_name(name: Column, mode: str = "none") -> Column:
    """A name made valid for the target: ``avro`` replaces other characters by ``_``,
    ``avro_unicode`` by ``_u`` and the code point. Dots part namespaces and stay."""
    if mode == "none":
        return name
    if mode == "avro":
        return F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9_.]", "_"), r"^[^A-Za-z_]", "_")
    if mode == "avro_unicode":
        code = lambda c: F.concat(F.lit("_u"), F.lpad(F.lower(F.hex(F.ascii(c))), 4, "0"))
        first = lambda c, i: (i == 0) & c.rlike(r"^[0-9.]$")
        chars = F.transform(
            F.split(name, ""), lambda c, i: F.when(c.rlike(r"^[A-Za-z0-9.]$") & ~first(c, i), c).otherwise(code(c))
        )
        return F.array_join(chars, "")
    raise ValueError(f"unknown name mode {mode}")


def adjust_names(df: DataFrame, mode: str, column: str = "topic") -> DataFrame:
    return df.withColumn(column, valid_name(F.col(column), mode))
