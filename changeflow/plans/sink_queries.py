"""Queries of routing and formatting."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.operators import image
from changeflow.plans import fixtures as fx
from changeflow.plans.registry import CHG, query
from changeflow.plans.state_queries import PK, SRC
from changeflow.session import shared_dir
from changeflow.sinks import routing


def _events(spark, d):
    return image.split_key_change(image.complete_after(image.map_op(fx.order_log(spark, d))), PK)


def _enveloped(spark, d):
    return image.build_envelope(image.build_source(_events(spark, d), "srv"))


@query("route_by_table", CHG + "SELECT 'srv.S1.T'||CAST(redo_thread AS STRING) AS topic, count(*) AS n FROM chg GROUP BY 1")
def route_by_table(spark, d):
    log = fx.order_log(spark, d).withColumn("table_name", F.concat(F.lit("T"), F.col("redo_thread").cast("string")))
    return routing.route_by_table(log, "srv").groupBy("topic").agg(F.count("*").alias("n"))


@query("write_by_topic", CHG + "SELECT 'srv.S1.T'||CAST(redo_thread AS STRING) AS topic, count(*) AS n FROM chg GROUP BY 1")
def write_by_topic(spark, d):
    log = fx.order_log(spark, d).withColumn("table_name", F.concat(F.lit("T"), F.col("redo_thread").cast("string")))
    path = shared_dir(spark, "topics")
    routing.write_by_topic(routing.route_by_table(log, "srv"), path)
    return spark.read.parquet(path).groupBy("topic").agg(F.count("*").alias("n"))


@query(
    "outbox_route",
    """SELECT CAST(event_id AS STRING) AS message_id, CAST(user_id AS STRING) AS message_key, ts AS message_ts,
 CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'outbox.event.'||event_type AS topic FROM events WHERE event_id%3<>0""",
)
def outbox_route(spark, d):
    e = fx.table(spark, d, "events")
    text = lambda c: F.col(c).cast("string")
    after = F.create_map(
        F.lit("ID"), text("event_id"), F.lit("AGGREGATETYPE"), text("event_type"), F.lit("OWNER"), text("user_id"),
        F.lit("TYPE"), text("event_type"), F.lit("PAYLOAD"), text("props"), F.lit("TIMESTAMP"), text("ts"),
    )
    events = e.select(
        # updates of the outbox table are no messages
        F.when(F.col("event_id") % 3 == 0, "u").otherwise("c").alias("op"), F.lit("S1").alias("schema_name"), F.lit("OUTBOX").alias("table_name"),
        after.alias("after"), F.col("ts").alias("commit_ts"),
    )
    cfg = {"event_key": "OWNER", "event_timestamp": "TIMESTAMP"}
    rows = routing.outbox_route(events, "s1.outbox", cfg, payload_schema="k long")
    return rows.select("message_id", "message_key", "message_ts", "payload.k", "topic")


@query(
    "cloud_events",
    CHG
    + f"""SELECT 'name:srv;scn:'||CAST(scn AS STRING)||';commit_scn:null;lcr_position:'||{SRC} AS id, '/srv' AS source, CAST(scn AS STRING) AS ext_scn,
 CAST(NULL AS STRING) AS ext_commit_scn, {SRC} AS ext_lcr_position, op FROM (
 SELECT scn, CASE WHEN scn-ok=40000000 THEN 'c' WHEN dml='INSERT' THEN 'c' WHEN dml='UPDATE' THEN 'u' ELSE 'd' END AS op FROM chg
 UNION ALL SELECT scn, 'd' FROM chg WHERE scn-ok=40000000)""",
)
def cloud_events(spark, d):
    """A change of key is two events of one id: a delete and an insert."""
    rows = routing.cloud_events(_enveloped(spark, d), "/srv")
    return rows.select("id", "source", "ext_scn", "ext_commit_scn", "ext_lcr_position", F.get_json_object("data", "$.op").alias("op"))


@query(
    "event_key",
    CHG
    + """SELECT scn, 0 AS sub, '{"k":"'||CAST(coalesce(f_k,b_k) AS STRING)||'"}' AS event_key FROM img WHERE scn-ok<>40000000
 UNION ALL SELECT scn, 0, '{"k":"'||CAST(b_k AS STRING)||'"}' FROM img WHERE scn-ok=40000000
 UNION ALL SELECT scn, 1, '{"k":"'||CAST(f_k AS STRING)||'"}' FROM img WHERE scn-ok=40000000""",
)
def event_key(spark, d):
    return routing.event_key(_events(spark, d), PK).select(F.col("position_scn").alias("scn"), "sub", "event_key")


@query(
    "event_key_custom",
    CHG
    + """SELECT scn, 0 AS sub, '{"st":"'||coalesce(f_st,b_st)||'"}' AS event_key FROM img
 UNION ALL SELECT scn, 1, '{"st":"'||f_st||'"}' FROM img WHERE scn-ok=40000000""",
)
def event_key_custom(spark, d):
    rows = routing.event_key(_events(spark, d), PK, {"S1.ORDERS": ["st"]})
    return rows.select(F.col("position_scn").alias("scn"), "sub", "event_key")


@query(
    "tombstones",
    CHG
    + """, d AS (SELECT count(*) n FROM img WHERE dml='DELETE' OR scn-ok=40000000)
SELECT op, tombstone, count(*) AS n, count(*) FILTER (WHERE NOT tombstone) AS with_value FROM (
 SELECT CASE WHEN scn-ok=40000000 THEN 'c' WHEN dml='INSERT' THEN 'c' WHEN dml='UPDATE' THEN 'u' ELSE 'd' END op, false tombstone FROM img
 UNION ALL SELECT 'd', false FROM img WHERE scn-ok=40000000 UNION ALL SELECT 'd', true FROM img WHERE dml='DELETE' OR scn-ok=40000000) GROUP BY op, tombstone""",
)
def tombstones(spark, d):
    rows = routing.tombstones(_enveloped(spark, d))
    return rows.groupBy("op", "tombstone").agg(F.count("*").alias("n"), F.count("value").alias("with_value"))
