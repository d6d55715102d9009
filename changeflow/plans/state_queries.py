"""Queries over the change log of the orders table: positions, images, table content."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.model import position
from changeflow.operators import apply, image, position as pos
from changeflow.plans import fixtures as fx
from changeflow.plans.registry import CHG, STATE, query, state_at

COLUMNS = {"k": "long", "st": "string", "p": "double", "pr": "string"}
PK = ["k"]
RESUME = {"position_scn": 20_001_000, "group_lsn": 0, "group_offset": 0, "batch_row_id": 0, "instance_id": 0}


def _state(rows: DataFrame) -> DataFrame:
    return apply.typed(rows, COLUMNS)


def _complete(spark, d) -> DataFrame:
    return image.complete_after(image.map_op(fx.order_log(spark, d)))


@query("current_state", STATE)
def current_state(spark, d):
    return _state(apply.current_state(fx.order_log(spark, d), PK))


for _scn in (15_000_000, 25_000_000, 45_000_000):

    @query(f"current_state_snapshot_{_scn}", STATE)
    def current_state_snapshot(spark, d, scn=_scn):
        snap = apply.snapshot_events(fx.order_snapshot(spark, d, scn), fx.SCHEMA, "ORDERS", PK, scn)
        return _state(apply.current_state(fx.order_log(spark, d), PK, snapshot=snap, from_scn=scn + 1))

    @query(f"as_of_scn_{_scn}", state_at(_scn))
    def as_of_scn(spark, d, scn=_scn):
        return _state(apply.as_of_scn(fx.order_log(spark, d), PK, scn))


TRUNC_SQL = "SELECT c_custkey AS k, c_name AS nm FROM customer WHERE c_custkey%2=0"


@query("current_state_truncate", TRUNC_SQL)
def current_state_truncate(spark, d):
    log = fx.truncate_log(spark, d)
    rows = apply.current_state(log, PK, floors=apply.truncate_floor(log))
    return apply.typed(rows, {"k": "long", "nm": "string"})


@query(
    "history_scd",
    CHG
    + """, ev AS (
 SELECT scn, 0 sub, f_k k, f_st st, f_p p, f_pr pr, dml FROM img WHERE redelivery=0 AND dml<>'DELETE' AND scn-ok<>40000000
 UNION ALL SELECT scn, 0, b_k, NULL, NULL, NULL, 'DELETE' FROM img WHERE redelivery=0 AND (dml='DELETE' OR scn-ok=40000000)
 UNION ALL SELECT scn, 1, f_k, f_st, f_p, f_pr, 'INSERT' FROM img WHERE redelivery=0 AND scn-ok=40000000),
l AS (SELECT *, lead(scn) OVER (PARTITION BY k ORDER BY scn, sub) valid_to FROM ev)
SELECT k, st, p, pr, scn valid_from, valid_to FROM l WHERE dml<>'DELETE'""",
)
def history_scd(spark, d):
    rows = apply.history_scd(fx.order_log(spark, d), PK)
    return rows.select(
        *[F.col("after")[c].cast(t).alias(c) for c, t in COLUMNS.items()], "valid_from", "valid_to"
    )


@query("with_position", CHG + "SELECT tx_no, max(scn) AS max_scn, max(scn)*2 AS max_lsn FROM chg GROUP BY tx_no")
def with_position(spark, d):
    log = pos.with_position(fx.order_log(spark, d))
    top = log.groupBy("tx_id").agg(F.max("pos").alias("pos"))
    return top.select(
        F.regexp_extract("tx_id", r"(\d+)", 1).cast("long").alias("tx_no"),
        F.col("pos.position_scn").alias("max_scn"),
        F.col("pos.group_lsn").alias("max_lsn"),
    )


@query(
    "resume_filter",
    CHG
    + f""", tx AS (SELECT tx_no, min(scn) f, max(scn) l FROM chg GROUP BY tx_no),
logx AS (SELECT 'DML' lcr_type, dml, scn FROM chg UNION ALL SELECT 'XACT', 'BEGIN', f FROM tx
 UNION ALL SELECT 'XACT', 'COMMIT', l FROM tx WHERE tx_no%10<>0
 UNION ALL SELECT 'METADATA', NULL, o_orderkey+10000000 FROM orders WHERE o_orderkey%100=0
 UNION ALL SELECT 'CHUNK', NULL, o_orderkey+10000000 FROM orders WHERE o_orderkey%100=1)
SELECT lcr_type, dml, count(*) AS n, min(scn) AS lo FROM logx
WHERE scn >= {RESUME['position_scn']} OR lcr_type IN ('METADATA','CHUNK') OR dml='BEGIN' GROUP BY lcr_type, dml""",
)
def resume_filter(spark, d):
    kept = pos.resume_filter(fx.full_log(spark, d), RESUME)
    return kept.groupBy("lcr_type", "dml").agg(F.count("*").alias("n"), F.min("position_scn").alias("lo"))


@query("dedup_replay", CHG + "SELECT scn, dml, ok AS k FROM chg WHERE redelivery=0")
def dedup_replay(spark, d):
    once = pos.dedup_replay(fx.order_log(spark, d))
    k = F.when(F.col("dml") == "INSERT", F.col("after")["k"]).otherwise(F.col("before")["k"]).cast("long")
    k = F.when((F.col("dml") == "DELETE") & (k >= 10_000_000), k - 10_000_000).otherwise(k)
    return once.select(F.col("position_scn").alias("scn"), "dml", k.alias("k"))


@query(
    "order_guard",
    CHG
    + """, applied AS (SELECT ok%50 g, max(scn) a FROM chg WHERE scn < 20000000 GROUP BY ok%50)
SELECT chg.ok%50 AS g, count(*) FILTER (WHERE scn > a) AS passed, count(*) FILTER (WHERE scn <= a) AS late
FROM chg JOIN applied ON chg.ok%50 = applied.g GROUP BY chg.ok%50""",
)
def order_guard(spark, d):
    """Replays a log against positions applied up to an earlier point; one group per 50 keys."""
    ok = F.coalesce(F.col("after")["k"], F.col("before")["k"]).cast("long") % 10_000_000
    # before the key change keeps the old number, the key change event carries it in ``before``
    old = F.coalesce(F.col("before")["k"], F.col("after")["k"]).cast("long")
    log = fx.order_log(spark, d).withColumn("g", F.when(old >= 10_000_000, old - 10_000_000).otherwise(old) % 50)
    applied = pos.applied_positions(log.filter("position_scn < 20000000"), ["g"])
    passed, late = pos.order_guard_batch(log, applied, ["g"])
    both = passed.select("g", F.lit(1).alias("ok"), F.lit(0).alias("l")).unionByName(
        late.select("g", F.lit(0).alias("ok"), F.lit(1).alias("l"))
    )
    return both.groupBy("g").agg(F.sum("ok").alias("passed"), F.sum("l").alias("late"))


@query("resume_position", CHG + "SELECT redo_thread, max(scn) AS scn, max(scn)*2 AS lsn FROM chg GROUP BY redo_thread HAVING max(scn) > 50000000")
def resume_position(spark, d):
    rows = pos.resume_position(fx.order_log(spark, d), {"position_scn": 50_000_000}, by=("redo_thread",))
    return rows.select("redo_thread", F.col("pos.position_scn").alias("scn"), F.col("pos.group_lsn").alias("lsn"))


@query(
    "commit_watermark",
    CHG
    + """, t AS (SELECT redo_thread, max(scn) commit_scn FROM chg GROUP BY redo_thread)
SELECT redo_thread, commit_scn, (SELECT max(commit_scn) FROM t) AS max_scn, (SELECT min(commit_scn) FROM t) AS safe_scn,
 CAST(sign((SELECT min(commit_scn) FROM t) - 50000000) AS INT) AS vs FROM t""",
)
def commit_watermark(spark, d):
    return pos.commit_watermark(fx.order_log(spark, d), F.lit(50_000_000))


@query("split_records", CHG + """, tx AS (SELECT DISTINCT tx_no FROM chg)
SELECT 'DML' AS lcr_type, (SELECT count(*) FROM chg) AS n
UNION ALL SELECT 'XACT', (SELECT count(*) + count(*) FILTER (WHERE tx_no%10<>0) FROM tx)
UNION ALL SELECT 'CHUNK', (SELECT count(*) FROM orders WHERE o_orderkey%100=1)
UNION ALL SELECT 'METADATA', (SELECT count(*) FROM orders WHERE o_orderkey%100=0)""")
def split_records(spark, d):
    parts = image.split_records(fx.full_log(spark, d))
    out = None
    for kind in ("DML", "XACT", "CHUNK", "METADATA"):
        one = parts[kind].groupBy("lcr_type").agg(F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "map_op",
    CHG
    + """SELECT CASE dml WHEN 'INSERT' THEN 'c' WHEN 'UPDATE' THEN 'u' WHEN 'DELETE' THEN 'd' END AS op,
 CAST(NULL AS STRING) AS op_error, count(*) AS n FROM chg GROUP BY 1
 UNION ALL SELECT NULL, 'unexpected command: BEGIN', count(DISTINCT tx_no) FROM chg
 UNION ALL SELECT NULL, 'unexpected command: COMMIT', count(DISTINCT tx_no) FROM chg WHERE tx_no%10<>0
 UNION ALL SELECT NULL, 'unexpected command: none', count(*) FROM orders WHERE o_orderkey%100 IN (0,1)""",
)
def map_op(spark, d):
    return image.map_op(fx.full_log(spark, d)).groupBy("op", "op_error").agg(F.count("*").alias("n"))


@query(
    "complete_after",
    CHG + "SELECT scn, dml, f_k AS k, f_st AS st, f_p AS p, f_pr AS pr FROM img",
)
def complete_after(spark, d):
    rows = _complete(spark, d)
    return rows.select(
        F.col("position_scn").alias("scn"), "dml", *[F.col("after")[c].cast(t).alias(c) for c, t in COLUMNS.items()]
    )


@query(
    "complete_after_unknown_presence",
    CHG + "SELECT scn, CASE WHEN scn-ok=30000000 THEN b_pr ELSE f_pr END AS pr FROM img WHERE dml='UPDATE'",
)
def complete_after_unknown(spark, d):
    log = image.map_op(fx.order_log(spark, d)).filter("dml = 'UPDATE'")
    return image.complete_after(log, presence_known=False).select(
        F.col("position_scn").alias("scn"), F.col("after")["pr"].alias("pr")
    )


@query(
    "split_key_change",
    CHG
    + """SELECT scn, 0 AS sub, CASE dml WHEN 'INSERT' THEN 'c' WHEN 'UPDATE' THEN 'u' ELSE 'd' END AS op,
 coalesce(f_k, b_k) AS key, f_p AS p FROM img WHERE scn-ok<>40000000
 UNION ALL SELECT scn, 0, 'd', b_k, NULL FROM img WHERE scn-ok=40000000
 UNION ALL SELECT scn, 1, 'c', f_k, f_p FROM img WHERE scn-ok=40000000""",
)
def split_key_change(spark, d):
    rows = image.split_key_change(_complete(spark, d), PK)
    return rows.select(
        F.col("position_scn").alias("scn"),
        "sub",
        "op",
        F.col("key")[0].cast("long").alias("key"),
        F.col("after")["p"].cast("double").alias("p"),
    )


def _with_noops(spark, d) -> DataFrame:
    """Adds, per order with k%17=0, an update that repeats the old values and one that carries none."""
    log = fx.order_log(spark, d)
    base = log.filter((F.col("dml") == "INSERT") & (F.col("redelivery") == 0) & (F.col("after")["k"].cast("long") % 17 == 0))
    repeat = base.withColumn("dml", F.lit("UPDATE")).withColumn("before", F.col("after")).withColumn(
        "position_scn", F.col("position_scn") + 1_000_000
    )
    empty = repeat.withColumn("after", F.map_filter("after", lambda c, v: F.lit(False))).withColumn(
        "position_scn", F.col("position_scn") + 1_000_000
    )
    return image.map_op(log.unionByName(repeat).unionByName(empty))


@query(
    "drop_empty_updates",
    CHG
    + """SELECT dml, count(*) AS n FROM (SELECT dml FROM chg UNION ALL SELECT 'UPDATE' FROM orders WHERE o_orderkey%17=0) GROUP BY dml""",
)
def drop_empty_updates(spark, d):
    return image.drop_empty_updates(_with_noops(spark, d)).groupBy("dml").agg(F.count("*").alias("n"))


@query(
    "drop_unchanged",
    CHG + "SELECT dml, count(*) AS n FROM img WHERE NOT (dml='UPDATE' AND f_k IS NOT DISTINCT FROM b_k AND f_st IS NOT DISTINCT FROM b_st AND f_p IS NOT DISTINCT FROM b_p AND f_pr IS NOT DISTINCT FROM b_pr) GROUP BY dml",
)
def drop_unchanged(spark, d):
    rows = image.drop_unchanged(image.complete_after(_with_noops(spark, d)))
    return rows.groupBy("dml").agg(F.count("*").alias("n"))


@query(
    "truncate_events",
    "SELECT 20000000+s_suppkey AS scn, 'S1' AS schema_name, 'T'||CAST(s_suppkey AS STRING) AS table_name, 't' AS op, 1 AS no_images FROM supplier",
)
def truncate_events(spark, d):
    rows = image.truncate_events(fx.supplier_truncates(spark, d))
    no = (F.col("before").isNull() & F.col("after").isNull()).cast("int")
    return rows.select(F.col("position_scn").alias("scn"), "schema_name", "table_name", "op", no.alias("no_images"))


SRC = """concat(CAST(scn AS STRING),'.',CAST(scn*2 AS STRING),'.',CAST(scn%1000 AS STRING),'.0.1')"""


@query(
    "build_envelope",
    CHG
    + f"""SELECT scn, CASE dml WHEN 'INSERT' THEN 'c' WHEN 'UPDATE' THEN 'u' ELSE 'd' END AS op,
 b_k AS before_k, f_k AS after_k, f_pr AS after_pr, 'srv' AS src_name, 'S1' AS src_schema, 'ORDERS' AS src_table,
 {SRC} AS src_position, CAST(epoch_us(od)//1000 + CAST(floor(scn/10000000) AS BIGINT)*1000 AS BIGINT) AS ts_ms FROM img""",
)
def build_envelope(spark, d):
    v = image.build_envelope(image.build_source(_complete(spark, d), "srv")).select("value")
    return v.select(
        F.col("value.source.position_scn").alias("scn"),
        F.col("value.op").alias("op"),
        F.col("value.before")["k"].cast("long").alias("before_k"),
        F.col("value.after")["k"].cast("long").alias("after_k"),
        F.col("value.after")["pr"].alias("after_pr"),
        F.col("value.source.name").alias("src_name"),
        F.col("value.source.schema").alias("src_schema"),
        F.col("value.source.table").alias("src_table"),
        F.col("value.source.lcr_position").alias("src_position"),
        F.col("value.ts_ms").alias("ts_ms"),
    )


@query(
    "build_source",
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey%4=0 THEN NULL WHEN o_orderkey%4=1 THEN 'S1' WHEN o_orderkey%4=2 THEN 'S1' ELSE 'S1,S2' END AS src_schema,
 CASE WHEN o_orderkey%4=0 THEN NULL WHEN o_orderkey%4=1 THEN 'A' WHEN o_orderkey%4=2 THEN 'A,B' ELSE 'A,B' END AS src_table,
 'tx'||CAST(o_custkey AS STRING) AS tx, CAST(o_orderkey AS STRING) AS scn FROM orders""",
)
def build_source(spark, d):
    o = fx.table(spark, d, "orders")
    k = F.col("o_orderkey") % 4
    tid = lambda s, t: F.struct(F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"))
    a, b1, b2 = tid("S1", "A"), tid("S1", "B"), tid("S2", "B")
    none = F.lit(None).cast("struct<schema_name:string,table_name:string>")
    ids = (
        F.when(k == 0, F.array(none)).when(k == 1, F.array(a, none)).when(k == 2, F.array(a, b1)).otherwise(F.array(a, b2))
    )
    events = o.select(
        "o_orderkey",
        ids.alias("table_ids"),
        F.concat(F.lit("tx"), F.col("o_custkey").cast("string")).alias("tx_id"),
        F.col("o_orderkey").alias("position_scn"),
        F.lit(1).alias("group_lsn"),
        F.lit(0).alias("group_offset"),
        F.lit(0).alias("batch_row_id"),
        F.lit(1).alias("instance_id"),
        F.col("o_orderdate").alias("commit_ts"),
    )
    return image.build_source(events, "srv").select(
        F.col("o_orderkey").alias("k"),
        F.col("source.schema").alias("src_schema"),
        F.col("source.table").alias("src_table"),
        F.col("source.txId").alias("tx"),
        F.col("source.scn").alias("scn"),
    )


@query(
    "source_hook",
    CHG + "SELECT scn, 'unit-'||CAST(redo_thread AS STRING) AS unit FROM chg",
)
def source_hook(spark, d):
    maker = lambda df: F.struct(F.concat(F.lit("unit-"), F.col("redo_thread").cast("string")).alias("unit"))
    return image.build_source(fx.order_log(spark, d), "srv", maker=maker).select(
        F.col("position_scn").alias("scn"), "source.unit"
    )


@query(
    "event_metadata",
    CHG
    + """SELECT CAST(scn AS STRING) AS event_scn, 'tx'||CAST(tx_no AS STRING) AS event_tx,
 od + CAST(floor(scn/10000000) AS INT) * INTERVAL 1 SECOND AS event_ts FROM chg WHERE scn%2=0
 UNION ALL SELECT NULL, NULL, NULL FROM chg WHERE scn%2<>0""",
)
def event_metadata(spark, d):
    env = image.build_envelope(image.build_source(_complete(spark, d), "srv"))
    half = env.select(F.when(F.col("position_scn") % 2 == 0, F.col("value")).alias("value"))
    return image.event_metadata(half)


def _drift(spark, d):
    log = fx.order_log(spark, d).withColumn(
        "after",
        F.when(
            F.col("position_scn") % 10 == 0,
            F.map_concat("after", F.create_map(F.lit("extra"), F.lit("1"), F.lit("gone"), F.lit("2"))),
        ).otherwise(F.col("after")),
    )
    tables = log.groupBy("schema_name", "table_name").agg(F.count("*").alias("n"))
    schemas = tables.select(
        "schema_name",
        "table_name",
        F.array(*[F.lit(c) for c in ("k", "pr", "p", "never")]).alias("columns"),
        F.array(F.lit("gone")).alias("deleted"),
    )
    return log, schemas


@query(
    "align_columns",
    CHG
    + """SELECT scn, CASE WHEN dml='INSERT' THEN 'k,pr,p' WHEN dml='DELETE' THEN '' WHEN scn-ok=20000000 THEN 'p' WHEN scn-ok=30000000 THEN 'pr' ELSE 'k' END AS after_cols,
 CASE WHEN scn%10=0 AND NOT (dml='INSERT' OR dml='UPDATE' OR dml='DELETE') THEN '' WHEN scn%10=0 THEN 'extra,st' ELSE 'st' END AS drift FROM chg""",
)
def align_columns(spark, d):
    log, schemas = _drift(spark, d)
    rows = image.align_columns(log, schemas)
    return rows.select(
        F.col("position_scn").alias("scn"),
        F.array_join(F.map_keys("after"), ",").alias("after_cols"),
        F.array_join(F.array_sort("drift"), ",").alias("drift"),
    )


@query(
    "drift_report",
    CHG
    + """SELECT 'ORDERS' AS table_name, 'extra,gone,st' AS unknown_columns, 'never' AS missing_columns, count(*) AS events, count(*) AS drift_events FROM chg""",
)
def drift_report(spark, d):
    log, schemas = _drift(spark, d)
    r = image.drift_report(log, schemas)
    return r.select(
        "table_name",
        F.array_join("unknown_columns", ",").alias("unknown_columns"),
        F.array_join("missing_columns", ",").alias("missing_columns"),
        "events",
        "drift_events",
    )
