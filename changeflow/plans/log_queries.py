"""Queries of positions, offsets, transactions and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.functions import scn as scnf
from changeflow.operators import image, metrics, position as pos, tx
from changeflow.plans import fixtures as fx
from changeflow.plans.registry import CHG, query
from changeflow.sources import offsets

OFF = """WITH off AS (SELECT o_orderkey id, o_custkey c, o_orderdate od FROM orders)
"""


def off(spark, d) -> DataFrame:
    o = fx.table(spark, d, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda x: x.cast("string")
    return o.select(
        k.alias("id"),
        F.when(k % 4 == 0, text(k))
        .when(k % 4 == 1, F.concat(text(k), F.lit(":x:y:3")))
        .when(k % 4 == 2, F.concat(text(k), F.lit(":1:txb-txa"), text(c), F.lit(","), text(k + 7), F.lit(":2:")))
        .otherwise(F.concat(text(k), F.lit(":2")))
        .alias("commit_scn"),
        F.concat(F.lit("tx1:"), text(k), F.lit(",, ,tx2:"), text(c)).alias("pending"),
        F.when(k % 10 == 0, "AAAAAAA=").when(k % 10 == 1, "BQAAAAA=").otherwise(text(k % 120)).alias("instance_id"),
        F.when(k % 9 != 0, k).alias("position_scn"),
        F.when(c % 7 != 0, c).alias("other_scn"),
    )


@query(
    "parse_commit_scn",
    OFF
    + """SELECT id, 0 AS entry_no, 1 AS redo_thread, id AS scn, '' AS txs, CAST(NULL AS STRING) AS bad_entry FROM off WHERE id%4=0
 UNION ALL SELECT id, 0, 3, id, '', NULL FROM off WHERE id%4=1
 UNION ALL SELECT id, 0, 1, id, 'txb-txa'||CAST(c AS STRING), NULL FROM off WHERE id%4=2
 UNION ALL SELECT id, 1, 2, id+7, '', NULL FROM off WHERE id%4=2
 UNION ALL SELECT id, 0, NULL, NULL, NULL, CAST(id AS STRING)||':2' FROM off WHERE id%4=3""",
)
def parse_commit_scn(spark, d):
    rows = pos.parse_commit_scn(off(spark, d).select("id", "commit_scn"))
    return rows.select("id", "entry_no", "redo_thread", F.col("scn").cast("long").alias("scn"), F.array_join("tx_ids", "-").alias("txs"), "bad_entry")


@query(
    "parse_commit_scn_large",
    OFF
    + """SELECT id, '99999999999999'||lpad(CAST(id AS STRING), 12, '0') AS scn, '99999999999999'||lpad(CAST(id AS STRING), 12, '0') AS earliest,
 'tx1:99999999999999'||lpad(CAST(id AS STRING), 12, '0') AS written FROM off""",
)
def parse_commit_scn_large(spark, d):
    """SCNs of 26 digits."""
    large = F.concat(F.lit("99999999999999"), F.lpad(F.col("id").cast("string"), 12, "0"))
    rows = off(spark, d).select("id", F.concat(large, F.lit(":1:")).alias("commit_scn"), F.concat(F.lit("tx1:"), large).alias("pending"))
    rows = pos.pending_tx(pos.parse_commit_scn(rows))
    return rows.select("id", F.col("scn").cast("string").alias("scn"), F.col("earliest_scn").cast("string").alias("earliest"),
                       scnf.pending_text(F.col("pending_map")).alias("written"))


@query(
    "format_commit_scn",
    OFF
    + """SELECT id, CASE id%4 WHEN 0 THEN CAST(id AS STRING)||':1:' WHEN 1 THEN CAST(id AS STRING)||':3:'
 ELSE CAST(id AS STRING)||':1:txa'||CAST(c AS STRING)||'-txb,'||CAST(id+7 AS STRING)||':2:' END AS commit_scn FROM off WHERE id%4<>3""",
)
def format_commit_scn(spark, d):
    return pos.format_commit_scn(pos.parse_commit_scn(off(spark, d).select("id", "commit_scn")), ["id"])


@query(
    "scn_arith",
    OFF
    + """, v AS (SELECT id, CASE WHEN id%9<>0 THEN id END a, CASE WHEN c%7<>0 THEN c END b FROM off)
SELECT id, CAST(CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE a+b END AS BIGINT) AS added,
 CAST(CASE WHEN a IS NULL THEN -b WHEN b IS NULL THEN a ELSE a-b END AS BIGINT) AS diff,
 CAST(CASE WHEN a IS NULL AND b IS NULL THEN 0 WHEN a IS NULL THEN -1 WHEN b IS NULL THEN 1 ELSE sign(a-b) END AS INT) AS cmp FROM v""",
)
def scn_arith(spark, d):
    a, b = F.col("position_scn"), F.col("other_scn")
    return off(spark, d).select(
        "id",
        scnf.scn_add(a, b).cast("long").alias("added"),
        scnf.scn_sub(a, b).cast("long").alias("diff"),
        scnf.scn_cmp(a, b).alias("cmp"),
    )


@query("pending_tx", OFF + "SELECT id, 2 AS n, least(id, c) AS earliest, 'tx1:'||CAST(id AS STRING)||',tx2:'||CAST(c AS STRING) AS written FROM off")
def pending_tx(spark, d):
    rows = pos.pending_tx(off(spark, d))
    return rows.select(
        "id", F.size("pending_map").alias("n"), F.col("earliest_scn").cast("long").alias("earliest"), scnf.pending_text(F.col("pending_map")).alias("written")
    )


def _offset_json(spark, d) -> DataFrame:
    o = off(spark, d)
    k = F.col("id")
    return o.select(
        "id",
        F.to_json(
            F.struct(
                "position_scn",
                (k * 2).cast("string").alias("group_lsn"),
                (k % 1000).alias("group_offset"),
                F.lit(0).alias("batch_row_id"),
                "instance_id",
                F.concat(F.lit("tx1:"), k.cast("string")).alias("snapshot_pending_tx"),
                (k % 3 == 0).alias("snapshot"),
                k.cast("string").alias("snapshot_scn"),
            )
        ).alias("offset"),
    )


@query(
    "read_offsets",
    OFF
    + """SELECT id, CASE WHEN id%9<>0 THEN id END AS scn, CASE WHEN id%9<>0 THEN id*2 END AS lsn, CAST(CASE WHEN id%9<>0 THEN id%1000 END AS INT) AS group_offset,
 CAST(CASE WHEN id%9=0 THEN NULL WHEN id%10=0 THEN 0 WHEN id%10=1 THEN 5 ELSE id%120 END AS INT) AS instance_id, id%3=0 AS snapshot, id AS snapshot_scn FROM off""",
)
def read_offsets(spark, d):
    o = offsets.read_offsets(_offset_json(spark, d))
    return o.select(
        "id",
        F.col("pos.position_scn").alias("scn"),
        F.col("pos.group_lsn").alias("lsn"),
        F.col("pos.group_offset").alias("group_offset"),
        F.col("pos.instance_id").alias("instance_id"),
        "snapshot",
        F.col("snapshot_scn").cast("long").alias("snapshot_scn"),
    )


@query(
    "write_offsets",
    OFF
    + """SELECT id, CASE WHEN id%9<>0 THEN '{"position_scn":'||CAST(id AS STRING)||',"group_lsn":'||CAST(id*2 AS STRING)||',"group_offset":'||CAST(id%1000 AS STRING)
 ||',"batch_row_id":0,"instance_id":"'||CASE WHEN id%10=0 THEN '0' WHEN id%10=1 THEN '5' ELSE CAST(id%120 AS STRING) END||'"' ELSE '{' END
 ||CASE WHEN id%9<>0 THEN ',' ELSE '' END||'"snapshot_scn":"'||CAST(id AS STRING)||'"'
 ||CASE WHEN id%3=0 THEN ',"snapshot":true,"snapshot_completed":false' ELSE '' END||',"snapshot_pending_tx":"tx1:'||CAST(id AS STRING)||'"}' AS written FROM off""",
)
def write_offsets(spark, d):
    return offsets.write_offsets(offsets.read_offsets(_offset_json(spark, d)), "written")


@query(
    "offsets_round_trip",
    OFF
    + """SELECT id, CASE WHEN id%9<>0 THEN id END AS position_scn, CAST('9'||lpad(CAST(id AS STRING), 25, '0') AS STRING) AS stream_start_scn, id%3=0 AS snapshot FROM off""",
)
def offsets_round_trip(spark, d):
    """Written, read, written again and read: nothing is lost, and the stream start may have any size."""
    start = F.concat(F.lit("9"), F.lpad(F.col("id").cast("string"), 25, "0"))
    rows = offsets.read_offsets(_offset_json(spark, d)).withColumn("stream_start_scn", start.cast("decimal(38,0)"))
    for _ in range(2):
        rows = offsets.read_offsets(offsets.write_offsets(rows))
    return rows.select("id", "pos.position_scn", F.col("stream_start_scn").cast("string").alias("stream_start_scn"), "snapshot")


CLOCK = """WITH clock AS (SELECT event_id*10 scn, ts FROM events),
o AS (SELECT o_orderkey k, o_orderkey*7+3 scn FROM orders)
"""


def _scns(spark, d):
    return fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") * 7 + 3).alias("scn"))


@query("scn_to_time", CLOCK + "SELECT k, o.scn, c.ts AS scn_ts FROM o ASOF LEFT JOIN clock c ON o.scn >= c.scn")
def scn_to_time(spark, d):
    return pos.scn_to_time(_scns(spark, d), fx.clock(spark, d))


@query("scn_to_time_merged", CLOCK + "SELECT k, o.scn, c.ts AS scn_ts FROM o ASOF LEFT JOIN clock c ON o.scn >= c.scn")
def scn_to_time_merged(spark, d):
    """The way taken when the clock is not small."""
    return pos.scn_to_time(_scns(spark, d), fx.clock(spark, d), small_limit=0)


TIMES = CLOCK + ", t AS (SELECT event_id, ts + INTERVAL 90 SECOND AS ts FROM events), u AS (SELECT ts, max(scn) scn FROM clock GROUP BY ts) "


@query("time_to_scn", TIMES + "SELECT event_id, t.ts, u.scn AS time_scn FROM t ASOF LEFT JOIN u ON t.ts >= u.ts")
def time_to_scn(spark, d):
    t = fx.table(spark, d, "events").select("event_id", (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("ts"))
    return pos.time_to_scn(t, fx.clock(spark, d))


@query(
    "same_time",
    CLOCK + """, p AS (SELECT k, scn a, CASE WHEN k%5<>0 THEN scn+k%20 END b FROM o)
SELECT k, coalesce(x.ts = y.ts, false) AS same_time FROM (SELECT p.*, c.ts FROM p ASOF LEFT JOIN clock c ON p.a >= c.scn) x
 JOIN (SELECT p.k kk, c.ts FROM p ASOF LEFT JOIN clock c ON p.b >= c.scn) y ON x.k = y.kk""",
)
def same_time(spark, d):
    pairs = _scns(spark, d).select("k", F.col("scn").alias("a"), F.when(F.col("k") % 5 != 0, F.col("scn") + F.col("k") % 20).alias("b"))
    return pos.same_time(pairs, fx.clock(spark, d), "a", "b").select("k", "same_time")


def _handover(shift: int) -> str:
    return f"""WITH clock AS (SELECT event_id*10 scn, ts FROM events), l AS (SELECT max(o_orderkey*7+3) scn FROM orders),
 ddl AS (SELECT max(s_suppkey)*700+{shift} AS scn FROM supplier WHERE s_suppkey%2=0),
 t AS (SELECT l.scn AS head, ddl.scn AS ddl, (SELECT arg_max(ts, clock.scn) FROM clock WHERE clock.scn <= l.scn) AS ht,
  (SELECT arg_max(ts, clock.scn) FROM clock WHERE clock.scn <= ddl.scn) AS dt FROM l, ddl),
 f AS (SELECT *, CASE WHEN head > ddl AND (dt IS NULL OR ht IS DISTINCT FROM dt) THEN head END AS flash FROM t)
SELECT flash AS flash_scn, ddl AS latest_ddl_scn, head AS start_scn, flash + 1 AS stream_scn FROM f"""


for _name, _shift in (("handover_point", 0), ("handover_waits", 1_000_000_000)):

    @query(_name, _handover(_shift))
    def handover_point(spark, d, shift=_shift):
        """With the latest DDL inside the log, and above its head, where there is no flash point yet."""
        log = _scns(spark, d).select(F.col("scn").alias("position_scn"))
        number = F.col("s_suppkey")
        ddl = fx.table(spark, d, "supplier").select(
            (number * 700 + shift).alias("scn"), F.lit("S1").alias("schema_name"), F.concat(F.lit("T"), number.cast("string")).alias("table_name"), "s_suppkey"
        )
        return pos.handover_point(log, ddl.drop("s_suppkey"), ddl.filter(number % 2 == 0), fx.clock(spark, d))


@query(
    "at_or_before",
    """SELECT o_orderkey AS id FROM orders WHERE CASE WHEN o_orderkey%2=0 THEN o_orderkey < 5000 OR (o_orderkey = 5000)
 WHEN o_orderkey%9=0 THEN true ELSE o_orderkey <= 5000 END""",
)
def at_or_before(spark, d):
    k = F.col("o_orderkey")
    whole = k % 2 == 0
    history = fx.table(spark, d, "orders").select(
        k.alias("id"),
        F.when(whole | (k % 9 != 0), k).alias("position_scn"),
        F.when(whole, k * 2).alias("group_lsn"),
        *[F.when(whole, F.lit(0)).alias(c) for c in ("group_offset", "batch_row_id", "instance_id")],
    )
    target = {"position_scn": 5000, "group_lsn": 10_000, "group_offset": 0, "batch_row_id": 0, "instance_id": 0}
    return pos.at_or_before(history, target).select("id")


# ---------------------------------------------------------------- transactions

TX = CHG + ", tx AS (SELECT tx_no, count(*) n, min(scn) f, max(scn) l FROM chg GROUP BY tx_no) "


@query(
    "tx_boundaries",
    TX
    + """, named AS (SELECT 'tx'||CAST(tx_no AS STRING) AS tx_id, tx_no, f, l, n FROM tx UNION ALL SELECT 'empty-tx'||CAST(tx_no AS STRING), tx_no, f, l, 0 FROM tx)
 SELECT tx_id, 'BEGIN' AS status, f AS scn, CAST(NULL AS BIGINT) AS event_count, CAST(NULL AS STRING) AS per_table FROM named
 UNION ALL SELECT tx_id, 'END', l, n, CASE WHEN n > 0 THEN 'S1.ORDERS='||CAST(n AS STRING) ELSE '' END FROM named WHERE tx_no%10<>0""",
)
def tx_boundaries(spark, d):
    """Transactions whose number ends in 0 are not committed; each has a twin without row changes, some records come twice."""
    log = fx.full_log(spark, d)
    marks = log.filter("lcr_type = 'XACT'")
    log = log.unionByName(marks.withColumn("tx_id", F.concat(F.lit("empty-"), "tx_id"))).unionByName(marks.filter("position_scn % 3 = 0"))
    rows = tx.tx_boundaries(log)
    listed = F.transform(F.map_entries("data_collections"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return rows.select("tx_id", "status", F.col("pos.position_scn").alias("scn"), "event_count", F.array_join(listed, ",").alias("per_table"))


@query(
    "tx_order",
    CHG
    + """, t AS (SELECT scn, tx_no, CASE WHEN ok%2=0 THEN 'ORDERS' ELSE 'ODD' END table_name FROM chg WHERE redelivery=0)
SELECT scn, row_number() OVER (PARTITION BY tx_no ORDER BY scn) AS total_order,
 row_number() OVER (PARTITION BY tx_no, table_name ORDER BY scn) AS data_collection_order FROM t""",
)
def tx_order(spark, d):
    log = fx.order_log(spark, d).filter("redelivery = 0")
    k = F.coalesce(F.col("before")["k"], F.col("after")["k"]).cast("long") % 10_000_000
    log = log.withColumn("table_name", F.when(k % 2 == 0, "ORDERS").otherwise("ODD"))
    return tx.tx_order(log).select(F.col("position_scn").alias("scn"), "total_order", "data_collection_order")


@query(
    "tx_order_hot",
    CHG
    + """, t AS (SELECT scn, CASE WHEN scn < 20000000 THEN -1 ELSE tx_no END tx_no FROM chg WHERE redelivery=0)
SELECT scn, row_number() OVER (PARTITION BY tx_no ORDER BY scn) AS total_order FROM t""",
)
def tx_order_hot(spark, d):
    """One load transaction holds half of all rows."""
    log = fx.order_log(spark, d).filter("redelivery = 0")
    log = log.withColumn("tx_id", F.when(F.col("position_scn") < 20_000_000, "load").otherwise(F.col("tx_id")))
    return tx.tx_order(log).select(F.col("position_scn").alias("scn"), "total_order")


@query(
    "tx_complete",
    TX
    + """, c AS (SELECT tx_no, l FROM tx WHERE tx_no%10<>0),
 th AS (SELECT redo_thread t, max(scn) m FROM chg GROUP BY redo_thread UNION ALL SELECT 1, max(scn) FROM chg),
 safe AS (SELECT min(m) s FROM (SELECT t, max(m) m FROM th GROUP BY t))
SELECT chg.scn, chg.dml, count(*) AS n FROM chg JOIN c ON chg.tx_no = c.tx_no AND c.l <= (SELECT s FROM safe) GROUP BY chg.scn, chg.dml""",
)
def tx_complete(spark, d):
    rows = tx.tx_complete(fx.full_log(spark, d))
    return rows.groupBy(F.col("position_scn").alias("scn"), "dml").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- metrics


@query(
    "capture_metrics",
    TX
    + """SELECT 'S1' AS schema_name, 'ORDERS' AS table_name, CAST(count(*) FILTER (WHERE dml='INSERT') AS BIGINT) AS op_c, CAST(0 AS BIGINT) AS op_r,
 count(*) FILTER (WHERE dml='UPDATE') AS op_u, count(*) FILTER (WHERE dml='DELETE') AS op_d, CAST(0 AS BIGINT) AS op_t, count(*) AS processed_rows,
 count(DISTINCT tx_no) AS transactions, (SELECT max(n) FROM tx) AS max_tx_rows, CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS warnings, max(scn) AS last_scn,
 (SELECT count(*) FROM supplier WHERE s_suppkey%3=0) AS unparsable_ddl FROM chg""",
)
def capture_metrics(spark, d):
    s = fx.table(spark, d, "supplier")
    text = F.when(F.col("s_suppkey") % 3 == 0, "ALTER TABLE ORDERS FROBNICATE").otherwise("TRUNCATE TABLE ORDERS")
    ddl = s.select(F.col("s_suppkey").alias("scn"), F.lit("S1").alias("schema_name"), text.alias("ddl_text"))
    return metrics.capture_metrics(image.map_op(fx.order_log(spark, d)), ddl)


@query(
    "lag_report",
    CLOCK
    + """, e AS (SELECT k, o.scn, c.ts, (SELECT max(ts) FROM events) + INTERVAL 1 HOUR AS now FROM o ASOF LEFT JOIN clock c ON o.scn >= c.scn)
SELECT 'ORDERS' AS table_name, count(*) AS events, round(max(epoch_us(now)-epoch_us(ts))/1000.0, 3) AS max_lag_ms, max(scn) AS last_scn,
 (SELECT max(scn) FROM clock) AS head_scn, (SELECT max(scn) FROM clock) - max(scn) AS scn_distance FROM e""",
)
def lag_report(spark, d):
    clock = fx.clock(spark, d)
    now = clock.agg((F.max("ts") + F.expr("INTERVAL 1 HOUR")).alias("now")).withColumn("__k", F.lit(1))
    events = _scns(spark, d).select(
        "k", F.col("scn").alias("position_scn"), F.lit("S1").alias("schema_name"), F.lit("ORDERS").alias("table_name"), F.lit(1).alias("__k")
    )
    events = events.join(F.broadcast(now), "__k").drop("__k")
    return metrics.lag_report(events, clock, "now").select(
        "table_name", "events", F.round("max_lag_ms", 3).alias("max_lag_ms"), "last_scn", "head_scn", "scn_distance"
    )
