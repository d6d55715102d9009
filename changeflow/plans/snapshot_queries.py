"""Queries of snapshots, capture filters, chunks and incremental snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.operators import apply, image, incremental, metrics, position as pos
from changeflow.plans import fixtures as fx
from changeflow.plans.registry import CHG, STATE, query, state_at
from changeflow.plans.state_queries import COLUMNS, PK
from changeflow.sources import capture as cap, keyset, signals as sig, snapshot as snap

TS = "2024-01-01 00:00:00"


def _ts():
    return F.lit(TS).cast("timestamp")


def _state_as_of(spark, d):
    """The orders table as a function of the SCN (null = latest), rebuilt from its log."""
    log = fx.order_log(spark, d)

    def at(scn: int | None) -> DataFrame:
        rows = apply.current_state(log, PK) if scn is None else apply.as_of_scn(log, PK, scn)
        return apply.typed(rows, COLUMNS)

    return at


@query(
    "snapshot_read",
    f"""SELECT 'r' AS op, 'ORDERS' AS table_name, o_orderkey AS k, CAST(77 AS BIGINT) AS scn, TIMESTAMP '{TS}' AS ts, true AS no_before FROM orders
 UNION ALL SELECT 'r', 'CUSTOMER', c_custkey, 77, TIMESTAMP '{TS}', true FROM customer""",
)
def snapshot_read(spark, d):
    tables = {"S1.ORDERS": fx.table(spark, d, "orders"), "S1.CUSTOMER": fx.table(spark, d, "customer")}
    rows = snap.snapshot_read(spark, tables, 77, _ts())
    return rows.select(
        "op", "table_name", F.coalesce(F.col("after")["o_orderkey"], F.col("after")["c_custkey"]).cast("long").alias("k"),
        F.col("position_scn").alias("scn"), F.col("commit_ts").alias("ts"), F.col("before").isNull().alias("no_before"),
    )


@query("snapshot_override", f"SELECT k, st FROM ({state_at(25_000_000)}) WHERE st = 'F' AND p > 100000")
def snapshot_override(spark, d):
    sql = "SELECT k, st FROM S1.ORDERS${AS_OF_SCN} WHERE st = 'F' AND p > 100000"
    return snap.snapshot_override(spark, sql, 25_000_000, {"S1.ORDERS": _state_as_of(spark, d)})


@query(
    "snapshot_override_mixed",
    f"SELECT a.k, a.p AS old_p, b.p AS new_p FROM ({state_at(15_000_000)}) a JOIN ({STATE}) b ON a.k = b.k WHERE a.p <> b.p",
)
def snapshot_override_mixed(spark, d):
    sql = "SELECT a.k, a.p AS old_p, b.p AS new_p FROM S1.ORDERS${AS_OF_SCN} a JOIN S1.ORDERS b ON a.k = b.k WHERE a.p <> b.p"
    return snap.snapshot_override(spark, sql, 15_000_000, {"S1.ORDERS": _state_as_of(spark, d)})


@query(
    "capture_filter",
    """SELECT 'S1' AS schema_name, 'T'||CAST(c_custkey AS STRING) AS table_name FROM customer WHERE c_custkey%4=0 AND c_custkey%10<>6
 AND CAST(c_custkey AS STRING) NOT LIKE '1%'""",
)
def capture_filter(spark, d):
    k = F.col("c_custkey")
    tables = fx.table(spark, d, "customer").select(
        F.when(k % 4 == 0, "S1").when(k % 4 == 1, "SYS").when(k % 4 == 2, "MDSYS").otherwise("S2").alias("schema_name"),
        F.concat(F.lit("T"), k.cast("string")).alias("table_name"),
    )
    return cap.capture_filter(tables, include=r"s1\.T\d+", exclude=r"S1\.T1.*, s1\.t\d*6")


@query("captured_only", CHG + "SELECT dml, count(*) AS n FROM chg WHERE redo_thread = 2 GROUP BY dml")
def captured_only(spark, d):
    log = fx.order_log(spark, d).withColumn("table_name", F.concat(F.lit("T"), F.col("redo_thread").cast("string")))
    tables = log.select("schema_name", "table_name").distinct().filter("table_name = 'T2'")
    return cap.captured_only(log, tables).groupBy("dml").agg(F.count("*").alias("n"))


@query(
    "column_filter",
    CHG + "SELECT scn, CASE WHEN dml='INSERT' THEN 'k,st' WHEN scn-ok=40000000 THEN 'k' ELSE '' END AS cols FROM chg",
)
def column_filter(spark, d):
    rows = cap.column_filter(fx.order_log(spark, d), include=r"S1\.ORDERS\.(k|st|p)", exclude=r".*\.P")
    return rows.select(F.col("position_scn").alias("scn"), F.array_join(F.map_keys("after"), ",").alias("cols"))


@query("column_filter_flat", "SELECT o_orderkey, o_orderstatus FROM orders")
def column_filter_flat(spark, d):
    return cap.column_filter(fx.table(spark, d, "orders"), include=r"S1\.ORDERS\.o_order(key|status|date)", exclude=r".*date", table="S1.ORDERS")


@query(
    "keyset_page",
    """SELECT o_orderkey, o_custkey FROM orders WHERE (o_custkey > 5 OR (o_custkey = 5 AND o_orderkey > 100)) AND o_orderstatus = 'F'
 ORDER BY o_custkey, o_orderkey LIMIT 250""",
)
def keyset_page(spark, d):
    return keyset.keyset_page(
        fx.table(spark, d, "orders"), ["o_orderkey", "o_custkey"], ["o_custkey", "o_orderkey"], 250, after=(5, 100), extra="o_orderstatus = 'F'"
    )


@query("keyset_chunks", "SELECT o_orderkey AS k, CAST((row_number() OVER (ORDER BY o_orderkey)-1)//700 AS BIGINT) AS chunk_id FROM orders")
def keyset_chunks(spark, d):
    rows = keyset.keyset_chunks(fx.table(spark, d, "orders"), ["o_orderkey"], 700)
    return rows.select(F.col("o_orderkey").alias("k"), "chunk_id")


_TYPED_KEYS = {
    "decimal": ("CAST(o_orderkey AS DECIMAL(38,0))", ["o_orderkey"]),
    "time": ("CAST(o_orderdate AS TIMESTAMP)", ["o_orderdate", "o_orderkey"]),
    "text": ("lpad(CAST(o_orderkey AS STRING), 12, '0')", ["o_orderkey"]),
    "fraction": ("CAST(o_orderkey AS DOUBLE) / 8", ["o_orderkey"]),
}


@query(
    "keyset_chunks_types",
    " UNION ALL ".join(f"SELECT '{kind}' AS kind, o_orderkey AS k, CAST((row_number() OVER (ORDER BY {', '.join(order)})-1)//700 AS BIGINT) AS chunk_id FROM orders"
                       for kind, (_, order) in _TYPED_KEYS.items()),
)
def keyset_chunks_types(spark, d):
    """Chunks by decimal, time, text and floating-point keys."""
    orders, out = fx.table(spark, d, "orders"), None
    for kind, (key, order) in _TYPED_KEYS.items():
        rows = keyset.keyset_chunks(orders.withColumn("key", F.expr(key)), ["key", *order[1:]], 700)
        rows = rows.select(F.lit(kind).alias("kind"), F.col("o_orderkey").alias("k"), "chunk_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "chunk_bounds",
    """WITH c AS (SELECT *, CAST((row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber)-1)//5000 AS BIGINT) AS chunk_id FROM lineitem)
SELECT chunk_id, min(l_orderkey) AS low_order, max(l_orderkey) AS high_order, count(*) AS rows FROM c GROUP BY chunk_id""",
)
def chunk_bounds(spark, d):
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    b = keyset.chunk_bounds(keyset.keyset_chunks(fx.table(spark, d, "lineitem"), key, 5000), key)
    return b.select("chunk_id", F.col("low_key.l_orderkey").alias("low_order"), F.col("high_key.l_orderkey").alias("high_order"), "rows")


def _signals(spark, d) -> DataFrame:
    """A request per customer: incremental for ORDERS, some with a condition; blocking for SUPPLIER; others unrelated."""
    k = F.col("c_custkey")
    data = (
        F.when(k % 4 == 0, '{"data-collections":["db.S1.ORDERS"],"type":"incremental"}')
        .when(
            k % 4 == 1,
            '{"data-collections":["db.s1.orders","S1.PART"],"type":"INCREMENTAL","additional-conditions":'
            '[{"data-collection":"S1.ORDERS","filter":"o_orderstatus = \'F\'"}]}',
        )
        .when(k % 4 == 2, '{"data-collections":["S1.SUPPLIER"],"type":"blocking"}')
        .otherwise('{"message":"hello"}')
    )
    return fx.table(spark, d, "customer").select(
        F.concat(F.lit("s"), k.cast("string")).alias("id"), F.when(k % 4 == 3, "log").otherwise("execute-snapshot").alias("type"), data.alias("data")
    )


@query(
    "signal_read",
    """WITH c AS (SELECT c_custkey k, 's'||CAST(c_custkey AS STRING) id FROM customer)
SELECT id, 'incremental' AS snapshot_type, 'S1.ORDERS' AS "table", CASE WHEN k%4=1 THEN 'o_orderstatus = ''F''' END AS condition FROM c WHERE k%4 IN (0,1)
 UNION ALL SELECT id, 'incremental', 'S1.PART', NULL FROM c WHERE k%4=1 UNION ALL SELECT id, 'blocking', 'S1.SUPPLIER', NULL FROM c WHERE k%4=2""",
)
def signal_read(spark, d):
    return sig.signal_read(_signals(spark, d))


@query("signals_from_log", "SELECT 's'||CAST(c_custkey AS STRING) AS id, c_custkey%4=3 AS other FROM customer WHERE c_custkey%2=1")
def signals_from_log(spark, d):
    s = _signals(spark, d)
    odd = F.substring("id", 2, 20).cast("long") % 2 == 1
    log = s.select(
        F.lit("DML").alias("lcr_type"), F.lit("INSERT").alias("dml"), F.lit("S1").alias("schema_name"),
        F.when(odd, "SIGNALS").otherwise("NOISE").alias("table_name"),
        F.create_map(F.lit("ID"), F.col("id"), F.lit("TYPE"), F.col("type"), F.lit("DATA"), F.col("data")).alias("after"),
    )
    return sig.signals_from_log(log, "db.s1.signals").select("id", (F.col("type") == "log").alias("other"))


PLAN = """WITH c AS (SELECT c_custkey k, 's'||CAST(c_custkey AS STRING) id FROM customer),
o AS (SELECT o_orderkey x, (row_number() OVER (ORDER BY o_orderkey)-1)//4000 ch FROM orders),
f AS (SELECT o_orderkey x, (row_number() OVER (ORDER BY o_orderkey)-1)//4000 ch FROM orders WHERE o_orderstatus='F'),
b AS (SELECT 0 kind, ch, min(x) lo, max(x) hi, count(*) n FROM o GROUP BY ch UNION ALL SELECT 1, ch, min(x), max(x), count(*) FROM f GROUP BY ch)
SELECT id, CAST(ch AS BIGINT) AS chunk_id, '{"o_orderkey":'||CAST(lo AS STRING)||'}' AS low_key, '{"o_orderkey":'||CAST(hi AS STRING)||'}' AS high_key, n AS rows
 FROM c JOIN b ON c.k%4 = b.kind"""


@query("chunk_plan", PLAN)
def chunk_plan(spark, d):
    plan = incremental.chunk_plan(_signals(spark, d), {"S1.ORDERS": (fx.table(spark, d, "orders"), ["o_orderkey"])}, 4000)
    return plan.select("id", "chunk_id", "low_key", "high_key", "rows")


WINDOW = (20_000_500, 40_006_000)


@query(
    "window_merge",
    CHG
    + f""", live AS (SELECT scn, CASE dml WHEN 'UPDATE' THEN 'u' WHEN 'DELETE' THEN 'd' ELSE 'c' END op, coalesce(f_k,b_k) k FROM img WHERE redelivery=0 AND scn-ok<>40000000 AND scn BETWEEN {WINDOW[0]} AND {WINDOW[1]}
 UNION ALL SELECT scn, 'd', b_k FROM img WHERE redelivery=0 AND scn-ok=40000000 AND scn BETWEEN {WINDOW[0]} AND {WINDOW[1]}
 UNION ALL SELECT scn, 'c', f_k FROM img WHERE redelivery=0 AND scn-ok=40000000 AND scn BETWEEN {WINDOW[0]} AND {WINDOW[1]})
SELECT scn, op, k FROM live UNION ALL SELECT {WINDOW[1]}, 'r', k FROM ({state_at(25_000_000)}) WHERE k NOT IN (SELECT k FROM live)""",
)
def window_merge(spark, d):
    log = pos.dedup_replay(fx.order_log(spark, d))
    chunk = apply.snapshot_events(fx.order_snapshot(spark, d, 25_000_000), fx.SCHEMA, "ORDERS", PK, 25_000_000)
    rows = incremental.window_merge(chunk, log, *WINDOW, PK)
    return rows.select(F.col("position_scn").alias("scn"), "op", F.col("key")[0].cast("long").alias("k"))


for _n in (997, 5000, 10_000_000):

    @query(f"incremental_snapshot_{_n}", STATE)
    def incremental_snapshot(spark, d, n=_n):
        table = fx.order_snapshot(spark, d, 25_000_000)
        events, _ = incremental.incremental_snapshot(
            table, "S1.ORDERS", fx.order_log(spark, d).filter("position_scn > 24000000"), n, PK,
            low=F.expr("greatest(24000001, 24900000 - chunk_id * 1000)"), high=F.expr("25100000 + chunk_id * 100000"),
        )
        return apply.typed(apply.latest_rows(events).filter("op <> 'd'"), COLUMNS)


# windows that move with the chunk: each reaches over the updates of some keys and not of others
CHUNK_LOW, CHUNK_HIGH = "19000000 + chunk_id * 30000", "30000000 + chunk_id * 70000"

for _n in (997, 5000):

    @query(
        f"incremental_chunks_{_n}",
        CHG + f""", s AS (SELECT k, CAST((row_number() OVER (ORDER BY k)-1)//{_n} AS BIGINT) AS chunk_id FROM ({state_at(25_000_000)})),
w AS (SELECT k, chunk_id, CAST({CHUNK_LOW} AS BIGINT) AS low, CAST({CHUNK_HIGH} AS BIGINT) AS high FROM s),
m AS (SELECT b_k AS k, scn FROM img WHERE b_k IS NOT NULL UNION ALL SELECT f_k, scn FROM img WHERE f_k IS NOT NULL)
SELECT chunk_id, count(*) AS rows, count(*) FILTER (NOT hit) AS kept, max(high) AS high FROM (
 SELECT w.*, EXISTS (SELECT 1 FROM m WHERE m.k = w.k AND m.scn BETWEEN w.low AND w.high) AS hit FROM w) GROUP BY chunk_id""",
    )
    def incremental_chunks(spark, d, n=_n):
        """Rows of each chunk, and those that no change inside the chunk's own window replaces."""
        table = fx.order_snapshot(spark, d, 25_000_000)
        events, progress = incremental.incremental_snapshot(
            table, "S1.ORDERS", fx.order_log(spark, d), n, PK, low=F.expr(CHUNK_LOW), high=F.expr(CHUNK_HIGH))
        kept = events.filter("op = 'r'").groupBy("chunk_id").agg(F.count("*").alias("kept"), F.max("pos.position_scn").alias("high"))
        return progress.join(kept, "chunk_id", "left").select(
            "chunk_id", "rows", F.coalesce("kept", F.lit(0)).alias("kept"), F.expr(f"coalesce(high, {CHUNK_HIGH})").cast("long").alias("high"))


@query(
    "incremental_progress",
    f"""WITH c AS (SELECT k, CAST((row_number() OVER (ORDER BY k)-1)//2000 AS BIGINT) AS chunk_id FROM ({state_at(25_000_000)}))
SELECT chunk_id, count(*) AS rows, '{{"k":'||CAST(max(k) AS STRING)||'}}' AS last_key FROM c GROUP BY chunk_id""",
)
def incremental_progress(spark, d):
    table = fx.order_snapshot(spark, d, 25_000_000)
    return incremental.incremental_snapshot(table, "S1.ORDERS", fx.order_log(spark, d), 2000, PK, low=24_500_000, high=30_100_000)[1]


@query(
    "incremental_marks",
    STATE,
)
def incremental_marks(spark, d):
    """Every chunk has its own window around the read."""
    table = fx.order_snapshot(spark, d, 25_000_000)
    ids = keyset.keyset_chunks(table, PK, 1500).select("chunk_id").distinct()
    marks = ids.select("chunk_id", (F.lit(24_900_000) - F.col("chunk_id") * 1000).alias("low"), (F.lit(25_100_000) + F.col("chunk_id") * 1_000_000).alias("high"))
    events, _ = incremental.incremental_snapshot(table, "S1.ORDERS", fx.order_log(spark, d).filter("position_scn > 20000000"), 1500, PK, marks=marks)
    return apply.typed(apply.latest_rows(events).filter("op <> 'd'"), COLUMNS)


@query("on_demand_snapshot", "SELECT 'SUPPLIER' AS table_name, s_suppkey AS k, CAST(99000000 AS BIGINT) AS scn FROM supplier")
def on_demand_snapshot(spark, d):
    tables = {"S1.SUPPLIER": fx.table(spark, d, "supplier"), "S1.PART": fx.table(spark, d, "part")}
    rows = snap.on_demand_snapshot(_signals(spark, d), tables, 99_000_000, _ts())
    return rows.select("table_name", F.col("after")["s_suppkey"].cast("long").alias("k"), F.col("position_scn").alias("scn"))


# ---------------------------------------------------------------- run modes

FLASH = 25_000_000
SNAP_N = f"(SELECT count(*) FROM ({state_at(FLASH)}))"
AFTER = f"(SELECT count(*) FROM chg WHERE scn > {FLASH})"
OFFSET = 40_000_000
FROM_OFFSET = f"(SELECT count(*) FROM chg WHERE scn >= {OFFSET})"

for _mode, _state, _snap, _log in (
    ("always", {"offset_scn": OFFSET, "snapshot_done": True}, SNAP_N, AFTER),
    ("initial", {}, SNAP_N, AFTER),
    ("initial", {"offset_scn": OFFSET, "snapshot_done": True}, "0", FROM_OFFSET),
    ("initial_only", {}, SNAP_N, "0"),
    ("no_data", {}, "0", AFTER),
    ("schema_only", {"offset_scn": OFFSET, "snapshot_done": True}, "0", FROM_OFFSET),
    ("recovery", {"offset_scn": OFFSET, "snapshot_done": True, "history_exists": False}, "0", FROM_OFFSET),
    ("when_needed", {"offset_scn": OFFSET, "snapshot_done": True, "offset_available": False}, SNAP_N, AFTER),
    ("when_needed", {"offset_scn": OFFSET, "snapshot_done": True}, "0", FROM_OFFSET),
):
    _name = f"capture_{_mode}" + ("_resumed" if _state.get("snapshot_done") and _snap == "0" and _mode in ("initial", "when_needed") else "")

    @query(_name, CHG + f"SELECT CAST({_snap} AS BIGINT) AS snapshot_rows, CAST({_log} AS BIGINT) AS log_rows")
    def capture(spark, d, mode=_mode, state=_state):
        log = fx.order_log(spark, d)
        events = snap.capture(
            mode,
            lambda scn: snap.read_events(fx.order_snapshot(spark, d, scn), "S1.ORDERS", scn, _ts()),
            lambda scn: image.map_op(log.filter(F.col("position_scn") >= scn)),
            FLASH,
            **state,
        )
        return events.agg(F.count_if(F.col("op") == "r").alias("snapshot_rows"), F.count_if(F.col("op") != "r").alias("log_rows"))


STRUCTURE = """SELECT 'schema' AS op, 'k bigint' AS what, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'schema', 'st string', 2
 UNION ALL SELECT 'schema', 'p double', 3 UNION ALL SELECT 'schema', 'pr string', 4"""
EVENTS = """ UNION ALL SELECT CASE dml WHEN 'INSERT' THEN 'c' WHEN 'UPDATE' THEN 'u' ELSE 'd' END, CAST(scn AS STRING), count(*) FROM chg WHERE scn>={} GROUP BY dml, scn"""

for _name, _mode, _state, _from in (
    ("capture_structure_no_data", "no_data", {}, FLASH + 1),
    ("capture_structure_recovery", "recovery", {"offset_scn": OFFSET, "snapshot_done": True, "history_exists": False}, OFFSET),
):

    @query(_name, CHG + STRUCTURE + EVENTS.format(_from))
    def capture_structure(spark, d, mode=_mode, state=_state):
        """Structure first, no table rows, then every event of the log."""
        log, orders = fx.order_log(spark, d), fx.order_snapshot(spark, d, FLASH)
        events = snap.capture(
            mode,
            lambda scn: snap.read_events(orders, "S1.ORDERS", scn, _ts()),
            lambda scn: image.map_op(log.filter(F.col("position_scn") >= scn)),
            FLASH,
            structure=lambda scn: snap.structure_rows(orders, "S1.ORDERS", scn, _ts()),
            **state,
        )
        columns = events.filter("op = 'schema'").select("op", F.posexplode("structure").alias("at", "c"))
        columns = columns.select("op", F.concat_ws(" ", "c.name", "c.type_name").alias("what"), (F.col("at") + 1).cast("long").alias("n"))
        rows = events.filter("op <> 'schema'").groupBy("op", F.col("position_scn").cast("string").alias("what")).agg(F.count("*").alias("n"))
        return columns.unionByName(rows)


@query(
    "snapshot_progress",
    """SELECT 'ORDERS' AS table_name, (SELECT count(*) FROM orders) AS rows, (SELECT (count(*)+999)//1000 FROM orders) AS chunks, CAST(0 AS BIGINT) AS remaining_chunks
 UNION ALL SELECT 'PART', 0, 0, (SELECT (count(*)+999)//1000 FROM part)""",
)
def snapshot_progress(spark, d):
    orders = keyset.keyset_chunks(fx.table(spark, d, "orders"), ["o_orderkey"], 1000)
    events = snap.read_events(orders, "S1.ORDERS", 1, _ts(), chunk="chunk_id")
    counts = lambda t: fx.table(spark, d, t).agg(F.ceil(F.count("*") / 1000).cast("long").alias("planned_chunks"))
    planned = (
        counts("orders").select(F.lit("S1").alias("schema_name"), F.lit("ORDERS").alias("table_name"), "planned_chunks")
    ).unionByName(counts("part").select(F.lit("S1").alias("schema_name"), F.lit("PART").alias("table_name"), "planned_chunks"))
    return metrics.snapshot_progress(events, planned).select("table_name", "rows", "chunks", "remaining_chunks")
