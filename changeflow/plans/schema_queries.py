"""Queries of the schema timeline, on statements derived from the customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.operators import history, typed
from changeflow.plans import fixtures as fx
from changeflow.plans.registry import query
from changeflow.sinks.routing import valid_name

K = "WITH c AS (SELECT c_custkey k FROM customer) "
NUM = "CAST(k AS STRING)"
#: name of T<k> after a possible rename
NOW = f"CASE WHEN k%7=0 THEN 'R'||{NUM} ELSE 'T'||{NUM} END"


def _ddl(spark, d) -> DataFrame:
    return fx.ddl_log(spark, d).select("scn", "schema_name", "ddl_text")


def _timeline(spark, d):
    changes = history.column_changes(_ddl(spark, d))
    return changes, history.schema_timeline(changes)


@query(
    "classify_ddl",
    K
    + f""", s AS (
 SELECT k, 'create' kind, 'S1' schema_name, 'T'||{NUM} table_name FROM c UNION ALL SELECT k, 'create', 's1', 'Mixed'||{NUM} FROM c
 UNION ALL SELECT k, 'create', 'S1', 'T'||{NUM} FROM c WHERE k%2=0 UNION ALL SELECT k, 'create', 'S1', 'T'||{NUM} FROM c WHERE k%26=0
 UNION ALL SELECT k, 'alter', 'S1', 'T'||{NUM} FROM c, range(7) r(i) WHERE i=0 OR (i=1 AND k%3=0) OR (i=2 AND k%4=0) OR (i=3 AND k%5=0) OR (i=4 AND k%6=0) OR (i=5 AND k%10=0) OR (i=6 AND k%7=0)
 UNION ALL SELECT k, 'alter', 'S1', 'NOPE'||{NUM} FROM c UNION ALL SELECT k, 'alter', 'S1', {NOW} FROM c WHERE k%9=1
 UNION ALL SELECT k, 'comment', 'S1', 'T'||{NUM} FROM c UNION ALL SELECT k, 'comment', 'S1', 'T'||{NUM} FROM c WHERE k%2=1
 UNION ALL SELECT k, 'truncate', 'S1', {NOW} FROM c UNION ALL SELECT k, 'drop', 'S1', {NOW} FROM c WHERE k%13=0
 UNION ALL SELECT k, 'drop', 's1', 'Mixed'||{NUM} FROM c WHERE k%8=0
 UNION ALL SELECT k, 'invalid', 'S1', NULL FROM c WHERE k%9=0 UNION ALL SELECT k, 'other', 'S1', NULL FROM c)
SELECT kind, schema_name, table_name, count(*) AS n FROM s GROUP BY ALL""",
)
def classify_ddl(spark, d):
    return history.classify_ddl(_ddl(spark, d)).groupBy("kind", "schema_name", "table_name").agg(F.count("*").alias("n"))


@query(
    "column_changes",
    K
    + f""", s AS (
 SELECT k*100+10 scn, 'create' action, NULL column_name, NULL more FROM c
 UNION ALL SELECT k*100+10, 'add', 'ID', 'NUMBER('||CAST(k%38+1 AS STRING)||')|false|' FROM c
 UNION ALL SELECT k*100+10, 'add', 'NOTE', 'VARCHAR(200)|true|''x, ('||{NUM}||'''' FROM c
 UNION ALL SELECT k*100+10, 'add', 'AMT', 'NUMBER(12,'||CAST(k%5 AS STRING)||')|true|' FROM c
 UNION ALL SELECT k*100+10, 'set-pk', NULL, 'ID' FROM c
 UNION ALL SELECT k*100+11, 'create', NULL, NULL FROM c
 UNION ALL SELECT k*100+11, 'add', 'ID', 'INT|true|' FROM c UNION ALL SELECT k*100+11, 'add', 'D', 'DATE|false|SYSDATE' FROM c
 UNION ALL SELECT k*100+11, 'add', 'J', 'JSON|true|' FROM c UNION ALL SELECT k*100+11, 'add', 'B', 'BLOB|true|' FROM c
 UNION ALL SELECT k*100+11, 'add', 'C', 'CLOB|true|' FROM c UNION ALL SELECT k*100+11, 'set-pk', NULL, 'ID' FROM c
 UNION ALL SELECT k*100+12, 'create', NULL, NULL FROM c WHERE k%2=0 UNION ALL SELECT k*100+12, 'add', 'X', 'INT|true|' FROM c WHERE k%2=0
 UNION ALL SELECT k*100+20, 'add', 'TS', 'TIMESTAMP(3)|true|' FROM c
 UNION ALL SELECT k*100+21, 'modify', 'NOTE', 'VARCHAR('||CAST(k%500+1 AS STRING)||')|true|' FROM c WHERE k%3=0
 UNION ALL SELECT k*100+22, 'rename', 'AMT', 'AMOUNT' FROM c WHERE k%4=0
 UNION ALL SELECT k*100+23, 'set-pk', NULL, 'ID,TS' FROM c WHERE k%5=0
 UNION ALL SELECT k*100+24, 'drop', 'NOTE', NULL FROM c WHERE k%6=0 UNION ALL SELECT k*100+25, 'drop-pk', NULL, NULL FROM c WHERE k%10=0
 UNION ALL SELECT k*100+26, 'comment', NULL, 'orders '||{NUM} FROM c UNION ALL SELECT k*100+27, 'comment', 'ID', 'it''s the key' FROM c WHERE k%2=1
 UNION ALL SELECT k*100+30, 'rename-table', NULL, 'R'||{NUM} FROM c WHERE k%7=0
 UNION ALL SELECT k*100+31, 'add', 'X', 'INT|true|' FROM c
 UNION ALL SELECT k*100+40, 'drop-table', NULL, NULL FROM c WHERE k%13=0
 UNION ALL SELECT k*100+41, 'create', NULL, NULL FROM c WHERE k%26=0 UNION ALL SELECT k*100+41, 'add', 'Y', 'INT|false|7' FROM c WHERE k%26=0
 UNION ALL SELECT k*100+42, 'drop-table', NULL, NULL FROM c WHERE k%8=0)
SELECT * FROM s""",
)
def column_changes(spark, d):
    rows = history.column_changes(_ddl(spark, d))
    defined = F.concat_ws("|", "type_text", F.col("nullable").cast("string"), F.coalesce("default_text", F.lit("")))
    more = F.coalesce(
        F.when(F.col("type_text").isNotNull(), defined), F.col("new_name"), F.col("comment"), F.array_join("key_columns", ",")
    )
    return rows.select("scn", "action", "column_name", more.alias("more"))


@query(
    "ddl_quarantine",
    K + """SELECT 'bad' AS side, count(*) AS n FROM c WHERE k%9 IN (0,1)
 UNION ALL SELECT 'good', (SELECT count(*)*8 FROM c) + count(*) FILTER (WHERE k%2=0) + count(*) FILTER (WHERE k%3=0) + count(*) FILTER (WHERE k%4=0)
 + count(*) FILTER (WHERE k%5=0) + count(*) FILTER (WHERE k%6=0) + count(*) FILTER (WHERE k%10=0) + count(*) FILTER (WHERE k%2=1) + count(*) FILTER (WHERE k%7=0)
 + count(*) FILTER (WHERE k%13=0) + count(*) FILTER (WHERE k%26=0) + count(*) FILTER (WHERE k%8=0) - (SELECT count(*) FROM c) FROM c""",
)
def ddl_quarantine(spark, d):
    good, bad = history.ddl_quarantine(_ddl(spark, d), "reread")
    return good.select(F.lit("good").alias("side")).unionByName(bad.filter("reread_structure").select(F.lit("bad").alias("side"))).groupBy(
        "side"
    ).agg(F.count("*").alias("n"))


# final structure of T<k> / R<k>, in column order, and of Mixed<k>
FOLD = f""", f AS (
 SELECT k, 'S1' schema_name, {NOW} table_name, 1 o, 'ID' column_name, 'NUMBER('||CAST(k%38+1 AS STRING)||')' type_text, false nullable, NULL default_text,
   CASE WHEN k%2=1 THEN 'it''s the key' END AS comment, CASE WHEN k%10=0 THEN NULL ELSE 1 END key_position FROM c WHERE k%13<>0
 UNION ALL SELECT k, 'S1', {NOW}, 2, 'NOTE', 'VARCHAR('||CAST(CASE WHEN k%3=0 THEN k%500+1 ELSE 200 END AS STRING)||')', true, CASE WHEN k%3<>0 THEN '''x, ('||{NUM}||'''' END, NULL, NULL FROM c WHERE k%13<>0 AND k%6<>0
 UNION ALL SELECT k, 'S1', {NOW}, 3, CASE WHEN k%4=0 THEN 'AMOUNT' ELSE 'AMT' END, 'NUMBER(12,'||CAST(k%5 AS STRING)||')', true, NULL, NULL, NULL FROM c WHERE k%13<>0
 UNION ALL SELECT k, 'S1', {NOW}, 4, 'TS', 'TIMESTAMP(3)', true, NULL, NULL, CASE WHEN k%5=0 AND k%10<>0 THEN 2 END FROM c WHERE k%13<>0
 UNION ALL SELECT k, 'S1', 'T'||{NUM}, 1, 'Y', 'INT', false, '7', NULL, NULL FROM c WHERE k%26=0
 UNION ALL SELECT k, 's1', 'Mixed'||{NUM}, i, name, typ, i<>2, CASE WHEN i=2 THEN 'SYSDATE' END, NULL, CASE WHEN i=1 THEN 1 END FROM c,
   (VALUES (1,'ID','INT'),(2,'D','DATE'),(3,'J','JSON'),(4,'B','BLOB'),(5,'C','CLOB')) m(i,name,typ) WHERE k%8<>0)
"""


@query(
    "fold_schema",
    K + FOLD + """SELECT schema_name, table_name, CAST(row_number() OVER (PARTITION BY schema_name, table_name ORDER BY o) AS INT) AS position,
 column_name, type_text, nullable, default_text, comment, CAST(key_position AS INT) AS key_position FROM f""",
)
def fold_schema(spark, d):
    return history.fold_schema(_timeline(spark, d)[1])


@query(
    "fold_schema_same_scn",
    K + "SELECT 'S1' AS schema_name, 'T'||CAST(k AS STRING) AS table_name, 'A,C' AS names FROM c",
)
def fold_schema_same_scn(spark, d):
    """Create, add and drop of a column under one SCN of 18 digits: the log position orders them."""
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    name = F.concat(F.lit("T"), F.col("k").cast("string"))
    texts = (F.concat(F.lit("CREATE TABLE "), name, F.lit(" (A INT, B INT)")), F.concat(F.lit("ALTER TABLE "), name, F.lit(" ADD (C INT)")),
             F.concat(F.lit("ALTER TABLE "), name, F.lit(" DROP COLUMN B")))
    ddl = c.select("k", F.posexplode(F.array(*texts)).alias("group_lsn", "ddl_text")).select(
        (F.lit(577_839_428_348_284_928) + F.col("k")).alias("scn"), F.lit("S1").alias("schema_name"), F.col("group_lsn").cast("long").alias("group_lsn"), "ddl_text")
    rows = history.fold_schema(history.schema_timeline(history.column_changes(ddl.repartition(5, "ddl_text"))))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "column_name"))), lambda x: x["column_name"]), ",")
    return rows.groupBy("schema_name", "table_name").agg(names.alias("names"))


@query(
    "ddl_reread",
    K + f"""SELECT {NOW} AS table_name, true AS known FROM c WHERE k%13<>0 AND k%9<>1 UNION ALL SELECT 'T'||{NUM}, true FROM c WHERE k%26=0
 UNION ALL SELECT 'Mixed'||{NUM}, true FROM c WHERE k%8<>0""",
)
def ddl_reread(spark, d):
    """A statement that is not understood ends what is known of its table."""
    changes = history.column_changes(_ddl(spark, d), policy="reread")
    return history.fold_schema(history.schema_timeline(changes)).select("table_name", F.lit(True).alias("known")).distinct()


@query(
    "fold_schema_at",
    K
    + f""", x AS (SELECT c.*, (SELECT CAST(max(k)//2 AS BIGINT)*100+22 FROM c) s FROM c)
SELECT schema_name, table_name, count(*) AS columns, string_agg(column_name, ',' ORDER BY o) AS names FROM (
 SELECT k, 'S1' AS schema_name, CASE WHEN k%7=0 AND s >= k*100+30 THEN 'R'||{NUM} ELSE 'T'||{NUM} END table_name, o, column_name FROM (
  SELECT k, s, 1 o, 'ID' column_name FROM x WHERE s >= k*100+10
  UNION ALL SELECT k, s, 2, 'NOTE' FROM x WHERE s >= k*100+10 AND NOT (k%6=0 AND s >= k*100+24)
  UNION ALL SELECT k, s, 3, CASE WHEN k%4=0 AND s >= k*100+22 THEN 'AMOUNT' ELSE 'AMT' END FROM x WHERE s >= k*100+10
  UNION ALL SELECT k, s, 4, 'TS' FROM x WHERE s >= k*100+20) WHERE NOT (k%13=0 AND s >= k*100+40)
 UNION ALL SELECT k, 'S1', 'T'||{NUM}, 1, 'Y' FROM x WHERE k%26=0 AND s >= k*100+41
 UNION ALL SELECT k, 's1', 'Mixed'||{NUM}, i, name FROM x, (VALUES (1,'ID'),(2,'D'),(3,'J'),(4,'B'),(5,'C')) m(i,name)
  WHERE s >= k*100+11 AND NOT (k%8=0 AND s >= k*100+42)) GROUP BY schema_name, table_name""",
)
def fold_schema_at(spark, d):
    """Structure of all tables as of the rename statement of the middle customer."""
    top = fx.table(spark, d, "customer").agg(F.max("c_custkey")).first()[0]
    at = history.fold_schema(_timeline(spark, d)[1], (top // 2) * 100 + 22)
    return at.groupBy("schema_name", "table_name").agg(
        F.count("*").alias("columns"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "column_name"))), lambda x: x["column_name"]), ",").alias("names"),
    )


@query(
    "schema_at_event",
    K
    + f"""SELECT k, v, CASE v WHEN 0 THEN k*100+10 WHEN 1 THEN k*100+20 WHEN 2 THEN CASE WHEN k%6=0 THEN k*100+24 WHEN k%4=0 THEN k*100+22 ELSE k*100+20 END END AS version_scn,
 CASE v WHEN 0 THEN 'ID,NOTE,AMT' WHEN 1 THEN 'ID,NOTE,AMT,TS' ELSE 'ID'||CASE WHEN k%6=0 THEN '' ELSE ',NOTE' END||CASE WHEN k%4=0 THEN ',AMOUNT' ELSE ',AMT' END||',TS' END AS columns
 FROM c, range(3) r(v)""",
)
def schema_at_event(spark, d):
    """Three events per table: after create, after the added column, and after all column changes."""
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    events = c.select("k", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("v")).select(
        "k",
        "v",
        F.lit("S1").alias("schema_name"),
        F.when(F.col("v") == 3, F.concat(F.lit("NEVER"), F.col("k").cast("string"))).otherwise(F.concat(F.lit("T"), F.col("k").cast("string"))).alias("table_name"),
        (F.col("k") * 100 + F.element_at(F.array(F.lit(15), F.lit(20), F.lit(25), F.lit(25)), F.col("v") + 1)).alias("position_scn"),
    )
    changes, timeline = _timeline(spark, d)
    versions = history.schema_versions(changes, timeline)
    # a modified column leaves the list of names as it is; the version that counts here is the last one with other names
    found, _missing = history.schema_at_event(events, _name_versions(versions))
    return found.select("k", F.col("v").cast("long").alias("v"), "version_scn", F.array_join("columns", ",").alias("columns"))


@query(
    "schema_versions_large_scn",
    """SELECT 'B'||CAST(c_custkey AS STRING) AS table_name, '999999999999'||lpad(CAST(c_custkey*10+v AS STRING), 12, '0') AS version_scn,
 CASE v WHEN 0 THEN 'ID,A' WHEN 1 THEN 'ID,A,C' WHEN 2 THEN 'ID,C' ELSE '' END AS columns
 FROM customer, range(4) r(v) WHERE v < 3 OR c_custkey%3=0""",
)
def schema_versions_large_scn(spark, d):
    """SCNs beyond a long integer: a table that gains a column, loses one, and every third is dropped."""
    k = F.col("c_custkey")
    scn = lambda v: F.concat(F.lit("999999999999"), F.lpad((k * 10 + v).cast("string"), 12, "0")).cast("decimal(38,0)")
    name = F.concat(F.lit("S1.B"), k.cast("string"))
    texts = [F.concat(F.lit("CREATE TABLE "), name, F.lit(" (ID INT, A INT)")), F.concat(F.lit("ALTER TABLE "), name, F.lit(" ADD COLUMN C INT")),
             F.concat(F.lit("ALTER TABLE "), name, F.lit(" DROP COLUMN A")), F.when(k % 3 == 0, F.concat(F.lit("DROP TABLE "), name))]
    rows = F.array(*[F.struct(scn(v).alias("scn"), F.lit(v).alias("n"), t.alias("ddl_text")) for v, t in enumerate(texts)])
    ddl = fx.table(spark, d, "customer").select(k, F.explode(rows).alias("e")).select(k.alias("k"), "e.*", F.lit("S1").alias("schema_name")).filter("ddl_text IS NOT NULL")
    changes = history.column_changes(ddl)
    found = history.schema_versions(changes, history.schema_timeline(changes))
    return found.select("table_name", F.col("version_scn").cast("string").alias("version_scn"), F.array_join("columns", ",").alias("columns"))


def _name_versions(versions: DataFrame) -> DataFrame:
    first = versions.groupBy("schema_name", "table_name", "columns").agg(F.min("version_scn").alias("version_scn"))
    return first.select("schema_name", "table_name", "version_scn", "columns")


@query("schema_missing_tables", K + "SELECT 'NEVER'||CAST(k%50 AS STRING) AS table_name, count(*) AS events FROM c GROUP BY 1")
def schema_missing_tables(spark, d):
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    events = c.select(
        F.lit("S1").alias("schema_name"), F.concat(F.lit("NEVER"), (F.col("k") % 50).cast("string")).alias("table_name"), (F.col("k") * 100).alias("position_scn")
    )
    changes, timeline = _timeline(spark, d)
    _, missing = history.schema_at_event(events, history.schema_versions(changes, timeline))
    return missing.select("table_name", "events")


TYPES = (
    # pattern of the type text, jdbc type, name, length, scale; {p} and {s} vary by part
    ("NUMBER", "NUMERIC", "NUMBER", "38", "NULL"),
    ("NUMBER(*)", "NUMERIC", "NUMBER", "38", "0"),
    ("NUMBER({p})", "NUMERIC", "NUMBER", "{p}", "0"),
    ("NUMBER({p},-{s})", "NUMERIC", "NUMBER", "{p}", "-{s}"),
    ("NUMBER({p}, {s})", "NUMERIC", "NUMBER", "{p}", "{s}"),
    ("FLOAT", "FLOAT", "FLOAT", "126", "NULL"),
    ("DOUBLE", "DOUBLE", "DOUBLE", "256", "NULL"),
    ("VARCHAR2({p} CHAR)", "VARCHAR", "VARCHAR2", "{p}", "NULL"),
    ("VARCHAR", "VARCHAR", "VARCHAR2", "4000", "NULL"),
    ("CHAR", "CHAR", "CHAR", "1", "NULL"),
    ("NCHAR({p})", "NCHAR", "NCHAR", "{p}", "NULL"),
    ("RAW({p})", "RAW", "RAW", "{p}", "NULL"),
    ("TIMESTAMP", "TIMESTAMP", "TIMESTAMP", "6", "NULL"),
    ("TIMESTAMP({s})", "TIMESTAMP", "TIMESTAMP", "{s}", "NULL"),
    ("DATE", "TIMESTAMP", "DATE", "NULL", "NULL"),
    ("INTERVAL YEAR({s}) TO MONTH", "YM_INTERVAL", "INTERVAL YEAR TO MONTH", "{s}", "NULL"),
    ("INTERVAL DAY({s}) TO SECOND(9)", "DS_INTERVAL", "INTERVAL DAY TO SECOND", "{s}", "9"),
    ("INTERVAL DAY TO SECOND({s})", "DS_INTERVAL", "INTERVAL DAY TO SECOND", "2", "{s}"),
    ("XMLTYPE", "SQLXML", "XMLTYPE", "NULL", "NULL"),
    ("ROWID", "VARCHAR", "ROWID", "NULL", "NULL"),
    ("BOOLEAN", "BOOLEAN", "BOOLEAN", "NULL", "NULL"),
    ("TINYINT", "TINYINT", "TINYINT", "NULL", "NULL"),
    ("GEOMETRY({p})", "OTHER", "GEOMETRY({p})", "NULL", "NULL"),
)


def _type_sql() -> str:
    fill = lambda text: "'" + text.replace("{p}", "'||CAST(p AS STRING)||'").replace("{s}", "'||CAST(s AS STRING)||'") + "'"
    number = lambda text: text.replace("{p}", "p").replace("{s}", "s")
    rows = [
        f"SELECT pk, {i} AS kind, {fill(t)} AS type_text, '{jdbc}' AS jdbc_type, {fill(name)} AS type_name, CAST({number(length)} AS INT) AS length, CAST({number(scale)} AS INT) AS scale FROM x"
        for i, (t, jdbc, name, length, scale) in enumerate(TYPES)
    ]
    return "WITH x AS (SELECT p_partkey pk, p_partkey%38+1 p, p_partkey%7+1 s FROM part) " + " UNION ALL ".join(rows)


@query("resolve_types", _type_sql())
def resolve_types(spark, d):
    p = fx.table(spark, d, "part").select(F.col("p_partkey").alias("pk"))
    args = {"{p}": (F.col("pk") % 38 + 1).cast("string"), "{s}": (F.col("pk") % 7 + 1).cast("string")}

    def text(pattern: str):
        out = F.lit(pattern)
        for mark, value in args.items():
            out = F.replace(out, F.lit(mark), value)
        return out

    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), text(t[0]).alias("type_text")) for i, t in enumerate(TYPES)])
    cols = p.select("pk", F.explode(kinds).alias("e")).select("pk", "e.*")
    return history.resolve_types(cols)


@query(
    "lob_columns",
    K + f"SELECT 's1' AS schema_name, 'Mixed'||{NUM} AS table_name, 'J,B,C' AS lobs FROM c WHERE k%8<>0",
)
def lob_columns(spark, d):
    cols = history.resolve_types(history.fold_schema(_timeline(spark, d)[1]))
    return history.lob_columns(cols).select("schema_name", "table_name", F.array_join("lob_columns", ",").alias("lobs"))


DEFAULTS = (
    # jdbc type, length, scale, nullable, default text, expected value as SQL over n
    ("NUMERIC", 12, 4, True, "{n}.5", "CAST(n AS STRING)||'.5000'"),
    ("NUMERIC", 10, 0, True, "{n}", "CAST(n AS STRING)"),
    ("NUMERIC", 10, 2, True, "SEQ.NEXTVAL", "NULL"),
    ("NUMERIC", 10, 2, True, "null", "NULL"),
    ("INTEGER", None, None, True, "-{n}", "CAST(-n AS STRING)"),
    ("BOOLEAN", None, None, True, "{b}", "CASE WHEN n%2=0 THEN 'false' ELSE 'true' END"),
    ("BOOLEAN", None, None, True, "TRUE", "'true'"),
    ("VARCHAR", 20, None, True, "'v{n}'", "'v'||CAST(n AS STRING)"),
    ("VARCHAR", 20, None, True, "('v{n}')", "'v'||CAST(n AS STRING)"),
    ("VARCHAR", 20, None, False, "''", "''"),
    ("VARCHAR", 20, None, True, "''", "NULL"),
    ("CHAR", 8, None, True, "'c{n}'", "rpad('c'||CAST(n AS STRING), 8, ' ')"),
    ("TIMESTAMP", 6, None, False, "SYSDATE", "'0'"),
    ("TIMESTAMP", 6, None, True, "current_timestamp", "NULL"),
    ("TIMESTAMP", 6, None, True, "'2024-01-02'", "'1704153600000000'"),
    ("TIMESTAMP", 6, None, True, "'2024-01-02 00:00:01.5'", "'1704153601500000'"),
    ("TIMESTAMP", 6, None, True, "TO_DATE('2024-01-02 00:00:00', 'YYYY')", "'1704153600000000'"),
    ("TIME", None, None, True, "'-{b}:30:00'", "CASE WHEN n%2=0 THEN '-1800000000' ELSE '-5400000000' END"),
    ("YM_INTERVAL", 2, None, True, "'{b}-6'", "CASE WHEN n%2=0 THEN '15778800000000' ELSE '47336400000000' END"),
    ("CLOB", None, None, True, "'x'", "NULL"),
)


def _defaults_sql() -> str:
    rows = [f"SELECT n, {i} AS kind, {want} AS default_value FROM x" for i, (*_, want) in enumerate(DEFAULTS)]
    return "WITH x AS (SELECT p_partkey n FROM part) " + " UNION ALL ".join(rows)


@query("resolve_defaults", _defaults_sql())
def resolve_defaults(spark, d):
    p = fx.table(spark, d, "part").select(F.col("p_partkey").alias("n"))

    def text(pattern: str):
        out = F.replace(F.lit(pattern), F.lit("{n}"), F.col("n").cast("string"))
        return F.replace(out, F.lit("{b}"), (F.col("n") % 2).cast("string"))

    kinds = F.array(*[
        F.struct(
            F.lit(i).alias("kind"), F.lit(jdbc).alias("jdbc_type"), F.lit(length).cast("int").alias("length"),
            F.lit(scale).cast("int").alias("scale"), F.lit(nullable).alias("nullable"), text(default).alias("default_text"),
        )
        for i, (jdbc, length, scale, nullable, default, _) in enumerate(DEFAULTS)
    ])
    cols = p.select("n", F.explode(kinds).alias("e")).select("n", "e.*")
    return typed.resolve_defaults(cols).select("n", "kind", "default_value")


@query(
    "apply_defaults",
    "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey%3<>0 THEN o_orderstatus END, 'N') AS o_orderstatus, coalesce(CASE WHEN o_orderkey%4<>0 THEN o_totalprice END, 0) AS o_totalprice FROM orders",
)
def apply_defaults(spark, d):
    o = fx.table(spark, d, "orders")
    gaps = o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("o_totalprice"),
    )
    return typed.apply_defaults(gaps, {"o_orderstatus": "N", "o_totalprice": 0})


@query(
    "latest_ddl_scn",
    """WITH u AS (SELECT ts, max(event_id*10) scn FROM events GROUP BY ts), d AS (SELECT max(ts) + INTERVAL 1 SECOND AS ddl_ts FROM events WHERE event_id%10=3)
SELECT u.scn AS latest_ddl_scn FROM d ASOF LEFT JOIN u ON d.ddl_ts >= u.ts""",
)
def latest_ddl_scn(spark, d):
    e = fx.table(spark, d, "events")
    ddl = e.select(
        F.lit("S1").alias("schema_name"),
        F.concat(F.lit("T"), (F.col("event_id") % 10).cast("string")).alias("table_name"),
        (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("ddl_ts"),
    )
    captured = ddl.filter("table_name = 'T3'").select("schema_name", "table_name").distinct()
    return history.latest_ddl_scn(ddl, captured, fx.clock(spark, d)).select("latest_ddl_scn")


@query(
    "table_ids",
    K
    + f"""SELECT k, CASE k%5 WHEN 0 THEN NULL WHEN 1 THEN 'cat' WHEN 2 THEN 'domain.sub' WHEN 3 THEN 'a.b.c' ELSE NULL END AS catalog,
 CASE k%5 WHEN 0 THEN 'schema' WHEN 1 THEN '_schema' WHEN 2 THEN 'SELECT' WHEN 3 THEN 'schema' ELSE NULL END AS schema_name, 't'||{NUM} AS table_name,
 CASE k%5 WHEN 0 THEN 'schema.' WHEN 1 THEN '"_schema".' WHEN 2 THEN '"SELECT".' WHEN 3 THEN 'schema.' ELSE '' END||'t'||{NUM} AS quoted FROM c""",
)
def table_ids(spark, d):
    from changeflow.functions.names import quote_id, table_id

    k = F.col("c_custkey")
    t = F.concat(F.lit("t"), k.cast("string"))
    text = (
        F.when(k % 5 == 0, F.concat(F.lit("schema."), t)).when(k % 5 == 1, F.concat(F.lit("cat._schema."), t))
        .when(k % 5 == 2, F.concat(F.lit("domain.sub.SELECT."), t)).when(k % 5 == 3, F.concat(F.lit("a.b.c.schema."), t)).otherwise(t)
    )
    rows = fx.table(spark, d, "customer").select(k.alias("k"), table_id(text).alias("t")).select("k", "t.*")
    return rows.withColumn("quoted", quote_id(F.struct("catalog", "schema_name", "table_name"), ["select", "from"]))


@query(
    "adjust_names",
    K
    + f"""SELECT k, 'srv.S1.T_'||{NUM}||'_x' AS avro, 'srv.S1.T_u0024'||{NUM}||'_u002dx' AS uni, '_abc' AS lead_digit FROM c""",
)
def adjust_names(spark, d):
    k = F.col("c_custkey")
    name = F.concat(F.lit("srv.S1.T$"), k.cast("string"), F.lit("-x"))
    return fx.table(spark, d, "customer").select(
        k.alias("k"), valid_name(name, "avro").alias("avro"), valid_name(name, "avro_unicode").alias("uni"),
        valid_name(F.concat((k % 10).cast("string"), F.lit("abc")), "avro").alias("lead_digit"),
    )


@query(
    "schema_change_rows",
    K
    + f""", s AS (SELECT 'create' event_type, 1 w FROM c UNION ALL SELECT 'create', 1 FROM c UNION ALL SELECT 'create', 1 FROM c WHERE k%2=0 UNION ALL SELECT 'create', 1 FROM c WHERE k%26=0
 UNION ALL SELECT 'alter', 1 FROM c, range(6) r(i) WHERE i=0 OR (i=1 AND k%3=0) OR (i=2 AND k%4=0) OR (i=3 AND k%5=0) OR (i=4 AND k%6=0) OR (i=5 AND k%10=0)
 UNION ALL SELECT 'alter', 1 FROM c UNION ALL SELECT 'rename', 1 FROM c WHERE k%7=0 UNION ALL SELECT 'comment', 1 FROM c UNION ALL SELECT 'comment', 1 FROM c WHERE k%2=1
 UNION ALL SELECT 'truncate', 1 FROM c UNION ALL SELECT 'drop', 1 FROM c WHERE k%13=0 UNION ALL SELECT 'drop', 1 FROM c WHERE k%8=0)
SELECT event_type, count(*) AS n FROM s GROUP BY event_type""",
)
def schema_change_rows(spark, d):
    return history.schema_change_rows(_ddl(spark, d)).groupBy("event_type").agg(F.count("*").alias("n"))
