"""Change-log shaped inputs that Spark derives from the driver's tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

SCHEMA = "S1"


def _utc(df: DataFrame) -> DataFrame:
    """Times without a zone are UTC, as everywhere in a change log."""
    local = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in local}) if local else df


#: Rows of a stored table that one task takes. A row becomes several log records or chunks of many times its stored size, and
#: a task sorts what it makes of its rows, so tasks are counted by rows and not by the bytes of the file.
TASK_ROWS = 250_000
DOCUMENT_ROWS = 10_000


def _tasks(stored: DataFrame, name: str) -> int | None:
    """Tasks to deal the rows to; none if the file gives as many by itself. Rows are counted from the file's footers."""
    rows = stored.count()
    want = max(stored.sparkSession.sparkContext.defaultParallelism, -(-rows // (DOCUMENT_ROWS if name == "documents" else TASK_ROWS)))
    return want if stored.rdd.getNumPartitions() < want else None


def _spread(df: DataFrame, tasks: int | None) -> DataFrame:
    return df.repartition(tasks) if tasks else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    stored = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return _spread(_utc(stored), _tasks(stored, name))


def stream_table(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """The same table as an unbounded file source."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = os.path.join(sf_dir, f"{name}.parquet")
    stored = spark.read.parquet(path)
    reader = spark.readStream.schema(stored.schema).options(**options)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(place).isDirectory():
        stream = reader.parquet(path)
    else:
        # a stream reads folders: the one file is picked out of its folder
        stream = reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return _utc(_spread(stream, _tasks(stored, name)))


def order_changes(orders: DataFrame) -> DataFrame:
    """Insert, price update, set-to-null, key change and delete per order, some delivered twice.

    One scan: the stages of an order are an array that is exploded. Works on batch and stream.
    No array is empty; the outer form spares the optimizer's test of that, which would build it twice.
    """
    k, st, p, pr = (F.col(c) for c in ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))
    none_l, none_s, none_d = (F.lit(None).cast(t) for t in ("long", "string", "double"))
    p1 = p + F.when(k % 3 == 0, 1.0).otherwise(0.0)
    pr1 = F.when(k % 5 == 0, none_s).otherwise(pr)

    def stage(base: int, dml: str, before: tuple, after: tuple, present: str) -> Column:
        names = ("b_k", "b_st", "b_p", "b_pr", "a_k", "a_st", "a_p", "a_pr")
        return F.struct(
            (k + base).alias("scn"),
            F.lit(dml).alias("dml"),
            *[v.alias(n) for n, v in zip(names, (*before, *after))],
            F.lit(present).alias("present"),
        )

    nothing = (none_l, none_s, none_d, none_s)
    k2 = F.when(k % 11 == 0, k + 10_000_000).otherwise(k)
    stages = F.array_compact(
        F.array(
            stage(10_000_000, "INSERT", nothing, (k, st, p, pr), "k,st,p,pr"),
            F.when(k % 3 == 0, stage(20_000_000, "UPDATE", (k, st, p, pr), (none_l, none_s, p + 1, none_s), "p")),
            F.when(k % 5 == 0, stage(30_000_000, "UPDATE", (k, st, p1, pr), nothing, "pr")),
            F.when(
                k % 11 == 0,
                stage(40_000_000, "UPDATE", (k, st, p1, pr1), (k + 10_000_000, none_s, none_d, none_s), "k"),
            ),
            F.when(k % 7 == 0, stage(50_000_000, "DELETE", (k2, st, p1, pr1), nothing, "")),
        )
    )
    rows = orders.select(k.alias("ok"), "o_orderdate", F.explode_outer(stages).alias("e")).select(
        "e.*", "ok", "o_orderdate"
    )
    twice = F.when(F.col("scn") % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "*",
        F.floor(F.col("scn") / 100).cast("long").alias("tx_no"),
        (F.col("ok") % 3 + 1).cast("int").alias("redo_thread"),
        F.explode_outer(twice).alias("redelivery"),
    )


def as_lcr(flat: DataFrame, table_name: str = "ORDERS") -> DataFrame:
    """Pack flat change rows into log records with map images."""
    text = {c: (F.col(f"b_{c}").cast("string"), F.col(f"a_{c}").cast("string")) for c in ("k", "st", "p", "pr")}
    full = lambda side: F.create_map(*[x for c, v in text.items() for x in (F.lit(c), v[side])])
    present = F.split("present", ",")
    return flat.select(
        F.lit("DML").alias("lcr_type"),
        "dml",
        F.lit(SCHEMA).alias("schema_name"),
        F.lit(table_name).alias("table_name"),
        F.concat(F.lit("tx"), F.col("tx_no").cast("string")).alias("tx_id"),
        "redo_thread",
        F.col("scn").alias("position_scn"),
        (F.col("scn") * 2).alias("group_lsn"),
        (F.col("scn") % 1000).cast("int").alias("group_offset"),
        F.lit(0).alias("batch_row_id"),
        F.lit(1).alias("instance_id"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("scn") / 10_000_000).cast("int"))).alias("commit_ts"),
        F.when(F.col("dml") != "INSERT", full(0)).alias("before"),
        F.map_filter(full(1), lambda c, v: F.array_contains(present, c)).alias("after"),
        F.lit(False).alias("has_chunks"),
        F.lit(0).alias("out_row_cols"),
        F.lit(None).cast("string").alias("ddl_text"),
        "redelivery",
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_lcr(order_changes(table(spark, sf_dir, "orders")))


def order_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_lcr(order_changes(stream_table(spark, sf_dir, "orders")))


def full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row changes plus begin, commit, chunk, metadata and truncate records.

    Transactions whose number ends in 0 have no commit record.
    """
    log = order_log(spark, sf_dir)
    per_tx = log.groupBy("tx_id").agg(
        F.min("position_scn").alias("first"), F.max("position_scn").alias("last"), F.max("commit_ts").alias("ts")
    )
    number = F.regexp_extract("tx_id", r"(\d+)", 1).cast("long")
    begin = _control(per_tx, "XACT", "BEGIN", F.col("first"), -1)
    commit = _control(per_tx.filter(number % 10 != 0), "XACT", "COMMIT", F.col("last"), 1)
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("tx_id"),
        F.col("o_orderdate").alias("ts"),
        (F.col("o_orderkey") + 10_000_000).alias("first"),
        "o_orderkey",
    )
    meta = _control(orders.filter("o_orderkey % 100 = 0"), "METADATA", None, F.col("first"), 0)
    chunk = _control(orders.filter("o_orderkey % 100 = 1"), "CHUNK", None, F.col("first"), 0)
    return log.unionByName(begin).unionByName(commit).unionByName(meta).unionByName(chunk)


def _control(rows: DataFrame, kind: str, dml: str | None, scn: Column, shift: int) -> DataFrame:
    image = F.lit(None).cast("map<string,string>")
    return rows.select(
        F.lit(kind).alias("lcr_type"),
        F.lit(dml).cast("string").alias("dml"),
        F.lit(SCHEMA).alias("schema_name"),
        F.lit("ORDERS").alias("table_name"),
        "tx_id",
        F.lit(1).alias("redo_thread"),
        scn.alias("position_scn"),
        (scn * 2 + shift).alias("group_lsn"),
        F.lit(0).alias("group_offset"),
        F.lit(0).alias("batch_row_id"),
        F.lit(1).alias("instance_id"),
        F.col("ts").alias("commit_ts"),
        image.alias("before"),
        image.alias("after"),
        F.lit(False).alias("has_chunks"),
        F.lit(0).alias("out_row_cols"),
        F.lit(None).cast("string").alias("ddl_text"),
        F.lit(0).alias("redelivery"),
    )


def order_snapshot(spark: SparkSession, sf_dir: str, scn: int) -> DataFrame:
    """Content of the order table once every change up to ``scn`` is in (closed form)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    done = lambda base: F.lit(scn) >= k + base
    return o.filter(done(10_000_000) & ~((k % 7 == 0) & done(50_000_000))).select(
        F.when((k % 11 == 0) & done(40_000_000), k + 10_000_000).otherwise(k).alias("k"),
        F.col("o_orderstatus").alias("st"),
        (F.col("o_totalprice") + F.when((k % 3 == 0) & done(20_000_000), 1.0).otherwise(0.0)).alias("p"),
        F.when(~((k % 5 == 0) & done(30_000_000)), F.col("o_orderpriority")).alias("pr"),
    )


def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select((F.col("event_id") * 10).alias("scn"), "ts")


def lob_chunks(spark: SparkSession, sf_dir: str, size: int = 500) -> DataFrame:
    return cut_into_chunks(table(spark, sf_dir, "documents"), size)


def cut_into_chunks(documents: DataFrame, size: int = 500) -> DataFrame:
    """Document texts cut into pieces of ``size`` characters. Works on batch and stream."""
    # in one pass: a piece taken by its place in the text would read all of the text
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    d = documents.select("doc_id", F.when(F.length("text") > 0, pieces).otherwise(F.array("text")).alias("pieces"))
    rows = d.select("doc_id", F.size("pieces").alias("n"), F.posexplode_outer("pieces").alias("seq", "piece"))
    return rows.select(
        F.col("doc_id").alias("event_id"),
        F.lit("TEXT").alias("col"),
        F.lit("CLOB").alias("type_name"),
        "seq",
        F.encode("piece", "UTF-8").alias("bytes"),
        (F.col("seq") == F.col("n") - 1).alias("is_end"),
        F.timestamp_seconds(F.col("doc_id") + 1_000_000).alias("commit_ts"),
    )


def truncate_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer inserts, one truncate, inserts of the even keys again."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    first = c.select((k + 10_000_000).alias("scn"), "c_custkey", "c_name")
    again = c.filter(k % 2 == 0).select((k + 30_000_000).alias("scn"), "c_custkey", "c_name")
    rows = first.unionByName(again)
    inserts = rows.select(
        F.lit("DML").alias("lcr_type"),
        F.lit("INSERT").alias("dml"),
        F.lit(None).cast("string").alias("ddl_text"),
        F.col("scn"),
        F.create_map(F.lit("k"), F.col("c_custkey").cast("string"), F.lit("nm"), F.col("c_name")).alias("after"),
    )
    # one statement, dated from the data
    cut = c.agg(F.count("*").alias("n")).select(
        F.lit("DDL").alias("lcr_type"),
        F.lit(None).cast("string").alias("dml"),
        F.lit("TRUNCATE TABLE CUSTOMER REUSE STORAGE").alias("ddl_text"),
        F.lit(20_000_000).cast("long").alias("scn"),
        F.lit(None).cast("map<string,string>").alias("after"),
    )
    return _positioned(inserts.unionByName(cut), "CUSTOMER")


def _positioned(rows: DataFrame, table_name: str | None = None) -> DataFrame:
    have = set(rows.columns)
    out = rows.select(
        *[c for c in rows.columns if c != "scn"],
        F.lit(SCHEMA).alias("schema_name"),
        *([F.lit(table_name).alias("table_name")] if "table_name" not in have else []),
        F.col("scn").alias("position_scn"),
        (F.col("scn") * 2).alias("group_lsn"),
        F.lit(0).alias("group_offset"),
        F.lit(0).alias("batch_row_id"),
        F.lit(1).alias("instance_id"),
    )
    if "before" not in have:
        out = out.withColumn("before", F.lit(None).cast("map<string,string>"))
    return out


def supplier_truncates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A truncate and a comment statement per supplier, with table names quoted in several ways."""
    s = table(spark, sf_dir, "supplier")
    name = F.concat(F.lit("t"), F.col("s_suppkey").cast("string"))
    target = (
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("s1."), name))
        .when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit('"S1"."T'), F.col("s_suppkey").cast("string"), F.lit('"')))
        .otherwise(name)
    )
    text = F.array(
        F.struct(F.lit(20_000_000).alias("base"), F.concat(F.lit("truncate  TABLE "), target, F.lit(" DROP STORAGE")).alias("ddl_text")),
        F.struct(F.lit(30_000_000).alias("base"), F.concat(F.lit("COMMENT ON TABLE "), target, F.lit(" IS 'truncate table x'")).alias("ddl_text")),
    )
    rows = s.select("s_suppkey", F.explode(text).alias("e")).select(
        F.lit("DDL").alias("lcr_type"),
        F.lit(None).cast("string").alias("dml"),
        F.col("e.ddl_text").alias("ddl_text"),
        (F.col("s_suppkey") + F.col("e.base")).alias("scn"),
        F.lit("").alias("table_name"),
        F.lit(None).cast("map<string,string>").alias("after"),
    )
    return _positioned(rows)


def ddl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table statements per customer k: two tables, T<k> and "s1"."Mixed<k>", and their changes.

    Which statements a customer has follows from k; statement n runs at SCN k * 100 + n.
    """
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    k = F.col("k")
    t = lambda pattern: F.format_string(pattern, *[k] * pattern.count("%d"))
    now = F.when(k % 7 == 0, t("S1.R%d")).otherwise(t("S1.T%d"))
    key_part = F.when(k % 2 == 0, "PRIMARY KEY (ID)").otherwise("CONSTRAINT PK1 PRIMARY KEY (ID)")
    always = F.lit(True)
    statements = (
        (10, always, F.concat(
            t("CREATE TABLE S1.T%d (ID NUMBER("), (k % 38 + 1).cast("string"), t(") NOT NULL, NOTE VARCHAR(200) DEFAULT 'x, (%d', AMT NUMBER(12,"),
            (k % 5).cast("string"), F.lit("), "), key_part, F.lit(")"))),
        (11, always, t('create table "s1"."Mixed%d" (ID INT PRIMARY KEY, D DATE DEFAULT SYSDATE NOT NULL, J JSON, B BLOB, C CLOB);')),
        (12, k % 2 == 0, t("CREATE TABLE S1.T%d (X INT)")),
        (20, always, t("ALTER TABLE S1.T%d ADD COLUMN TS TIMESTAMP(3)")),
        (21, k % 3 == 0, F.concat(t("ALTER TABLE S1.T%d MODIFY NOTE VARCHAR("), (k % 500 + 1).cast("string"), F.lit(")"))),
        (22, k % 4 == 0, t("ALTER TABLE S1.T%d RENAME COLUMN AMT TO AMOUNT")),
        (23, k % 5 == 0, t("ALTER TABLE S1.T%d ADD CONSTRAINT PK2 PRIMARY KEY (ID, TS)")),
        (24, k % 6 == 0, F.when(k % 12 == 0, t("ALTER TABLE S1.T%d DROP COLUMN NOTE")).otherwise(t("ALTER TABLE S1.T%d DROP COLUMN (NOTE)"))),
        (25, k % 10 == 0, t("ALTER TABLE S1.T%d DROP PRIMARY KEY")),
        (26, always, t("COMMENT ON TABLE S1.T%d IS 'orders %d'")),
        (27, k % 2 == 1, t("COMMENT ON COLUMN S1.T%d.ID IS 'it''s the key'")),
        (30, k % 7 == 0, t("ALTER TABLE S1.T%d RENAME TO R%d")),
        (31, always, t("ALTER TABLE S1.NOPE%d ADD X INT")),
        (32, always, F.concat(F.lit("TRUNCATE TABLE "), now, F.lit(" REUSE STORAGE"))),
        (33, k % 9 == 0, F.lit("CREATE TABEL broken (")),
        (34, k % 9 == 1, F.concat(F.lit("ALTER TABLE "), now, F.lit(" SHUFFLE EVERYTHING"))),
        (35, always, t("CREATE INDEX I%d ON S1.T%d (ID)")),
        (40, k % 13 == 0, F.concat(F.lit("DROP TABLE "), now)),
        (41, k % 26 == 0, t("CREATE TABLE S1.T%d (Y INT DEFAULT 7 NOT NULL)")),
        (42, k % 8 == 0, t('DROP TABLE "s1"."Mixed%d"')),
    )
    rows = F.array_compact(
        F.array(*[
            F.when(test, F.struct((k * 100 + n).alias("scn"), F.lit(n).alias("n"), text.alias("ddl_text"))) for n, test, text in statements
        ])
    )
    return c.select("k", F.explode_outer(rows).alias("e")).select("k", "e.*", F.lit(SCHEMA).alias("schema_name"))
