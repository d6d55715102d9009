"""What keeps tasks, shuffles and the driver small as tables grow."""

from pyspark.sql import functions as F

from changeflow.operators import history, incremental, ranges
from changeflow.plans import fixtures, stream_queries
from changeflow.session import shared_dir
from changeflow.sources import keyset
from changeflow.streaming import sinks
from changeflow.streaming.store import Files


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_do_not_join_the_table_with_its_ranges(spark):
    rows = spark.range(5_000).select((F.col("id") * 7 % 5_000).alias("k"), F.when(F.col("id") % 50 != 0, F.col("id")).alias("maybe"))
    chunks = keyset.keyset_chunks(rows, ["k"], 300, parts=13)
    assert "Join" not in plan_of(chunks)
    assert sorted((r["k"], r["chunk_id"]) for r in chunks.collect()) == [(k, k // 300) for k in range(5_000)]
    # null keys come first and are counted
    sizes = keyset.keyset_chunks(rows, ["maybe"], 300, parts=13).groupBy("chunk_id").count().collect()
    assert sorted((r["chunk_id"], r["count"]) for r in sizes) == [(i, 300 if i < 16 else 200) for i in range(17)]
    assert keyset.keyset_chunks(rows.limit(0), ["k"], 300).count() == 0


def test_timeline_of_many_small_tables_takes_no_sample(spark, monkeypatch):
    """More changes than fit one task, but few of each table: nothing is searched for hot keys, and the result is the same."""
    ddl = spark.range(40).select(
        (F.col("id") % 8 * 100 + F.col("id")).alias("scn"), F.lit("S").alias("schema_name"),
        F.concat(F.lit("CREATE TABLE T"), F.col("id"), F.lit(" (A INT PRIMARY KEY, B INT)")).alias("ddl_text"),
    )
    moves = spark.range(40).filter("id % 4 = 1").select(
        (F.col("id") + 5_000).alias("scn"), F.lit("S").alias("schema_name"),
        F.concat(F.lit("ALTER TABLE T"), F.col("id"), F.lit(" RENAME TO R"), F.col("id")).alias("ddl_text"),
    )
    changes = history.column_changes(ddl.unionByName(moves))
    want = sorted(tuple(r) for r in history.fold_schema(history.schema_timeline(changes)).collect())
    assert len(want) == 80 and {r[1] for r in want} == {f"{'R' if i % 4 == 1 else 'T'}{i}" for i in range(40)}
    monkeypatch.setattr(history, "SMALL", 50)
    samples = []
    monkeypatch.setattr(ranges, "_sample", lambda *a: samples.append(a) or [])
    timeline = history.schema_timeline(changes)
    assert sorted(tuple(r) for r in history.fold_schema(timeline).collect()) == want
    assert not samples
    # one table with more changes than that is searched
    monkeypatch.setattr(history, "SMALL", 2)
    history.schema_timeline(changes)
    assert samples


def test_versions_read_the_timeline_once(spark):
    """Starts, ends and columns come from one written table, not from three runs of the whole timeline."""
    ddl = spark.createDataFrame([(1, "S", "CREATE TABLE T (A INT)"), (2, "S", "ALTER TABLE T ADD COLUMN B INT")], "scn long, schema_name string, ddl_text string")
    changes = history.column_changes(ddl)
    versions = history.schema_versions(changes, history.schema_timeline(changes))
    assert "Window" not in plan_of(versions)
    assert sorted((int(r["version_scn"]), r["columns"]) for r in versions.collect()) == [(1, ["A"]), (2, ["A", "B"])]


def test_requests_are_dealt_out_over_a_plan(spark):
    """Many requests of one table and condition: chunks are computed once and go to every task."""
    data = '{"data-collections":["S.T"],"type":"incremental"}'
    signals = spark.range(30).select(F.col("id").cast("string").alias("id"), F.lit("execute-snapshot").alias("type"), F.lit(data).alias("data"))
    plan = incremental.chunk_plan(signals, {"S.T": (spark.range(100), ["id"])}, 25)
    text = plan_of(plan)
    assert "rightHint=(strategy=broadcast)" in text and "Window" not in text
    assert plan.rdd.getNumPartitions() > 1
    assert plan.columns == ["table", "condition", "chunk_id", "low_key", "high_key", "rows", "id"]
    assert sorted((int(r["id"]), r["chunk_id"], r["rows"]) for r in plan.collect()) == [(i, c, 25) for i in range(30) for c in range(4)]


def test_a_batch_is_many_files_and_still_one_batch(spark):
    """Parts of different sizes, one without rows: each is a micro-batch, none is written or read as a whole by one task."""
    rows = spark.range(1_000).select(F.col("id").alias("x"), F.when(F.col("id") < 900, 0).when(F.col("id") < 903, 1).otherwise(3).alias("part"))
    path, out = shared_dir(spark, "files"), shared_dir(spark, "out")
    files = stream_queries.files_of_parts(rows, 4, path, rows=100)
    assert files == 9
    stream = spark.readStream.schema("x long").option("maxFilesPerTrigger", files).parquet(path)
    sinks.write_changes(stream, out, shared_dir(spark, "progress"), available_now=True).awaitTermination()
    got = sinks.read_changes(spark, out).groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in got} == {0: 900, 1: 3, 3: 97}


def test_tasks_are_counted_by_rows(spark, monkeypatch, sf_dir):
    """A small file of many rows is dealt to as many tasks as its rows ask for."""
    monkeypatch.setattr(fixtures, "TASK_ROWS", 50)
    orders = fixtures.table(spark, sf_dir, "orders")
    assert orders.rdd.getNumPartitions() == -(-orders.count() // 50)


def test_texts_are_cut_in_one_pass(spark):
    """Pieces by characters, whatever their bytes and lines; no piece is searched for in the whole text."""
    texts = [(1, "x" * 7), (2, "a\nb\r\u2028\u0085é😀\U0001f600z" * 3), (3, ""), (4, None), (5, "abc"), (6, "ab\n\n\n\n")]
    cut = fixtures.cut_into_chunks(spark.createDataFrame(texts, "doc_id long, text string"), 3)
    got = sorted((r["event_id"], r["seq"], bytes(r["bytes"]).decode() if r["bytes"] is not None else None, r["is_end"]) for r in cut.collect())
    want = [(i, k, t and t[3 * k : 3 * k + 3], k == max(0, -(-len(t or "") // 3) - 1)) for i, t in texts for k in range(max(1, -(-len(t or "") // 3)))]
    assert got == want
    assert "substring" not in plan_of(cut) and plan_of(cut).count("regexp_extract_all") == 1


def test_parts_are_kept_once_and_shuffles_go(spark):
    """Staged parts go as they are dealt out; the shuffle files of a stream's batches go with the batch."""
    seen = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name, None), seen.size()
    rows = spark.range(1_000).select(F.col("id").alias("x"), (F.col("id") % 2).alias("part")).repartition(3)
    path, out = shared_dir(spark, "once"), shared_dir(spark, "out")
    files = stream_queries.files_of_parts(rows, 2, path, rows=100)
    assert not [f for f in Files(spark, path).names(f"{path}-parts") if f.startswith("part=")]
    stream = spark.readStream.schema("x long").option("maxFilesPerTrigger", files).parquet(path).repartition(5)
    sinks.write_changes(stream, out, shared_dir(spark, "progress"), available_now=True).awaitTermination()
    assert seen.size() <= before and spark.conf.get(name, None) == setting
    assert sinks.read_changes(spark, out).agg(F.sum("x")).first()[0] == 499_500
