"""Invariants of replay, snapshots and streams."""

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from changeflow.operators import apply, image, lob, position as pos
from changeflow.plans import fixtures as fx
from changeflow.plans.state_queries import COLUMNS, PK
from changeflow.session import shared_dir
from changeflow.sources import snapshot as snap
from changeflow.sources.changelog import changelog_read, changelog_write
from changeflow.streaming import sinks, stateful, store


def state(df):
    return sorted(tuple(r) for r in apply.typed(df, COLUMNS).collect())


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    path = shared_dir(spark, "log")
    changelog_write(fx.order_log(spark, sf_dir), path)
    return changelog_read(spark, path)


@pytest.fixture(scope="module")
def want(spark, sf_dir):
    return sorted(tuple(r) for r in fx.order_snapshot(spark, sf_dir, 10**9).collect())


def test_order_and_repetition_do_not_matter(log, want):
    assert state(apply.current_state(log.orderBy(F.rand(1)), PK)) == want
    assert state(apply.current_state(log.unionByName(log), PK)) == want
    assert state(apply.current_state(pos.dedup_replay(log), PK)) == want


def test_any_split_point(spark, sf_dir, log, want):
    for scn in (9_000_000, 10_000_700, 30_000_333, 40_000_500, 60_000_000):
        rows = apply.snapshot_events(fx.order_snapshot(spark, sf_dir, scn), fx.SCHEMA, "ORDERS", PK, scn)
        assert state(apply.current_state(log, PK, snapshot=rows, from_scn=scn + 1)) == want
        # an overlap of snapshot and log is harmless
        assert state(apply.current_state(log, PK, snapshot=rows, from_scn=scn - 500)) == want


def test_resume_filter_reaches_the_scan(log):
    plan = pos.resume_filter(log, {"position_scn": 5, "group_lsn": 1})._jdf.queryExecution().executedPlan().toString()
    assert "position_scn" in plan.split("PushedFilters")[1].split("]")[0] or "PartitionFilters: [" in plan


def test_state_stream_over_many_batches(spark, log, want):
    src = shared_dir(spark, "src")
    log.repartition(9).write.parquet(src)
    path, progress = shared_dir(spark, "state"), shared_dir(spark, "progress")

    def run():
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(src)
        sinks.current_state_stream(stream, PK, path, progress, compact_every=2, available_now=True).awaitTermination()

    run()
    assert state(sinks.read_state(spark, path)) == want
    # a later run with the same records again changes nothing
    log.repartition(3).write.mode("append").parquet(src)
    run()
    assert state(sinks.read_state(spark, path)) == want


def test_order_guard_over_batches(spark):
    src = shared_dir(spark, "src")
    cols = "lcr_type string, dml string, schema_name string, table_name string, k string, position_scn long, group_lsn long, group_offset int, batch_row_id int, instance_id int"

    def put(rows):
        full = [("DML", "UPDATE", "S", "T", k, p, 0, 0, 0, 0) for k, p in rows]
        spark.createDataFrame(full, cols).coalesce(1).write.mode("append").parquet(src)

    out, marks, progress = (shared_dir(spark, n) for n in ("out", "marks", "progress"))
    for rows in ([("a", 5), ("b", 1)], [("a", 4), ("a", 5), ("a", 6), ("b", 2), ("c", 1)], [("a", 6), ("b", 3)]):
        put(rows)
        stream = spark.readStream.schema(cols).parquet(src)
        sinks.order_guard(stream, ["k"], out, marks, progress, compact_every=2, available_now=True).awaitTermination()
    got = {(r["k"], r["position_scn"], r["batch_id"]): r["late"] for r in sinks.read_guarded(spark, out).collect()}
    assert got == {
        ("a", 5, 0): False, ("b", 1, 0): False, ("a", 4, 1): True, ("a", 5, 1): True, ("a", 6, 1): False, ("b", 2, 1): False,
        ("c", 1, 1): False, ("a", 6, 2): True, ("b", 3, 2): False,
    }


def test_readers_see_committed_batches_only(spark):
    """A batch that fails half-way leaves files and no record; one that runs again after its commit changes nothing."""
    src, out, progress = (shared_dir(spark, n) for n in ("src", "out", "progress"))

    def put(*xs):
        for x in xs:
            spark.createDataFrame([(x,)], "x long").coalesce(1).write.mode("append").parquet(src)

    def run(broken=None):
        stream = spark.readStream.schema("x long").parquet(src)
        x = F.when(F.col("x") == broken, F.raise_error(F.lit("lost"))).otherwise(F.col("x")) if broken else F.col("x")
        sinks.write_changes(stream.select(x.cast("long").alias("x")), out, progress, available_now=True).awaitTermination()

    def seen(**kw):
        return sorted((r["x"], r["batch_id"]) for r in sinks.read_changes(spark, out, **kw).collect())

    put(1, 2)
    run()
    put(3, 4)
    with pytest.raises(StreamingQueryException):
        run(broken=4)
    files = store.Files(spark, out)
    assert files.exists(f"{out}/batch_id=1") and seen() == [(1, 0), (2, 0)]
    run()
    whole = [(1, 0), (2, 0), (3, 1), (4, 1)]
    assert seen() == whole and seen(below=1) == whole[:2]
    folders = store.Commits(spark, out).folders()
    files.remove(f"{progress}/commits/1")
    run()
    assert seen() == whole and store.Commits(spark, out).folders() == folders
    with pytest.raises(StreamingQueryException, match="another query"):
        progress = shared_dir(spark, "progress")
        run()
    assert seen() == whole


def test_readers_before_the_first_batch(spark, log):
    """The tables are there, and empty."""
    src = shared_dir(spark, "none")
    log.limit(0).write.parquet(src)
    for read, start in (
        (sinks.read_changes, sinks.write_changes),
        (sinks.read_state, lambda s, out, p, **kw: sinks.current_state_stream(s, PK, out, p, **kw)),
        (sinks.read_guarded, lambda s, out, p, **kw: sinks.order_guard(s, ["table_name"], out, shared_dir(spark, "marks"), p, **kw)),
    ):
        out = shared_dir(spark, "out")
        with pytest.raises(ValueError, match="no stream"):
            read(spark, out)
        start(spark.readStream.schema(log.schema).parquet(src), out, shared_dir(spark, "progress"), available_now=True).awaitTermination()
        assert read(spark, out).count() == 0


def test_records_fold(spark, monkeypatch):
    """The folders of many batches come from few records."""
    monkeypatch.setattr(store, "FOLD", 3)
    commits = store.Commits(spark, shared_dir(spark, "records"))
    for n in range(8):
        commits.add(n, "q", f"f{n}")
    opened = []
    get = commits.get
    monkeypatch.setattr(commits, "get", lambda n: opened.append(n) or get(n))
    assert commits.folders() == [f"f{n}" for n in range(8)] and opened == [7, 6]
    assert commits.folders(below=4) == ["f0", "f1", "f2", "f3"]


def test_state_buckets(spark, log, want):
    """Ten batches, each of which folds two of eight buckets: equal to batch, old folders go, an old version can be read, and a
    batch of one key reads one bucket."""
    src, path, progress = (shared_dir(spark, n) for n in ("src", "state", "progress"))
    log.repartition(10).write.parquet(src)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(src)
    sinks.current_state_stream(stream, PK, path, progress, compact_every=4, available_now=True, buckets=8, retain=3).awaitTermination()
    assert state(sinks.read_state(spark, path)) == want
    commits = store.Commits(spark, path)
    ids = commits.ids()
    last = commits.get(ids[-1])["tables"]["rows"]
    assert ids == [7, 8, 9] and last["upto"] == [8, 9, 6, 7, 8, 9, 6, 7] and set(last["deltas"]) == {"7", "8", "9"}
    named = {f.split("/")[2] for n in ids for f in commits.get(n)["tables"]["rows"]["deltas"].values()}
    assert set(commits.files.names(f"{path}/rows/delta")) == named
    older = apply.typed(sinks.read_state(spark, path, below=ids[-1]), COLUMNS)
    assert 0 < older.count() <= log.count()

    schema = commits.schema()["rows"].dataType
    table = store.BucketTable(commits, "rows", [*apply.TABLE, "key"], schema, apply.latest_rows, 8, 4)
    whole = table.parts(last)
    one = spark.createDataFrame(whole.take(1), whole.schema)
    assert len(table.touched(one)) == 1
    part = table.parts(last, table.touched(one))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "__bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert 0 < part.select("key").distinct().count() < whole.select("key").distinct().count()


def test_lob_stream_holds_open_objects(spark):
    src = shared_dir(spark, "src")
    cols = "event_id long, col string, type_name string, seq int, bytes binary, is_end boolean, out_row_cols int, commit_ts timestamp"

    def put(rows):
        spark.createDataFrame(rows, cols.replace("commit_ts timestamp", "s long")).withColumn(
            "commit_ts", F.timestamp_seconds("s")
        ).drop("s").coalesce(1).write.mode("append").parquet(src)

    out, progress = shared_dir(spark, "out"), shared_dir(spark, "progress")
    batches = (
        [(1, "C", "CLOB", 1, b"World", True, 2, 100), (1, "C", "CLOB", 0, b"Hello", False, 2, 100), (2, "C", "CLOB", 0, b"open", False, 1, 100)],
        [(1, "B", "BLOB", 0, bytes([1, 2]), False, 2, 101), (1, "B", "BLOB", 1, bytes([3]), True, 2, 101), (3, "Z", "CLOB", 0, b"", True, 1, 101)],
        [(4, "C", "CLOB", 0, b"much later", True, 1, 100_000)],
    )
    for rows in batches:
        put(rows)
        stream = spark.readStream.schema(cols).parquet(src)
        sinks.write_changes(
            stateful.assemble_lobs_stream(stream, "1 minute", 60_000), out, progress, available_now=True
        ).awaitTermination()
    got = {(r["event_id"], r["col"]): (r["text"], r["bytes"], r["complete"]) for r in sinks.read_changes(spark, out).collect()}
    assert got[1, "C"] == ("HelloWorld", None, True)
    assert got[1, "B"] == (None, bytearray([1, 2, 3]), True)
    assert got[3, "Z"] == (None, None, True)
    assert got[2, "C"] == ("open", None, False)


def test_lob_examples(spark):
    rows = [
        (1, "C", "CLOB", 0, b"Hello", False), (1, "C", "CLOB", 1, b"World", True), (1, "C", "CLOB", 1, b"World", True),
        (2, "B", "BLOB", 2, bytes([6, 7, 8, 9]), True), (2, "B", "BLOB", 0, bytes([1, 2, 3]), False), (2, "B", "BLOB", 1, bytes([4, 5]), False),
        (3, "E", "BLOB", 0, b"", True), (4, "U", "CLOB", 0, "é".encode()[:1], False), (4, "U", "CLOB", 1, "é".encode()[1:], True),
    ]
    df = spark.createDataFrame(rows, "event_id long, col string, type_name string, seq int, bytes binary, is_end boolean")
    got = {r["event_id"]: (r["text"], r["bytes"]) for r in lob.assemble_lobs(df).values.collect()}
    assert got == {1: ("HelloWorld", None), 2: (None, bytearray(range(1, 10))), 3: (None, None), 4: ("é", None)}


def test_state_folds_before_the_shuffle(log):
    plan = apply.current_state(log, PK)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max_by" in plan


def test_modes():
    assert snap.phases("schema_only") == snap.phases("no_data") == {"schema": True, "data": False, "stream": True}
    assert snap.phases("initial", True, False) == snap.phases("initial")
    for bad in (("recovery",), ("initial", True, True, False), ("initial", True, True, True, False), ("other",)):
        with pytest.raises(ValueError):
            snap.phases(*bad)


def test_unchanged_and_null_updates(spark):
    rows = [("u", {"k": "1", "a": None}, {"a": None}), ("u", {"k": "1", "a": "x"}, {"a": None}), ("u", {"k": "1", "a": "x"}, {})]
    df = spark.createDataFrame(rows, "op string, before map<string,string>, after map<string,string>")
    full = image.complete_after(df)
    assert [dict(r["after"]) for r in full.collect()] == [{"k": "1", "a": None}, {"k": "1", "a": None}, {"k": "1", "a": "x"}]
    assert image.drop_unchanged(full).count() == 1
    assert image.drop_empty_updates(df).count() == 2


def test_object_with_pauses_comes_whole(spark):
    """Pauses below the time an open object is kept: each chunk moves the one timer on."""
    cols = "event_id long, col string, type_name string, seq int, bytes binary, is_end boolean, out_row_cols int, commit_ts timestamp"
    src, out, progress = (shared_dir(spark, x) for x in ("pauses", "pauses-out", "pauses-progress"))
    pieces = [(0, b"a", False, 1000), (1, b"b", False, 1050), (2, b"c", True, 1100)]
    for seq, data, end, at in pieces:
        row = [(1, "C", "CLOB", seq, data, end, 1, at), (100 + seq, "C", "CLOB", 0, b"x", True, 1, at)]
        df = spark.createDataFrame(row, cols.replace("commit_ts timestamp", "at long"))
        df.select("*", F.timestamp_seconds("at").alias("commit_ts")).drop("at").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(cols).parquet(src)
        sinks.write_changes(stateful.assemble_lobs_stream(stream, "0 seconds", 60_000), out, progress, available_now=True).awaitTermination()
    got = {(r["event_id"], r["text"], r["complete"]) for r in sinks.read_changes(spark, out).filter("event_id = 1").collect()}
    assert got == {(1, "abc", True)}


def test_begun_column_keeps_an_event_open():
    """The stream takes batch's rule: columns that have begun must end, whatever the record expects."""
    a = [("A", 0, False, 1), ("A", 1, True, 1)]
    assert stateful._whole(a)
    assert not stateful._whole([*a, ("B", 0, False, 1)])
    assert stateful._whole([*a, ("B", 0, False, 1), ("B", 1, True, 1)])
    assert not stateful._whole([("A", 1, True, 1)])
    assert not stateful._whole([*a, ("A", 2, False, 1)])
    assert not stateful._whole([("A", 0, True, 2)])


def test_lobs_of_a_stream_in_many_batches_equal_batch(spark):
    """Columns that end in any order, chunks delivered twice, a column that begins and never ends."""
    cols = "event_id long, col string, type_name string, seq int, bytes binary, is_end boolean, out_row_cols int, commit_ts timestamp"
    src, out, progress = (shared_dir(spark, x) for x in ("many", "many-out", "many-progress"))
    rows = [(e, c, "CLOB", s, f"{e}{c}{s};".encode(), s == 2, 1 + (e % 2), 1000 + e) for e in range(12) for c in "AB"[: 1 + e % 2] for s in range(3)]
    rows += [(3, "A", "CLOB", 0, b"3A0;", False, 2, 1003), (20, "A", "CLOB", 0, b"a", True, 1, 1020), (20, "B", "CLOB", 0, b"b", False, 1, 1020)]
    rows.sort(key=lambda r: (r[3] * 7 + r[0]) % 5)
    for i in range(0, len(rows), 11):
        df = spark.createDataFrame(rows[i : i + 11], cols.replace("commit_ts timestamp", "at long"))
        df.select("*", F.timestamp_seconds("at").alias("commit_ts")).drop("at").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(cols).option("maxFilesPerTrigger", 1).parquet(src)
    sinks.write_changes(stateful.assemble_lobs_stream(stream, "1 hour", 10**9), out, progress, available_now=True).awaitTermination()
    got = {(r["event_id"], r["col"], r["text"]) for r in sinks.read_changes(spark, out).filter("complete").collect()}
    chunks = spark.read.schema(cols).parquet(src)
    want = lob.assemble_lobs(chunks, chunks.select("event_id", "out_row_cols").distinct()).values
    assert got == {(r["event_id"], r["col"], r["text"]) for r in want.collect()} and len(got) == 18


class _Store:
    """State and timers of one key, in memory. ``calls`` counts what would each be a round trip."""

    def __init__(self):
        self.value, self.map, self.timers, self.calls, self.watermark = None, {}, set(), 0, 0

    def __getattr__(self, name):
        does = {
            "getValueState": lambda *a: self, "getMapState": lambda *a: self, "getCurrentWatermarkInMs": lambda: self.watermark,
            "getExpiryTimeInMs": lambda: 0, "get": lambda: self.value, "update": lambda v: setattr(self, "value", v),
            "clear": lambda: setattr(self, "value", None), "getValue": lambda k: self.map[k], "updateValue": self.map.__setitem__,
            "removeKey": self.map.__delitem__, "registerTimer": self.timers.add, "deleteTimer": self.timers.remove,
        }[name]

        def call(*args):
            self.calls += 1
            return does(*args)

        return call


def _assembled(store, keep_ms, rows):
    """One micro-batch of chunk rows for a bucket; returns what comes out."""
    worker = stateful.Assembler(keep_ms, 1)
    worker.init(store)
    frame = pd.DataFrame(rows, columns=["event_id", "unnamed", "col", "type_name", "seq", "bytes", "is_end", "out_row_cols", "at_ms"])
    out = [r for df in worker.handleInputRows((0,), iter([frame]), store) for r in df.itertuples(index=False, name=None)] if rows else []
    for due in sorted(t for t in store.timers if t <= store.watermark):
        out += [r for df in worker.handleExpiredTimer((0,), store, store) for r in df.itertuples(index=False, name=None)]
        store.timers.discard(due)
    return out


def _piece(event, seq, last, at=0, col="C"):
    return (event, False, col, "CLOB", seq, f"{event}.{seq};".encode(), seq == last, 1, at)


def test_state_calls_of_a_bucket_do_not_grow_with_its_events():
    def calls(events):
        store, out = _Store(), []
        for seq in range(4):
            out += _assembled(store, 1000, [_piece(e, seq, 3) for e in range(events)])
        assert sorted(out) == sorted((e, "C", "CLOB", "".join(f"{e}.{s};" for s in range(4)).encode(), True) for e in range(events))
        assert not store.map and len(store.timers) == 1
        return store.calls

    assert calls(500) == calls(5) < 50


def test_segments_of_held_chunks(monkeypatch):
    """Many small segments, events that end in another order than they came, objects put together a few at a time."""
    monkeypatch.setattr(stateful, "SEGMENT_BYTES", 40)
    monkeypatch.setattr(stateful, "JOIN_BYTES", 60)
    store, events = _Store(), range(30)
    assert _assembled(store, 10**9, [_piece(e, s, 3) for e in events for s in (2, 0)]) == []
    assert len(store.map) > 5
    assert _assembled(store, 10**9, [_piece(e, 1, 3) for e in events] + [_piece(e, 0, 3) for e in events]) == []
    out = []
    for some in ([29, 3, 11], [e for e in events if e not in (29, 3, 11, 7)]):
        out += _assembled(store, 10**9, [_piece(e, 3, 3) for e in some])
    assert sorted(out) == [(e, "C", "CLOB", f"{e}.0;{e}.1;{e}.2;{e}.3;".encode(), True) for e in events if e != 7]
    # what is left is the one open event; segments that it has no chunk in are gone, others have less of the ended events
    assert 1 <= len(store.map) <= 3
    assert _assembled(store, 10**9, [_piece(e, 0, 3) for e in (3, 11)]) == []  # they have ended and take no more
    store.watermark = 10**10
    assert _assembled(store, 10**9, []) == [(7, "C", "CLOB", b"7.0;7.1;7.2;", False)]
    assert not store.map and not store.timers and store.value is None


def test_events_of_a_bucket_expire_one_by_one():
    """One timer for all: an event that is open, or has ended, goes at its own time; then it may begin anew."""
    store = _Store()
    assert _assembled(store, 100, [_piece(1, 0, 1, at=50), _piece(2, 0, 1, at=10), _piece(3, 0, 0, at=20)]) == [(3, "C", "CLOB", b"3.0;", True)]
    assert store.timers == {110}
    assert _assembled(store, 100, [_piece(2, 0, 1, at=60), _piece(3, 0, 0, at=90)]) == []  # 2 is due at 160 now, 3 stays at 120
    store.watermark = 119
    assert _assembled(store, 100, []) == [] and store.timers == {120}
    store.watermark = 150
    assert _assembled(store, 100, []) == [(1, "C", "CLOB", b"1.0;", False)] and store.timers == {160}
    assert _assembled(store, 100, [_piece(3, 0, 0, at=155)]) == [(3, "C", "CLOB", b"3.0;", True)]
    store.watermark = 160
    assert _assembled(store, 100, []) == [(2, "C", "CLOB", b"2.0;", False)]
    store.watermark = 255
    assert _assembled(store, 100, []) == [] and store.value is None and not store.timers
    with pytest.raises(ValueError, match="buckets"):
        _assembled(store, 100, [_piece(1, 0, 1, at=300)])
        other = stateful.Assembler(100, 2)
        other.init(store)
        list(other.handleExpiredTimer((0,), store, store))


def test_lob_stream_of_few_buckets_equals_batch(spark):
    """Many events share a bucket, its state and its timer over restarts; an event without a name is one of its own."""
    cols = "event_id long, col string, type_name string, seq int, bytes binary, is_end boolean, out_row_cols int, commit_ts timestamp"
    src, out, progress = (shared_dir(spark, x) for x in ("few", "few-out", "few-progress"))
    big = 2**53
    for seq in (1, 0, 2):
        rows = [(big + e, "C", "CLOB", seq, f"{e}.{seq};".encode(), seq == 2, 1, 1000 + seq) for e in range(40) if e != 5 or seq < 2]
        rows.append((None, "C", "BLOB", seq, bytes([seq]), seq == 2, 1, 1000 + seq))
        df = spark.createDataFrame(rows, cols.replace("commit_ts timestamp", "at long"))
        df.select("*", F.timestamp_seconds("at").alias("commit_ts")).drop("at").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(cols).parquet(src)
        sinks.write_changes(stateful.assemble_lobs_stream(stream, "1 hour", 10**6, buckets=3), out, progress, available_now=True).awaitTermination()
    got = sorted((r["event_id"] - big, r["text"], r["complete"]) for r in sinks.read_changes(spark, out).filter("event_id IS NOT NULL").collect())
    assert got == [(e, f"{e}.0;{e}.1;{e}.2;", True) for e in range(40) if e != 5]
    assert [bytes(r["bytes"]) for r in sinks.read_changes(spark, out).filter("event_id IS NULL").collect()] == [b"\x00\x01\x02"]


@pytest.mark.parametrize("parts", [1, 40])
def test_chunks_follow_their_record(spark, sf_dir, parts):
    """Any cut of the log into ranges gives each chunk to the same record."""
    from changeflow.plans.lob_queries import _lob_log

    log = _lob_log(spark, sf_dir)
    chunks, records = lob.log_chunks(log.repartition(7), parts)
    pairs = chunks.select("event_id", "col", "seq").distinct()
    assert records.count() == log.filter("has_chunks").select("position_scn").distinct().count()
    lost = log.filter("lcr_type = 'XACT'").count()
    all_chunks = log.filter("lcr_type = 'CHUNK'").select("position_scn", "chunk_col", "chunk_no").distinct().count()
    orphans = log.filter("lcr_type = 'XACT' AND group_offset = 11").count()  # the other column's chunk stands behind the commit, too
    assert pairs.count() == all_chunks - lost - orphans
