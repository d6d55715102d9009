"""Streaming operators with state of their own: replay removal and object assembly.

The Python parts only see Arrow batches of one bucket of events and hold no more than that bucket's rows of a batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from changeflow.model import POSITION_FIELDS
from changeflow.operators.lob import lob_values

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State that spills to disk; needed by the processors below. Each state partition is a store of its own, whose log files
    would take some MB beforehand."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")


def dedup_stream(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Replay removal with bounded state: a record delivered again within ``delay`` is dropped."""
    return stream.withWatermark("commit_ts", delay).dropDuplicatesWithinWatermark(
        ["lcr_type", "dml", "schema_name", "table_name", *POSITION_FIELDS]
    )


_NUMBER = T.StructType([T.StructField("number", T.LongType())])
_PACKED = T.StructType([T.StructField("packed", T.BinaryType())])


def _whole(marks: list[tuple[str, int, bool, int]]) -> bool:
    """Whether an event has ended, as in ``assemble_lobs``: every column that has begun has an end mark, every chunk before it
    and none behind it, and as many columns as the record expects have ended."""
    places: dict[str, set[int]] = {}
    last: dict[str, int] = {}
    for col, seq, end, _ in marks:
        places.setdefault(col, set()).add(seq)
        if end:
            last[col] = max(seq, last.get(col, seq))
    ended = [c for c, seen in places.items() if c in last and max(seen) == last[c] and len(seen) == last[c] + 1]
    return len(ended) == len(places) and len(ended) >= max(n for *_, n in marks)


_ASSEMBLED = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("col", T.StringType()),
        T.StructField("type_name", T.StringType()),
        T.StructField("bytes", T.BinaryType()),
        T.StructField("complete", T.BooleanType()),
    ]
)


def _pack(value: tuple | dict) -> tuple[bytes]:
    """A state value: pickled and compressed behind its length."""
    plain = pickle.dumps(value, 5)
    return (len(plain).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True),)


def _unpack(stored: tuple[bytes]) -> tuple | dict:
    size, packed = int.from_bytes(stored[0][:8], "little"), memoryview(stored[0])[8:]
    return pickle.loads(pa.decompress(packed, decompressed_size=size, codec="zstd"))


#: buckets that events fall into; a checkpoint stays with the number it began with
BUCKETS = 1024
#: bytes of held chunks that are stored, and read again, in one piece
SEGMENT_BYTES = 256 << 10
#: bytes of objects that are put together at once
JOIN_BYTES = 32 << 20


class Assembler(StatefulProcessor):
    """Holds the chunks of the events of one bucket until every column of an event has ended.

    A call of the state or a key costs far more than a chunk, so a batch makes a few calls per bucket, however many events and
    chunks it has. ``events`` is read and written in each batch that the bucket has rows in. It has

    * ``done``: event -> until when an event that has ended is known,
    * ``held``: event -> until when an event is held open, the marks (places) of its chunks, their bytes, and the numbers of the
      segments that have them,
    * the one timer of the bucket, at or before the first of these times; the next segment number; the number of buckets.

    ``pieces`` has the bytes, in segments of bounded size: those that the bucket has to hold after a batch are appended. A
    segment is read when one of its events ends, written anew when three quarters of its events have gone, and removed with the last.
    """

    def __init__(self, keep_ms: int, buckets: int) -> None:
        self.keep_ms, self.buckets = keep_ms, buckets

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getValueState("events", _PACKED)
        self.pieces = handle.getMapState("pieces", _NUMBER, _PACKED)

    def _load(self) -> None:
        stored = self.events.get()
        self.done, self.held, self.timer, self.next, buckets = (
            _unpack(stored) if stored is not None else ({}, {}, None, 0, self.buckets)
        )
        if buckets != self.buckets:
            raise ValueError(f"the state has {buckets} buckets of events, not {self.buckets}")

    def _store(self) -> None:
        if self.done or self.held:
            self.events.update(_pack((self.done, self.held, self.timer, self.next, self.buckets)))
        else:
            self.events.clear()

    def _wake(self, due: int) -> None:
        """Be called at ``due``, or before."""
        if self.timer is None or due < self.timer:
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            self.handle.registerTimer(due)
            self.timer = due

    def _append(self, fresh: dict) -> None:
        """Store the chunks of events that stay open."""
        segment, size = {}, 0
        for event, chunks in fresh.items():
            for chunk in chunks:
                segment.setdefault(event, []).append(chunk)
                size += len(chunk[3])
                if size >= SEGMENT_BYTES:
                    self._segment(segment)
                    segment, size = {}, 0
        if segment:
            self._segment(segment)

    def _segment(self, segment: dict) -> None:
        self.pieces.updateValue((self.next,), _pack(segment))
        for event in segment:
            self.held[event][3].append(self.next)
        self.next += 1

    def _take(self, events: list) -> dict:
        """The stored chunks of events, oldest first; the events are held no more."""
        wanted = {event: self.held.pop(event) for event in events if event in self.held}
        taken: dict = {}
        for number in sorted({n for *_, numbers in wanted.values() for n in numbers}):
            segment = _unpack(self.pieces.getValue((number,)))
            for event in segment.keys() & wanted.keys():
                if number in wanted[event][3]:
                    taken.setdefault(event, []).extend(segment[event])
            left = {e: chunks for e, chunks in segment.items() if e in self.held and number in self.held[e][3]}
            if not left:
                self.pieces.removeKey((number,))
            elif 4 * len(left) <= len(segment):
                self.pieces.updateValue((number,), _pack(left))
        return taken

    def _join(self, events: list, fresh: dict, complete: bool) -> Iterator[pd.DataFrame]:
        """Objects of events from their stored and their fresh chunks, so many at once as have ``JOIN_BYTES``."""
        some, size = [], 0
        for i, event in enumerate(events):
            some.append(event)
            size += (self.held[event][2] if event in self.held else 0) + sum(len(c[3]) for c in fresh.get(event, ()))
            if size >= JOIN_BYTES or i == len(events) - 1:
                stored = self._take(some)
                rows = [row for e in some for row in _objects(e, stored.get(e, []) + fresh.get(e, []), complete)]
                some, size = [], 0
                yield pd.DataFrame(rows, columns=_ASSEMBLED.fieldNames(), dtype=object)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._load()
        fresh: dict = {}
        marks: dict = {}
        newest: dict = {}
        expected: dict = {}
        names: dict = {}
        for batch in rows:
            columns = (batch[c].tolist() for c in _FRESH)
            for event, unnamed, col, kind, seq, data, end, out_row_cols, at in zip(*columns, strict=True):
                event = None if unnamed else int(event)
                if event in self.done:
                    continue
                col, seq = names.setdefault(col, col), int(seq)
                fresh.setdefault(event, []).append((col, names.setdefault(kind, kind), seq, data or b""))
                marks.setdefault(event, []).append((col, seq, bool(end)))
                newest[event] = max(at, newest.get(event, 0))
                expected[event] = max(out_row_cols, expected.get(event, 0))
        if not fresh:
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        whole: dict = {}
        dues = []
        for event, new in marks.items():
            due, known, size, numbers = self.held.get(event, (0, [], 0, []))
            due = max(due, int(max(newest[event], watermark)) + self.keep_ms)
            dues.append(due)
            known = known + [(*mark, int(expected[event])) for mark in new]
            if _whole(known):
                whole[event] = due
            else:
                self.held[event] = (due, known, size + sum(len(c[3]) for c in fresh[event]), numbers)
        self._wake(min(dues))
        yield from self._join([*whole], fresh, True)
        self._append({event: chunks for event, chunks in fresh.items() if event not in whole})
        self.done |= whole
        self._store()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load()
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        yield from self._join([event for event, (due, *_) in self.held.items() if due <= now], {}, False)
        self.done = {event: due for event, due in self.done.items() if due > now}
        self.timer = None
        if self.done or self.held:
            self._wake(min([*self.done.values(), *(due for due, *_ in self.held.values())]))
        self._store()

    def close(self) -> None:
        pass


_FRESH = ("event_id", "unnamed", "col", "type_name", "seq", "bytes", "is_end", "out_row_cols", "at_ms")


def _objects(event: int | None, chunks: list, complete: bool) -> Iterator[tuple]:
    """The columns of an event, their chunks in order; of a chunk that came twice the last counts."""
    cols: dict = {}
    for col, kind, seq, data in chunks:
        cols.setdefault(col, {})[seq] = (kind, data)
    for col, pieces in cols.items():
        order = sorted(pieces)
        yield event, col, pieces[order[0]][0], b"".join(pieces[seq][1] for seq in order), complete


def assemble_lobs_stream(chunks: DataFrame, delay: str = "10 minutes", keep_ms: int = 600_000, buckets: int = BUCKETS) -> DataFrame:
    """Streaming ``assemble_lobs``: values once every column of the event has ended.

    Chunks carry ``out_row_cols`` and ``commit_ts``. What is still open ``keep_ms`` of event time
    after its last chunk comes out with ``complete`` false; the state of an event ends there too.
    Chunks whose time lies at or before the watermark are dropped; it starts at the epoch, so chunks
    must be dated later than that.

    Events lie in ``buckets`` by a hash: the work of a batch is a few calls of the state per bucket and some steps per chunk.
    The number bounds the tasks that have rows, and what one task holds in Python: the chunks of a batch that fall into a
    bucket. It should grow with the stream, and stays what it was when the checkpoint began.
    """
    use_rocksdb(chunks.sparkSession)
    slim = chunks.withWatermark("commit_ts", delay).select(
        F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int").alias("bucket"),
        # a null would make pandas read all numbers of a batch as floats
        F.coalesce(F.col("event_id").cast("long"), F.lit(0)).alias("event_id"), F.col("event_id").isNull().alias("unnamed"),
        "col", "type_name", "seq", "bytes", "is_end", F.coalesce(F.col("out_row_cols").cast("int"), F.lit(0)).alias("out_row_cols"),
        F.coalesce(F.unix_millis("commit_ts"), F.lit(0)).alias("at_ms"), "commit_ts",
    )
    joined = slim.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Assembler(keep_ms, buckets), outputStructType=_ASSEMBLED, outputMode="Append", timeMode="EventTime"
    )
    return lob_values(joined, "complete")
