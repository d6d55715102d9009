"""Removal of repeated windows of a fixed number of symbols, the common course of the suffix and the substring dedup.

1. Seeds. Every window has an anchor, the smallest q-gram in it (``rolling.anchors``). Seeds with one occurrence are done:
   their windows are unique. Only a hash and an id are shuffled for each anchor, folded before the shuffle.
2. Runs. The windows that share an anchor are a run. Runs of equal content at an equal offset form classes; a class with a
   partner is settled as a whole.
3. Blocks. Where a seed has several classes, a run stands for each class (with ``earlier`` the runs of its first document, which
   may still lose windows), and these runs are cut into blocks of windows, aligned by the offset from the anchor. Blocks of
   equal content are settled; a block is closed if what all its windows share, its core, has no other block or only settled
   ones; the rest is cut into smaller blocks, down to single windows. What is settled is held against the rest and not written again.
4. Removal. Settled spans are gathered per document and cut out.

No step pairs up occurrences: each is a count or a minimum per key, joined back, so a passage held by a third of all
documents costs as much as any other text. Every step is written to the shared folder, so its shuffle is freed and a
lost executor repeats one step at most. Contents that share an anchor are told apart by a 64-bit value that mixes a polynomial
modulo 2**64 with two modulo a prime.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm import rolling
from changeflow.llm.common import discard, documents, stage

LAST = (1 << 63) - 1
#: Bytes of text that a task works on at a time, and rows that it is handed at a time.
PART_BYTES = 1 << 18
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}

# from the bytes of rows to (symbols, where each row starts in them)
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Plan:
    """``window`` symbols are compared, ``seed`` of them make an anchor, ``blocks`` are the sizes that runs are cut to, the last
    1. ``earlier``: a window goes only if it also starts in a document with a smaller id; otherwise if it starts
    anywhere else, the same document included."""

    symbols: Symbols
    window: int
    seed: int
    blocks: tuple[int, ...]
    earlier: bool


class Contents:
    """Hashes that tell contents apart."""

    def __init__(self, symbols: np.ndarray):
        self.one, self.two = rolling.Spans(symbols, rolling.BASES[1]), rolling.PrimeSpans(symbols)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return rolling.mix(self.one.hash(start, end) + rolling.mix(self.two.hash(start, end)))


def _seeds(plan: Plan, placed: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, names = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, hi, data, offsets in rolling.text_parts(batch, part_bytes=PART_BYTES):
                symbols, at = plan.symbols(data, offsets)
                grams = rolling.Spans(symbols).grams(plan.seed)
                row, anchor, _, _ = rolling.anchors(grams, at, plan.window, plan.seed)
                h = pa.array(rolling.signed(grams[anchor]))
                if placed:
                    yield pa.RecordBatch.from_arrays([h, pa.array(names[lo:hi][row]), pa.array(anchor - at[row])], ["h", "row", "at"])
                else:
                    yield pa.RecordBatch.from_arrays([h, pa.array(docs[lo:hi][row])], ["h", "doc"])

    return run


def _listed(batch: pa.RecordBatch, lo: int, hi: int) -> tuple[np.ndarray, pa.Array]:
    """The places of rows ``lo`` to ``hi``: row of each, and the places."""
    lists = batch.column(batch.schema.names.index("places")).slice(lo, hi - lo)
    return np.repeat(np.arange(hi - lo), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), lists.flatten()


def _ranges(batch: pa.RecordBatch, lo: int, hi: int, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The window ranges of rows ``lo`` to ``hi``: row; anchor, first and last among the symbols of these rows; whether it is settled."""
    row, flat = _listed(batch, lo, hi)
    *places, done = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
    return row, [x + at[:-1][row] for x in places], done.astype(bool)


def _runs(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The runs whose anchors are listed in ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in rolling.text_parts(batch, part_bytes=PART_BYTES):
                symbols, at = plan.symbols(data, offsets)
                grams = rolling.Spans(symbols).grams(plan.seed)
                row, anchor, first, last = rolling.anchors(grams, at, plan.window, plan.seed)
                owner, listed = _listed(batch, lo, hi)
                pick = np.isin(anchor, listed.to_numpy(zero_copy_only=False) + at[:-1][owner])
                row, anchor, first, last = row[pick], anchor[pick], first[pick], last[pick]
                spans, done = Contents(symbols), np.zeros(len(row), bool)
                yield _block_rows(plan, batch, lo, at, row, anchor, first, last, done, grams[anchor], np.zeros(len(row), rolling.U), spans)

    return run


def _blocks(plan: Plan, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The blocks of the window ranges listed in ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in rolling.text_parts(batch, part_bytes=PART_BYTES):
                symbols, at = plan.symbols(data, offsets)
                row, (anchor, first, last), done = _ranges(batch, lo, hi, at)
                low, high = (anchor - last) // size, (anchor - first) // size
                n = high - low + 1
                each = np.repeat(np.arange(len(n)), n)
                block = low[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                row, anchor = row[each], anchor[each]
                end = anchor - block * size  # the last window of the block, and the first
                start = end - size + 1
                spans = Contents(symbols)
                core = rolling.mix(spans.hash(end, start + plan.window) ^ block.astype(rolling.U))
                h = rolling.Spans(symbols).hash(anchor, anchor + plan.seed)
                first, last = np.maximum(start, first[each]), np.minimum(end, last[each])
                yield _block_rows(plan, batch, lo, at, row, anchor, first, last, done[each], h, core, spans)

    return run


def _block_rows(plan, batch, lo, at, row, anchor, first, last, done, h, core, spans) -> pa.RecordBatch:
    docs, names = (batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False)[lo:] for c in ("doc", "row"))
    content = rolling.mix(spans.hash(first, last + plan.window) ^ (anchor - first).astype(rolling.U))
    base = at[:-1][row]
    cols = [rolling.signed(h), rolling.signed(core), rolling.signed(content), docs[row], names[row], anchor - base, first - base, last - base, done]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["h", "core", "content", "doc", "row", "anchor", "first", "last", "done"])


SAME = ["h", "core", "content"]


def _classes(plan: Plan, blocks: DataFrame) -> DataFrame:
    """(h, core, content, n, least, open) of the blocks of equal content; ``open`` if windows of theirs may still be found elsewhere.

    Unless the order of documents counts, a block (row, anchor, first, last) stands for its class: any will do, as all
    blocks of a class of several are settled, and the values of one block stay together as all are taken at the same rows.
    """
    n, least = F.count("*").alias("n"), F.min("doc").alias("least")
    if plan.earlier:
        return blocks.groupBy(*SAME).agg(n, least, F.lit(True).alias("open"))
    one = [F.first(c).alias(c) for c in ("row", "anchor", "first", "last")]
    return blocks.groupBy(*SAME).agg(n, least, ((F.count("*") == 1) & ~F.max("done")).alias("open"), *one)


def with_spans(docs: DataFrame, plan: Plan, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, spans): ``spans`` has (start, end) in symbols, in no order, overlapping, or is null if there are none.

    Rows without an id come after all others in the order of ids. Each row has a number of its own, written with its text,
    by which its places are gathered; rows that share an id, or have none, never meet in it.
    """
    rows = stage(documents(docs, doc_id, text).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.monotonically_increasing_id().alias("row"), "text"), "texts")
    wanted = (F.min("doc") < F.max("doc")) if plan.earlier else (F.count("*") > 1)
    texts = rows.select("doc", "row", "text")

    repeated = stage(texts.mapInArrow(_seeds(plan, False), "h long, doc long").groupBy("h").agg(wanted.alias("w")).filter("w").select("h"), "seeds", **BATCH)
    places = stage(
        texts.mapInArrow(_seeds(plan, True), "h long, row long, at long").join(repeated, "h")
        .groupBy("row").agg(F.collect_list("at").alias("places")), "marks", **BATCH)
    discard(repeated)

    schema, settled = "h long, core long, content long, doc long, row long, anchor long, first long, last long, done boolean", None
    for size in (0, *plan.blocks):
        open_rows = texts.join(places, "row").select("doc", "row", "text", "places")
        blocks = stage(open_rows.mapInArrow(_blocks(plan, size) if size else _runs(plan), schema), "blocks", **BATCH)
        discard(places)
        classes = stage(_classes(plan, blocks), "classes")
        placed = blocks.join(classes.select(*SAME, "n", "least"), SAME)
        found = placed.filter("least < doc" if plan.earlier else "n > 1 AND NOT done")
        found = stage(found.select("row", F.col("first").alias("start"), (F.col("last") + plan.window).alias("end")), "found")
        settled = found if settled is None else settled.unionByName(found)
        if size != 1:
            several = stage(classes.groupBy("h", "core").agg((F.count("*") > 1).alias("w"), F.max("open").alias("open"))
                            .filter("w AND open").select("h", "core"), "several")
            kept = placed.filter("doc = least") if plan.earlier else classes.withColumn("done", ~F.col("open"))
            places = stage(kept.join(several, ["h", "core"]).groupBy("row").agg(
                F.collect_list(F.struct("anchor", "first", "last", "done")).alias("places")), "open")
            discard(several)
        discard(blocks, classes)

    spans = stage(settled.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    return rows.select("doc_id", "row", "text").join(spans, "row", "left").select("doc_id", "text", "spans")


def covered(batch: pa.RecordBatch, lo: int, hi: int, at: np.ndarray) -> np.ndarray:
    """Which symbols of rows ``lo`` to ``hi`` lie in a span of theirs."""
    spans = batch.column(batch.schema.names.index("spans")).slice(lo, hi - lo)
    n = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    both = spans.flatten()
    base = np.repeat(at[:-1], n)
    depth = np.zeros(at[-1] + 1, np.int64)
    np.add.at(depth, both.field(0).to_numpy(zero_copy_only=False) + base, 1)
    np.add.at(depth, both.field(1).to_numpy(zero_copy_only=False) + base, -1)
    return np.cumsum(depth)[:-1] > 0


def maximal(mask: np.ndarray, at: np.ndarray) -> pa.ListArray:
    """The runs of the mask, cut at rows, as (start, end) lists."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[at] = True
    before = np.r_[False, mask[:-1]][: len(mask)]
    after = np.r_[mask[1:], False][: len(mask)]
    starts = np.flatnonzero(mask & (edge[:-1] | ~before))
    ends = np.flatnonzero(mask & (edge[1:] | ~after)) + 1
    lists = np.searchsorted(starts, at).astype(np.int32)
    base = np.repeat(at[:-1], np.diff(lists))
    values = pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(lists), values)


def strings(data: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of bytes as an Arrow array."""
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
