"""Alignment of two tokenizers by lockstep merging.

Both vocabularies cut the same bytes, so a token of one overlaps a token of the other exactly where a merge of the two lists
of token ends meets them. All documents of a batch are merged at once: one NumPy state vector holds each document's two
pointers; a step emits the link between the two tokens pointed at, advances the pointer whose token ends first, or both,
which is a cut, and drops the documents that are finished. Long documents enter as several lanes, split at offsets where
tokens of both end, so that a batch has many lanes of like length. Style: Arrow batches; counts over the corpus are
DataFrame work, and what a block of documents has to know of them comes back to the block by one co-group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from changeflow.llm import vocabulary
from changeflow.llm.common import stage

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BATCH_BYTES, BLOCK_BYTES, LANE_BYTES = 1 << 20, 1 << 23, 1 << 10
Batches = Iterator[pa.RecordBatch]


class Joined:
    """Bytes of token sequences, by one gather from a table of all tokens' bytes."""

    def __init__(self, tokens: dict[int, bytes], lengths: np.ndarray):
        self.lengths = lengths
        self.start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        self.table = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(len(lengths))), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths[ids]
        ends = np.cumsum(n)
        if not len(ends):
            return np.zeros(0, np.uint8)
        at = np.repeat(self.start[ids] - (ends - n), n) + np.arange(ends[-1])
        return self.table[at]


@lru_cache(2)
def tokenizers(a: str, b: str) -> tuple[vocabulary.ByteLevel, Joined, vocabulary.Pieces, Joined]:
    one, two = vocabulary.byte_level(a), vocabulary.pieces(b)
    return one, Joined(one.bytes, one.lengths), two, Joined(two.bytes, two.lengths)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    flat = np.array(list(chain.from_iterable(ids)), np.int64)
    return flat, at


def _kept(flat: np.ndarray, at: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.where(keep, np.diff(at), 0)
    return flat[np.repeat(keep, np.diff(at))], np.concatenate([[0], np.cumsum(n)])


def encoded(texts: list[str | None], a: str, b: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of both and where each text's begin; none where a text is empty or its bytes do not come back."""
    one, join_a, two, join_b = tokenizers(a, b)
    have = [t or "" for t in texts]
    raw = [(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in have]
    ids_a, at_a = _flat(one.encode([" " + t if t else "" for t in have]))
    ids_b, at_b = _flat(two.encode(have))
    size = np.array([len(r) for r in raw], np.int64)
    whole = np.frombuffer(b"".join(raw), np.uint8)
    first = np.concatenate([[0], np.cumsum(size)])
    keep = size > 0
    for ids, at, join in ((ids_a, at_a, join_a), (ids_b, at_b, join_b)):
        total = np.concatenate([[0], np.cumsum(join.lengths[ids])])
        keep &= total[at[1:]] - total[at[:-1]] == size
    ids_a, at_a = _kept(ids_a, at_a, keep)
    ids_b, at_b = _kept(ids_b, at_b, keep)
    rows = np.flatnonzero(keep)
    want = whole[np.repeat(keep, size)]
    where = np.repeat(rows, size[rows])
    wrong = np.unique(where[(join_a.join(ids_a) != want) | (join_b.join(ids_b) != want)])
    if len(wrong):
        keep = np.ones(len(have), bool)
        keep[wrong] = False
        ids_a, at_a = _kept(ids_a, at_a, keep)
        ids_b, at_b = _kept(ids_b, at_b, keep)
    return ids_a, at_a, ids_b, at_b


def lanes(ends_a: np.ndarray, at_a: np.ndarray, ends_b: np.ndarray, at_b: np.ndarray, lane_bytes: int = LANE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes begin among the tokens of both (the end of all follows): every document, and inside long ones about every
    ``lane_bytes`` the first of the next few ends of A that is an end of B. ``ends`` are byte offsets over the whole batch."""
    if not len(ends_a):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    goals = np.arange(lane_bytes, ends_a[-1], lane_bytes)
    tries = np.minimum(np.searchsorted(ends_a, goals)[:, None] + np.arange(8), len(ends_a) - 1)
    there = np.searchsorted(ends_b, ends_a[tries])
    both = ends_b[np.minimum(there, len(ends_b) - 1)] == ends_a[tries]
    found, first = both.any(axis=1), both.argmax(axis=1)
    pick = np.arange(len(goals))[found], first[found]
    full = np.diff(at_a) > 0
    start_a = np.union1d(np.r_[at_a[:-1][full], len(ends_a)], tries[pick] + 1)
    end = np.r_[0, ends_a][start_a]
    return start_a, np.searchsorted(ends_b, end, "right") * (end > 0)


def lockstep(ends_a: np.ndarray, start_a: np.ndarray, ends_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge all lanes at once: the A and the B token of each link, and those at which a cut lies."""
    pair = np.stack([start_a[:-1], start_b[:-1]])
    stop = start_a[1:].copy()
    link_a, link_b, cut_a, cut_b = [], [], [], []
    live = pair[0] < stop
    pair, stop = pair[:, live], stop[live]
    while len(stop):
        a, b = pair
        link_a.append(a.copy())
        link_b.append(b.copy())
        end_a, end_b = ends_a[a], ends_b[b]
        cut = end_a == end_b
        cut_a.append(a[cut])
        cut_b.append(b[cut])
        b += end_b <= end_a
        a += end_a <= end_b
        live = a < stop
        if not live.all():
            pair, stop = pair[:, live], stop[live]
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (link_a, link_b, cut_a, cut_b))


def _digits(numbers: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of each number and the mark after it (none: 0) as one byte string, and the length of each."""
    width = max(1, len(str(int(numbers.max())))) if len(numbers) else 1
    power = 10 ** np.arange(width - 1, -1, -1)
    cells = np.zeros((len(numbers), width + 1), np.uint8)
    for i, p in enumerate(power.tolist()):
        cells[:, i] = numbers // p % 10 + 48
        if i < width - 1:
            cells[numbers < p, i] = 0
    cells[:, width] = after
    use = cells != 0
    return cells[use], use.sum(axis=1)


def grouped_text(ids_a: np.ndarray, at_a: np.ndarray, ids_b: np.ndarray, at_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[bytes]:
    """For each document `a1,a2|b1;a3|b2,b3`, groups in order; ``cut_a`` and ``cut_b`` are the last tokens of each group, sorted."""
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[cut_a], last_b[cut_b] = True, True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    # a token lies behind the tokens of its own kind, and of the other kind those of the groups before it
    place_a = np.arange(len(ids_a)) + np.r_[0, cut_b + 1][group_a]
    place_b = np.arange(len(ids_b)) + (cut_a + 1)[group_b] if len(cut_a) else np.zeros(0, np.int64)
    numbers, after = np.zeros(len(ids_a) + len(ids_b), np.int64), np.zeros(len(ids_a) + len(ids_b), np.uint8)
    numbers[place_a], numbers[place_b] = ids_a, ids_b
    after[place_a] = np.where(last_a, ord("|"), ord(","))
    after[place_b] = np.where(last_b, ord(";"), ord(","))
    at = at_a + at_b
    after[at[1:][np.diff(at) > 0] - 1] = 0
    text, n = _digits(numbers, after)
    edge = np.concatenate([[0], np.cumsum(n)])[at]
    text = text.tobytes()
    return [text[i:j] for i, j in zip(edge.tolist(), edge[1:].tolist(), strict=False)]


def aligned(texts: list[str | None], a: str = VOCABULARY_A, b: str = VOCABULARY_B, lane_bytes: int = LANE_BYTES) -> dict[str, list]:
    """For each text: n_a, n_b, n_groups, n_links, groups (text), pairs (distinct linked ids, A's times 2**32 plus B's, ascending)
    and times (links of each pair)."""
    one, join_a, two, join_b = tokenizers(a, b)
    ids_a, at_a, ids_b, at_b = encoded(texts, a, b)
    ends_a, ends_b = np.cumsum(join_a.lengths[ids_a]), np.cumsum(join_b.lengths[ids_b])
    start_a, start_b = lanes(ends_a, at_a, ends_b, at_b, lane_bytes)
    link_a, link_b, cut_a, cut_b = lockstep(ends_a, start_a, ends_b, start_b)
    cut_a, cut_b = np.sort(cut_a), np.sort(cut_b)
    groups = grouped_text(ids_a, at_a, ids_b, at_b, cut_a, cut_b)
    doc = np.repeat(np.arange(len(texts)), np.diff(at_a))
    n_groups = np.bincount(doc[cut_a], minlength=len(texts))
    n_links = np.bincount(doc[link_a], minlength=len(texts))
    # distinct pairs of each document: by document, then by pair
    pair = (ids_a[link_a] << 32) | ids_b[link_b]
    known, code = np.unique(pair, return_inverse=True)
    seen, times = np.unique(doc[link_a] * max(1, len(known)) + code, return_counts=True)
    edge = np.searchsorted(seen, np.arange(len(texts) + 1) * max(1, len(known)))
    pairs = known[seen % max(1, len(known))] if len(known) else known
    cuts = list(zip(edge.tolist(), edge[1:].tolist(), strict=False))
    return {"n_a": np.diff(at_a), "n_b": np.diff(at_b), "n_groups": n_groups, "n_links": n_links, "groups": groups,
            "pairs": [pairs[i:j] for i, j in cuts], "times": [times[i:j].astype(np.int32) for i, j in cuts]}


def _runs(texts: list[str | None], limit: int) -> Iterator[tuple[int, int, int]]:
    lo = size = 0
    for hi, text in enumerate(texts):
        n = len(text or "")
        if hi > lo and size + n > limit:
            yield lo, hi, size
            lo, size = hi, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts), size


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> DataFrame:
    """(block, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times), a row per row of ``docs``; ``pairs`` and
    ``times`` are arrays of 64 and 32 bits as bytes. A block is a run of rows of one task, of bounded bytes."""
    names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches: Batches) -> Batches:
        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts, ids = batch.column(1).to_pylist(), batch.column(0)
            for lo, hi, size in _runs(texts, BATCH_BYTES):
                if filled and filled + size > BLOCK_BYTES:
                    block, filled = block + 1, 0
                filled += size
                found = aligned(texts[lo:hi], a, b)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(hi - lo, block)), ids.slice(lo, hi - lo), *(pa.array(found[c]) for c in names[2:6]),
                    pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]]),
                    *(pa.array([x.tobytes() for x in found[c]], pa.binary()) for c in ("pairs", "times"))], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary")


def _block_pairs(batches: Batches) -> Batches:
    """(block, pair, docs): how many documents of a run of rows of a block hold each pair."""
    def told(block: int, held: list[np.ndarray]) -> pa.RecordBatch:
        pair, docs = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), block)), pa.array(pair), pa.array(docs)], ["block", "pair", "docs"])

    last, held = None, []
    for batch in batches:
        for block, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if block != last and held:
                yield told(last, held)
                held = []
            last = block
            if pairs:
                held.append(np.frombuffer(pairs, np.int64))
    if held:
        yield told(last, held)


def pair_counts(asked: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents each pair is linked, and whether no pair of its A id is in more."""
    counts = stage(asked.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return stage(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _scored(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    order = np.argsort(known["pair"].to_numpy())
    pair, n, best = (known[c].to_numpy()[order] for c in ("pair", "n", "best"))
    n_best, total = [], []
    for pairs, times in zip(own["pairs"], own["times"], strict=True):
        at, many = np.searchsorted(pair, np.frombuffer(pairs, np.int64)), np.frombuffer(times, np.int32).astype(np.int64)
        n_best.append(int(many[best[at].astype(bool)].sum()) if len(at) else 0)
        total.append(int((many * n[at]).sum()) if len(at) else 0)
    return own.drop(columns=["block", "pairs", "times"]).assign(n_best=n_best, count_sum=total)


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per row of ``docs``.

    ``a`` is a byte-level vocabulary given the text after a space, ``b`` a SentencePiece model that adds the space itself. A link
    is a pair of token occurrences whose bytes overlap; groups end where tokens of both end. A pair of ids counts once for
    each document (row) that holds it linked: ``count_sum`` adds these counts over a document's links, ``n_best`` are its links
    whose count is the highest of their A id. A text that is null, empty or not given back byte by byte by one of the two
    has no tokens: zeros and an empty ``groups_sha256``. Ids may be missing or repeat. An empty table gives no rows.

    A document's state is its tokens; corpus counts are folded in each block before they are shuffled, so a common pair is a
    row per block.
    """
    rows = stage(links(docs, doc_id, text, a, b), "links")
    asked = stage(rows.select("block", "pairs").mapInArrow(_block_pairs, "block long, pair long, docs long"), "asked")
    told = asked.join(pair_counts(asked), "pair").select("block", "pair", "n", "best")
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(_scored, out)
