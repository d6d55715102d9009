"""N-gram Jaccard join with set-relation skipping.

Two sets link when 100 * intersection >= threshold * union. Sets are ordered rare tokens first and indexed by their prefix, so
that linked sets meet in at least one list, and a list is skipped in blocks: an entry (size n, position i) is looked at
only if sizes are within the threshold and the tokens from there on can still make up the overlap.

Set relations save the rest:

1. Equal sets are one set.
2. In each list a pivot, the set with the largest share of frequent tokens (the likely source of the others), answers
   first: every set is compared with the pivot that it shares most tokens with. Linked sets form components.
3. A list whose sets are one component is skipped. In the others only sets outside the pivot's component look at the
   rest, at members of other components, and what the pivot has answered decides pairs unseen: Jaccard distance is a
   metric, so sets whose distances from one pivot differ by more than the threshold's distance cannot link.
4. What is left is held against bitmaps of the sets, of a bit for each token, which bound the difference from below; only
   pairs that they leave open are compared, text by text.

The order of tokens only steers the work, so it may rest on a sketch: token counts folded into a fixed number of cells,
whose size does not grow with the data. Tokens are 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow.llm import rolling
from changeflow.llm.common import discard, documents, same_document, stage
from changeflow.llm.components import components

SHINGLE = 5
PERCENT = 80
CELL_BITS, BLOCK_BITS = 20, 12
SLICES, PAIRS = 2, 128
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

Batches = Iterator[pa.RecordBatch]


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and where each row's begin. A row of fewer words has one shingle, all of them."""
    data = _LOWER[data]
    starts, ends, rows = rolling.words(data, at)
    spans = rolling.Spans(rolling.word_symbols(data, starts, ends))
    first = np.arange(len(starts))
    row = np.repeat(np.arange(len(at) - 1), np.diff(rows))
    end = np.minimum(first + size, rows[1:][row])
    use = (end - first == size) | (first == rows[:-1][row])
    row, tokens = row[use], spans.hash(first[use], end[use])
    order = np.lexsort((tokens, row))
    row, tokens = row[order], tokens[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (tokens[1:] != tokens[:-1])][: len(row)]
    row, tokens = row[new], tokens[new]
    return tokens, np.searchsorted(row, np.arange(len(at)))


def _sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x) + 1, x.dtype)
    np.cumsum(x, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def sketches(tokens: np.ndarray, at: np.ndarray) -> pa.Array:
    """A bitmap for each set, of about as many bits as it has tokens: a bit is the parity of the tokens that fall on it. Bits in
    which two bitmaps differ, the longer folded to the shorter, are never more than the tokens in which the sets differ."""
    n = np.diff(at)
    bits = np.int64(1) << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(bits)])
    row = np.repeat(np.arange(len(n)), n)
    place = first[row] + (tokens & (bits[row] - 1).astype(rolling.U)).astype(np.int64)
    data = np.packbits((np.bincount(place, minlength=first[-1]) & 1).astype(bool))
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((first // 8).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _folded(bitmap: bytes, size: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, np.uint8).reshape(-1, size), axis=0)


def differing(x: bytes, y: bytes) -> int:
    size = min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can link by the bitmaps of ``sets`` (id, n_shingles, sketch); the others cannot."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = [(100 + percent) * differing(x, y) <= (100 - percent) * n for x, y, n in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    a, b = (sets.select(F.col("id").alias(c), F.col("sketch").alias(f"s{c}"), F.col("n_shingles").alias(f"n{c}")) for c in ("a", "b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb", (F.col("na") + F.col("nb")).alias("n"))
    return stage(both.mapInArrow(run, "a long, b long"), "possible")


def _digests(size: int) -> Callable[[Batches], Batches]:
    """Size, a 128-bit digest and the bitmap of each set."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for lo, hi, data, offsets in rolling.text_parts(batch):
                tokens, at = shingle_sets(data, offsets, size)
                cols = [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(np.diff(at))]
                cols += [pa.array(rolling.signed(_sums(rolling.mix(tokens ^ rolling.U(seed)), at))) for seed in rolling.BASES]
                yield pa.RecordBatch.from_arrays([*cols, sketches(tokens, at)], ["doc_id", "key", "n_shingles", "d1", "d2", "sketch"])

    return run


def _cells(size: int) -> Callable[[Batches], Batches]:
    """Token counts of a partition, folded into cells, a row for each block of cells."""

    def run(batches: Batches) -> Batches:
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for _, _, data, offsets in rolling.text_parts(batch):
                tokens, _ = shingle_sets(data, offsets, size)
                counts += np.bincount((tokens >> rolling.U(64 - CELL_BITS)).astype(np.int64), minlength=1 << CELL_BITS)
        if counts.any():
            blocks = counts.reshape(-1, 1 << BLOCK_BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(blocks))), pa.array([b.tobytes() for b in blocks], pa.binary())], ["block", "counts"])

    return run


def _added(block: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(1 << BLOCK_BITS, np.int64)
    for counts in block["counts"]:
        total += np.frombuffer(counts, np.int64)
    return pd.DataFrame({"block": block["block"].iloc[:1], "counts": [total.tobytes()]})


def token_levels(sets: DataFrame, size: int) -> np.ndarray:
    """Level of each cell: 0 for counts near the mean, one more for each doubling from four times the mean on."""
    rows = sets.select("text").mapInArrow(_cells(size), "block long, counts binary").groupBy("block").applyInPandas(_added, "block long, counts binary")
    counts = np.zeros((1 << CELL_BITS - BLOCK_BITS, 1 << BLOCK_BITS), np.int64)
    for block, values in rows.collect():  # a fixed number of fixed-size rows
        counts[block] = np.frombuffer(values, np.int64)
    counts = counts.ravel()
    return np.floor(np.log2(np.maximum(1, 2 * counts / (4 * counts.mean() + 4)))).astype(np.uint8)


def _entries(size: int, percent: int, levels) -> Callable[[Batches], Batches]:
    """Prefix entries: token, id, size and position in one number, and the share of frequent tokens with random lower bits."""

    def run(batches: Batches) -> Batches:
        level = levels.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in rolling.text_parts(batch):
                tokens, at = shingle_sets(data, offsets, size)
                n = np.diff(at)
                row = np.repeat(np.arange(hi - lo), n)
                high = level[(tokens >> rolling.U(64 - CELL_BITS)).astype(np.int64)]
                order = np.lexsort((tokens, high, row))
                place = np.arange(len(tokens)) - at[:-1][row]
                prefix = n - -(-percent * n // 100) + 1
                use = place < prefix[row]
                share = 1000 * _sums((high > 0).astype(np.int64), at) // np.maximum(n, 1)
                rank = (share << 52) | (rolling.mix(ids[lo:hi].astype(rolling.U)) >> rolling.U(12)).astype(np.int64)
                row, place = row[use], place[use]
                cols = [rolling.signed(tokens[order][use]), ids[lo:hi][row], (n[row] << 31) | place, rank[row]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["token", "id", "at", "rank"])

    return run


def _overlaps(size: int) -> Callable[[Batches], Batches]:
    """Sizes of intersection and union of the sets of two texts."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for lo in range(0, batch.num_rows, PAIRS):
                part = batch.slice(lo, PAIRS)
                both: list[tuple[int, int]] = []
                sides = [[tokens[s:e] for _, _, data, offsets in rolling.text_parts(part, column) for tokens, at in [shingle_sets(data, offsets, size)]
                          for s, e in zip(at.tolist(), at[1:].tolist(), strict=False)] for column in ("x", "y")]
                for x, y in zip(*sides, strict=True):
                    place = np.searchsorted(y, x)
                    both.append((int(np.count_nonzero(y[np.minimum(place, len(y) - 1)] == x)), len(x) + len(y)))
                same, total = (np.array([b[k] for b in both], np.int64) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(same), pa.array(total - same)], ["a", "b", "same", "joint"])

    return run


def compared(pairs: DataFrame, sets: DataFrame, size: int, slices: int = SLICES) -> DataFrame:
    """(a, b, same, joint): sizes of intersection and union of each pair, written.

    Texts travel, as they pack better than sets of hashes; the pairs go in ``slices`` by their first set, so that the shuffle
    files of one slice alone lie on disk at a time.
    """
    out = None
    for i in range(slices):
        def own(column: str) -> Column:
            return F.pmod(F.xxhash64(F.lit(11), column), F.lit(slices)) == i

        left = pairs.filter(own("a")).join(sets.filter(own("id")).select(F.col("id").alias("a"), F.col("text").alias("x")), "a")
        both = left.join(sets.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
        part = stage(both.mapInArrow(_overlaps(size), "a long, b long, same long, joint long"), "compared")
        out = part if out is None else out.unionByName(part)
    return out


def _size(entry: str) -> str:
    return f"shiftright({entry}, 31)"


def _left(entry: str) -> str:
    return f"({_size(entry)} - ({entry} & {(1 << 31) - 1}))"


def _possible(x: str, y: str, percent: int) -> str:
    """Whether sets can link that meet at these entries: by their sizes, and by the tokens left from there on."""
    total = f"({_size(x)} + {_size(y)})"
    return (f"100 * least({_size(x)}, {_size(y)}) >= {percent} * greatest({_size(x)}, {_size(y)})"
            f" AND {100 + percent} * least({_left(x)}, {_left(y)}) >= {percent} * {total}")


def linked_sets(sets: DataFrame, bitmaps: DataFrame, size: int, percent: int) -> DataFrame:
    """Components of distinct sets (id, text), with their ``bitmaps`` (id, n_shingles, sketch): (id, component) for the sets that have a link. Tables that have had their last
    reader are removed at once."""
    spark = sets.sparkSession
    levels = spark.sparkContext.broadcast(token_levels(sets, size))
    entries = sets.select("id", "text").mapInArrow(_entries(size, percent, levels), "token long, id long, at long, rank long")
    shared = stage(entries.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").select("token"), "tokens")
    lists = stage(entries.join(shared, "token"), "lists")
    discard(shared)

    # every set against the pivot it shares most prefix tokens with
    pivots = stage(lists.groupBy("token").agg(F.max_by("id", "rank").alias("pivot"), F.max_by("at", "rank").alias("pivot_at")), "pivots")
    met = lists.join(pivots, "token").filter(f"id <> pivot AND {_possible('at', 'pivot_at', percent)}")
    votes = met.groupBy("id", "pivot").agg(F.count("*").alias("n"))
    weight = F.shiftleft("n", 40).bitwiseOR(F.shiftrightunsigned(F.xxhash64("pivot"), 24))
    first = stage(votes.groupBy("id").agg(F.max_by("pivot", weight).alias("pivot")), "first")
    discard(pivots)
    linked = f"100 * same >= {percent} * joint"
    asked = possible(first.select(F.col("id").alias("a"), F.col("pivot").alias("b")), bitmaps, percent)
    answers = compared(asked, sets, size)
    near = stage(components(answers.filter(linked)), "near")

    # lists of several components: sets outside the pivot's component against the others
    known = answers.select(F.col("a").alias("id"), F.col("b").alias("pivot"), (1 - F.col("same") / F.col("joint")).alias("far"))
    placed = stage(
        lists.join(near, "id", "left").join(known, "id", "left")
        .select("token", "id", "at", "rank", F.coalesce("component", "id").alias("component"), "pivot", "far"), "placed")
    discard(lists, first, asked, near)
    mixed = stage(
        placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max_by("component", "rank").alias("main"))
        .filter("lo < hi").select("token", "main"), "mixed")
    rest = stage(placed.join(mixed, "token"), "rest")
    discard(placed, mixed)
    x, y = rest.filter("component <> main").alias("x"), rest.alias("y")
    seen = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    unseen = x.join(y, F.expr(
        f"x.token = y.token AND x.component <> y.component AND (y.component = y.main OR x.id < y.id) AND {_possible('x.at', 'y.at', percent)}"
        f" AND NOT coalesce(x.pivot = y.pivot AND abs(x.far - y.far) > {1 - percent / 100} + 1e-9, false)"))
    pairs = unseen.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    pairs = stage(pairs.join(seen, ["a", "b"], "left_anti"), "pairs")
    discard(rest)
    open_pairs = possible(pairs, bitmaps, percent)
    discard(pairs)
    more = compared(open_pairs, sets, size).filter(linked)
    found = stage(components(answers.filter(linked).select("a", "b").unionByName(more.select("a", "b"))), "linked")
    discard(open_pairs)
    return found


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, head), a row per row of ``docs``; ``key`` as in ``common.documents``, and
    ``head`` is whether the row's id is its component's.

    A-Z are lower-cased; a document's set are its distinct shingles of ``shingle`` words, or all its words as one if it has
    fewer. Null, empty and blank texts have no set and link with nothing. ``component_id`` is the smallest id that links
    lead to, any 64-bit number. Rows that share an id are one document with several texts, and thus linked. Rows without an id
    link like others; a component of such rows alone has none. An empty table gives no rows.
    """
    rows = documents(docs, doc_id, text)
    # rows go by written numbers, as ids may be any number or missing
    digests = stage(rows.select("doc_id", "key", "text").mapInArrow(
        _digests(shingle), "doc_id long, key long, n_shingles long, d1 long, d2 long, sketch binary").withColumn("id", F.monotonically_increasing_id()), "digests")
    alike = ["n_shingles", "d1", "d2"]
    classes = stage(digests.filter("n_shingles > 0").groupBy(*alike).agg(F.min("id").alias("least")), "classes")
    joined = stage(digests.drop("sketch").join(classes, alike, "left").withColumn("least", F.coalesce("least", "id")), "members")

    heads = joined.filter("n_shingles > 0 AND id = least").select("doc_id", "key", "id")
    texts = rows.join(heads, same_document(rows, heads)).select("id", "text")
    texts = stage(texts.dropDuplicates(["id"]), "texts")
    discard(classes)
    near = linked_sets(texts, digests.select("id", "n_shingles", "sketch"), shingle, percent)
    discard(texts)

    # an id of several texts: link their sets
    named = joined.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    several = named.groupBy("doc_id").agg(F.min("least").alias("a"), F.max("least").alias("b")).filter("a < b")
    if not several.isEmpty():
        ties = named.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("least").alias("b")).distinct()
        near = components(near.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(ties))
    placed = stage(joined.join(near.withColumnRenamed("id", "least"), "least", "left").select(
        "doc_id", "key", "n_shingles", "id", F.coalesce("component", "least").alias("component")), "components")
    smallest = stage(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    own = F.when(F.col("component_id").isNull(), F.col("id") == F.col("component")).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return placed.join(smallest, "component").select("doc_id", "key", "n_shingles", "component_id", own.alias("head"))


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **join: int) -> DataFrame:
    """The rows of ``docs``, columns unchanged, without those whose component has a smaller id; of rows that share the id or
    are given twice one stays. Rows without an id stay for a component only if none of it has one."""
    heads = jaccard_components(docs, doc_id, text, **join).filter("head")
    heads = heads.groupBy(F.col("doc_id").alias("_head"), F.when(F.col("doc_id").isNull(), F.col("key")).alias("_own")).agg(F.min("key").alias("_least"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).cast("long").alias("_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_key"))
    kept = rows.join(heads.select("_head", "_least"), F.col("_id").eqNullSafe(F.col("_head")) & (F.col("_key") == F.col("_least")))
    return kept.withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_key").orderBy("_id"))).filter("_n = 1").select("doc.*")
