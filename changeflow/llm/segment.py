"""Sampled segmentations over the piece lattice of a SentencePiece model: forward filtering, backward sampling.

The lattice of a text falls apart at spaces, as no piece reaches into the next word. A node's forward value is the total
weight of all segmentations up to it; walking back from the end, an edge is drawn in proportion to the weight through it,
so a whole segmentation comes with its exact probability. Draws are hashes of (seed, row key, word, step): the same row
has the same segmentation in every run and partitioning.

A piece weighs (its rank + 3) ** -alpha: the vocabulary is ordered by use, so no model is trained. Characters outside the
vocabulary are spelt in byte pieces, which keeps every text. Arrays over the distinct words of a run of rows, with numpy
in Arrow batches; memory is bounded by the run or its longest text.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm import rolling
from changeflow.llm.common import documents

MODEL = "piece_bpe_32k.model"
ALPHA = 0.5
BYTE_WEIGHT = -25.0
PART_BYTES = 1 << 19
STOP, SPELT, PIECE_BITS = 0xFF, (1 << 11) - 1, 20
#: Bytes of the character that a byte begins.
CHARACTER = np.repeat([1, 0, 2, 3, 4], [0x80, 0x40, 0x20, 0x10, 0x10])
Batches = Iterator[pa.RecordBatch]


class Vocabulary:
    """Pieces as bytes, with plain spaces for the model's space mark, and a trie of them."""

    def __init__(self, model: str):
        import sentencepiece

        path = model
        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(model)
        known = sentencepiece.SentencePieceProcessor(model_file=path)
        size = known.get_piece_size()
        pieces: list[bytes] = [b""] * size
        self.byte_id = np.zeros(256, np.int32)
        ids = []
        for i in range(size):
            if known.is_byte(i):
                value = int(known.id_to_piece(i)[1:-1], 16)
                pieces[i] = bytes([value])
                self.byte_id[value] = i
            elif not (known.is_control(i) or known.is_unknown(i) or known.is_unused(i)):
                pieces[i] = known.id_to_piece(i).replace("▁", " ").encode()
                ids.append(i)
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.longest = int(self.lengths.max())
        if size > 1 << PIECE_BITS or self.longest >= SPELT:
            raise ValueError(f"{model} has too many pieces or too long ones")
        self.ids = np.array(ids, np.int32)
        self.ranks = np.zeros(size, np.int64)
        self.ranks[ids] = np.arange(len(ids))

    @cached_property
    def trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each beginning of a piece has a cell, the empty one cell 0: per cell ``base``, ``parent`` and the piece that ends there
        or -1. What byte ``b`` makes of the beginning in ``cell`` is in ``base[cell] + b`` if the ``parent`` there is ``cell``."""
        lengths, parents, labels, whole, node, size = self.lengths[self.ids], [[0]], [[0]], [[-1]], np.zeros(len(self.ids), np.int64), 1
        for depth in range(self.longest):
            on = np.flatnonzero(lengths > depth)
            new, place = np.unique(node[on] << 8 | self.bytes[self.starts[self.ids[on]] + depth], return_inverse=True)
            node[on] = size + place
            ends = on[lengths[on] == depth + 1]
            parents.append(new >> 8)
            labels.append(new & 0xFF)
            whole.append(np.full(len(new), -1))
            whole[-1][node[ends] - size] = self.ids[ends]
            size += len(new)
        parents, labels, whole = (np.concatenate(x) for x in (parents, labels, whole))
        # children lie one after the other, by label; where there are several, their cells are found one node after the other
        fan = np.bincount(parents[1:], minlength=size)
        first = 1 + np.cumsum(fan) - fan
        many = np.argsort(-fan, kind="stable")[: np.count_nonzero(fan > 1)]
        taken = np.zeros(512 * (len(many) + 2) + size, bool)
        taken[:256] = True
        shift, low = np.zeros(size, np.int64), 256
        for one in many:
            label = labels[first[one] : first[one] + fan[one]]
            while True:
                free = low + np.flatnonzero(~taken[low : low + 256])
                fits = np.flatnonzero(~taken[free[:, None] + (label - label[0])].any(1))
                if len(fits):
                    break
                low += 256
            shift[one] = free[fits[0]] - label[0]
            taken[shift[one] + label] = True
        single = np.flatnonzero(fan == 1)  # these fill the gaps
        shift[single] = np.flatnonzero(~taken)[: len(single)] - labels[first[single]]
        cell = shift[parents] + labels
        cell[0] = 0
        base = np.zeros(int(cell.max()) + 257, np.int64)
        parent, piece = np.full(len(base), -1), np.full(len(base), -1)
        base[cell], parent[cell], piece[cell] = shift, cell[parents], whole
        parent[0] = -1
        return base, parent, piece


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(model: str) -> Vocabulary:
    if model not in _vocabularies:
        _vocabularies[model] = Vocabulary(model)
    return _vocabularies[model]


def prefixed(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a space before each that is not empty."""
    n = np.diff(at)
    starts = np.r_[0, np.cumsum(n + (n > 0))]
    out = np.full(starts[-1], 32, np.uint8)
    old = np.ones(len(out), bool)
    old[starts[:-1][n > 0]] = False
    out[old] = data
    return out, starts


def lattice(v: Vocabulary, data: np.ndarray, at: np.ndarray, alpha: float) -> tuple[np.ndarray, ...]:
    """Nodes and edges of the words that lie one after the other in ``data``, each from its ``at`` to the next. Nodes are
    numbered by their place in the word, then by word, longest first, so the first ones are the words' beginnings. Returns
    the end node of each word, per node its first edge, and per edge the share of its node's weight up to it, its piece and
    the node it comes from."""
    n = np.diff(at)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(n), np.int64)
    rank[order] = np.arange(len(n))
    reach = np.searchsorted(-n[order], -np.arange(n.max(initial=0) + 1), "right")  # words of at least so many bytes
    offset = np.r_[0, np.cumsum(reach)]
    # a byte that no piece has stands behind each word
    stops = at[1:] + np.arange(len(n))
    spelt = np.ones(len(data) + len(n), bool)
    spelt[stops] = False
    symbols = np.full(len(spelt), STOP, np.uint8)
    symbols[spelt] = data
    node = offset[np.arange(len(symbols)) - np.repeat(stops - n, n + 1)] + np.repeat(rank, n + 1)
    # an edge is a number: the node it goes to, its length (byte pieces come last), its piece
    base, parent, ends = v.trie
    edges, live, cell = [], np.arange(len(symbols)), np.zeros(len(symbols), np.int64)
    for length in range(1, v.longest + 1):
        after = base[cell] + symbols[live + (length - 1)]
        on = np.flatnonzero(parent[after] == cell)
        live, cell = live[on], after[on]
        if not len(live):
            break
        piece = ends[cell]
        use = np.flatnonzero(piece >= 0)
        begin = live[use]
        edges.append(node[begin + length] << 32 | length << PIECE_BITS | piece[use])
        if length <= 4:  # characters of the vocabulary; the bytes of others are spelt
            char = begin[CHARACTER[symbols[begin]] == length]
            for k in range(length):
                spelt[char + k] = False
    raw = np.flatnonzero(spelt)
    edges.append(node[raw + 1] << 32 | SPELT << PIECE_BITS | v.byte_id[symbols[raw]])
    edges = np.sort(np.concatenate(edges))
    target, length, piece = edges >> 32, edges >> PIECE_BITS & SPELT, edges & (1 << PIECE_BITS) - 1
    length[length == SPELT] = 1
    new = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.zeros(0, np.int64)
    cuts = np.r_[new, len(target)]
    sizes = np.diff(cuts)
    level = np.searchsorted(target[new], offset)
    place = np.repeat(np.arange(len(offset) - 1), np.diff(cuts[level]))
    source = target + (offset[place - length] - offset[place])

    weights = -alpha * np.log(v.ranks + 3.0)
    weights[v.byte_id] = BYTE_WEIGHT
    share, total = weights[piece], np.zeros(offset[-1])
    for lo, hi in zip(level[1:-1], level[2:], strict=True):
        part, cut = share[cuts[lo] : cuts[hi]], new[lo:hi] - cuts[lo]
        part += total[source[cuts[lo] : cuts[hi]]]
        most = np.maximum.reduceat(part, cut)
        part -= np.repeat(most, sizes[lo:hi])
        np.exp(part, out=part)
        both = np.add.reduceat(part, cut)
        part /= np.repeat(both, sizes[lo:hi])
        total[target[new[lo:hi]]] = most + np.log(both)
    upto = np.cumsum(share)
    upto -= np.repeat(upto[new] - share[new], sizes)
    upto[cuts[1:] - 1] = 2.0
    edge = np.zeros(offset[-1], np.int64)
    edge[target[new]] = new
    return offset[n] + rank, edge, upto, piece, source


def sample(v: Vocabulary, data: np.ndarray, at: np.ndarray, keys: np.ndarray, alpha: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all rows and where each row's begin."""
    data, at = prefixed(data, at)
    space = data == 32
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin[at[:-1][np.diff(at) > 0]] = True
    starts = np.flatnonzero(begin)
    rows = np.searchsorted(starts, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(rows))
    # words lie one after the other; distinct ones are told by their bytes
    edges = np.r_[starts, len(data)].astype(np.int64)
    words_of = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data.tobytes())]).dictionary_encode()
    kind, known = words_of.indices.to_numpy(zero_copy_only=False), words_of.dictionary
    _, places, spelling = known.buffers()
    places = np.frombuffer(places, np.int64)[known.offset : known.offset + len(known) + 1]
    spelling = np.frombuffer(spelling, np.uint8)[places[0] : places[-1]] if len(known) else data
    last, edge, upto, piece, source = lattice(v, spelling, places - places[0], alpha)

    draw = rolling.mix(rolling.mix(keys ^ rolling.U(seed * rolling.BASES[0] % (1 << 64)))[row] + (np.arange(len(starts)) - rows[:-1][row]).astype(rolling.U) * rolling.U(rolling.BASES[1]))
    live, node, count = np.arange(len(starts)), last[kind], np.zeros(len(starts), np.int64)
    words, ids = [], []
    while len(live):
        point = (rolling.mix(draw + rolling.U(len(words) * rolling.BASES[0] % (1 << 64))) >> rolling.U(11)) * 2.0**-53
        pick = edge[node]
        more = np.flatnonzero(point >= upto[pick])
        while len(more):
            pick[more] += 1
            more = more[point[more] >= upto[pick[more]]]
        words.append(live)
        ids.append(piece[pick])
        count[live] = len(words)
        node = source[pick]
        on = np.flatnonzero(node >= len(known))
        live, node, draw = live[on], node[on], draw[on]
    begins = np.r_[0, np.cumsum(count)]
    out = np.zeros(begins[-1], np.int32)
    for step, (w, i) in enumerate(zip(words, ids, strict=True), 1):
        out[begins[w + 1] - step] = i
    return out, begins[rows]


def _sampled(model: str, alpha: float, seed: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        v = vocabulary(model)
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for lo, hi, data, at in rolling.text_parts(batch, part_bytes=PART_BYTES):
                ids, begins = sample(v, data, at, keys[lo:hi], alpha, seed)
                lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], ["doc_id", "pieces"])

    return run


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL, alpha: float = ALPHA, seed: int = 1) -> DataFrame:
    """(doc_id, pieces): a segmentation of each text, drawn with the row's id and text as key.

    ``alpha`` near 0 draws all segmentations alike, a large one keeps to the best. A space is put before the text as the
    model wants it. Bytes that make no character are spelt. Null and empty texts have no pieces. Rows that repeat a document have equal segmentations; rows without
    an id are drawn by their text. An empty table gives no rows.
    """
    rows = documents(docs, doc_id, text).select("doc_id", F.xxhash64("doc_id", "key").alias("row"), "text")
    return rows.mapInArrow(_sampled(model, alpha, seed), "doc_id long, pieces array<int>")


def _spelt(model: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        v = vocabulary(model)
        for batch in batches:
            ids = batch.column(1)
            ends = np.r_[0, np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))].astype(np.int64)
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            lo = 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + (PART_BYTES >> 2), "right")) - 1)
                part = flat[ends[lo] : ends[hi]]
                n = v.lengths[part]
                begins = np.r_[0, np.cumsum(n)]
                data = v.bytes[np.repeat(v.starts[part] - begins[:-1], n) + np.arange(begins[-1])]
                at = begins[ends[lo : hi + 1] - ends[lo]]
                stay = np.ones(len(data), bool)
                stay[at[:-1][np.diff(at) > 0]] = False
                kept = np.r_[0, np.cumsum(stay)][at]
                text = pa.Array.from_buffers(pa.string(), hi - lo, [None, pa.py_buffer(kept.astype(np.int32).tobytes()), pa.py_buffer(data[stay].tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), ids.slice(lo, hi - lo), text], ["doc_id", "pieces", "text"])
                lo = hi

    return run


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, pieces) with ``text``: exactly the text that was encoded, empty for no or null pieces."""
    return encoded.select("doc_id", "pieces").mapInArrow(_spelt(model), "doc_id long, pieces array<int>, text string")
