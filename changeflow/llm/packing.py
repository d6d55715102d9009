"""Packing token sequences: first-fit decreasing over a tournament tree of bin capacities, in randomised groups.

Documents become token ids; each is cut into pieces of at most one sequence. Pieces are written once, numbered, and dealt at
random, by a hash of their number, into groups of bounded expected size, and every group is packed on its own, so no task sees more than its groups. Random
groups have the corpus' mix of lengths, hence the same padding as a packing of everything. Style: Arrow batches for the
tokenizer, pandas per group for the tree.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm import vocabulary as vocabularies
from changeflow.llm.common import stage

SEQUENCE = 1024
VOCABULARY = "byte_bpe_50k.json"
END_ID = b"\0\0\0\0"
GROUP_PIECES = 4096

_BATCH_CHARS = 1_000_000


def token_bytes(texts: list[str], name: str = VOCABULARY) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers; added tokens of the vocabulary are matched in the text."""
    return [np.array(ids, "<u4").tobytes() for ids in vocabularies.byte_level(name, special=True).encode(texts)]


def _batches(names: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    lo = chars = 0
    for hi, text in enumerate(texts):
        if chars and chars + len(text) > _BATCH_CHARS:
            yield names[lo:hi], texts[lo:hi]
            lo, chars = hi, 0
        chars += len(text)
    if lo < len(texts):
        yield names[lo:], texts[lo:]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): a document's ids with the end id, cut after every ``size`` ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, texts in _batches(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cols: list[list] = [[], [], [], [], []]
                for name, ids in zip(names, token_bytes(texts, vocabulary), strict=True):
                    ids += END_ID
                    total = len(ids) // 4
                    for start in range(0, total, size):
                        piece = ids[4 * start : 4 * (start + size)]
                        for col, value in zip(cols, (name, start, len(piece) // 4, zlib.crc32(piece), total), strict=True):
                            col.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def first_fit_decreasing(lengths: list[int], size: int = SEQUENCE) -> list[tuple[int, int]]:
    """Bin and offset of each length. Leaves of the tree are the bins' free places, an inner node holds the larger of its
    two; walking down to the left whenever that side has room finds the first bin that fits."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    free = [size] * (2 * leaves)
    out = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        node = 1
        while node < leaves:
            node *= 2
            if free[node] < lengths[i]:
                node += 1
        out[i] = (node - leaves, size - free[node])
        free[node] -= lengths[i]
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
    return out


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SEQUENCE, vocabulary: str = VOCABULARY,
         group_pieces: int = GROUP_PIECES, seed: int = 7) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; a sequence has its pieces without gaps from offset 0.

    ``group_pieces`` bounds the expected pieces of a group: the number of groups follows the number of pieces. A null or empty text is the end id alone. Rows that repeat an id are packed each; a null id stays null.
    An empty table gives no rows.
    """
    numbered = stage(pieces(docs, doc_id, text, size, vocabulary).withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = 1 + numbered.count() // group_pieces

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "row"], ascending=[False, True, True, True])
        places = first_fit_decreasing(rows["length"].tolist(), size)
        rows["sequence_id"] = [(int(g) << 32) + b for g, (b, _) in zip(rows["group"], places, strict=True)]
        rows["offset"] = [o for _, o in places]
        return rows.drop(columns=["group", "row"])

    group = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(groups))
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return numbered.withColumn("group", group).groupBy("group").applyInPandas(fill, out)
