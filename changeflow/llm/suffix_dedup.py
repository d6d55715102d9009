"""Removal of repeated 200-byte strings, by counts of content hashes around anchors.

The dealt method, refinement of q-gram buckets by the identifiers of buckets at later offsets, is not what this does: a table
of identifiers for every byte, joined with itself in each round, is many times the input on disk. Instead suffixes are
sampled by content: each 200-byte string holds the smallest of its 64-grams, and equal strings hold it at equal offsets.
Strings that share it form a run; runs, then blocks of 32, 8 and 1 suffixes of those that stay open, are told apart by
hashes of their content, which every round makes anew from the text (``repeats``). Rounds only narrow what is open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from changeflow.llm import repeats, rolling

DEPTH = 200
BUCKET = 64
BLOCKS = (32, 8, 1)


def _bytes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return rolling.BYTE[data], at


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, at in rolling.text_parts(batch):
            gone = repeats.covered(batch, lo, hi, at)
            kept = np.r_[0, np.cumsum(~gone)][at]
            cols = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(np.diff(at) - np.diff(kept)),
                    repeats.maximal(gone, at), repeats.strings(data[~gone], kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): each byte goes that is covered by a string of ``depth`` bytes which also
    starts elsewhere, in any document. ``spans`` are the maximal removed runs and ``kept`` the remaining bytes.

    Texts are UTF-8 bytes, null counts as empty; strings never cross rows and are judged on the input. Rows that repeat a
    document are occurrences of their own, with or without an id. Texts shorter than ``depth`` stay whole. A task holds
    about 100 bytes of memory for a byte of its longest text.
    """
    plan = repeats.Plan(_bytes, depth, bucket, tuple(b for b in BLOCKS if b == 1 or 2 * b <= depth), earlier=False)
    return repeats.with_spans(docs, plan, doc_id, text).mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
