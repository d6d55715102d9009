"""Substring dedup by seeds and extension.

Documents meet on winnowed anchors, 5-grams of words. A match is extended both ways from the anchor as far as the windows
that own it reach, whole runs first and the runs without an equal partner word by word. Neighbouring matches join to
maximal repeats; only repeats of at least the window length exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from changeflow.llm import repeats, rolling

WINDOW = 13
SEED = 5


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, rows = rolling.words(data, at)
    return rolling.word_symbols(data, starts, ends), rows


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, at in rolling.text_parts(batch):
            starts, ends, rows = rolling.words(data, at)
            gone = repeats.covered(batch, lo, hi, rows)
            stay = np.flatnonzero(~gone)
            row = np.searchsorted(rows, stay, "right") - 1
            more = np.r_[row[1:] == row[:-1], False][: len(row)]  # a kept word of the row follows, after a space
            depth = np.zeros(len(data) + 1, np.int64)
            np.add.at(depth, starts[stay], 1)
            np.add.at(depth, ends[stay], -1)
            mask = np.cumsum(depth)[:-1] > 0
            spaced = data.copy()
            spaced[ends[stay[more]]] = 32
            mask[ends[stay[more]]] = True
            kept = np.r_[0, np.cumsum(mask)][at]
            n, left = np.diff(rows), np.diff(np.searchsorted(stay, rows))
            cols = [batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(n - left), repeats.maximal(gone, rows),
                    repeats.strings(spaced[mask], kept, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_removed", "spans", "kept"])


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): each word goes that is covered by a run of ``window`` words which also
    starts in a document with a smaller id. ``spans`` are the maximal removed runs, in words; ``kept`` has the other words
    with one space between them.

    Null counts as empty; windows are judged on the input. A row without an id counts as later than all others; rows that
    share an id never remove each other's words, and repeats inside a document stay. Shorter texts stay whole.
    """
    plan = repeats.Plan(_words, window, seed, (1,), earlier=True)
    return repeats.with_spans(docs, plan, doc_id, text).mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string")
