"""Packing against the plain tokenizer and against first-fit by scanning all bins."""

import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, strategies as st
from tokenizers import Tokenizer

from changeflow.llm import packing
from changeflow.llm.catalog import QUERIES

PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]


def whole(rows, texts, size=1024):
    """Every id of every document lies in one piece, pieces lie gapless in their sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for name, own in by_doc.items():
        ids, at = plain_ids(texts[name]), 0
        for r in sorted(own, key=lambda r: r.start):
            part = ids[r.start : r.start + r.length]
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= size
    return by_seq


def test_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op9_pack_sequences"](spark, sf_dir).collect()
    by_seq = whole(rows, texts)
    total = sum(r.length for r in rows)
    assert len(by_seq) * 1024 < 1.05 * total


def test_odd_rows(docs):
    texts = {1: None, 2: "", 3: "x " * 5000, 4: "a\n\n b\tc  d \x1c e f  ", 5: "é" * 3000, 6: " lead", 7: "don't stop 12 34!!"}
    whole(packing.pack(docs(texts.items())).collect(), texts)
    assert packing.pack(docs([])).collect() == []
    twice = packing.pack(docs([(1, "same text"), (1, "same text"), (None, "no id")])).collect()
    assert sorted((r.doc_id or 0, r.start) for r in twice) == [(0, 0), (1, 0), (1, 0)]
    assert len({(r.sequence_id, r.offset) for r in twice}) == 3


def test_small_groups(docs):
    texts = {i: "word " * (i * 37 % 900) for i in range(60)}
    whole(packing.pack(docs(texts.items()), group_pieces=8).collect(), texts)


@given(st.lists(st.integers(1, 50), max_size=60))
def test_tree_equals_scan(lengths):
    free, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
        if b == len(free):
            free.append(50)
        want[i] = (b, 50 - free[b])
        free[b] -= lengths[i]
    assert packing.first_fit_decreasing(lengths, 50) == [want[i] for i in range(len(lengths))]


@pytest.mark.parametrize("text", ["a b  c", " a  b ", " x y\u0085 z", "x\x1fy z", "1 2,3 'll we'll  \n q", "tab\t x"])
def test_units(text):
    assert packing.token_bytes([text])[0] == struct.pack(f"<{len(plain_ids(text)) - 1}I", *plain_ids(text)[:-1])


@pytest.mark.parametrize("text", ["x end<|endoftext|>, y", "end<|endoftext|>", "a end<|endoftext|>.) b<|endoftext|>\nc<|endoftext|>!", "x end<|endoftext|>a, end<|endoftext,|> y|>"])
def test_units_with_added_tokens(text):
    assert packing.token_bytes([text])[0] == struct.pack(f"<{len(plain_ids(text)) - 1}I", *plain_ids(text)[:-1])
