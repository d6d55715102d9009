"""Alignment against a pointer-free version: every pair of tokens is compared by its bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeflow.llm import align
from changeflow.llm.catalog import QUERIES

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


def tokens(text):
    """(ids, byte ranges) of both, or none."""
    if not text:
        return [], [], [], []
    a = A.encode(" " + text, add_special_tokens=False)
    b = B.encode(text)
    bytes_a = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a.ids]
    bytes_b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return [], [], [], []

    def ranges(parts):
        at = [0]
        for p in parts:
            at.append(at[-1] + len(p))
        return list(zip(at, at[1:], strict=False))

    return a.ids, ranges(bytes_a), b, ranges(bytes_b)


def plain(text):
    a, at_a, b, at_b = tokens(text)
    found = [(i, j) for i, (s, e) in enumerate(at_a) for j, (u, v) in enumerate(at_b) if max(s, u) < min(e, v)]
    cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
    groups = [",".join(str(i) for i, (_, e) in zip(a, at_a, strict=True) if lo < e <= hi) + "|" + ",".join(str(i) for i, (_, e) in zip(b, at_b, strict=True) if lo < e <= hi)
              for lo, hi in zip([0, *cuts], cuts, strict=False)]
    return len(a), len(b), len(groups), ";".join(groups), [(a[i], b[j]) for i, j in found]


def told(texts):
    """What the query returns, by brute force."""
    each = {d: plain(t) for d, t in texts.items()}
    count, best = Counter(), defaultdict(int)
    for *_, links in each.values():
        count.update(set(links))
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return {d: (n_a, n_b, n_groups, len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links),
                hashlib.sha256(groups.encode()).hexdigest() if n_a else "") for d, (n_a, n_b, n_groups, groups, links) in each.items()}


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["", None, " ", "a", "x▁y", "<|endoftext|> and <s> here", "end<|endoftext|>", "tab\tand\r\nline", "éè 你好 \U0001f600 ﬁ ½",
       "a" * 700, " " * 300, "\n" * 90, "nul\x00here", "  lead and trail  ", "unk \U0010ffff"]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.sampled_from(ODD), st.text("ab \né", max_size=200)), max_size=6), st.sampled_from([3, 16, 1024]))
def test_batches(texts, lane_bytes):
    found = align.aligned(texts, lane_bytes=lane_bytes)
    for i, text in enumerate(texts):
        n_a, n_b, n_groups, groups, links = plain(text)
        assert (found["n_a"][i], found["n_b"][i], found["n_groups"][i], found["groups"][i].decode()) == (n_a, n_b, n_groups, groups)
        have = Counter({(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(found["pairs"][i], found["times"][i], strict=True)})
        assert have == Counter(links) and found["n_links"][i] == len(links)


def test_corpus_counts(spark, docs):
    rng = random.Random(5)
    words = ["alignment", "tokeniser", "of", "the", "bücher", "12345", "x_y", "\n", "unbelievable"]
    texts = {i: " ".join(rng.choices(words, k=rng.randrange(1, 40))) for i in range(60)} | {100 + i: t for i, t in enumerate(ODD)} | {200: "the same", 201: "the same"}
    rows = align.align(docs(texts.items()).repartition(5)).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == told(texts)


def test_blocks_of_any_size_agree(spark, docs, monkeypatch):
    texts = [(i, f"document {i % 7} has its words") for i in range(50)]
    whole = {r.doc_id: r for r in align.align(docs(texts).coalesce(1)).collect()}
    cut = {r.doc_id: r for r in align.align(docs(texts).repartition(17)).collect()}
    assert whole == cut


def test_long_text_empty_table_and_rows_without_id(spark, docs):
    long = "a very long text with many words " * 40_000
    rows = align.align(docs([(1, long), (None, "x"), (None, "x"), (2, "y"), (2, "y")])).collect()
    assert len(rows) == 5
    first = next(r for r in rows if r.doc_id == 1)
    assert (first.n_a, first.n_b) == (len(A.encode(" " + long, add_special_tokens=False).ids), len(B.encode(long)))
    assert sorted(r.count_sum for r in rows if r.doc_id is None) == [2 * 1, 2 * 1]
    assert align.align(docs([])).collect() == []


def test_lanes_start_where_both_end():
    ends_a, ends_b = np.array([2, 5, 9, 10, 14]), np.array([3, 5, 10, 12, 14])
    start_a, start_b = align.lanes(ends_a, np.array([0, 5]), ends_b, np.array([0, 5]), 4)
    assert start_a[0] == 0 and start_b[0] == 0 and (start_a[-1], start_b[-1]) == (5, 5)
    assert all(ends_a[i - 1] == ends_b[j - 1] for i, j in zip(start_a[1:], start_b[1:], strict=True))


def test_query_equals_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op12_align_tokenizers"](spark, sf_dir)
    short = {d: t for d, t in texts.items() if len(t or "") < 3000}
    got = {r.doc_id: r for r in rows.collect()}
    assert set(got) == set(texts)
    each = {d: plain(t) for d, t in short.items()}
    for d, (n_a, n_b, n_groups, groups, links) in each.items():
        r = got[d]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, n_groups, len(links))
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if n_a else "")
    assert rows.filter(F.col("n_links") < F.greatest("n_a", "n_b")).count() == 0
