"""Suffix and substring dedup against brute force over all windows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from changeflow.llm import common, repeats, rolling
from changeflow.llm.catalog import QUERIES
from changeflow.llm.substring_dedup import substring_dedup
from changeflow.llm.suffix_dedup import suffix_dedup


def by_bytes(texts, depth):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + depth] for d in data for i in range(len(d) - depth + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - depth + 1):
            if seen[d[i : i + depth]] > 1:
                gone[i : i + depth] = True
        runs = int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]])) if len(gone) else 0
        out.append((len(d), int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone]) if d else b""))
    return out


def by_words(rows, window):
    split = [(LAST if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            least[g] = min(least.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


LAST = 1 << 63
ODD = [None, "", "x", "ab" * 300, "ab" * 300, "-" * 450, "é" * 180, "same text\n" * 60, " ".join(f"w{i % 37} q{i * i % 91}" for i in range(400))]
ODD += [ODD[-1][300:1500] + " tail", "head " + ODD[-1][301:1700], ODD[-1], "only once " + " ".join(f"z{i}" for i in range(300)), " \t\n ", "a\x0bb\x0cc " * 30]


def pairs(df, *cols):
    return sorted((r["doc_id"] if r["doc_id"] is not None else LAST, *(r[c] for c in cols)) for r in df.collect())


@pytest.mark.parametrize("depth,bucket", [(200, 64), (20, 6)])
def test_suffixes(docs, depth, bucket):
    got = suffix_dedup(docs(enumerate(ODD)), depth=depth, bucket=bucket)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got.collect())
    assert got == [(i, *row) for i, row in enumerate(by_bytes(ODD, depth))]


def test_suffix_query(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    want = {i: (n, gone, runs, hashlib.sha256(kept).hexdigest()) for i, (n, gone, runs, kept) in zip(texts, by_bytes(texts.values(), 200), strict=True)}
    rows = QUERIES["op2_suffix_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want and len(rows) == len(want)
    assert any(r.n_removed for r in rows)


@pytest.mark.parametrize("window,seed", [(13, 5), (4, 1)])
def test_words(docs, window, seed):
    rows = [(100 - i, t) for i, t in enumerate(ODD)]
    want = sorted((i, *w) for (i, _), w in zip(rows, by_words(rows, window), strict=True))
    assert pairs(substring_dedup(docs(rows), window=window, seed=seed), "n_words", "n_removed", "kept") == want


def test_repeated_rows_and_missing_ids(docs):
    text = " ".join(f"u{i}" for i in range(80))
    rows = [(5, text), (5, text), (None, text), (3, "other " * 20), (5, "short")]
    want = sorted((LAST if i is None else i, *w) for (i, _), w in zip(rows, by_words(rows, 13), strict=True))
    assert pairs(substring_dedup(docs(rows)), "n_words", "n_removed", "kept") == want
    got = suffix_dedup(docs(rows)).collect()
    want = sorted((LAST if i is None else i, *w) for (i, _), w in zip(rows, by_bytes([t for _, t in rows], 200), strict=True))
    assert sorted((LAST if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == want


def test_empty_table(docs):
    assert suffix_dedup(docs([])).collect() == [] and substring_dedup(docs([])).collect() == []


def test_first_minimum():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 9, 500).astype(np.uint64)
    for w in (1, 2, 3, 7, 8, 9, 137):
        assert rolling.first_minimum(v, w).tolist() == [i + int(np.argmin(v[i : i + w])) for i in range(500 - w + 1)]


@pytest.mark.parametrize("given", [None, 7])
def test_texts_with_like_hashes(spark, docs, given):
    """Rows without an id, or with one id, whose texts share the lower bits of their hashes stay apart."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [(f"long{i} own{i} {passage} end{i}", f"short{i} " + " ".join(f"s{i}x{k}" for k in range(14))) for i in range(600)]
    flat = spark.createDataFrame([(t,) for both in texts for t in both], "text string").selectExpr("text", "xxhash64(text) & 32767 AS low").collect()
    seen = {r.low: r.text for r in flat if r.text.startswith("long")}
    like = [t for r in flat if r.text.startswith("short") and r.low in seen for t in (seen[r.low], r.text)]
    assert like
    rows = [(1, passage), *((given, t) for t in dict.fromkeys(like)), (given, like[0]), (given, like[0])]
    want = sorted((LAST if i is None else i, *row) for (i, _), row in zip(rows, by_words(rows, 13), strict=True))
    assert pairs(substring_dedup(docs(rows)), "n_words", "n_removed", "kept") == want
    got = sorted((LAST if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup(docs(rows)).collect())
    assert got == sorted((LAST if i is None else i, *row) for (i, _), row in zip(rows, by_bytes([t for _, t in rows], 200), strict=True))


def written(monkeypatch):
    """The rows of the tables that the steps write, by name."""
    rows = {}

    def stage(df, name, **settings):
        made = common.stage(df, name, **settings)
        rows.setdefault(name, []).extend(made.collect())
        return made

    monkeypatch.setattr(repeats, "stage", stage)
    return rows


def suffixes(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in df.collect())


PASSAGE = " ".join(f"p{i}q{i * i % 89}" for i in range(60))


def context(i):
    return " ".join(f"c{i}x{k * k % 97}" for k in range(40))


def test_settled_classes_are_closed(docs, monkeypatch):
    """One passage in twelve contexts, each in three documents: the first round settles all, nothing is left for the next."""
    rows = written(monkeypatch)
    texts = [f"{context(i)} {PASSAGE} {context(i + 50)}" for i in range(12) for _ in range(3)]
    assert suffixes(suffix_dedup(docs(enumerate(texts)))) == [(i, *row) for i, row in enumerate(by_bytes(texts, 200))]
    assert rows["found"] and not rows["open"]


def test_windows_are_found_once(docs, monkeypatch):
    """One passage in contexts that are unique, repeated, and repeated inside a document: each string is written once, a class has one row."""
    rows = written(monkeypatch)
    texts = [f"{context(i)} {PASSAGE} {context(i + 50)}" for i in (*range(12), 3, 3, 4, 5)]
    texts += ["\n".join([texts[0]] * 4), PASSAGE[:300] + context(70), None, ""]
    assert suffixes(suffix_dedup(docs(enumerate(texts)))) == [(i, *row) for i, row in enumerate(by_bytes(texts, 200))]
    each = Counter((r.row, k) for r in rows["found"] for k in range(r.start, r.end - 199))
    assert rows["open"] and max(each.values()) == 1


def test_batches_are_bounded(spark, docs, monkeypatch):
    """Tasks are handed a bounded number of texts at a time, and the session is left as it was."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", set()
    write = common.stage

    def stage(df, name, **settings):
        if name in ("seeds", "marks", "blocks"):
            seen.add(int(settings.get(key, spark.conf.get(key))))
        return write(df, name, **settings)

    monkeypatch.setattr(repeats, "stage", stage)
    before = spark.conf.get(key)
    assert suffix_dedup(docs([(1, "a" * 500), (2, "b")])).count() == 2
    assert seen == {1000} and spark.conf.get(key) == before
