"""The pipeline against a plain version of every stage, and the corpus queries against their SQL."""

import re

import pytest
from oracle import compare, connect
from test_dedup_rules import norm, plain_measures
from test_jaccard import brute
from test_packing import whole
from test_pii import plain_spans

import corpus_pipeline
from changeflow.llm.catalog import ORACLES, QUERIES


def rejected(text):
    n, chars, symbols, lines, dup, rep = plain_measures(text)
    return n < 50 or 100 * rep > 50 * n or symbols > n or 100 * dup > 50 * lines or chars > 20 * n or chars < 2 * n


def test_stages(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    docs = sorted((r.doc_id, r.text) for r in rows.collect())
    seen, want = rows, []
    docs = [(i, t) for i, t in docs if not rejected(t)]
    want.append(docs)
    first = {}
    for i, t in docs:
        first.setdefault(norm(t), i)
    docs = [(i, t) for i, t in docs if first[norm(t)] == i]
    want.append(docs)
    head = {i: c for i, _, c in brute(docs)}
    docs = [(i, t) for i, t in docs if head[i] == i]
    want.append(docs)
    for (name, step), expected in zip(corpus_pipeline.STAGES, want, strict=False):
        out = step(spark, seen, sf_dir)
        assert out.columns == rows.columns and out.dtypes == rows.dtypes, name
        assert sorted((r.doc_id, r.text) for r in out.collect()) == expected, name
        seen = spark.createDataFrame(out.collect(), rows.schema)
    clean = corpus_pipeline.STAGES[3][1](spark, seen, sf_dir)
    assert clean.columns == rows.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert set(texts) == {i for i, _ in docs}
    for i, t in docs:
        assert not plain_spans(texts[i]), i
        assert plain_spans(t) or texts[i] == t
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    whole(packed, texts)
    assert re.search(r"\[(EMAIL|PHONE|IP|CARD)\]", " ".join(texts.values()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def test_names():
    assert sorted(q.split("_")[0] for q in QUERIES) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])


def test_odd_tables(docs, spark, sf_dir):
    """Nulls everywhere, repeated rows and no rows at all pass through every stage."""
    text = " ".join(f"word{i}" for i in range(70))
    for rows in ([], [(None, None), (1, None), (1, text), (1, text), (None, text + " tail"), (2, text + " +1 212 555 0100"), (3, "x" * 9000)]):
        seen = docs(rows)
        columns = seen.columns
        for name, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, seen, sf_dir)
            assert out.columns == columns, name
            seen = spark.createDataFrame(out.collect(), seen.schema)
        packed = corpus_pipeline.STAGES[-1][1](spark, seen, sf_dir).collect()
        assert bool(packed) == bool(rows)
