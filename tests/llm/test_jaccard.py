"""The Jaccard join against all pairs compared one by one."""

import random
import re

import numpy as np
import pytest

from changeflow.llm import jaccard_join
from changeflow.llm.catalog import QUERIES
from changeflow.llm.components import components

NONE = 1 << 63


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, size=5, percent=80):
    """Shingle counts and the smallest id reached, over an inverted index of all shingles."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    index, ids = {}, {}
    for i, s in enumerate(sets):
        name = rows[i][0]
        if s and name is not None:
            root[find(i)] = find(ids.setdefault(name, i))
        for j in {j for g in s for j in index.get(g, ())}:
            if 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                root[find(i)] = find(j)
        for g in s:
            index.setdefault(g, []).append(i)
    least = {}
    for i, (name, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), NONE), NONE if name is None else name)
    return sorted((NONE if n is None else n, len(sets[i]), least[find(i)]) for i, (n, _) in enumerate(rows))


def result(df):
    return sorted((NONE if r.doc_id is None else r.doc_id, r.n_shingles, NONE if r.component_id is None else r.component_id) for r in df.collect())


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = result(QUERIES["op10_jaccard_join"](spark, sf_dir))
    assert got == brute(rows)
    assert len({c for _, _, c in got}) < len(got)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.random():.6f}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_edited_copies(docs, seed):
    """Copies at all distances from a common source, chains of edits, and a passage that all share."""
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(120)]
        rows += [edited(rng, base, rng.randrange(9)) for _ in range(60)]
        chain = base
        for _ in range(12):
            chain = edited(rng, chain, 2).split()
            rows.append(" ".join(chain))
    rows += [f"{passage} " + " ".join(f"r{i}x{j}" for j in range(rng.randrange(40))) for i in range(80)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert result(jaccard_join.jaccard_components(docs(rows))) == brute(rows)


def test_odd_rows(docs):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(9, None), (8, ""), (7, " \n"), (6, "One two"), (5, "one TWO"), (4, "one two three"), (3, long), (2, long + " more"), (None, long),
            (None, "nobody else has this text at all"), (1, "a b a b a b a b a b"), (1, "another text of the same id here"), (6, "One two"),
            (11, "another text of the same id here"), (None, None), (12, "É one two three four five"), (13, "é one two three four five")]
    assert result(jaccard_join.jaccard_components(docs(rows))) == brute(rows)
    assert result(jaccard_join.jaccard_components(docs([]))) == []
    assert result(jaccard_join.jaccard_components(docs([(1, None), (2, "x")]))) == [(1, 0, 1), (2, 1, 2)]


def test_large_ids(docs):
    """Ids of all 64 bits are ids, and rows without one are told from them."""
    text = [" ".join(f"t{g}w{i}" for i in range(80)) for g in range(5)]
    rows = [(1 << 62, text[0]), ((1 << 63) - 1, text[0] + " more"), (None, text[0]), ((1 << 62) + 5, text[1]), (None, text[2]), (None, text[2] + " more"),
            (-(1 << 63), text[3]), ((1 << 62) + 9, text[3] + " more"), ((1 << 62) + 7, text[4]), ((1 << 62) + 7, text[1] + " x"), (3 << 61, None)]
    assert result(jaccard_join.jaccard_components(docs(rows))) == brute(rows)
    kept = [(r.doc_id, r.text) for r in jaccard_join.near_dedup(docs(rows)).collect()]
    assert sorted(i for i, _ in kept if i is not None) == [-(1 << 63), 1 << 62, (1 << 62) + 5, 3 << 61]
    assert [t in (text[2], text[2] + " more") for i, t in kept if i is None] == [True]


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(i, 900) for i in range(800, 860)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(180)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    ends = {x for link in links if link[0] != link[1] for x in link}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.id, r.component) for r in got) == sorted((x, find(x)) for x in ends)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bitmaps_bound_the_difference(seed):
    rng = np.random.default_rng(seed)
    base = np.unique(rng.integers(0, 1 << 63, 900).astype(np.uint64))
    for n in (1, 5, 64, 65, 300, len(base)):
        for gone, more in ((0, 0), (n // 9, 0), (0, n // 7), (n // 3, n)):
            x, y = np.sort(base[:n]), np.sort(np.r_[base[gone:n], rng.integers(0, 1 << 63, more).astype(np.uint64)])
            at = np.array([0, len(x), len(x) + len(y)])
            a, b = jaccard_join.sketches(np.r_[x, y], at).to_pylist()
            apart = len(np.setxor1d(x, y))
            assert jaccard_join.differing(a, b) <= apart and (apart or jaccard_join.differing(a, b) == 0)
