"""Windows and as-of joins with one hot key, against brute force."""

import bisect
import random

from pyspark.sql import functions as F

from changeflow.operators import ranges
from changeflow.sources.keyset import keyset_chunks


def hot_rows(n=6000, seed=7):
    rng = random.Random(seed)
    times = rng.sample(range(10 * n), n)
    # a third of all rows has one key
    return [("hot" if i % 3 == 0 else f"k{rng.randrange(400)}", t, None if t % 5 == 0 else t % 97) for i, t in enumerate(times)]


def by_group(rows):
    groups = {}
    for g, t, v in sorted(rows, key=lambda r: (r[0], r[1])):
        groups.setdefault(g, []).append((t, v))
    return groups


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, t long, v long").repartition(7)


def test_hot_key_is_cut_and_others_are_not(spark):
    cuts = ranges.hot_cuts(frame(spark, hot_rows()), ["g"], ["t"], 8)
    assert len(cuts.rows) >= 2 and {r[0] for r in cuts.rows} == {"hot"}


def test_no_cuts_without_skew(spark):
    df = spark.range(5000).select((F.col("id") % 1000).cast("string").alias("g"), F.col("id").alias("t"))
    assert ranges.hot_cuts(df, ["g"], ["t"], 8).rows == ()


def test_lead_lag_row_number_carry(spark):
    rows = hot_rows()
    df = frame(spark, rows)
    want_lead, want_lag, want_n, want_carry = {}, {}, {}, {}
    for g, seq in by_group(rows).items():
        last = None
        for i, (t, v) in enumerate(seq):
            want_lead[g, t] = seq[i + 1][1] if i + 1 < len(seq) else None
            want_lag[g, t] = seq[i - 1][1] if i else None
            want_n[g, t] = i + 1
            last = v if v is not None else last
            want_carry[g, t] = last
    get = lambda d, c: {(r["g"], r["t"]): r[c] for r in d.collect()}
    assert get(ranges.lead_in_group(df, ["g"], ["t"], "v", "x", 8), "x") == want_lead
    assert get(ranges.lag_in_group(df, ["g"], ["t"], "v", "x", 8), "x") == want_lag
    assert get(ranges.row_number_in_group(df, ["g"], ["t"], "x", 8), "x") == want_n
    assert get(ranges.carry_in_group(df, ["g"], ["t"], {"x": "v"}, 8), "x") == want_carry


def test_asof_both_ways(spark):
    rng = random.Random(3)
    right = [("hot" if i % 2 else f"k{i % 50}", t, i) for i, t in enumerate(rng.sample(range(50_000), 3000))]
    left = [(i, "hot" if i % 3 == 0 else f"k{i % 60}", rng.randrange(50_000)) for i in range(4000)]
    table = {}
    for g, t, v in sorted(right, key=lambda r: r[1]):
        table.setdefault(g, ([], []))
        table[g][0].append(t)
        table[g][1].append(v)
    want = {}
    for i, g, t in left:
        times, values = table.get(g, ([], []))
        at = bisect.bisect_right(times, t)
        want[i] = values[at - 1] if at else None
    ldf = spark.createDataFrame(left, "id long, g string, t long")
    rdf = spark.createDataFrame(right, "g string, rt long, val long")
    for limit in (None, 0):
        got = ranges.asof_join(ldf, rdf, ["g"], "t", "rt", ["val"], parts=8, small_limit=limit)
        assert {r["id"]: r["val"] for r in got.collect()} == want


def test_chunks_do_not_depend_on_ranges(spark):
    keys = random.Random(5).sample(range(10**6), 5000)
    df = spark.createDataFrame([(f"{k:07d}", k) for k in keys], "s string, k long").repartition(5)
    want = {k: i // 333 for i, k in enumerate(sorted(keys))}
    for key, parts in ((["k"], 4), (["k"], 16), (["s"], 8), (["s", "k"], 3)):
        got = {r["k"]: r["chunk_id"] for r in keyset_chunks(df, key, 333, parts).collect()}
        assert got == want
