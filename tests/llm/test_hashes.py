"""Patterns of two symbols for which polynomials modulo 2**64 collide, whatever the base."""

import numpy as np
import pytest

from changeflow.llm import jaccard_join, packing, repeats, rolling, segment, suffix_dedup
from changeflow.llm.substring_dedup import substring_dedup


def thue_morse(bits, zero="a", one="b"):
    return "".join(one if i.bit_count() % 2 else zero for i in range(1 << bits))


ONE, TWO = thue_morse(11), thue_morse(11, "b", "a")


def test_words():
    data = np.frombuffer(f"{ONE} {TWO} {ONE}".encode(), np.uint8)
    starts, ends, _ = rolling.words(data, np.array([0, len(data)]))
    a, b, c = rolling.word_symbols(data, starts, ends).tolist()
    assert a == c != b


@pytest.mark.parametrize("bits", [6, 8, 11])
def test_contents(bits):
    data = np.frombuffer((thue_morse(bits) + thue_morse(bits, "b", "a")).encode(), np.uint8)
    n = 1 << bits
    spans = repeats.Contents(rolling.BYTE[data])
    a, b = spans.hash(np.array([0, n]), np.array([n, 2 * n])).tolist()
    assert a != b
    one, two = rolling.PrimeSpans(rolling.BYTE[data]).hash(np.array([0, n]), np.array([n, 2 * n])).tolist()
    assert one != two


def test_prime_spans_equal_where_contents_are():
    rng = np.random.default_rng(2)
    part = rng.integers(0, 256, 5000).astype(np.uint8)
    data = np.r_[part, rng.integers(0, 256, 77).astype(np.uint8), part]
    spans = rolling.PrimeSpans(rolling.BYTE[data])
    start = np.arange(4000)
    assert (spans.hash(start, start + 900) == spans.hash(start + 5077, start + 5977)).all()
    assert len(np.unique(spans.hash(start, start + 900))) == 4000


def test_jaccard_does_not_link(docs):
    rows = [(1, f"{ONE} x y z w"), (2, f"{TWO} x y z w")]
    assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs(rows)).collect()} == {1: 1, 2: 2}


def test_substrings_stay(docs):
    rest = " ".join("cdefghijklmn")
    rows = {r.doc_id: r.n_removed for r in substring_dedup(docs([(1, f"{ONE} {rest}"), (2, f"{TWO} {rest}")])).collect()}
    assert rows == {1: 0, 2: 0}


def test_suffixes(docs):
    texts = {1: ONE, 2: TWO, 3: thue_morse(9), 4: "c" + thue_morse(9, "b", "a")}
    rows = {r.doc_id: r.kept for r in suffix_dedup.suffix_dedup(docs(texts.items())).collect()}
    own = {d: [t[i : i + 200] for i in range(len(t) - 199)] for d, t in texts.items()}
    count = {}
    for windows in own.values():
        for w in windows:
            count[w] = count.get(w, 0) + 1
    for d, t in texts.items():
        gone = {j for i, w in enumerate(own[d]) if count[w] > 1 for j in range(i, i + 200)}
        assert bytes(rows[d]).decode() == "".join(c for i, c in enumerate(t) if i not in gone)


def test_segments_are_lossless(docs):
    texts = {1: f"{ONE} {TWO}", 2: f"x{TWO} x{ONE}"}
    back = segment.decode(segment.encode(docs(texts.items()))).collect()
    assert {r.doc_id: r.text for r in back} == texts


def test_packing_of_equal_rows_without_id(docs):
    """Rows that are equal in all columns are dealt to all groups."""
    rows = packing.pack(docs([(None, "")] * 3000), group_pieces=300).collect()
    groups = {}
    for r in rows:
        groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
    assert len(rows) == 3000 and len(groups) >= 8 and max(groups.values()) < 600
