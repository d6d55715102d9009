"""Personal data against the plain patterns, and disclosure on a made corpus."""

import math
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from changeflow.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), n, m.end()))
    return sorted(out)


def found(df):
    rows = pii.personal_data(df).select("doc.doc_id", "base", "spans").collect()
    return {r.doc_id: [(x.start, x.kind, x.end) for x in r.base] for r in rows}, {r.doc_id: [tuple(x) for x in r.spans] for r in rows}


TEXTS = [
    None, "", "no data here", "mail a.b+c@x-y.co.uk now", "a@b.c-d_e@f.g.h@i.j", "x@@y.z a@b a@b. .@-.-", "1.2.3.4 256.1.1.1 01.002.0003.255 1.2.3.4.5.6.7.8 999.1.2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111x 12 34", "call +1 (212) 555-0100 or +49.30.1234567 or +12345 or ++33 1 23 45 67 89 10 11 12 13",
    "é\U0001F600 ü@example.com é@example.org +1 212 555 0100 é", "a" * 6_000, "1" * 6_000, "1." * 3_000, "+" + "1 " * 2_000, "a@b." * 900 + "c",
    " ".join(f"u{i}@host{i}.org 10.0.0.{i % 300}" for i in range(400)), "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "x+1.2.3.4 5 6 7 8-9",
]


def test_base(docs):
    base, spans = found(docs(enumerate(TEXTS)))
    for i, t in enumerate(TEXTS):
        assert base[i] == plain_spans(t), (t or "")[:80]
        assert set(base[i]) <= set(spans[i])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text("ab1.25@+- ()é\n", max_size=80), min_size=150, max_size=150))
def test_base_at_random(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.base] for r in pii.base_spans(df).select("doc_id", F.transform("base", lambda x: F.struct(x["start"], x["kind"], x["end"])).alias("base")).collect()}
    assert got == {i: plain_spans(t) for i, t in enumerate(texts)}


def corpus():
    """One address always stands near the same rare words, another near common ones."""
    rows = [f"filler words about nothing number{i} common story again" for i in range(200)]
    rows += [f"case {i}: doctor Zweistein writes as zw@clinic.example from Ulmenau common story end" for i in range(5)]
    rows += [f"case {i}: the common story tells again that all@list.example is common again here {i}" for i in range(5)]
    rows += [f"once writes Solitaire here to so@lo.example the common{c} story" for c in "ab"] + ["Ulmenau is mentioned alone"] + [f"doctor {c}" for c in "abcdefgh"]
    rows += ["doctor again"] * 300  # copies are one text
    return list(enumerate(rows))


def test_disclosure(docs):
    """Every count by its definition: distinct texts, all terms of one letter or more, no least support."""
    rows = corpus()
    _, spans = found(docs(rows))
    texts = {t for _, t in rows}
    words = {t: set(re.findall(r"[^\W\d_]+", t.lower())) for t in texts}
    value = {t: m[0] for t in texts if (m := re.search(PLAIN["email"], t))}
    beside = {t: set(re.findall(r"[^\W\d_]+", t.replace(v, " ").lower())) for t, v in value.items()}
    for i, t in rows:
        terms = {(t[s:e].lower(), pii.KINDS[k]) for s, k, e in spans[i] if k >= 4}
        want = set()
        for term in beside.get(t, ()):
            with_value = [x for x in value if value[x] == value[t]]
            n_et, n_e, n_t = sum(term in beside[x] for x in with_value), len(with_value), sum(term in w for w in words.values())
            score = math.log(n_et * len(texts) / (n_e * n_t)) / math.log(len(texts) / n_e) * n_et / (n_et + 1)
            if score >= 0.45:
                want.add((term, "removed" if score >= 0.7 else "generalised"))
        assert terms == want, t
    kinds = {(rows[i][1][s:e].lower(), pii.KINDS[k]) for i, x in spans.items() for s, k, e in x if k >= 4}
    assert {("zweistein", "removed"), ("as", "removed"), ("doctor", "generalised"), ("solitaire", "generalised")} <= kinds
    assert spans[212] == []  # the same words away from the address stay


def test_sanitised(docs):
    rows = corpus()
    df = docs([*rows, (900, None), (901, "x +1 212 555 0100, 4111 1111 1111 1111 y"), (None, "a@b.c"), (None, "a@b.c")])
    clean = pii.remove_personal_data(df)
    assert clean.columns == df.columns
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got[0] == rows[0][1] and got[900] is None and got[None] == "[EMAIL]"
    assert "zw@clinic" not in got[200] and "Zweistein" not in got[200] and "d*" in got[200] and "[EMAIL]" in got[200] and "Ulmenau" not in got[200]
    assert got[901] == "x* [PHONE], [CARD] y*"  # nothing else has these letters
    assert pii.remove_personal_data(docs([])).collect() == []
