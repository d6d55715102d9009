"""Exact dedup, rules and line templates on odd rows, against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from changeflow.llm import quality
from changeflow.llm.exact_dedup import exact_dedup
from changeflow.llm.line_templates import line_dedup

NONE = 1 << 63
LONG = "lorem ipsum dolor " * 20_000


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(NONE if i is None else i)
    out, used = [], set()
    for i, t in rows:
        i = NONE if i is None else i
        keep = min(groups[norm(t)])
        out.append((i, keep, len(groups[norm(t)]), i == keep and (keep, norm(t)) not in used))
        if i == keep:
            used.add((keep, norm(t)))
    return sorted(out)


def copies(df, **digits):
    rows = exact_dedup(df, **digits).select("doc.doc_id", "keep_id", "group_size", "kept").collect()
    return sorted((NONE if r[0] is None else r[0], NONE if r[1] is None else r[1], r[2], r[3]) for r in rows)


ROWS = [(1, None), (2, ""), (3, " "), (4, "\t\n"), (5, "a b"), (6, "a\n\nb"), (7, " a b"), (8, LONG), (9, LONG), (10, LONG + "x"), (11, LONG[:-1]), (12, LONG[:64]),
        (13, LONG[:65]), (14, LONG[:64]), (5, "a b"), (None, "a b"), (None, "nobody"), (None, "nobody"), (15, "É"), (16, "É"), (17, "É"), (15, "other text of 15")]


@pytest.mark.parametrize("digits", [{}, {"first_digit": 1, "growth": 2}, {"first_digit": 3, "growth": 20}])
def test_exact_copies(docs, digits):
    assert copies(docs(ROWS), **digits) == plain_copies(ROWS)


def test_exact_no_rows(docs):
    assert copies(docs([])) == []


def test_exact_prefixes(docs):
    """Every text is a beginning of another, so groups end in every round."""
    rng = random.Random(5)
    rows = [(i, "ab" * rng.randrange(60)) for i in range(150)]
    assert copies(docs(rows), first_digit=2, growth=2) == plain_copies(rows)


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text or ""), len(lines), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \n\t", "one", "a b c", "a b c a b c", "a a a a", "x y\nx y\nx y \nz", "# $ * % & | < > ##", "é" * 9, "w " * 60, "line one here\n" * 40,
         " ".join(f"w{i}" for i in range(60)), "abcdefghijklmnopqrstuvwxyz" * 3, "\r\nx\r\nx\r\n"]


def test_ledger(docs):
    rows = quality.rule_ledger(docs(enumerate(TEXTS))).select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "failures").collect()
    for r in rows:
        want = plain_measures(TEXTS[r.doc_id])
        assert tuple(r[1:7]) == want, TEXTS[r.doc_id]
        n, chars, symbols, lines, dup, rep = want
        tests = (n < 50, 100 * rep > 50 * n, symbols > n, 100 * dup > 50 * lines, chars > 20 * n, chars < 2 * n)
        assert r.failures == sum(1 << i for i, t in enumerate(tests) if t)
    assert len(rows) == len(TEXTS) and quality.rule_ledger(docs([])).count() == 0


def test_ablations(spark, sf_dir):
    ledger = quality.rule_ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("failures").cache()
    masks = [r.failures for r in ledger.collect()]
    for r in quality.ablations(ledger).collect():
        mask, bit = quality.mask(r.version), quality.bit(r.rule)
        assert (r.n_docs, r.n_rejected, r.n_failed, r.n_only) == (
            len(masks), sum(bool(m & mask) for m in masks), sum(bool(m & bit) for m in masks), sum(bool(m & mask) and not m & mask & ~bit for m in masks))
    assert quality.ablations(ledger).count() == sum(map(len, quality.POLICIES.values()))


def test_filter_keeps_columns(docs):
    df = docs([(1, "short"), (2, TEXTS[12])])
    kept = quality.quality_filter(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [2]


def dropped(df, **tree):
    return {r.doc_id: r.kept for r in line_dedup(df, **tree).select("doc.doc_id", "kept").collect()}


def test_templates(docs):
    own = [f"alpha{c} beta{c} gamma{c} delta{c} own words" for c in "abcd"]
    rows = [
        (1, f"Page 1 of 20 printed today\n{own[0]}\nthis page was posted by anna here"),
        (2, f"Page 2 of 33 printed today\n{own[1]}\nthis page was posted by bert here\nshort line"),
        (3, f"this page  was posted\tby carl here\r\n{own[2]}\nshort line\n\n"),
        (4, f"{own[3]}\n{own[3]}\nthis page was made with the help of others"),
    ]
    got = dropped(docs(rows))
    assert got[1] == rows[0][1]  # the first document keeps what recurs
    assert got[2] == f"{own[1]}\nshort line"  # numbers and names are fields
    assert got[3] == f"{own[2]}\n\n"  # short lines are judged, blank lines stay
    assert got[4] == rows[3][1]  # another leaf; repeats inside one document stay


def test_short_lines(docs):
    """Lines of one to three tokens: constants make a template, lines of fields alone go only where they are equal."""
    rows = [(1, "Of.\nAll rights reserved.\n2024\n7 of 9\nnext page 3\n12 34\nonly here"), (2, " Of. \nAll  rights\treserved.\n2025\n8 of 9\nnext page 4\n12 34\nmine"),
            (3, "of.\nOf. Of.\nrights All reserved.\n2024\n7 of 9\nnext part 3\n12 35\n\n \n"), (4, "日本語の行\n同じ行"), (5, "同じ行\n別の行"), (6, "\nOf.\n" + "x" * 300_000), (7, "x" * 300_000)]
    got = dropped(docs(rows))
    assert got == {1: rows[0][1], 2: "2025\n8 of 9\nmine", 3: "of.\nOf. Of.\nrights All reserved.\nnext part 3\n12 35\n\n \n", 4: rows[3][1], 5: "別の行",
                   6: "\n" + "x" * 300_000, 7: ""}
    assert dropped(docs(rows), min_tokens=4) == dict(rows)


def test_templates_odd_rows(docs):
    line = "the very same line of text"
    rows = [(1, None), (2, ""), (3, line), (None, line), (5, "\n\n"), (6, "a " * 5000), (3, line), (7, line + "\n" + line)]
    got = sorted((r.doc_id or 0, r.kept) for r in line_dedup(docs(rows)).select("doc.doc_id", "kept").collect())
    assert got == sorted([(1, ""), (2, ""), (3, line), (0, ""), (5, "\n\n"), (6, "a " * 5000), (3, line), (7, "")])
    assert line_dedup(docs([])).collect() == []


def test_templates_of_numbers(docs):
    """Lines with too few constants go only if another document has the same line."""
    rows = [(1, "12 15 18 20\nMon 12 15 18 20\nrow of the 1 2 3"), (2, "7 3 9 1\nMon 7 3 9 1\nrow of the 4 5 6"), (3, "12 15  18 20\nMon 1 1 1 1\nrow of the 1 2 3"),
            (4, "Tue 1 2 3\nrow of the 4 x 6"), (5, "Tue 4 5 6"), (6, "<*> <*> <*> <*>"), (7, "<*> <*> <*> <*>\n12 15 18 21")]
    got = dropped(docs(rows))
    assert got == {**dict(rows), 3: "Mon 1 1 1 1", 7: "12 15 18 21"}


def test_query_digests(spark, sf_dir):
    from changeflow.llm.catalog import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op6_exact_dedup"](spark, sf_dir).collect()}
    for i, t in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect():
        assert rows[i].text_sha256 == hashlib.sha256(norm(t).encode()).hexdigest()
