"""Quality rules as a bitmask ledger.

Every rule is evaluated once. The ledger keeps the measurements and one bit per failed rule, so a policy is a mask of
rules, a new policy needs no second look at the texts, and ablations are counts over masks. Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.llm.common import SPACE, WORD

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

# Bit of each rule, in order; a bit is never given a new meaning, new rules are added at the end.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("long_words", "word_chars > 20 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
)

# Rules that reject under each version of the policy.
POLICIES: dict[int, tuple[str, ...]] = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "symbols", "repeated_lines", "long_words", "short_words"),
}
BASE, CURRENT = 1, 2


def bit(rule: str) -> int:
    return 1 << [name for name, _ in RULES].index(rule)


def mask(version: int) -> int:
    return sum(bit(rule) for rule in POLICIES[version])


def measured(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` in column ``doc`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.select("*", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", f"{SPACE}+", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"))
    window = F.transform(
        F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), F.size("words") - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(F.concat_ws(" ", F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("w"), i.alias("i")))
    # equal windows are neighbours once sorted
    rows = rows.select("doc", "n_words", "word_chars", "n_symbols", "lines", F.sort_array(window).alias("windows"))
    twice = F.filter("windows", lambda x, i: F.coalesce(
        (x["w"] == F.get("windows", i - 1)["w"]) | (x["w"] == F.get("windows", i + 1)["w"]),
        x["w"] == F.get("windows", i - 1)["w"], x["w"] == F.get("windows", i + 1)["w"], F.lit(False)))
    rows = rows.select("*", twice.alias("twice"))
    covered = F.array_distinct(F.flatten(F.transform("twice", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return rows.select(
        "doc", "n_words", "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"))


def rule_ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: column ``doc`` (the row as a struct, so that no name can clash), the measurements and
    ``failures``, the bits of the rules that failed.

    A null or empty text has no words and fails ``few_words``; an empty table gives an empty ledger. Rows are judged one by
    one, so repeated rows and ties change nothing.
    """
    ledger = measured(docs, F.col(text))
    bits = [F.when(F.expr(test), F.lit(bit(name))).otherwise(F.lit(0)).cast("long") for name, test in RULES]
    failures = bits[0]
    for b in bits[1:]:
        failures = failures.bitwiseOR(b)
    return ledger.withColumn("failures", failures)


def rejected(version: int, failures: str | Column = "failures") -> Column:
    """Whether a policy rejects: its mask meets the failed bits."""
    col = F.col(failures) if isinstance(failures, str) else failures
    return col.bitwiseAND(F.lit(mask(version))) != 0


def ablations(ledger: DataFrame) -> DataFrame:
    """Per policy version and rule: documents, documents the policy rejects, those that fail the rule, and those that would
    stay if this rule alone were left out. One aggregation over masks (as many rows as masks), then bitwise tests."""
    masks = ledger.groupBy("failures").agg(F.count("*").alias("n"))
    tests = [F.struct(F.lit(v).alias("version"), F.lit(rule).alias("rule"), F.lit(mask(v)).cast("long").alias("mask"), F.lit(bit(rule)).cast("long").alias("bit"))
             for v, rules in POLICIES.items() for rule in rules]
    each = masks.select("failures", "n", F.explode(F.array(*tests)).alias("t")).select("failures", "n", "t.*")
    hit = F.col("failures").bitwiseAND(F.col("mask"))
    count = lambda test: F.sum(F.when(test, F.col("n")).otherwise(F.lit(0))).cast("long")
    return each.groupBy("version", "rule").agg(
        F.sum("n").cast("long").alias("n_docs"), count(hit != 0).alias("n_rejected"),
        count(F.col("failures").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count((hit != 0) & (hit == F.col("bit"))).alias("n_only"))


def quality_filter(docs: DataFrame, text: str = "text", version: int = CURRENT) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that the policy keeps.

    Kept rows come out of an outer explode: a filter on the verdict would be pushed down to the scan, with every measurement
    written out in it several times.
    """
    kept = F.explode_outer(F.when(~rejected(version), F.array("doc")))
    return rule_ledger(docs, text).select(kept.alias("doc")).filter("doc IS NOT NULL").select("doc.*")
