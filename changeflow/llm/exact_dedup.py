"""Exact dedup by distributed MSD radix partitioning.

A document is the record (length in bytes, bytes of its normal form). Records are split by the length first and then by
successive digits of their bytes. A group of one is finished at once, a group whose bytes are used up holds equal texts.
Digits grow from round to round, so the number of rounds is logarithmic in the longest repeated text. Groups are compared
by their bytes; no digest decides equality.

Each round counts groups with map-side folding (a group of copies is one row per task) and then joins the groups of two
or more back, which adaptive execution splits where a group is hot. What is still open is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from changeflow.llm.common import documents, one_space, same_document, stage


def copy_groups(docs: DataFrame, first_digit: int = 64, growth: int = 8) -> DataFrame:
    """Groups of two or more equal texts: (doc_id, key, keep_id, group_size), one row per document of ``documents()``.

    ``first_digit`` is the number of bytes of the first digit and ``growth`` the factor from digit to digit.
    """
    alive = docs.select("doc_id", "key", F.octet_length("text").cast("long").alias("part"), F.col("text").cast("binary").alias("rest"))
    width, finished = first_digit, []
    while True:
        digit = alive.select("*", F.substring("rest", 1, width).alias("digit"), (F.octet_length("rest") <= width).alias("ended"))
        by = ["part", "digit", "ended"]
        groups = stage(
            digit.groupBy(*by).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            .filter("group_size > 1").withColumn("next_part", F.monotonically_increasing_id()),
            "radix-groups",
        )
        rest = F.when(~F.col("ended"), F.expr(f"substring(rest, {width + 1})"))
        split = stage(
            digit.join(groups.hint("merge"), by).select("doc_id", "key", F.col("next_part").alias("part"), "ended", "keep_id", "group_size", rest.alias("rest")),
            "radix-rows",
        )
        finished.append(split.filter("ended").select("doc_id", "key", "keep_id", "group_size"))
        alive = split.filter("NOT ended").select("doc_id", "key", "part", "rest")
        if alive.isEmpty():
            break
        width *= growth
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **digits: int) -> DataFrame:
    """Every row of ``docs`` in column ``doc`` (a struct, so that no name can clash) with ``keep_id``, ``group_size``
    and ``kept``. Columns of ``doc`` that are not asked for are not shuffled.

    Texts are equal when they are identical after each run of white space is replaced by one space; null counts as empty,
    so empty texts form one group. The smallest id of a group stays. A row without an id stays only in a group without
    any id. Rows that repeat both id and text count in ``group_size``, and one of them stays. An empty table gives none.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).cast("long").alias("doc_id"), one_space(F.col(text)).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    groups = copy_groups(documents(rows), **digits).groupBy("doc_id", "key").agg(
        F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"))
    joined = rows.join(groups, same_document(rows, groups), "left").select(
        "doc", rows["doc_id"], rows["key"],
        F.when(F.col("group_size").isNull(), rows["doc_id"]).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    again = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("doc_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("again") == 1)
    return joined.withColumn("again", again).select("doc", "keep_id", "group_size", kept.alias("kept"))
