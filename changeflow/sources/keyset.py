"""Pages and chunks of a table in key order."""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow.operators.ranges import RANGE, range_cuts


def keyset_page(
    df: DataFrame,
    cols: Sequence[str],
    order_by: Sequence[str],
    limit: int,
    after: Sequence | None = None,
    extra: Column | str | None = None,
) -> DataFrame:
    """Next page in key order: rows above ``after`` that meet ``extra``. Spark plans a top-k."""
    if after is not None:
        # leading column alone reaches the scan, the struct test is exact
        low = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order_by, after)])
        df = df.filter(F.col(order_by[0]) >= F.lit(after[0])).filter(F.struct(*order_by) > low)
    if extra is not None:
        df = df.filter(extra)
    return df.orderBy(*order_by).limit(limit).select(*cols)


def keyset_chunks(df: DataFrame, key: Sequence[str], n: int, parts: int | None = None) -> DataFrame:
    """Exact chunks of ``n`` rows in key order as ``chunk_id``.

    Keys are cut into ranges; rows are numbered inside each range and shifted by the rows of the
    ranges before. These are counted first, at most one number per cut point, and are literals of
    the plan like the cut points: a join of the table with its own ranges is not planned reliably
    and would wait for a broadcast. No window spans the table.
    """
    cuts = range_cuts(df, key, parts)
    ranged = df.withColumn(RANGE, cuts.range_id())
    inside = Window.partitionBy(RANGE).orderBy(*key)
    sizes = dict(ranged.groupBy(RANGE).agg(F.count("*").alias("n")).collect())
    before = list(accumulate((sizes.get(i, 0) for i in range(len(cuts.rows))), initial=0))
    shift = F.get(F.from_json(F.lit(json.dumps(before)), "array<bigint>"), F.col(RANGE))
    numbered = ranged.withColumn("__rn", F.row_number().over(inside).cast("long"))
    return numbered.withColumn("chunk_id", F.floor((shift + F.col("__rn") - 1) / n).cast("long")).drop("__rn", RANGE)


def chunk_bounds(chunks: DataFrame, key: Sequence[str]) -> DataFrame:
    k = F.struct(*key)
    return chunks.groupBy("chunk_id").agg(F.min(k).alias("low_key"), F.max(k).alias("high_key"), F.count("*").alias("rows"))
