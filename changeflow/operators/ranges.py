"""Ordered work per key that survives a key holding a large share of all rows.

A window per key puts the whole key into one task. Here a bounded sample finds the hot
keys and cuts them into order ranges; a window then runs per (key, range) and the few
rows at the range edges are repaired from a small table with one row per hot (key, range).
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from changeflow.session import shuffle_partitions

SAMPLE_PER_PART = 32
RANGE = "__range"


@dataclass(frozen=True)
class Cuts:
    """Cut points of the hot keys: ``keys`` name the columns, ``rows`` are sorted values."""

    keys: tuple[str, ...]
    sources: tuple[T.DataType, ...]
    rows: tuple[tuple, ...]

    @property
    def types(self) -> tuple[T.DataType, ...]:
        return tuple(_sortable(t) for t in self.sources)

    def range_id(self) -> Column:
        """Number of cut points at or before the row (binary search, log2 steps per row)."""
        if not self.rows:
            return F.lit(0)
        names = [f"c{i}" for i in range(len(self.keys))]
        schema = T.ArrayType(
            T.StructType([T.StructField(n, t) for n, t in zip(names, self.types)])
        )
        text = json.dumps([dict(zip(names, row)) for row in self.rows], default=str)
        cuts = F.from_json(F.lit(text), schema)
        here = F.struct(*[_sort_value(k, t).alias(n) for k, t, n in zip(self.keys, self.sources, names)])
        steps = [1 << i for i in reversed(range(len(self.rows).bit_length()))]

        def step(low: Column, width: Column) -> Column:
            probe = low + width
            return F.when(
                (probe <= len(self.rows)) & (F.get(cuts, probe - 1) <= here), probe
            ).otherwise(low)

        # never null, so that no join on it adds a test of the whole expression to what lies below
        return F.coalesce(F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step), F.lit(0))


def _sortable(dtype: T.DataType) -> T.DataType:
    """Type in which cut points of a key are kept; its order is that of the key."""
    if isinstance(dtype, (T.DecimalType, T.StringType)):
        return dtype if isinstance(dtype, T.DecimalType) else T.StringType()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dtype, T.BinaryType):
        return T.StringType()
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(dtype, whole):
        return T.LongType()
    raise TypeError(f"range keys must have an order, got {dtype.simpleString()}")


def _sort_value(key: str, dtype: T.DataType) -> Column:
    """A key as its ``_sortable`` type: days, microseconds and hex digits for dates, times and bytes."""
    col = F.col(key)
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp"))
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, T.BooleanType):
        return col.cast("int").cast("long")
    return col.cast(_sortable(dtype))


def _sample(df: DataFrame, keys: Sequence[str], size: int) -> list[tuple]:
    """``size`` rows with the smallest hash: bounded, and uniform over rows, also over rows that repeat."""
    names = [f"c{i}" for i in range(len(keys))]
    rows = (
        df.select(*[_sort_value(k, df.schema[k].dataType).alias(n) for k, n in zip(keys, names)], F.monotonically_increasing_id().alias("row"))
        .orderBy(F.xxhash64(*names, "row"))
        .select(*names)
        .limit(size)
        .collect()
    )
    # nulls sort first, as in Spark
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, v) for v in r])


def hot_cuts(df: DataFrame, group: Sequence[str], order: Sequence[str], parts: int | None = None) -> Cuts:
    """Cut points inside groups that hold more than about ``1/parts`` of the rows.

    ``parts`` 0 means the caller has counted the rows and any group fits one task: no cuts.
    """
    keys = (*group, *order)
    types = tuple(df.schema[k].dataType for k in keys)
    for t in types:
        _sortable(t)
    if parts == 0:
        return Cuts(keys, types, ())
    parts = parts or shuffle_partitions(df.sparkSession)
    sample = _sample(df, keys, parts * SAMPLE_PER_PART)
    width = max(2, len(sample) // parts)
    sizes = Counter(row[: len(group)] for row in sample)
    rows, seen = [], Counter()
    for row in sample:
        g = row[: len(group)]
        seen[g] += 1
        if sizes[g] >= 2 * width and seen[g] > 1 and seen[g] % width == 1 % width:
            rows.append(row)
    return Cuts(keys, types, tuple(dict.fromkeys(rows)))


def range_cuts(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> Cuts:
    """Cut points that split the whole table into about ``parts`` equal ranges."""
    parts = parts or shuffle_partitions(df.sparkSession)
    types = tuple(df.schema[k].dataType for k in keys)
    sample = _sample(df, keys, parts * SAMPLE_PER_PART)
    width = max(1, len(sample) // parts)
    return Cuts(tuple(keys), types, tuple(dict.fromkeys(sample[width::width])))


def _hot_rows(df: DataFrame, cuts: Cuts, group: Sequence[str]) -> DataFrame:
    """Rows of the groups that were cut; there are at most as many groups as cut points."""
    names = [f"__hot{i}" for i in range(len(group))]
    fields = [T.StructField(n, _sortable(df.schema[g].dataType)) for n, g in zip(names, group)]
    values = sorted({row[: len(group)] for row in cuts.rows}, key=str)
    hot = df.sparkSession.createDataFrame(values, T.StructType(fields))
    same = F.lit(True)
    for n, g in zip(names, group):
        same = same & (_sort_value(g, df.schema[g].dataType) == F.col(n))
    return df.join(F.broadcast(hot), same, "left_semi")


def _repair(df: DataFrame, edges: DataFrame, group: Sequence[str]) -> DataFrame:
    """Attach edge values; ``edges`` has one row per (hot group, range), bounded by the cuts."""
    on = [*group, RANGE]
    return df.join(F.broadcast(edges), on, "left")


def _shift_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str, parts: int | None, ahead: bool
) -> DataFrame:
    cuts = hot_cuts(df, group, order, parts)
    ranged = df.withColumn(RANGE, cuts.range_id())
    # wrapped so that a null value is told apart from "no such row"
    boxed = F.struct(F.col(value).alias("v"))
    window = Window.partitionBy(*group, RANGE).orderBy(*order)
    result = ranged.withColumn("__near", (F.lead if ahead else F.lag)(boxed).over(window))
    if cuts.rows:
        pick = (F.min_by if ahead else F.max_by)(boxed, F.struct(*order))
        by_range = Window.partitionBy(*group).orderBy(RANGE)
        edges = _hot_rows(ranged, cuts, group).groupBy(*group, RANGE).agg(pick.alias("end"))
        edges = edges.select(*group, RANGE, (F.lead if ahead else F.lag)("end").over(by_range).alias("__edge"))
        result = _repair(result, edges, group).withColumn("__near", F.coalesce("__near", "__edge")).drop("__edge")
    return result.withColumn(out, F.col("__near.v")).drop("__near", RANGE)


def lead_in_group(df, group, order, value: str, out: str, parts: int | None = None) -> DataFrame:
    """``lead(value) over (partition by group order by order)``."""
    return _shift_in_group(df, group, order, value, out, parts, ahead=True)


def lag_in_group(df, group, order, value: str, out: str, parts: int | None = None) -> DataFrame:
    """``lag(value) over (partition by group order by order)``."""
    return _shift_in_group(df, group, order, value, out, parts, ahead=False)


def carry_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], columns: dict[str, str], parts: int | None = None
) -> DataFrame:
    """Last non-null value so far, per group, for each ``out: column`` of ``columns``."""
    cuts = hot_cuts(df, group, order, parts)
    ranged = df.withColumn(RANGE, cuts.range_id())
    so_far = Window.partitionBy(*group, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    result = ranged.withColumns({out: F.last(c, ignorenulls=True).over(so_far) for out, c in columns.items()})
    if cuts.rows:
        before = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        when = {c: F.when(F.col(c).isNotNull(), F.struct(*order)) for c in columns.values()}
        ends = _hot_rows(ranged, cuts, group).groupBy(*group, RANGE).agg(
            *[F.max_by(c, when[c]).alias(f"__end_{out}") for out, c in columns.items()]
        )
        edges = ends.select(
            *group, RANGE, *[F.last(f"__end_{o}", ignorenulls=True).over(before).alias(f"__edge_{o}") for o in columns]
        )
        result = (
            _repair(result, edges, group)
            .withColumns({o: F.coalesce(o, f"__edge_{o}") for o in columns})
            .drop(*[f"__edge_{o}" for o in columns])
        )
    return result.drop(RANGE)


def row_number_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, parts: int | None = None
) -> DataFrame:
    """``row_number() over (partition by group order by order)``."""
    cuts = hot_cuts(df, group, order, parts)
    ranged = df.withColumn(RANGE, cuts.range_id())
    window = Window.partitionBy(*group, RANGE).orderBy(*order)
    result = ranged.withColumn(out, F.row_number().over(window).cast("long"))
    if cuts.rows:
        before = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        edges = (
            _hot_rows(ranged, cuts, group)
            .groupBy(*group, RANGE)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(*group, RANGE, F.sum("n").over(before).alias("__skip"))
        )
        result = (
            _repair(result, edges, group)
            .withColumn(out, F.col(out) + F.coalesce("__skip", F.lit(0)))
            .drop("__skip")
        )
    return result.drop(RANGE)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    values: Sequence[str],
    parts: int | None = None,
    small_limit: int | None = None,
) -> DataFrame:
    """For each left row the ``values`` of the last right row with ``right_on <= left_on``.

    A right side proven small is broadcast as one sorted array per ``by`` key and searched;
    otherwise (or with ``small_limit`` 0) both sides are merged per (key, range) in one shuffle.
    """
    limit = 50_000 if small_limit is None else small_limit
    found = F.struct(*[F.col(v) for v in values])
    # texts are compared as such, everything else as whole numbers
    kind = "string" if isinstance(right.schema[right_on].dataType, T.StringType) else "long"
    left = left.withColumn("__at", F.col(left_on).cast(kind))
    slim = right.select(*by, F.col(right_on).cast(kind).alias("__t"), found.alias("__v")).filter(
        F.col("__t").isNotNull()
    )
    if limit > 0 and slim.limit(limit + 1).count() <= limit:
        return _asof_search(left, slim, by, values, limit).drop("__at")
    return _asof_merge(left, slim, by, values, parts)


def _asof_search(left: DataFrame, slim: DataFrame, by: Sequence[str], values: Sequence[str], limit: int) -> DataFrame:
    keys = list(by) or ["__one"]
    if not by:
        left, slim = left.withColumn("__one", F.lit(1)), slim.withColumn("__one", F.lit(1))
    table = slim.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__t", "__v"))).alias("__table"))
    joined = left.join(F.broadcast(table), keys, "left")
    size = F.size("__table")
    # as many steps as the number of rows checked by the caller needs
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(limit.bit_length()))])

    def step(low: Column, width: Column) -> Column:
        probe = low + width
        hit = F.get("__table", probe - 1)["__t"] <= F.col("__at")
        return F.when((probe <= size) & hit, probe).otherwise(low)

    joined = joined.withColumn("__hit", F.get("__table", F.aggregate(steps, F.lit(0), step) - 1)["__v"])
    for v in values:
        joined = joined.withColumn(v, F.col("__hit")[v])
    return joined.drop("__hit", "__table", "__one")


def _asof_merge(
    left: DataFrame, slim: DataFrame, by: Sequence[str], values: Sequence[str], parts: int | None
) -> DataFrame:
    keys = list(by) or ["__one"]
    if not by:
        left, slim = left.withColumn("__one", F.lit(1)), slim.withColumn("__one", F.lit(1))
    payload = [c for c in left.columns if c not in (*keys, "__at")]
    salt = F.xxhash64(*[F.col(c) for c in payload if not isinstance(left.schema[c].dataType, T.MapType)])
    rows = left.select(
        *keys,
        F.col("__at").alias("__t"),
        F.lit(1).alias("__side"),
        salt.alias("__salt"),
        F.struct(*payload).alias("__row"),
    ).unionByName(
        slim.select(*keys, "__t", F.lit(0).alias("__side"), F.lit(0).cast("long").alias("__salt"), "__v"),
        allowMissingColumns=True,
    )
    result = carry_in_group(rows, keys, ["__t", "__side", "__salt"], {"__hit": "__v"}, parts)
    # a left row without a time has no as-of value
    hit = F.when(F.col("__t").isNotNull(), F.col("__hit"))
    return result.filter(F.col("__side") == 1).select(
        *[k for k in keys if k != "__one"],
        *[F.col("__row")[c].alias(c) for c in payload],
        *[hit[v].alias(v) for v in values],
    )
