"""Typed projection: the text values of images or raw columns as Spark types, one pass."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.functions import values as v
from changeflow.model import UNAVAILABLE_PLACEHOLDER


@dataclass(frozen=True)
class ColumnSpec:
    """One source column, as the schema timeline describes it."""

    name: str
    jdbc_type: str
    length: int | None = None
    scale: int | None = None
    optional: bool = True
    type_name: str | None = None


@dataclass(frozen=True)
class Options:
    decimal_mode: str = "precise"  # precise, double, string
    legacy_decimal: bool = True
    temporal_mode: str = "timestamp"  # timestamp, connect, millis, micros, nanos
    interval_mode: str = "numeric"  # numeric, string
    binary_mode: str = "bytes"  # bytes, base64, base64-url-safe, hex
    lob_enabled: bool = True
    placeholder: str = UNAVAILABLE_PLACEHOLDER
    on_failure: str = "warn"  # fail, warn, skip


Converter = Callable[[Column, ColumnSpec], Column]


@dataclass
class Converters:
    """Converters of the user, tried in the order they were registered; the first match wins."""

    rules: list[tuple[re.Pattern, re.Pattern | None, Converter]] = field(default_factory=list)

    def register(self, selector: str, type_re: str | None, fn: Converter) -> Converters:
        self.rules.append((re.compile(selector, re.I), re.compile(type_re, re.I) if type_re else None, fn))
        return self

    def find(self, table: str, spec: ColumnSpec) -> Converter | None:
        path = f"{table}.{spec.name}"
        for selector, type_re, fn in self.rules:
            kind = spec.type_name or spec.jdbc_type
            if selector.fullmatch(path) and (type_re is None or type_re.fullmatch(kind)):
                return fn
        return None


def date_to_text(fmt: str = "yyyy-MM-dd") -> Converter:
    return lambda col, spec: v.date_text(F.timestamp_micros(v.literal_micros(col)), fmt)


def time_to_text(fmt: str = "HH:mm:ss.SSSSSS") -> Converter:
    return lambda col, spec: v.time_text(v.to_duration(col), fmt)


def timestamp_to_text(fmt: str = "yyyy-MM-dd HH:mm:ss.SSSSSS", cut_to_millis: bool = False) -> Converter:
    return lambda col, spec: v.timestamp_text(F.timestamp_micros(v.literal_micros(col)), fmt, cut_to_millis)


def register_converter(converters: Converters, selector: str, type_re: str | None, fn: Converter) -> Converters:
    """``fn(column, spec) -> Column`` for columns whose ``table.column`` and type name match."""
    return converters.register(selector, type_re, fn)


def _numeric(col: Column, spec: ColumnSpec, opt: Options) -> Column:
    length = spec.length if spec.length is not None else 38
    scale = spec.scale
    if scale is not None and scale <= 0 and not (scale == 0 and not opt.legacy_decimal and opt.decimal_mode != "precise"):
        width = v.integer_width(length, scale)
        if width:
            return v.to_integer(col, width)
    if opt.decimal_mode == "double":
        return v.to_double(col)
    if opt.decimal_mode == "string":
        return F.when(col.try_cast("double").isNotNull(), col)
    if scale is None:
        return v.to_variable_scale(col)
    return v.to_decimal(col, length, scale)


TEMPORAL = ("TIMESTAMP", "DATE")


def convert(col: Column, spec: ColumnSpec, opt: Options = Options(), staged: bool = False) -> Column:
    """The typed value of one text column. ``staged``: literals were unwrapped before."""
    jdbc = spec.jdbc_type
    if jdbc in ("NUMERIC", "DECIMAL"):
        return _numeric(col, spec, opt)
    if jdbc in ("INTEGER", "SMALLINT", "BIGINT"):
        return v.to_integer(col, {"INTEGER": "int", "SMALLINT": "smallint", "BIGINT": "bigint"}[jdbc])
    if jdbc == "TINYINT":
        return v.to_tinyint(col)
    if jdbc == "BOOLEAN":
        return v.to_boolean(col)
    if jdbc == "BIT":
        return v.to_bits(col, spec.length or 1)
    if jdbc in ("FLOAT", "DOUBLE"):
        return v.to_double(col)
    if jdbc == "REAL":
        return v.to_float(col)
    if jdbc in TEMPORAL:
        return v.to_timestamp(v.literal_text(col) if not staged else col, opt.temporal_mode)
    if jdbc == "TIMESTAMP_TZ":
        digits = spec.scale if spec.scale is not None else spec.length
        return v.to_zoned_text(col, 6 if digits is None else digits)
    if jdbc == "TIME":
        return v.to_duration(col)
    if jdbc == "YM_INTERVAL":
        return v.to_year_month(col, opt.interval_mode)
    if jdbc == "DS_INTERVAL":
        return v.to_day_second(col, opt.interval_mode)
    if jdbc == "JSON":
        # a value that was not supplied is null for JSON, and is never looked up again
        return F.when(col != opt.placeholder, v.to_json_text(col))
    if jdbc in ("RAW", "BLOB"):
        bytes_of = v.to_binary(col, spec.optional, opt.binary_mode, jdbc == "BLOB", opt.lob_enabled)
        missing = v.encode_binary(F.encode(F.lit(opt.placeholder), "UTF-8"), opt.binary_mode)
        return F.when(col == opt.placeholder, missing).otherwise(bytes_of)
    is_lob = jdbc in ("CLOB", "NCLOB", "SQLXML")
    if jdbc in ("CHAR", "VARCHAR", "NCHAR", "NVARCHAR", "CLOB", "NCLOB", "SQLXML", "STRUCT", "ROWID"):
        return F.when(col == opt.placeholder, col).otherwise(v.to_string(col, spec.optional, is_lob, opt.lob_enabled))
    return col


def _empty_by_rule(col: Column, spec: ColumnSpec, opt: Options) -> Column:
    """Inputs that are null on purpose and no failure."""
    rule = F.lit(False)
    if spec.jdbc_type in ("CHAR", "VARCHAR", "NCHAR", "NVARCHAR", "CLOB", "NCLOB", "SQLXML", "STRUCT", "ROWID", "RAW", "BLOB"):
        rule = col.isin("", "EMPTY_CLOB()", "EMPTY_BLOB()")
        if not opt.lob_enabled and spec.jdbc_type in ("CLOB", "NCLOB", "SQLXML", "BLOB"):
            rule = F.lit(True)
    if spec.jdbc_type == "JSON":
        rule = col == opt.placeholder
    return rule


def typed_projection(
    df: DataFrame,
    schema: Sequence[ColumnSpec],
    options: Options = Options(),
    table: str = "",
    image: str | None = None,
    keep: Sequence[str] = (),
    converters: Converters | None = None,
) -> DataFrame:
    """Typed columns out of text columns, or out of the map column ``image``.

    Values that cannot be converted are null; ``warn`` lists their columns in ``failed``, ``fail``
    raises, ``skip`` keeps quiet.
    """
    if options.on_failure not in ("fail", "warn", "skip"):
        raise ValueError(f"unknown failure policy {options.on_failure}")
    def source(name: str) -> Column:
        return F.col(image)[name] if image else F.col(f"`{name}`")

    rules = {s.name: converters.find(table, s) if converters else None for s in schema}
    # literals are unwrapped in a projection of their own, so that later tests do not repeat it
    staged = {
        s.name: f"__bare_{i}" for i, s in enumerate(schema) if s.jdbc_type in TEMPORAL and rules[s.name] is None
    }
    df = df.withColumns({bare: v.literal_text(source(name)) for name, bare in staged.items()}) if staged else df
    out, failed = [], []
    for spec in schema:
        own = rules[spec.name]
        raw = F.col(staged[spec.name]) if spec.name in staged else source(spec.name)
        value = own(raw, spec) if own else convert(raw, spec, options, staged=True)
        bad = raw.isNotNull() & value.isNull() & ~F.coalesce(_empty_by_rule(raw, spec, options), F.lit(False))
        if options.on_failure == "fail":
            stop = F.raise_error(F.concat(F.lit(f"cannot convert {spec.name}: "), raw))
            value = F.when(bad, stop).otherwise(value)
        out.append(value.alias(spec.name))
        failed.append(F.when(bad, F.lit(spec.name)))
    extra = [F.array_compact(F.array(*failed)).alias("failed")] if options.on_failure == "warn" and failed else []
    return df.select(*keep, *out, *extra)


def resolve_defaults(cols: DataFrame) -> DataFrame:
    """Add ``default_value``, the canonical text of ``default_text``, to resolved columns."""
    return cols.withColumn(
        "default_value",
        v.default_value(F.col("default_text"), F.col("jdbc_type"), F.col("length"), F.col("scale"), F.col("nullable")),
    )


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill nulls of required columns with their typed default."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(d).cast(types[c])) for c, d in defaults.items()})
