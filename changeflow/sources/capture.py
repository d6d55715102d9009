"""Which tables and columns take part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.model import SYSTEM_SCHEMAS
from changeflow.session import broadcast_if_small


def _any(patterns: str | None) -> str | None:
    """Comma list of regular expressions as one, matched against the whole name, any case."""
    if not patterns:
        return None
    parts = [p.strip() for p in patterns.split(",") if p.strip()]
    return "(?i)^(?:" + "|".join(f"(?:{p})" for p in parts) + ")$"


def _kept(name: Column, include: str | None, exclude: str | None) -> Column:
    keep = F.lit(True)
    if include:
        keep = keep & name.rlike(_any(include))
    if exclude:
        keep = keep & ~name.rlike(_any(exclude))
    return keep


def capture_filter(tables: DataFrame, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Tables to capture: no system schemas, then ``schema.table`` patterns."""
    name = F.concat_ws(".", "schema_name", "table_name")
    return tables.filter(~F.col("schema_name").isin(*SYSTEM_SCHEMAS) & _kept(name, include, exclude))


def captured_only(log: DataFrame, tables: DataFrame) -> DataFrame:
    keep, _ = broadcast_if_small(tables.select("schema_name", "table_name").distinct())
    return log.join(keep, ["schema_name", "table_name"], "left_semi")


def column_filter(df: DataFrame, include: str | None = None, exclude: str | None = None, table: str | None = None) -> DataFrame:
    """Keep columns by ``schema.table.column`` patterns: of both images, or of a flat table named ``table``."""
    if table is not None:
        import re

        keep = lambda c: (not include or re.match(_any(include), f"{table}.{c}")) and not (
            exclude and re.match(_any(exclude), f"{table}.{c}")
        )
        return df.select(*[c for c in df.columns if keep(c)])
    prefix = F.concat_ws(".", "schema_name", "table_name")
    test = lambda c, v: _kept(F.concat_ws(".", prefix, c), include, exclude)
    return df.withColumns({side: F.map_filter(side, test) for side in ("before", "after")})
