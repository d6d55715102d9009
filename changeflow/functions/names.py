"""Column expressions over dotted table names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def table_id(text: Column) -> Column:
    """``a.b.schema.table`` as catalog, schema and table; all but the last two parts are the catalog."""
    parts = F.split(text, r"\.")
    n = F.size(parts)
    return F.struct(
        F.when(n > 2, F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 2, F.lit(0))), ".")).alias("catalog"),
        F.when(n > 1, F.get(parts, n - 2)).alias("schema_name"),
        F.get(parts, n - 1).alias("table_name"),
    )


def quote_part(part: Column, keywords: list[str]) -> Column:
    """Quoted if it starts with an underscore or is a keyword; missing becomes the text ``null``."""
    needs = part.startswith("_") | F.array_contains(F.array(*[F.lit(w.lower()) for w in keywords]), F.lower(part))
    return F.coalesce(F.when(needs, F.concat(F.lit('"'), part, F.lit('"'))).otherwise(part), F.lit("null"))


def quote_id(tid: Column, keywords: list[str], use_catalog: bool = False) -> Column:
    """``schema.table`` (or ``catalog.table``) with parts quoted where needed."""
    head = tid["catalog"] if use_catalog else tid["schema_name"]
    return F.concat(
        F.when(head.isNotNull(), F.concat(quote_part(head, keywords), F.lit("."))).otherwise(""),
        quote_part(tid["table_name"], keywords),
    )
