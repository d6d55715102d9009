"""Column expressions over system change numbers and their text encodings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCN_TYPE = "decimal(38,0)"


def as_scn(value: Column) -> Column:
    return value.cast(SCN_TYPE)


def scn_add(a: Column, b: Column) -> Column:
    """Sum that treats a missing side as absent: null + x = x."""
    a, b = as_scn(a), as_scn(b)
    return F.coalesce((a + b).cast(SCN_TYPE), a, b)


def scn_sub(a: Column, b: Column) -> Column:
    """Difference with null - x = -x and x - null = x."""
    a, b = as_scn(a), as_scn(b)
    return F.coalesce((a - b).cast(SCN_TYPE), a, (-b).cast(SCN_TYPE))


def scn_cmp(a: Column, b: Column) -> Column:
    """-1, 0 or 1; a missing SCN is lower than any other."""
    a, b = as_scn(a), as_scn(b)
    return (
        F.when(a.eqNullSafe(b), 0)
        .when(a.isNull(), -1)
        .when(b.isNull(), 1)
        .otherwise(F.signum((a - b).cast("double")).cast("int"))
    )


def scn_of_text(text: Column) -> Column:
    """A whole number of up to 38 digits, else null."""
    return F.when(text.rlike(r"^\s*[+-]?[0-9]{1,38}\s*$"), F.trim(text).try_cast(SCN_TYPE))


def commit_entry(entry: Column) -> Column:
    """``scn``, ``scn:thread:tx-tx`` or ``scn:_:_:thread`` as a struct; null for other forms."""
    parts = F.split(entry, ":", -1)
    none = F.array().cast("array<string>")
    scn = scn_of_text(F.get(parts, 0))
    size = F.size(parts)
    thread = F.when(size == 1, F.lit(1)).when(size == 3, F.get(parts, 1).try_cast("int")).when(
        size == 4, F.get(parts, 3).try_cast("int")
    )
    # an empty SCN stays null but the text "null" is its written form
    known = (F.get(parts, 0) == "null") | scn.isNotNull()
    ids = F.when((size == 3) & (F.get(parts, 2) != ""), F.array_distinct(F.split(F.get(parts, 2), "-"))).otherwise(none)
    return F.when(known & thread.isNotNull(), F.struct(thread.alias("redo_thread"), scn.alias("scn"), ids.alias("tx_ids")))


def pending_map(text: Column) -> Column:
    """``tx:scn,tx:scn`` as a map from transaction to SCN, blank entries removed."""
    entries = F.filter(F.transform(F.split(text, ","), lambda e: F.trim(e)), lambda e: e != "")
    pairs = F.transform(
        entries,
        lambda e: F.struct(F.substring_index(e, ":", 1), scn_of_text(F.regexp_extract(e, r"^[^:]*:(.*)$", 1))),
    )
    return F.map_from_entries(pairs)


def pending_text(pending: Column) -> Column:
    pairs = F.transform(
        F.array_sort(F.map_entries(pending)), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))
    )
    return F.array_join(pairs, ",")


def instance_number(text: Column) -> Column:
    """Instance id as written by either format: digits, or base64 whose first byte counts."""
    first = F.conv(F.substring(F.hex(F.try_to_binary(text, F.lit("base64"))), 1, 2), 16, 10).try_cast("int")
    signed = F.when(first > 127, first - 256).otherwise(first)
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int")).otherwise(signed)
