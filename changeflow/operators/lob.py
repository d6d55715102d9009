"""Large objects that arrive in pieces, and values the log does not supply."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.model import BINARY_LOB_TYPES, IMAGE, POSITION_FIELDS, TEXT_LOB_TYPES, UNAVAILABLE_PLACEHOLDER
from changeflow.operators.image import Key, key_of
from changeflow.operators.ranges import carry_in_group
from changeflow.session import cut_lineage


class Lobs(NamedTuple):
    #: event_id, col, type_name, text, bytes, size, ref; every column of the complete events
    values: DataFrame
    #: event_id, ended, expected; events whose chunks have not all arrived
    open_events: DataFrame
    #: event_id, col, segment, type_name, bytes; the pieces of objects too long for one cell, in order
    segments: DataFrame


def _concat(pieces: Column) -> Column:
    """Bytes of an array of (seq, bytes) in order. One byte is one Latin-1 character, so joining
    text is linear where repeated binary concatenation would copy again and again."""
    ordered = F.array_sort(pieces)
    once = F.filter(ordered, lambda p, i: (i == 0) | (p["seq"] != F.get(ordered, i - 1)["seq"]))
    latin = F.transform(once, lambda p: F.decode(p["bytes"], "ISO-8859-1"))
    return F.encode(F.array_join(latin, ""), "ISO-8859-1")


def assemble_lobs(
    chunks: DataFrame, expected: DataFrame | None = None, value_bytes: int = 256 << 20, segment_chunks: int = 10_000
) -> Lobs:
    """Put the chunks of each (event, column) together.

    ``expected`` has event_id and out_row_cols, the number of columns that must have ended. A column
    has ended when its end mark and every chunk before it are there. Chunks delivered twice count once.
    An object of more than ``value_bytes`` bytes, which one cell and one task could not hold, comes as
    ordered segments; its row in ``values`` has ``ref``, the name of the segments, in place of the data.
    """
    # the bookkeeping reads lengths only
    one = chunks.groupBy("event_id", "col", "seq").agg(F.max("is_end").alias("is_end"), F.max(F.length("bytes")).alias("n"))
    per_col = one.groupBy("event_id", "col").agg(
        F.max(F.when(F.col("is_end"), F.col("seq"))).alias("last_seq"), F.max("seq").alias("top"), F.count("*").alias("pieces"),
        F.sum("n").alias("size"),
    )
    per_col = per_col.withColumn("whole", (F.col("pieces") == F.col("last_seq") + 1) & (F.col("top") == F.col("last_seq")))
    status = per_col.groupBy("event_id").agg(F.count_if("whole").alias("ended"), F.count("*").alias("cols"))
    if expected is not None:
        status = expected.select("event_id", F.col("out_row_cols").alias("expected")).join(status, "event_id", "left")
    else:
        status = status.withColumn("expected", F.col("cols"))
    ended = F.coalesce(F.col("ended"), F.lit(0))
    # a column that has begun must end too
    done = (ended >= F.col("expected")) & (ended >= F.coalesce("cols", F.lit(0)))
    open_events = status.filter(~done).select("event_id", ended.alias("ended"), "expected")

    complete = per_col.join(status.filter(done).select("event_id"), "event_id").select(
        "event_id", "col", (F.coalesce("size", F.lit(0)) > value_bytes).alias("long"), "size")
    pieces = chunks.join(complete, ["event_id", "col"])
    joined = _concat(F.collect_list(F.struct("seq", "bytes"))).alias("bytes")
    kind = F.min_by("type_name", "seq").alias("type_name")
    values = pieces.filter("NOT long").groupBy("event_id", "col").agg(kind, joined)
    # segments of an object meet by (event, column, segment), so no task gathers all of it
    long = pieces.filter("long")
    segments = long.groupBy("event_id", "col", F.floor(F.col("seq") / segment_chunks).alias("segment")).agg(kind, joined)
    named = long.groupBy("event_id", "col").agg(kind, F.max("size").alias("size"))
    return Lobs(lob_values(values).unionByName(_references(named)), open_events, segments)


def log_chunks(log: DataFrame, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The chunks of a log with the record that each follows, and the records that expect chunks.

    In log order a chunk belongs to the last record before it, whatever lies in another task or file: the open record is
    carried along the log, and from range to range. Any other record, of whatever kind, ends it; chunks behind a record that
    expects none belong to nothing. ``event_id`` is the record's position as text. A record or chunk delivered twice is one.
    """
    other = F.col("lcr_type") != "CHUNK"
    opened = F.coalesce("has_chunks", F.lit(False)) & (F.col("lcr_type") == "DML")
    name = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in POSITION_FIELDS])
    rows = log.select(
        *POSITION_FIELDS, F.when(other, F.lit(-1)).otherwise(F.col("chunk_no")).alias("seq"), F.lit(0).alias("log"),
        F.when(other, F.struct(F.when(opened, name).alias("event_id"))).alias("opens"),
        F.col("chunk_col").alias("col"), F.col("chunk_type").alias("type_name"), F.col("chunk_bytes").alias("bytes"), F.col("chunk_end").alias("is_end"))
    carried = carry_in_group(rows, ["log"], [*POSITION_FIELDS, "seq"], {"record": "opens"}, parts)
    chunks = carried.filter("opens IS NULL AND record.event_id IS NOT NULL").select(
        F.col("record.event_id").alias("event_id"), "col", "type_name", "seq", "bytes", F.coalesce("is_end", F.lit(False)).alias("is_end"))
    records = log.filter(opened).groupBy(name.alias("event_id")).agg(F.max(F.coalesce("out_row_cols", F.lit(0))).alias("out_row_cols"))
    return cut_lineage(chunks), records


def lobs_from_log(log: DataFrame, value_bytes: int = 256 << 20, segment_chunks: int = 10_000, parts: int | None = None) -> Lobs:
    """``assemble_lobs`` from the CHUNK records of a log: an event whose chunks another record cuts off stays open."""
    chunks, records = log_chunks(log, parts)
    return assemble_lobs(chunks, records, value_bytes, segment_chunks)


def complete_records(log: DataFrame, lobs: Lobs) -> DataFrame:
    """The row changes of a log, ``after`` with its large objects. Records that wait for chunks are left out."""
    name = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in POSITION_FIELDS])
    rows = log.filter("lcr_type = 'DML'").withColumn("event_id", name)
    ready = rows.join(lobs.open_events.select("event_id"), "event_id", "left_anti").join(lob_images(lobs.values), "event_id", "left")
    kept = F.map_filter("after", lambda c, v: ~F.array_contains(F.map_keys("lobs"), c))
    return ready.withColumn("after", F.when(F.col("lobs").isNull(), F.col("after")).otherwise(F.map_concat(F.coalesce(kept, F.create_map().cast(IMAGE)), "lobs"))).drop("event_id", "lobs")


def _references(named: DataFrame) -> DataFrame:
    none = F.lit(None)
    ref = F.concat_ws(":", F.lit("segments"), "event_id", "col")
    return named.filter(F.col("type_name").isin(*TEXT_LOB_TYPES, *BINARY_LOB_TYPES)).select(
        "event_id", "col", "type_name", none.cast("string").alias("text"), none.cast("binary").alias("bytes"), F.col("size").cast("long"), ref.alias("ref"))


def lob_values(values: DataFrame, *keep: str) -> DataFrame:
    """Text types decoded, binary types kept, an object of size 0 null, other types left out."""
    is_text = F.col("type_name").isin(*TEXT_LOB_TYPES)
    size = F.length("bytes")
    filled = F.when(size > 0, F.col("bytes"))
    return values.filter(is_text | F.col("type_name").isin(*BINARY_LOB_TYPES)).select(
        "event_id",
        "col",
        "type_name",
        *keep,
        F.when(is_text, F.decode(filled, "UTF-8")).alias("text"),
        F.when(~is_text, filled).alias("bytes"),
        size.cast("long").alias("size"),
        F.lit(None).cast("string").alias("ref"),
    )


def lob_images(values: DataFrame) -> DataFrame:
    """One row per event: column -> value text (bytes as hex), as images hold it; an object too long for a cell is its reference."""
    text = F.coalesce("text", F.hex("bytes"), "ref")
    return values.groupBy("event_id").agg(
        F.map_from_entries(F.collect_list(F.struct("col", text.alias("value")))).alias("lobs")
    )


def mark_unavailable(
    events: DataFrame, lob_cols: Column, lobs: DataFrame | None = None, placeholder: str = UNAVAILABLE_PLACEHOLDER
) -> DataFrame:
    """Fill the large-object columns of both images.

    After: the assembled value, else the placeholder, wherever the image has none. Before: the
    placeholder wherever the image has none. ``lobs`` (event_id, lobs) comes from ``lob_images``.
    """
    none = F.lit(None).cast("map<string,string>")
    rows = events.join(lobs, "event_id", "left") if lobs is not None else events.withColumn("lobs", none)
    rows = rows.withColumn("__cols", lob_cols)
    empty = F.create_map().cast("map<string,string>")

    def fill(image: Column, known: Column) -> Column:
        image = F.coalesce(image, empty)
        rest = F.map_filter(image, lambda c, v: ~F.array_contains("__cols", c) | v.isNotNull())
        gaps = F.filter("__cols", lambda c: image[c].isNull())
        value = lambda c: F.when(F.map_contains_key(known, c), known[c]).otherwise(F.lit(placeholder))
        return F.map_concat(rest, F.map_from_entries(F.transform(gaps, lambda c: F.struct(c, value(c)))))

    after = F.when(F.col("after").isNotNull(), fill(F.col("after"), F.coalesce("lobs", empty)))
    before = F.when(F.col("before").isNotNull(), fill(F.col("before"), empty))
    return rows.withColumn("after", after).withColumn("before", before).drop("lobs", "__cols")


def reselect_lobs(
    events: DataFrame,
    table: DataFrame,
    pk: list[str],
    lob_cols: dict[str, str],
    lob_enabled: bool = True,
    placeholder: str = UNAVAILABLE_PLACEHOLDER,
) -> DataFrame:
    """Look up placeholder values of updates in the current table, by primary key, in one join.

    ``lob_cols`` maps column to type. JSON columns never count as placeholders. The create half of a
    key change is looked up only when large objects are enabled. Without a match nothing changes.
    Only events that need it are shuffled; a hot key is split by adaptive execution.
    """
    names = [c for c, t in lob_cols.items() if t != "JSON"]
    if not names:
        return events
    after = F.col("after")
    gap = F.lit(False)
    for c in names:
        gap = gap | after[c].eqNullSafe(F.lit(placeholder))
    moved = (F.col("op") == "c") & (F.coalesce(F.col("sub"), F.lit(0)) == 1) if "sub" in events.columns else F.lit(False)
    need = F.coalesce(gap & ((F.col("op") == "u") | (moved & F.lit(lob_enabled))), F.lit(False))
    current = table.select(
        F.array(*[F.col(c).cast("string") for c in pk]).alias("__key"),
        F.lit(True).alias("__found"),
        F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("string"))]).alias("__lobs"),
    )
    wanted = events.filter(need).withColumn("__key", key_of(after, pk)).join(current, "__key", "left")
    is_gap = lambda c, v: F.col("__found") & c.isin(*names) & (v == placeholder)
    looked_up = wanted.withColumn(
        "after", F.transform_values("after", lambda c, v: F.when(is_gap(c, v), F.col("__lobs")[c]).otherwise(v))
    ).drop("__key", "__found", "__lobs")
    return events.filter(~need).unionByName(looked_up)
