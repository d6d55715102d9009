"""Consistent snapshots of tables as read events."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changeflow.model import IMAGE
from changeflow.sources.signals import signal_read

AS_OF_TOKEN = "${AS_OF_SCN}"


def read_events(df: DataFrame, name: str, scn: Column | int, ts: Column, chunk: str | None = None) -> DataFrame:
    """Rows of one table as ``op='r'`` events without a before-image."""
    schema_name, table = name.split(".", 1)
    cols = [c for c in df.columns if c != chunk]
    image = F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))])
    scn = F.lit(scn) if isinstance(scn, int) else scn
    return df.select(
        F.lit("r").alias("op"),
        F.lit(schema_name).alias("schema_name"),
        F.lit(table).alias("table_name"),
        F.lit(None).cast(IMAGE).alias("before"),
        image.alias("after"),
        scn.cast("long").alias("position_scn"),
        ts.alias("commit_ts"),
        *([F.col(chunk).alias("chunk_id")] if chunk else []),
    )


def snapshot_read(
    spark: SparkSession, tables: dict[str, DataFrame | Callable[[int], DataFrame]], scn: int, ts: Column
) -> DataFrame:
    """All captured tables as of one SCN. A table is a frame, or a function of the SCN.

    The union keeps the partitions of every table, so tables are read side by side.
    """
    parts = [
        read_events(source(scn) if callable(source) else source, name, scn, ts) for name, source in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def jdbc_table(spark: SparkSession, url: str, table: str, key: str, bounds: tuple, partitions: int, **options) -> DataFrame:
    """A live table split into ``partitions`` key ranges that are read in parallel."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions,
        properties={"fetchsize": "10000", **options},
    )


def snapshot_override(
    spark: SparkSession, sql: str, scn: int, views: dict[str, Callable[[int | None], DataFrame]], token: str = AS_OF_TOKEN
) -> DataFrame:
    """A custom SELECT. A table name followed by the token is read as of ``scn``, others as they are now.

    ``views`` maps a table name to a function of the SCN (null = latest).
    """
    frames: dict[str, DataFrame] = {}

    def bind(match: re.Match) -> str:
        name = f"t{len(frames)}"
        frames[name] = views[match.group(1)](scn if match.group(2) else None)
        return "{" + name + "}"

    names = "|".join(sorted((re.escape(n) for n in views), key=len, reverse=True))
    text = re.sub(rf"(?<![\w.])({names})(?![\w.])(\s*{re.escape(token)})?", bind, sql)
    return spark.sql(text, **frames)


# Which phases a mode runs. (schema, data, stream), by whether a usable offset exists.
MODES = {
    "always": ((True, True, True), (True, True, True)),
    "initial": ((True, True, True), (False, False, True)),
    "initial_only": ((True, True, False), (False, False, False)),
    "no_data": ((True, False, True), (False, False, True)),
    "recovery": (None, (True, False, True)),
    "when_needed": ((True, True, True), (False, False, True)),
}
ALIASES = {"schema_only": "no_data", "schema_only_recovery": "recovery"}


def phases(mode: str, has_offset: bool = False, snapshot_done: bool = False, history_exists: bool = True, offset_available: bool = True) -> dict[str, bool]:
    """Phases of a run. An unfinished snapshot counts as none; an offset the log no longer holds
    starts over only in ``when_needed``."""
    mode = ALIASES.get(mode, mode)
    if mode not in MODES:
        raise ValueError(f"unknown snapshot mode {mode}")
    usable = has_offset and snapshot_done
    if mode == "when_needed":
        usable = usable and offset_available
    elif usable and not offset_available and mode != "always":
        raise ValueError("the stored position is no longer in the log")
    if usable and not history_exists and mode not in ("recovery", "always"):
        raise ValueError("the schema history is missing; use mode recovery")
    plan = MODES[mode][usable]
    if plan is None:
        raise ValueError("recovery needs a stored position")
    return dict(zip(("schema", "data", "stream"), plan))


def capture(
    mode: str,
    snapshot: Callable[[int], DataFrame],
    log_from: Callable[[int], DataFrame],
    flash_scn: int,
    offset_scn: int | None = None,
    structure: Callable[[int], DataFrame] | None = None,
    **state: bool,
) -> DataFrame | None:
    """The events a run in ``mode`` delivers: table structure as of F (if ``structure`` gives it, see ``structure_rows``),
    snapshot as of F, then the log from F+1, or the log from the stored position. None when the mode has nothing to do."""
    plan = phases(mode, has_offset=offset_scn is not None, **state)
    out = []
    if plan["schema"] and structure is not None:
        out.append(structure(flash_scn))
    if plan["data"]:
        out.append(snapshot(flash_scn))
    if plan["stream"]:
        fresh = plan["data"] or offset_scn is None
        out.append(log_from(flash_scn + 1 if fresh else offset_scn))
    if not out:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def structure_rows(df: DataFrame, name: str, scn: int, ts: Column) -> DataFrame:
    """The structure of one table as one row ``op='schema'`` with its columns in order. Rows of the table are not read."""
    schema_name, table = name.split(".", 1)
    fields = [F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type_name"), F.lit(f.nullable).alias("nullable")) for f in df.schema]
    return df.sparkSession.range(1).select(
        F.lit("schema").alias("op"), F.lit(schema_name).alias("schema_name"), F.lit(table).alias("table_name"),
        F.lit(scn).cast("long").alias("position_scn"), ts.alias("commit_ts"), F.array(*fields).alias("structure"),
    )


def on_demand_snapshot(signals: DataFrame, tables: dict[str, DataFrame], scn: int, ts: Column) -> DataFrame | None:
    """Fresh read events of just the signalled tables; their SCN supersedes older rows."""
    wanted = {n.upper(): n for n in tables}
    asked = signal_read(signals, "blocking").filter(F.col("table").isin(*wanted)).select("table").distinct()
    # at most one row per table given
    names = [wanted[r["table"]] for r in asked.collect()]
    spark = signals.sparkSession
    return snapshot_read(spark, {n: tables[n] for n in sorted(names)}, scn, ts) if names else None
