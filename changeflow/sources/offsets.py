"""Resume records as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.functions.scn import instance_number

# every value is read as text first, since numbers were written as text, int or long over time
_FIELDS = (
    "scn", "commit_scn", "position_scn", "group_lsn", "group_offset", "batch_row_id", "instance_id", "lcr_position",
    "snapshot_scn", "stream_start_scn", "snapshot", "snapshot_completed", "snapshot_pending_tx",
)
_JSON = "struct<" + ",".join(f"{f}:string" for f in _FIELDS) + ">"


def read_offsets(df: DataFrame, column: str = "offset") -> DataFrame:
    """Decode the JSON of ``column``. Without a position SCN there is no position (``pos`` is null)."""
    o = df.withColumn("__o", F.from_json(column, _JSON))
    number = lambda f, t: F.col(f"__o.{f}").try_cast(t)
    scn = number("position_scn", "long")
    pos = F.struct(
        scn.alias("position_scn"),
        number("group_lsn", "long").alias("group_lsn"),
        number("group_offset", "int").alias("group_offset"),
        number("batch_row_id", "int").alias("batch_row_id"),
        instance_number(F.col("__o.instance_id")).alias("instance_id"),
    )
    return o.select(
        *[c for c in df.columns if c != column],
        F.when(scn.isNotNull(), pos).alias("pos"),
        number("scn", "decimal(38,0)").alias("scn"),
        F.col("__o.commit_scn").alias("commit_scn"),
        F.col("__o.lcr_position").alias("lcr_position"),
        number("snapshot_scn", "decimal(38,0)").alias("snapshot_scn"),
        number("stream_start_scn", "decimal(38,0)").alias("stream_start_scn"),
        F.coalesce(F.col("__o.snapshot").try_cast("boolean"), F.lit(False)).alias("snapshot"),
        F.coalesce(F.col("__o.snapshot_completed").try_cast("boolean"), F.lit(False)).alias("snapshot_completed"),
        F.col("__o.snapshot_pending_tx").alias("snapshot_pending_tx"),
    )


def write_offsets(df: DataFrame, column: str = "offset") -> DataFrame:
    """Encode positions: during a snapshot with its flags, later the position alone, else the SCN."""
    has = set(df.columns)
    get = lambda c: F.col(c) if c in has else F.lit(None)
    pos = [
        F.col("pos.position_scn").alias("position_scn"),
        F.col("pos.group_lsn").alias("group_lsn"),
        F.col("pos.group_offset").alias("group_offset"),
        F.col("pos.batch_row_id").alias("batch_row_id"),
        F.col("pos.instance_id").cast("string").alias("instance_id"),
    ]
    in_snapshot = F.coalesce(get("snapshot").cast("boolean"), F.lit(False))
    scn = F.when(in_snapshot | F.col("pos").isNull(), get("scn").cast("string"))
    record = F.struct(
        scn.alias("scn"),
        F.when(F.col("pos").isNull(), get("commit_scn").cast("string")).alias("commit_scn"),
        *pos,
        get("snapshot_scn").cast("string").alias("snapshot_scn"),
        get("stream_start_scn").cast("string").alias("stream_start_scn"),
        F.when(in_snapshot, True).alias("snapshot"),
        F.when(in_snapshot, get("snapshot_completed").cast("boolean")).alias("snapshot_completed"),
        F.nullif(get("snapshot_pending_tx").cast("string"), F.lit("")).alias("snapshot_pending_tx"),
    )
    keep = [c for c in df.columns if c not in ("pos", "scn", "commit_scn", "snapshot_scn", "stream_start_scn", "snapshot", "snapshot_completed", "snapshot_pending_tx", "lcr_position")]
    # fields without a value are left out
    return df.select(*keep, F.to_json(record).alias(column))
