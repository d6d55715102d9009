"""Column layout of a change log and the constants shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

IMAGE = T.MapType(T.StringType(), T.StringType(), True)

#: One row per log record. In ``after`` a missing key means "column not touched",
#: a key with a null value means "column set to NULL".
LCR_SCHEMA = T.StructType(
    [
        T.StructField("lcr_type", T.StringType()),  # DML, DDL, XACT, CHUNK, METADATA
        T.StructField("dml", T.StringType()),  # INSERT, UPDATE, DELETE; BEGIN / COMMIT for XACT
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("tx_id", T.StringType()),
        T.StructField("redo_thread", T.IntegerType()),
        T.StructField("position_scn", T.LongType()),
        T.StructField("group_lsn", T.LongType()),
        T.StructField("group_offset", T.IntegerType()),
        T.StructField("batch_row_id", T.IntegerType()),
        T.StructField("instance_id", T.IntegerType()),
        T.StructField("commit_ts", T.TimestampType()),
        T.StructField("before", IMAGE),
        T.StructField("after", IMAGE),
        T.StructField("has_chunks", T.BooleanType()),
        T.StructField("out_row_cols", T.IntegerType()),
        T.StructField("ddl_text", T.StringType()),
        # of CHUNK records: a piece of a large object of the record that it follows, and its place among the column's pieces
        T.StructField("chunk_col", T.StringType()),
        T.StructField("chunk_type", T.StringType()),
        T.StructField("chunk_no", T.IntegerType()),
        T.StructField("chunk_bytes", T.BinaryType()),
        T.StructField("chunk_end", T.BooleanType()),
    ]
)

CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("col", T.StringType()),
        T.StructField("type_name", T.StringType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("bytes", T.BinaryType()),
        T.StructField("is_end", T.BooleanType()),
    ]
)

# Fixed values.
SYSTEM_SCHEMAS = ("SYS", "MDSYS", "XA_SYS")
LOB_TYPES = ("CLOB", "NCLOB", "BLOB", "JSON", "XMLTYPE")
TEXT_LOB_TYPES = ("CLOB", "NCLOB", "JSON")
BINARY_LOB_TYPES = ("RAW", "BLOB")
REPLAY_EXEMPT_TYPES = ("METADATA", "CHUNK")
UNAVAILABLE_PLACEHOLDER = "__value_unavailable"
EMPTY_CLOB = "EMPTY_CLOB()"
EMPTY_BLOB = "EMPTY_BLOB()"

POSITION_FIELDS = ("position_scn", "group_lsn", "group_offset", "batch_row_id", "instance_id")


def position() -> Column:
    """Comparable log position. Spark compares structs field by field, nulls first.

    The field order lives only here: commit SCN, log sequence, offset, row, instance.
    """
    return F.struct(*POSITION_FIELDS)


def table_name() -> Column:
    return F.concat_ws(".", "schema_name", "table_name")
