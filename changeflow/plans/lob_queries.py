"""Queries of large objects, on chunks cut out of the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.model import UNAVAILABLE_PLACEHOLDER as PH
from changeflow.operators import lob, position as pos
from changeflow.plans import fixtures as fx
from changeflow.plans.registry import query
from changeflow.session import shared_dir
from changeflow.sources.changelog import changelog_read, changelog_write


def _expected(spark, d) -> DataFrame:
    return fx.table(spark, d, "documents").select(F.col("doc_id").alias("event_id"), F.lit(1).alias("out_row_cols"))


def _twice(chunks: DataFrame) -> DataFrame:
    """Every third chunk is delivered twice."""
    return chunks.unionByName(chunks.filter("seq % 3 = 0"))


@query("assemble_lobs", "SELECT doc_id AS event_id, text, CAST(octet_length(encode(text)) AS BIGINT) AS size FROM documents")
def assemble_lobs(spark, d):
    out = lob.assemble_lobs(_twice(fx.lob_chunks(spark, d)), _expected(spark, d))
    return out.values.select("event_id", "text", "size")


@query(
    "assemble_lobs_open",
    """SELECT doc_id AS event_id, 'complete' AS state FROM documents WHERE doc_id%17<>0 AND doc_id%19<>0
 UNION ALL SELECT doc_id, 'open' FROM documents WHERE doc_id%17=0 OR doc_id%19=0""",
)
def assemble_lobs_open(spark, d):
    """The last chunk is missing for doc_id%17=0, all chunks for doc_id%19=0."""
    chunks = fx.lob_chunks(spark, d).filter(~((F.col("event_id") % 17 == 0) & F.col("is_end")) & (F.col("event_id") % 19 != 0))
    out = lob.assemble_lobs(chunks, _expected(spark, d))
    return out.values.select("event_id", F.lit("complete").alias("state")).unionByName(
        out.open_events.select("event_id", F.lit("open").alias("state"))
    )


@query(
    "assemble_lobs_gap",
    """SELECT doc_id AS event_id, 'complete' AS state, text FROM documents WHERE NOT (doc_id%3=0 AND length(text) > 1000)
 UNION ALL SELECT doc_id, 'open', NULL FROM documents WHERE doc_id%3=0 AND length(text) > 1000""",
)
def assemble_lobs_gap(spark, d):
    """The second of three or more chunks is missing for doc_id%3=0: the end mark alone does not complete an event."""
    chunks = fx.lob_chunks(spark, d)
    long = fx.table(spark, d, "documents").filter((F.col("doc_id") % 3 == 0) & (F.length("text") > 1000)).select(F.col("doc_id").alias("event_id"), F.lit(1).alias("seq"))
    out = lob.assemble_lobs(_twice(chunks.join(long, ["event_id", "seq"], "left_anti")), _expected(spark, d))
    return out.values.select("event_id", F.lit("complete").alias("state"), "text").unionByName(
        out.open_events.select("event_id", F.lit("open").alias("state"), F.lit(None).cast("string").alias("text"))
    )


@query(
    "assemble_lobs_segments",
    """SELECT doc_id AS event_id, text, octet_length(encode(text)) > 2000 AS long, CASE WHEN octet_length(encode(text)) > 2000 THEN 'segments:'||CAST(doc_id AS STRING)||':TEXT' END AS ref FROM documents""",
)
def assemble_lobs_segments(spark, d):
    """Objects of more than 2,000 bytes count as too long here; their segments are put together by the reader."""
    out = lob.assemble_lobs(_twice(fx.lob_chunks(spark, d)), _expected(spark, d), value_bytes=2_000, segment_chunks=3)
    whole = out.segments.groupBy("event_id", "col").agg(F.array_sort(F.collect_list(F.struct("segment", "bytes"))).alias("s"))
    hexed = F.array_join(F.transform("s", lambda s: F.hex(s["bytes"])), "")
    whole = whole.select("event_id", "col", F.decode(F.unhex(hexed), "UTF-8").alias("joined"))
    return out.values.join(whole, ["event_id", "col"], "left").select(
        "event_id", F.coalesce("text", "joined").alias("text"), F.col("ref").isNotNull().alias("long"), "ref")


@query(
    "mark_unavailable_long",
    """SELECT doc_id AS event_id, CASE WHEN octet_length(encode(text)) > 2000 THEN 'segments:'||CAST(doc_id AS STRING)||':TEXT' ELSE text END AS text,
 CASE WHEN octet_length(encode(text)) > 2000 THEN 'segments:'||CAST(doc_id AS STRING)||':DATA' ELSE upper(hex(encode(text))) END AS data, lang AS small FROM documents""",
)
def mark_unavailable_long(spark, d):
    """A text and a binary object of many chunks and a small column per event: no placeholder where data exists."""
    chunks = fx.lob_chunks(spark, d).select("event_id", "col", "type_name", "seq", "bytes", "is_end")
    binary = chunks.withColumn("col", F.lit("DATA")).withColumn("type_name", F.lit("BLOB"))
    small = fx.table(spark, d, "documents").select(
        F.col("doc_id").alias("event_id"), F.lit("SMALL").alias("col"), F.lit("CLOB").alias("type_name"), F.lit(0).alias("seq"),
        F.encode("lang", "UTF-8").alias("bytes"), F.lit(True).alias("is_end"))
    out = lob.assemble_lobs(chunks.unionByName(binary).unionByName(small), value_bytes=2_000)
    cols = F.array(F.lit("TEXT"), F.lit("DATA"), F.lit("SMALL"))
    rows = lob.mark_unavailable(_lob_events(spark, d), cols, lob.lob_images(out.values))
    return rows.select("event_id", *[F.col("after")[c].alias(c.lower()) for c in ("TEXT", "DATA", "SMALL")])


@query(
    "assemble_lobs_types",
    """SELECT doc_id AS event_id, 'T' AS kind, text AS shown FROM documents
 UNION ALL SELECT doc_id, 'B', upper(hex(encode(text))) FROM documents
 UNION ALL SELECT doc_id, 'Z', NULL FROM documents""",
)
def assemble_lobs_types(spark, d):
    """Per document a text and a binary object of as many chunks, an empty one, and one of a type that is left out."""
    base = fx.lob_chunks(spark, d).select("event_id", "col", "type_name", "seq", "bytes", "is_end")
    as_type = lambda col, kind: base.withColumn("col", F.lit(col)).withColumn("type_name", F.lit(kind))
    ids = fx.table(spark, d, "documents").select(F.col("doc_id").alias("event_id"))
    empty = ids.select(
        "event_id", F.lit("Z").alias("col"), F.lit("NCLOB").alias("type_name"), F.lit(0).alias("seq"), F.lit(b"").alias("bytes"), F.lit(True).alias("is_end")
    )
    chunks = as_type("T", "CLOB").unionByName(as_type("B", "BLOB")).unionByName(empty).unionByName(as_type("X", "GEOMETRY"))
    out = lob.assemble_lobs(chunks, ids.withColumn("out_row_cols", F.lit(4))).values
    return out.select("event_id", F.col("col").alias("kind"), F.coalesce("text", F.hex("bytes")).alias("shown"))


def _lob_events(spark, d) -> DataFrame:
    """An update per document that does not carry its text in the row."""
    docs = fx.table(spark, d, "documents")
    key = F.col("doc_id").cast("string")
    return docs.select(
        F.col("doc_id").alias("event_id"),
        F.when(F.col("doc_id") % 5 == 0, "c").otherwise("u").alias("op"),
        F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0).alias("sub"),
        F.create_map(F.lit("ID"), key, F.lit("LANG"), F.col("lang")).alias("before"),
        F.create_map(F.lit("ID"), key, F.lit("LANG"), F.lit("xx"), F.lit("TEXT"), F.lit(None).cast("string")).alias("after"),
    )


def _marked(spark, d) -> DataFrame:
    chunks = fx.lob_chunks(spark, d).filter(F.col("event_id") % 19 != 0)
    lobs = lob.lob_images(lob.assemble_lobs(chunks).values)
    cols = F.array(F.lit("TEXT"), F.lit("EXTRA"))
    return lob.mark_unavailable(_lob_events(spark, d), cols, lobs)


@query(
    "mark_unavailable",
    f"""SELECT doc_id AS event_id, CASE WHEN doc_id%19=0 THEN '{PH}' ELSE text END AS text, '{PH}' AS extra, '{PH}' AS old_text, 'xx' AS lang FROM documents""",
)
def mark_unavailable(spark, d):
    return _marked(spark, d).select(
        "event_id", F.col("after")["TEXT"].alias("text"), F.col("after")["EXTRA"].alias("extra"),
        F.col("before")["TEXT"].alias("old_text"), F.col("after")["LANG"].alias("lang"),
    )


for _on in (True, False):

    @query(
        f"reselect_lobs_{'on' if _on else 'off'}",
        f"""SELECT doc_id AS event_id, CASE WHEN doc_id%19=0 AND doc_id%2=0 THEN '{PH}' WHEN doc_id%19=0 AND doc_id%5=0 AND NOT {str(_on).lower()} THEN '{PH}' ELSE text END AS text,
 '{PH}' AS extra FROM documents""",
    )
    def reselect(spark, d, on=_on):
        """The current table lacks the even documents and has no EXTRA column of a type that is looked up."""
        current = fx.table(spark, d, "documents").filter("doc_id % 2 = 1").select(F.col("doc_id").alias("ID"), F.col("text").alias("TEXT"))
        rows = lob.reselect_lobs(_marked(spark, d), current, ["ID"], {"TEXT": "CLOB", "EXTRA": "JSON"}, lob_enabled=on)
        return rows.select("event_id", F.col("after")["TEXT"].alias("text"), F.col("after")["EXTRA"].alias("extra"))


def _lob_log(spark, d) -> DataFrame:
    """Documents as inserts with two large objects, their chunks interleaved; a commit cuts off the last chunk of every seventh long
    text, every fifth document has no chunks, and a third is delivered twice."""
    docs = fx.table(spark, d, "documents")

    def rows(df, kind, offset, **own):
        named = {
            "lcr_type": F.lit(kind), "dml": F.lit(None).cast("string"), "schema_name": F.lit("S1"), "table_name": F.lit("DOCUMENTS"),
            "position_scn": F.col("doc_id") + 1000, "group_lsn": F.col("doc_id") * 2, "group_offset": F.lit(offset).cast("int") if isinstance(offset, int) else offset.cast("int"),
            "batch_row_id": F.lit(0), "instance_id": F.lit(1), "has_chunks": F.lit(False), "out_row_cols": F.lit(0), "after": F.lit(None).cast("map<string,string>"),
            **{c: F.lit(None).cast(t) for c, t in (("chunk_col", "string"), ("chunk_type", "string"), ("chunk_no", "int"), ("chunk_bytes", "binary"), ("chunk_end", "boolean"))}, **own}
        return df.select(*[c.alias(n) for n, c in named.items()])

    with_chunks = F.col("doc_id") % 5 != 0
    records = rows(docs, "DML", 0, dml=F.lit("INSERT"), has_chunks=with_chunks, out_row_cols=F.when(with_chunks, 2).otherwise(0),
                   after=F.create_map(F.lit("DOC_ID"), F.col("doc_id").cast("string"), F.lit("TEXT"), F.lit(None).cast("string")))
    text = fx.cut_into_chunks(docs.filter(with_chunks)).withColumnRenamed("event_id", "doc_id")
    piece = {"chunk_col": F.col("col"), "chunk_type": F.col("type_name"), "chunk_no": F.col("seq"), "chunk_bytes": F.col("bytes"), "chunk_end": F.col("is_end")}
    texts = rows(text, "CHUNK", F.col("seq") * 2 + 10, **piece)
    langs = rows(docs.filter(with_chunks), "CHUNK", 11, chunk_col=F.lit("LANG"), chunk_type=F.lit("CLOB"), chunk_no=F.lit(0),
                 chunk_bytes=F.encode("lang", "UTF-8"), chunk_end=F.lit(True))
    cut = rows(text.filter("doc_id % 7 = 3 AND is_end AND seq > 0"), "XACT", F.col("seq") * 2 + 9, dml=F.lit("COMMIT"))
    log = records.unionByName(texts).unionByName(langs)
    return log.unionByName(log.filter("position_scn % 3 = 0")).unionByName(cut)


_CUT = "doc_id%5<>0 AND doc_id%7=3 AND length(text) > 500"


@query(
    "lobs_from_log",
    f"""SELECT CAST(doc_id AS STRING) AS doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang, 'complete' AS state FROM documents WHERE doc_id%5<>0 AND coalesce(NOT ({_CUT}), true)
 UNION ALL SELECT CAST(doc_id AS STRING), NULL, NULL, 'plain' FROM documents WHERE doc_id%5=0
 UNION ALL SELECT CAST(doc_id+1000 AS STRING)||'-'||CAST(doc_id*2 AS STRING)||'-0-0-1', NULL, NULL, 'open' FROM documents WHERE {_CUT}""",
)
def lobs_from_log(spark, d):
    """Large objects from the CHUNK records of a stored log, and the row changes that have them."""
    path = shared_dir(spark, "lob-log")
    changelog_write(_lob_log(spark, d), path)
    log = changelog_read(spark, path)
    found = lob.lobs_from_log(log)
    done = pos.dedup_replay(lob.complete_records(log, found))
    state = F.when(F.col("has_chunks"), "complete").otherwise("plain")
    after = F.col("after")
    return done.select(after["DOC_ID"].alias("doc_id"), after["TEXT"].alias("text"), after["LANG"].alias("lang"), state.alias("state")).unionByName(
        found.open_events.select(F.col("event_id").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"), F.lit("open").alias("state")))
