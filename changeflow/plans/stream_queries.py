"""Streaming operators run to the end of their source; the result is read back from the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.operators import apply
from changeflow.plans import fixtures as fx
from changeflow.plans.registry import CHG, ORACLES, STATE, query, state_at
from changeflow.plans.state_queries import COLUMNS, PK, RESUME
from changeflow.session import freed_shuffles, held_settings, shared_dir
from changeflow.sources.changelog import changelog_read, changelog_stream, changelog_write
from changeflow.streaming import sinks, stateful
from changeflow.streaming.store import Files


def run(stream: DataFrame, **kw) -> DataFrame:
    spark = stream.sparkSession
    out, state = shared_dir(spark, "out"), shared_dir(spark, "progress")
    sinks.write_changes(stream, out, state, available_now=True, **kw).awaitTermination()
    return sinks.read_changes(spark, out)


def stored_log(spark, d) -> str:
    path = shared_dir(spark, "log")
    changelog_write(fx.full_log(spark, d), path)
    return path


LOG_KINDS = (
    CHG
    + """, tx AS (SELECT DISTINCT tx_no FROM chg)
SELECT 'DML' AS lcr_type, dml, count(*) AS n FROM chg GROUP BY dml
UNION ALL SELECT 'XACT', 'BEGIN', count(*) FROM tx
UNION ALL SELECT 'XACT', 'COMMIT', count(*) FROM tx WHERE tx_no%10<>0
UNION ALL SELECT 'CHUNK', NULL, (SELECT count(*) FROM orders WHERE o_orderkey%100=1)
UNION ALL SELECT 'METADATA', NULL, (SELECT count(*) FROM orders WHERE o_orderkey%100=0)"""
)


@query("changelog_read", LOG_KINDS)
def changelog_read_q(spark, d):
    return changelog_read(spark, stored_log(spark, d)).groupBy("lcr_type", "dml").agg(F.count("*").alias("n"))


@query("changelog_stream", LOG_KINDS)
def changelog_stream_q(spark, d):
    rows = run(changelog_stream(spark, stored_log(spark, d), files_per_trigger=4))
    return rows.groupBy("lcr_type", "dml").agg(F.count("*").alias("n"))


@query("changelog_stream_from", ORACLES["resume_filter"])
def changelog_stream_from(spark, d):
    """A first run that starts at a stored position."""
    rows = run(changelog_stream(spark, stored_log(spark, d), from_pos=RESUME, files_per_trigger=4))
    return rows.groupBy("lcr_type", "dml").agg(F.count("*").alias("n"), F.min("position_scn").alias("lo"))


@query("dedup_stream", CHG + "SELECT dml, count(*) AS n FROM chg WHERE redelivery=0 GROUP BY dml")
def dedup_stream_q(spark, d):
    rows = run(stateful.dedup_stream(fx.order_log_stream(spark, d), "4000 days"))
    return rows.groupBy("dml").agg(F.count("*").alias("n"))


@query("order_guard_stream", CHG + "SELECT dml, count(*) FILTER (WHERE redelivery=0) AS passed, count(*) FILTER (WHERE redelivery=1) AS late FROM chg GROUP BY dml")
def order_guard_q(spark, d):
    stream = fx.order_log_stream(spark, d).withColumn("k", F.coalesce(F.col("before")["k"], F.col("after")["k"]))
    out, state, progress = (shared_dir(spark, n) for n in ("out", "marks", "progress"))
    sinks.order_guard(stream, ["k"], out, state, progress, available_now=True).awaitTermination()
    rows = sinks.read_guarded(spark, out)
    return rows.groupBy("dml").agg(F.count_if(~F.col("late")).alias("passed"), F.count_if("late").alias("late"))


#: rows of a file that a stream reads; a task takes no more
FILE_ROWS = 250_000


def files_of_parts(dealt: DataFrame, n: int, path: str, rows: int = FILE_ROWS) -> int:
    """Write the rows of ``part`` 0 to n-1 one after the other into ``path``, each part as the same number of files of about
    ``rows`` rows: a stream that takes so many files a trigger has a micro-batch per part. Returns the number."""
    spark, staged = dealt.sparkSession, f"{path}-parts"
    here = Files(spark, path)
    with freed_shuffles(spark):
        dealt.write.partitionBy("part").parquet(staged, compression="zstd")
        parts = spark.read.schema(dealt.schema).parquet(staged)
        files = max(1, -(-(parts.groupBy("part").count().agg(F.max("count")).first()[0] or 0) // rows))
        plain = parts.drop("part")
        # the staged files are splits enough to be dealt out as they lie: a shuffle would cost more and part what belongs together
        with held_settings(spark, {"spark.sql.files.minPartitionNum": str(2 * files)}):
            for i in range(n):  # files are taken in the order of their times
                rows_of = parts.filter(F.col("part") == i).drop("part")
                in_files = rows_of.coalesce(files) if files == 1 or rows_of.rdd.getNumPartitions() >= files else rows_of.repartition(files)
                in_files.write.mode("append").parquet(path, compression="zstd")
                here.remove(f"{staged}/part={i}")
                # a part of few rows has files without any
                for _ in range((i + 1) * files - sum(name.endswith(".parquet") for name in here.names(path))):
                    plain.limit(0).coalesce(1).write.mode("append").parquet(path)
    return files


def in_batches(spark, d, n: int = 5) -> DataFrame:
    """The order log as a stream of ``n`` micro-batches along its positions and one more that delivers records again."""
    log, path = fx.order_log(spark, d), shared_dir(spark, "batches")
    part = F.when(F.col("redelivery") == 1, n).otherwise(F.least(F.floor((F.col("position_scn") - 10_000_000) * n / 45_000_000), F.lit(n - 1)))
    files = files_of_parts(log.withColumn("part", part.cast("int")), n + 1, path)
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files).parquet(path)


@query("order_guard_stream_batches", CHG + """
SELECT scn, dml, coalesce(b_k, a_k) AS k, redelivery=1 AS late FROM chg""")
def order_guard_batches(spark, d):
    """Six micro-batches; the last one delivers records of all others again, all of them late."""
    stream = in_batches(spark, d).withColumn("k", F.coalesce(F.col("before")["k"], F.col("after")["k"]).cast("long"))
    out, state, progress = (shared_dir(spark, n) for n in ("out", "marks", "progress"))
    sinks.order_guard(stream, ["k"], out, state, progress, compact_every=2, available_now=True).awaitTermination()
    return sinks.read_guarded(spark, out).select(F.col("position_scn").alias("scn"), "dml", "k", "late")


@query("assemble_lobs_stream", "SELECT doc_id AS event_id, text FROM documents")
def assemble_lobs_stream_q(spark, d):
    docs = fx.stream_table(spark, d, "documents")
    rows = run(stateful.assemble_lobs_stream(fx.cut_into_chunks(docs).withColumn("out_row_cols", F.lit(1))))
    return rows.filter("complete").select("event_id", "text")


@query(
    "assemble_lobs_stream_batches",
    """SELECT doc_id AS event_id, text, true AS complete FROM documents WHERE doc_id%9<>4""",
)
def assemble_lobs_stream_batches(spark, d):
    """Eight micro-batches, chunks of an object spread over them and some delivered twice; every ninth document has a second
    column that begins and does not end, so it stays open though its record expects one column."""
    chunks = fx.cut_into_chunks(fx.table(spark, d, "documents")).withColumn("out_row_cols", F.lit(1))

    def copy(col, is_end, part):
        return F.struct(col.alias("col"), is_end.alias("is_end"), part.cast("int").alias("part"))

    once = copy(F.col("col"), F.col("is_end"), 1 + F.pmod(F.xxhash64("event_id", "seq"), F.lit(7)))
    # the columns that never end come first: an event that has ended takes no more chunks
    begun = copy(F.lit("BEGUN"), F.lit(False), F.lit(0))
    copies = F.array(once, F.when(F.expr("seq % 4 = 1"), once), F.when(F.expr("event_id % 9 = 4 AND seq = 0"), begun))
    dealt = chunks.withColumn("copy", F.explode_outer(F.array_compact(copies))).select(*chunks.drop("col", "is_end").columns, "copy.*")
    path = shared_dir(spark, "chunks")
    files = files_of_parts(dealt, 8, path, rows=100_000)
    stream = spark.readStream.schema(dealt.drop("part").schema).option("maxFilesPerTrigger", files).parquet(path)
    rows = run(stateful.assemble_lobs_stream(stream, "4000 days", 10**12))
    return rows.select("event_id", "text", "complete")


@query("current_state_stream", STATE)
def current_state_stream_q(spark, d):
    path, state = shared_dir(spark, "state"), shared_dir(spark, "progress")
    sinks.current_state_stream(fx.order_log_stream(spark, d), PK, path, state, compact_every=1, available_now=True).awaitTermination()
    return apply.typed(sinks.read_state(spark, path), COLUMNS)


@query("current_state_stream_batches", STATE)
def current_state_batches(spark, d):
    """Six micro-batches, buckets folded in turn."""
    path, state = shared_dir(spark, "state"), shared_dir(spark, "progress")
    sinks.current_state_stream(in_batches(spark, d), PK, path, state, compact_every=3, available_now=True, retain=2).awaitTermination()
    return apply.typed(sinks.read_state(spark, path), COLUMNS)


@query("current_state_stream_version", state_at(36_999_999))
def current_state_version(spark, d):
    """An older version of the table content: three of six micro-batches, the log below SCN 37,000,000."""
    path, state = shared_dir(spark, "state"), shared_dir(spark, "progress")
    sinks.current_state_stream(in_batches(spark, d), PK, path, state, compact_every=2, available_now=True).awaitTermination()
    return apply.typed(sinks.read_state(spark, path, below=3), COLUMNS)


@query("write_changes", CHG + "SELECT scn, count(*) AS n FROM chg GROUP BY scn")
def write_changes_q(spark, d):
    """Runs the same stream into the same place twice; nothing is added the second time."""
    out, state = shared_dir(spark, "out"), shared_dir(spark, "progress")
    for _ in range(2):
        sinks.write_changes(fx.order_log_stream(spark, d), out, state, available_now=True).awaitTermination()
    return sinks.read_changes(spark, out).groupBy(F.col("position_scn").alias("scn")).agg(F.count("*").alias("n"))


@query("progress_rows", CHG + "SELECT count(*) AS rows, min(scn) AS first_scn, max(scn) AS last_scn FROM chg")
def progress_rows_q(spark, d):
    out, state = shared_dir(spark, "out"), shared_dir(spark, "progress")
    sinks.progress_rows(fx.order_log_stream(spark, d), out, state, available_now=True).awaitTermination()
    return sinks.read_changes(spark, out).agg(
        F.sum("rows").alias("rows"), F.min("first_pos.position_scn").alias("first_scn"), F.max("last_pos.position_scn").alias("last_scn")
    )
