"""Session set-up and the few driver-side checks the operators rely on."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 100_000


def build_session(app: str = "changeflow", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="changeflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def held_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def freed_shuffles(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """The shuffle files of what runs in here, and of each batch of a stream that is started in here, go when it has run. Else
    they stay until the driver happens to collect its garbage. What is read more than once must not be the shuffle itself."""
    return held_settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write into the shared folder and read back, so that later jobs neither recompute nor depend on executors. The input
    is computed once."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Broadcast hint only after counting at most ``limit + 1`` rows.

    Beyond the limit the plain frame is returned, so the join shuffles and adaptive
    execution splits skewed partitions.
    """
    small = df.limit(limit + 1).count() <= limit
    return (F.broadcast(df), True) if small else (df, False)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
