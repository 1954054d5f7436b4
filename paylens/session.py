"""Session builder for tests and benches, and the shared folder for files."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def build_session(app: str = "paylens", cores: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and benches; a cluster brings its own."""
    cores = cores or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="paylens-")
    return _local_folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


#: Spark's own switch to drop a query's shuffle files when it has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession):
    """Shuffle files of queries that run inside are dropped when the query ends, not when the driver collects garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder once and read it back.

    For intermediate results that several later passes need: the passes read a file
    instead of repeating the work, and a lost executor costs only the current pass. What
    was shuffled for it is not needed again and goes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with freeing_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    stored.scratch = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that came from ``written`` and that nothing reads any more."""
    for frame in frames:
        if path := getattr(frame, "scratch", None):
            context = frame.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
