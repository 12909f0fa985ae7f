"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join partitions, coalesces small ones and re-plans joins from real sizes.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str | None = None, app: str = "quire", **extra: str) -> SparkSession:
    """A session with the scale settings; `master` only for local runs, a cluster names its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared `spark.checkpoint.dir`; a local run without one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="quire-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that start in here remove their shuffle files when they end; else these stay until the driver collects its garbage."""
    before = spark.conf.get(SHUFFLES_REMOVED, None)
    spark.conf.set(SHUFFLES_REMOVED, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_REMOVED) if before is None else spark.conf.set(SHUFFLES_REMOVED, before)


def stored_once(df: DataFrame, label: str) -> DataFrame:
    """A frame that several later steps ask for: written to the scratch folder and read back."""
    folder = scratch_folder(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that no later step reads; what is not under the scratch folder is left alone."""
    for frame in frames:
        spark = frame.sparkSession
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.checkpoint.dir"))
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        top = fs.makeQualified(root).toUri().getPath().rstrip("/") + "/"
        for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            if path.toUri().getPath().startswith(top):
                fs.delete(path, True)
