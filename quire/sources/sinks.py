"""Writers. A table is a Parquet folder; each is written to a path that is not being read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.clustering import cluster_by


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a table together with its schema."""
    df.write.mode("overwrite").parquet(path)


def overwrite_sorted(df: DataFrame, path: str, key: str) -> None:
    """Full load ordered by key: ranges over files, sorted inside each, never one global file."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def overwrite_partitioned(df: DataFrame, path: str, by: str, partitions: int | None = None) -> None:
    """One folder per value of `by`.

    Ranges over the value and a row hash have even sizes: a heavy year is cut over as many tasks as its
    rows need, and a task writes to one or two folders.
    """
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
    spreadable = df.withColumn("_spread", spread)
    order = [F.col(by), F.col("_spread")]
    ranged = (
        spreadable.repartitionByRange(partitions, *order)
        if partitions
        else spreadable.repartitionByRange(*order)
    )
    ranged.drop("_spread").write.mode("overwrite").partitionBy(by).parquet(path)


def overwrite_clustered(
    df: DataFrame, path: str, columns: tuple[str, ...], partitions: int | None = None, stored: bool = False
) -> None:
    """Replace a table, laid out for skipping files on several columns."""
    cluster_by(df, columns, partitions, stored).write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """A report as JSON lines."""
    df.write.mode("overwrite").json(path)
