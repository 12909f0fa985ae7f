"""Parquet files and partitioned folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.model.fields import SourceTable


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Read a file or a partitioned folder; `merge_schema` for files written before a column was added."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_typed(spark: SparkSession, path: str, table: SourceTable) -> DataFrame:
    """Read with the declared schema of a source table."""
    return spark.read.schema(table.schema).parquet(path)
