"""Pipe-delimited text with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    encoding: str = "UTF-8",
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read with a declared schema; without one every column is text, as nothing is inferred.

    A line that does not fit stops the load, or is kept in `_corrupt_record` when asked for.
    """
    reader = (
        spark.read.option("sep", "|")
        .option("header", True)
        .option("encoding", encoding)
        .option("enforceSchema", False)
    )
    if schema is None:
        return reader.csv(path)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        return reader.option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", CORRUPT
        ).option("enforceSchema", True).schema(schema).csv(path)
    return reader.option("mode", "FAILFAST").schema(schema).csv(path)


def write_delimited(df: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "overwrite") -> None:
    """Write the same format. Padding is kept; an empty text cannot be told from NULL and reads as NULL."""
    (
        df.write.mode(mode)
        .option("sep", "|")
        .option("header", True)
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
