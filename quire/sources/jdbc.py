"""Relational sources over JDBC, read in parallel slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = "10000"


def jdbc_options(
    url: str,
    driver: str | None = None,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **extra: str,
) -> dict[str, str]:
    """Reader options for a whole table, or for a query that the source runs.

    A partitioned read needs a column, its bounds and the number of slices; the bounds only set the
    stride, rows outside them are still read. A `query` cannot be sliced by Spark, so a sliced
    projection goes in as a derived table.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"url": url, "fetchsize": FETCH_ROWS, **extra}
    if driver:
        options["driver"] = driver
    sliced = partition_column is not None and partitions > 1
    if query is not None and not sliced:
        options["query"] = query
    else:
        options["dbtable"] = table if table is not None else f"({query}) sliced"
    if sliced:
        if bounds is None:
            raise ValueError("a sliced read needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, predicates: list[str] | None = None, **settings
) -> DataFrame:
    """Read by the options above, or one task per predicate (such as one year or one publisher each)."""
    if predicates is None:
        return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()
    if settings.get("partition_column") is not None:
        raise ValueError("slice by predicates or by a partition column, not by both")
    options = jdbc_options(**settings)
    query = options.pop("query", None)
    url, source = options.pop("url"), options.pop("dbtable", f"({query}) sliced")
    return spark.read.jdbc(url, source, predicates=predicates, properties=options)
