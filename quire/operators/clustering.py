"""Multi-column clustering of a table, and in how many files a filter finds its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.columns import literal
from quire.session import stored_once

MOST_BITS = 6  # per column
CELL_BITS = 12  # of all columns together; cells are cut further by value
SAMPLE_ROWS = 20_000

# Clustering columns per gold table; dimensions are small and stay as they are.
CLUSTER_COLUMNS = {
    "fact_ventes": ("date_vente", "isbn"),
    "fact_stocks": ("date_position", "code_entrepot"),
    "fact_commandes": ("date_commande", "isbn"),
    "fact_commandes_editeurs": ("date_commande", "code_editeur"),
    "fact_droits": ("code_auteur", "num_contrat"),
    "fact_droits_periodes": ("periode", "code_auteur"),
}


def _interleaved(bucket: int, place: int, columns: int, bits: int) -> int:
    """The bits of a bucket number moved to its column's places in the cell number, highest bits first."""
    return sum(
        (bucket >> bit & 1) << (bit * columns + columns - 1 - place) for bit in range(bits)
    )


def _cell_part(column: Column, bounds: list[Column], parts: list[int]) -> Column:
    """A column's share of the cell number, found by halving its bounds; NULL goes with the lowest."""
    if not bounds:
        return F.lit(parts[0])
    middle = len(bounds) // 2
    above = _cell_part(column, bounds[middle + 1 :], parts[middle + 1 :])
    below = _cell_part(column, bounds[:middle], parts)
    return F.when(column > bounds[middle], above).otherwise(below)


def _bounds(values: list, ranges: int) -> list:
    """Values that cut a sample into ranges of about equal size, in Spark's order: texts by their bytes."""
    known = sorted(
        (v for v in values if v is not None and v == v), key=lambda v: v.encode() if isinstance(v, str) else v
    )
    return list(dict.fromkeys(known[len(known) * i // ranges] for i in range(1, ranges))) if known else []


def cluster_by(df: DataFrame, columns: tuple[str, ...], partitions: int | None = None, stored: bool = False) -> DataFrame:
    """Rows partitioned and sorted along a space-filling order of several columns.

    A sample of fixed size cuts each column, whatever its type, into ranges by its own values; the ranges
    are the cells of the order. Rows are dealt out by range of cell and values, so a cell of any size is
    cut by value over as many partitions as its rows need, and one value by the row's place in the input.
    `stored` says that df is read straight from files; else its rows are written first.
    """
    # The sample, the range shuffle's own sample and the shuffle each read the rows.
    df = df if stored else stored_once(df, "clustering")
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, min(MOST_BITS, CELL_BITS // len(columns)))
    chosen = df.select(*columns).withColumn("_row", F.monotonically_increasing_id())
    sample = chosen.orderBy(F.xxhash64("_row")).limit(SAMPLE_ROWS).select(*columns).collect()
    z = F.lit(0).cast("bigint")
    for i, c in enumerate(columns):
        parts = [_interleaved(b, i, len(columns), bits) for b in range(1 << bits)]
        bounds = [literal(v, df.schema[c].dataType) for v in _bounds([row[i] for row in sample], 1 << bits)]
        z = z + _cell_part(F.col(c), bounds, parts)
    celled = df.withColumns({"_z": z, "_row": F.monotonically_increasing_id()})
    placed = celled.repartitionByRange(partitions, "_z", *columns, "_row")
    return placed.sortWithinPartitions("_z", *columns).drop("_z", "_row")


def files_holding(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """What a range filter finds in a stored table: files that hold matching rows, and these rows.

    `df` is read straight from files; `bounds` maps columns to inclusive (low, high) of the filter, which is really run.
    """
    inside = F.lit(True)
    for c, edges in bounds.items():
        low, high = (literal(edge, df.schema[c].dataType) for edge in edges)
        inside = inside & F.col(c).between(low, high)
    by_file = df.where(inside).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("row_count"))
    return by_file.agg(F.count("*").alias("files"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
