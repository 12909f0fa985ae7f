"""Readers and writers."""

from quire.sources.delimited import read_delimited, write_delimited
from quire.sources.incremental import high_water_mark, rows_since, slice_counts, slice_predicates
from quire.sources.jdbc import jdbc_options, read_jdbc
from quire.sources.parquet import read_parquet, read_typed
from quire.sources.sinks import overwrite, overwrite_clustered, overwrite_partitioned, write_json
from quire.sources.xml import read_products

__all__ = [
    "high_water_mark", "jdbc_options", "overwrite", "overwrite_clustered",
    "overwrite_partitioned", "read_delimited", "read_jdbc", "read_parquet", "read_products",
    "read_typed", "rows_since", "slice_counts", "slice_predicates", "write_delimited",
    "write_json",
]
