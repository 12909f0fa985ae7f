"""Source database types to Spark types, and casts that give NULL for bad input."""

from __future__ import annotations

from pyspark.sql import Column

from quire.functions.columns import ColumnOrName, as_column

# Source type to Spark SQL type. Types not named here become STRING.
TYPE_NAMES = {
    "CHAR": "STRING",
    "VARCHAR": "STRING",
    "CLOB": "STRING",
    "GRAPHIC": "STRING",
    "VARGRAPHIC": "STRING",
    "SMALLINT": "SMALLINT",
    "INTEGER": "INT",
    "BIGINT": "BIGINT",
    "REAL": "FLOAT",
    "DOUBLE": "DOUBLE",
    "DATE": "DATE",
    "TIME": "STRING",
    "TIMESTAMP": "TIMESTAMP",
    "BLOB": "BINARY",
}
SIZED_TYPES = ("DECIMAL", "NUMERIC")


def spark_type_name(source_type: str, length: int = 0, scale: int = 0) -> str:
    name = source_type.strip().upper()
    if name in SIZED_TYPES:
        return f"DECIMAL({length},{scale})"
    return TYPE_NAMES.get(name, "STRING")


def typed(value: ColumnOrName, type_name: str) -> Column:
    """Cast that turns unreadable input into NULL instead of failing the job."""
    return as_column(value).try_cast(type_name)
