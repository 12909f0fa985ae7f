"""The source tables: columns, types, keys and cleaned names."""

from quire.model.fields import Field, SourceTable
from quire.model.tables import TABLES, table

__all__ = ["TABLES", "Field", "SourceTable", "table"]
