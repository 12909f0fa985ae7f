"""Small helpers shared by the expression modules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def literal(value: object, data_type: T.DataType) -> Column:
    """A value as a literal of a column's type. A local timestamp goes in as text: as a Python datetime it
    would be shifted wherever Python and the session are in different time zones."""
    if isinstance(value, dt.datetime) and isinstance(data_type, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(data_type)
    return F.lit(value).cast(data_type)
