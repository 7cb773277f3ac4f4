from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    """A name becomes a column reference; a Column is passed through."""
    return F.col(value) if isinstance(value, str) else value
