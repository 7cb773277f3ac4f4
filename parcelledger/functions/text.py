from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelledger.functions.columns import ColumnLike, as_column


def has_prefix(value: ColumnLike, prefixes: Iterable[str], length: int = 2) -> Column:
    """True when the first ``length`` characters are one of ``prefixes``."""
    return F.substring(as_column(value), 1, length).isin(*prefixes)


def after_underscore(value: ColumnLike) -> Column:
    """Text behind the first underscore; NULL when there is none."""
    text = as_column(value)
    return F.when(F.contains(text, F.lit("_")), F.regexp_extract(text, "_(.*)", 1))


def first_token(value: ColumnLike) -> Column:
    """Leading run without a hyphen; NULL when nothing but hyphens is there."""
    return F.regexp_substr(as_column(value), F.lit("[^-]+"))
