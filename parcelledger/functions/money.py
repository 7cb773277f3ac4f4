"""Exact decimals for money, weights and rates.

Weights keep nine decimals, as rules compare them with bounds; they are cut down only where a rule has decided. All
other types fit 18 digits, which Spark keeps in a long: sums stay exact, independent
of task order, and inside the hash aggregate. Every product is cast back at once,
because a third decimal factor would silently lose scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelledger.functions.columns import ColumnLike, as_column

AMOUNT = "decimal(18,4)"
FEE = "decimal(18,6)"
RATE = "decimal(18,9)"
WEIGHT = "decimal(38,9)"


def amount(value: ColumnLike) -> Column:
    """Money as stored; NULL where a text column holds no number."""
    return as_column(value).try_cast(AMOUNT)


def weight(value: ColumnLike) -> Column:
    """Weight from its text form, to the last of nine decimals; NULL where it holds no number."""
    return as_column(value).try_cast(WEIGHT)


def factor(value: ColumnLike) -> Column:
    """A weight as a factor of a price: the product of two such numbers is exact. NULL from a billion on."""
    return as_column(value).try_cast(RATE)


def unreadable(value: ColumnLike, kind: str = WEIGHT) -> Column:
    """True where there is a value, but none that ``kind`` can hold: what ``weight`` and ``amount`` make NULL."""
    return as_column(value).isNotNull() & as_column(value).try_cast(kind).isNull()


def rate(value: ColumnLike) -> Column:
    return as_column(value).try_cast(RATE)


def fee(value: Column) -> Column:
    """Round a computed fee to the working scale."""
    return value.cast(FEE)


def ratio(part: ColumnLike, whole: ColumnLike) -> Column:
    """``part / whole`` as a rate; NULL, not an error, when ``whole`` is zero."""
    share = F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))
    return share.cast(RATE)


def as_float(value: ColumnLike) -> Column:
    """Report form of an exact amount."""
    return as_column(value).cast("double")
