"""Column expressions: time zones, exact money, text codes and ordered rules."""

from parcelledger.functions.money import amount, as_float, factor, fee, rate, ratio, unreadable, weight
from parcelledger.functions.rules import Rule, bucketise, first_match
from parcelledger.functions.text import after_underscore, first_token, has_prefix
from parcelledger.functions.time import (
    day_age,
    day_start,
    local_date,
    local_datetime,
    months_before,
    utc_bound,
)

__all__ = [
    "Rule",
    "after_underscore",
    "amount",
    "as_float",
    "bucketise",
    "day_age",
    "day_start",
    "factor",
    "fee",
    "first_match",
    "first_token",
    "has_prefix",
    "local_date",
    "local_datetime",
    "months_before",
    "rate",
    "ratio",
    "unreadable",
    "utc_bound",
    "weight",
]
