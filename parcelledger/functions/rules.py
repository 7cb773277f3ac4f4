"""Ordered business rules: the first condition that is true decides."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """One arm of a rule table. A NULL value is final: later arms are not tried."""

    name: str
    applies: Column
    value: Column


def first_match(rules: Iterable[Rule], otherwise: Column | None = None) -> Column:
    """Turn a rule table into one conditional expression."""
    chain: Column | None = None
    for rule in rules:
        chain = (F.when if chain is None else chain.when)(rule.applies, rule.value)
    if chain is None:
        raise ValueError("a rule table needs at least one rule")
    return chain if otherwise is None else chain.otherwise(otherwise)


def rule_name(rules: Iterable[Rule], otherwise: str = "otherwise") -> Column:
    """Name of the arm that decides, for audit columns."""
    named = [Rule(rule.name, rule.applies, F.lit(rule.name)) for rule in rules]
    return first_match(named, F.lit(otherwise))


def bucketise(
    value: Column, bounds: Sequence[tuple[int | None, str]], beyond: str
) -> Column:
    """Label of the first inclusive upper bound that holds ``value``; NULL stays NULL."""
    arms = [Rule(label, value <= F.lit(upper), F.lit(label)) for upper, label in bounds]
    arms.append(Rule(beyond, value.isNotNull(), F.lit(beyond)))
    return first_match(arms)
