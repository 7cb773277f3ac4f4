from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from parcelledger.functions import as_float
from parcelledger.session import tune
from parcelledger.sources.sample import raw, view_sql

Runner = Callable[[SparkSession, str], DataFrame]

# Reporting dates of the sample: the facts end in 2001, the events in January 2024.
FACTS_AS_OF = date(2001, 8, 2)
EVENTS_AS_OF = date(2024, 1, 31)
LOADED_AT = datetime(2024, 1, 31, 7, 0, 0)

_RUNNERS: dict[str, Runner] = {}
_ORACLES: dict[str, str] = {}


class Sample:
    """Sample tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return raw(self.spark, self.folder, name)


def query(sql: str | None) -> Callable[[Callable[[Sample], DataFrame]], Callable[[Sample], DataFrame]]:
    """Register a query under its function name; decimals leave as doubles."""

    def register(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
        @functools.wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Sample(tune(spark), folder)))

        _RUNNERS[build.__name__] = run
        if sql is not None:
            _ORACLES[build.__name__] = sql
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, the only inexact type both engines print alike."""
    decimals = [n for n, t in df.dtypes if t.startswith("decimal")]
    return df.withColumns({n: as_float(n) for n in decimals}) if decimals else df


def with_views(views: list[str], body: str) -> str:
    """SQL with derived inputs in front; ``body`` starts with SELECT or with ``, cte AS``."""
    parts = ",\n".join(f"{name} AS ({view_sql(name)})" for name in views)
    return f"WITH {parts}\n{body}"


def _load() -> None:
    from parcelledger.registry import blocks, reports, rules, sinks  # noqa: F401


def runners() -> dict[str, Runner]:
    _load()
    return dict(_RUNNERS)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
