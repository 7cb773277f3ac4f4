"""Logical table names mapped to DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession


class Tables(Mapping[str, DataFrame]):
    """Input tables of a report by logical name. A table is opened when first asked for."""

    def __init__(self, openers: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._openers = dict(openers)

    @classmethod
    def from_files(cls, spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> Tables:
        """Each logical name is read from a path."""
        return cls({n: (lambda p=p: spark.read.format(fmt).load(p)) for n, p in paths.items()})

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Tables:
        """Each logical name is a catalog table or view."""
        return cls({n: (lambda t=t: spark.table(t)) for n, t in names.items()})

    def __getitem__(self, name: str) -> DataFrame:
        found = self._openers[name]
        if not isinstance(found, DataFrame):
            found = self._openers[name] = found()
        return found

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    def with_tables(self, **more: DataFrame) -> Tables:
        """A copy in which some names are added or replaced."""
        return Tables({**self._openers, **more})
