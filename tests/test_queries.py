"""Every registered query gives exactly the rows, names and types of its SQL statement."""

from __future__ import annotations

import pytest
from compare import difference

from __spark_entry__ import entry, oracle_sql, queries
from parcelledger.registry import oracles, runners

NAMES = sorted(runners())


def test_every_query_has_a_statement():
    assert set(oracles()) == set(NAMES)
    assert set(NAMES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(name, spark, sql, small):
    assert difference(queries()[name], oracle_sql()[name], spark, sql, small) is None


def test_the_comparison_sees_a_changed_value(spark, sql, small):
    changed = oracle_sql()["oms_aggregate"].replace("COUNT(waybill_no)", "COUNT(waybill_no) + 1")
    assert difference(queries()["oms_aggregate"], changed, spark, sql, small) is not None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
