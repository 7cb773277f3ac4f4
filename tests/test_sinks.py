from __future__ import annotations

from datetime import date

import pytest
from compare import difference

from parcelledger.registry import oracles, runners
from parcelledger.sources import append_load_named, refresh_named, scratch_dir


def test_history_is_loaded_by_month(spark, small, sql):
    """Once registered and right, the query stays beside sink_append_billing."""
    run, statement = runners()["sink_append_days"], oracles()["sink_append_days"]
    assert "sink_append_billing" in runners()
    assert difference(run, statement, spark, sql, small) is None


def test_named_tables_are_appended_to_and_refreshed(spark):
    path = scratch_dir(spark, "named-test")
    name = path.rpartition("/")[2].replace("-", "_")
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    frame = lambda *data: spark.createDataFrame(data, "id int, day date")
    for day, rows in ((days[0], [(1, days[0])]), (days[1], [(2, days[0])]), (days[0], [(3, days[1])])):
        append_load_named(frame(*rows), name, day, ["id"], path)
    assert {tuple(r) for r in spark.table(name).collect()} == {(3, days[1], days[0]), (2, days[0], days[1])}
    with pytest.raises(ValueError, match="other columns"):
        append_load_named(frame((1, days[0])).withColumnRenamed("day", "other"), name, days[0], ["id"])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    refresh_named(frame((9, days[0])), f"{name}_new", "day", ["id"], f"{path}-new")
    refresh_named(frame((8, days[1])), f"{name}_new", "day", ["id"], f"{path}-new")
    assert [tuple(r) for r in spark.table(f"{name}_new").collect()] == [(8, days[1])]
