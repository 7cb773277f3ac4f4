"""Wallet sums that are kept up to date load by load, and the billing that reads them."""

from __future__ import annotations

from datetime import date
from decimal import Decimal


from parcelledger.plans import billing, wallet_totals
from parcelledger.sources import scratch_dir
from parcelledger.sources.sample import BILLING, sample_tables
from parcelledger.sources.versions import latest_version, manifest

FIELDS = "waybill_no string, total_shipping_fee decimal(18,4), discount_amount decimal(18,4), net_shipping_fee decimal(18,4)"


def test_loads_are_summed_once_and_runs_are_merged_by_level(spark):
    path = scratch_dir(spark, "totals-test")
    expected: dict = {}
    for load in range(7):
        rows = [(f"w{n % 4}" if n else None, Decimal(load), Decimal(1), Decimal(n)) for n in range(6)]
        for key, total, discount, net in rows:
            old = expected.get(key, (0, 0, 0))
            expected[key] = (old[0] + total, old[1] + discount, old[2] + net)
        frame = spark.createDataFrame(rows, FIELDS)
        assert wallet_totals.add_load(spark, path, frame, f"load {load}", fan_in=2)
        if load == 3:
            version = latest_version(spark, path)
            assert not wallet_totals.add_load(spark, path, frame, "load 1", fan_in=2)
            assert latest_version(spark, path) == version
    # Seven loads by twos: one run of four, one of two, one of one.
    levels = sorted(r["value"].split("/")[0] for r in manifest(spark, path).collect())
    assert levels == ["00", "01", "02"]
    sums = billing.wallet_per_waybill(wallet_totals.totals(spark, path)).collect()
    assert {r["waybill_no"]: (r["total_shipping_fee"], r["discount_amount"], r["net_shipping_fee"]) for r in sums} == expected


def test_a_day_of_billing_does_not_read_the_history(spark, small):
    tables = sample_tables(spark, small, BILLING)
    path = scratch_dir(spark, "totals-plan")
    wallet_totals.add_load(spark, path, tables["agg_wallet_summary"], "all")

    def untouched(*_):
        raise AssertionError("the wallet history was opened")

    maintained = tables.with_tables(wallet_totals=wallet_totals.totals(spark, path), agg_wallet_summary=untouched)
    day = billing.daily_billing(maintained, date(2001, 8, 2))
    text = day._jdf.queryExecution().optimizedPlan().toString()
    # Sums are cut to the day's waybills before they are added up.
    assert "LeftSemi" in text
    assert day.count() == billing.daily_billing(tables, date(2001, 8, 2)).count()
    assert day.exceptAll(billing.daily_billing(tables, date(2001, 8, 2))).count() == 0


def test_the_name_of_a_run_is_found_without_a_sum(spark):
    """The name was read off the sums, so each load and merge was spread and summed once more than needed."""
    rows = spark.createDataFrame([("w1", Decimal(1), Decimal(1), Decimal(1))], FIELDS)
    name = wallet_totals._name(rows, "00/a")
    assert [r.value for r in name.collect()] == ["00/a"]
    plan = name._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "hashpartitioning" not in plan
    path = scratch_dir(spark, "totals-empty")
    assert wallet_totals.add_load(spark, path, rows.limit(0), "none") and wallet_totals.totals(spark, path).isEmpty()
    assert wallet_totals.add_load(spark, path, rows, "one") and wallet_totals.totals(spark, path).count() == 1
