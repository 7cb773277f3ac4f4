"""Each rule arm and boundary on hand-written rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from parcelledger.functions import after_underscore, amount, first_token, ratio, weight
from parcelledger.functions.money import AMOUNT, WEIGHT
from parcelledger.operators import observe_unreadable, unreadable_values
from parcelledger.plans import billing, journey, monitoring, oms, virtual_accounts, wallet
from parcelledger.sources.sample import BILLING, JOURNEY, WALLET, sample_tables

AS_OF = date(2024, 6, 1)


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_chargeable_weight(spark):
    df = one_column(spark, ["0", "1.309", "1.3090001", "1.31", "1.3101", "2.31", "2.31004", "2.310000001", "2.32", None, "x", "9" * 17])
    got = results(df, billing.chargeable_weight(weight("v")))
    assert [None if g is None else int(g) for g in got] == [1, 1, 1, 1, 2, 2, 3, 3, 3, None, None, 10**17 - 1]
    bad = {(r.column, r.value): r.rows for r in unreadable_values(df, {"v": WEIGHT}).collect()}
    assert bad == {("v", "x"): 1}
    seen = Observation()
    assert observe_unreadable(df.union(df), {"v": AMOUNT, "i": AMOUNT}, seen).count() == 24
    assert seen.get == {"v": 4, "i": 0}


def test_ageing_buckets(spark):
    ages = [-1, 0, 1, 7, 8, 30, 31, 60, 61, 90, 91, 120, 121, 150, 151, 180, 181, 210, 211, 240, 241, 270, 271, 300, 301]
    df = one_column(spark, [AS_OF - timedelta(days=a) for a in ages] + [None], "date").withColumn("s", F.lit("0"))
    got = results(df, virtual_accounts.ageing_bucket("s", "v", AS_OF))
    assert got == [
        "00NO_OD", "00NO_OD", "P001_007", "P001_007", "P008_030", "P008_030", "P031_060", "P031_060", "P061_090", "P061_090",
        "P091_120", "P091_120", "P121_150", "P121_150", "P151_180", "P151_180", "P181_210", "P181_210", "P211_240", "P211_240",
        "P241_270", "P241_270", "P270_300", "P270_300", "P300_UP", None,
    ]
    paid = results(df, virtual_accounts.ageing_bucket(F.lit("1"), "v", AS_OF))
    assert set(paid) == {"00NO_OD"}
    assert set(results(df, virtual_accounts.overdue_days(F.lit("1"), "v", AS_OF))) == {0}


def test_branch_codes(spark):
    df = one_column(spark, ["A_B_C", "ABC", "A_", None])
    assert results(df, after_underscore("v")) == ["B_C", None, "", None]
    df = one_column(spark, ["MH1-A-B", "-A", "--", "", "X", None])
    assert results(df, first_token("v")) == ["MH1", "A", None, None, "X", None]


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(0, Decimal(1), Decimal(0)), (1, Decimal(1), Decimal(3))], "i int, a decimal(18,4), b decimal(18,4)")
    assert results(df, ratio("a", "b")) == [None, Decimal("0.333333333")]


MILES = [
    # branch, origin branch, scan, pickup branch, waybill status -> mile
    (("MH_1", None, None, None, None), "Medium Mile"),
    (("TH_1", None, "Pick up scan", "TH_1", None), "First Mile"),
    (("VH_1", None, "Sending scan", "TH_1", None), "Not Defined"),
    (("VH_1", None, "Problem scan", "TH_1", None), "Last Mile"),
    (("TH_1", None, "Problem scan", "TH_1", None), "Not Defined"),
    (("XX_1", "MH_9", "Collection", "TH_1", None), "Last Mile"),
    (("XX_1", "VH_9", "Collection", "TH_1", None), "Not Defined"),
    (("TH_1", None, None, "TH_1", "03"), "Last Mile"),
    (("TH_1", None, None, "TH_1", "05"), "First Mile"),
    (("TH_1", None, "Delivery scan", "TH_1", "01"), "Last Mile"),
    (("TH_1", None, None, None, "03"), "Not Defined"),
    ((None, None, None, None, None), "Not Defined"),
]


def test_mile_of_a_scan(spark):
    schema = """i int, operation_branch_name string, origin_branch_name string, scan_operation_type string,
        pickup_branch_name string, waybill_status string"""
    df = spark.createDataFrame([(i, *given) for i, (given, _) in enumerate(MILES)], schema)
    assert results(df, monitoring.mile()) == [mile for _, mile in MILES]


def test_transaction_types(spark):
    start = date(2024, 8, 1)
    early, late = datetime(2024, 7, 30), datetime(2024, 8, 2)
    cases = [
        # source, priced origin, pod, return pod, shipped, flag, flag start, reported, reported type, miles -> type
        (("756", None, late, None, early, None, None, None, None, "fm"), "DROPSHIP"),
        (("756", None, None, late, early, None, None, None, None, "fm"), "DROPSHIP"),
        (("756", None, None, None, late, None, None, None, None, "fm"), "DROPSHIP"),
        (("756", None, early, None, early, None, None, None, None, "fm"), "FMPU"),
        (("756", "X", late, None, early, 1, date(2024, 7, 31), None, None, "fm"), "DROPSHIP"),
        (("756", "X", late, None, early, 1, date(2024, 7, 1), None, None, "mm,lm"), "MMLM"),
        (("756", "X", late, None, early, 1, None, None, None, "fm"), "DROPSHIP"),
        (("756", "X", late, None, late, 1, None, None, None, "fm,mm,lm"), "E2EPU"),
        (("756", "X", late, None, late, 0, None, "W", "REPORTED", "fm"), "REPORTED"),
        (("756", "X", late, None, late, 0, None, "W", None, "fm"), None),
        (("104", None, late, late, late, 1, None, "W", "REPORTED", "fm"), None),
        (("756", "X", None, None, None, 1, None, None, None, None), None),
    ]
    schema = """i int, waybill_source string, priced_origin string, pod_record_time timestamp_ntz,
        return_pod_record_time timestamp_ntz, shipping_time timestamp_ntz, dropship_flag int, dropship_start date,
        reported_waybill string, reported_type string, role_miles string"""
    df = spark.createDataFrame([(i, *given) for i, (given, _) in enumerate(cases)], schema)
    assert results(df, oms.transaction_type(start)) == [kind for _, kind in cases]


def test_wallet_fee_origin(spark):
    cases = [
        ("03", 5, 7, "change"), ("03", 5, 5, "waybill"), ("03", None, 5, "order"), ("04", 5, 7, "waybill"),
        ("06", 5, 7, "return"), ("01", 5, 7, "order"), (None, 5, 5, "order"),
    ]
    schema = "i int, status_code string, oo_standard_shipping_fee int, ww_standard_shipping_fee int"
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], schema)
    assert results(df, wallet.fee_origin()) == [c[3] for c in cases]


def test_cod_flags_differ_on_a_missing_amount(spark, small):
    df = one_column(spark, [None, 0, 5], "int")
    assert results(df, F.when(F.col("v") == 0, "Non COD").otherwise("COD")) == ["COD", "Non COD", "COD"]
    assert results(df, F.when(F.col("v") > 0, "COD").otherwise("Non COD")) == ["Non COD", "Non COD", "COD"]


def test_every_billing_arm_occurs_in_the_sample(spark):
    tables = sample_tables(spark, "/root/testdata/sf0.01", BILLING)
    priced = billing.priced_waybills(tables, date(2001, 8, 2), days=2500, scheme_start=date(2000, 1, 1))
    seen = {r[0] for r in priced.select(billing.net_arm()).distinct().collect()}
    assert seen == {None, *[r.name for r in billing.net_fee_rules()]}
    arms = {r[0] for r in priced.select("marketplace_arm").distinct().collect()}
    assert arms == {None, *[t.name for t in billing.marketplace_tariffs()]}


# --- invariants -------------------------------------------------------------------------

def test_batch_amounts_are_counted_once(spark, small):
    tables = sample_tables(spark, small, WALLET)
    got = wallet.wallet_transactions(tables, floor=date(1996, 1, 1))
    batches = got.filter("batch_id <> ''")
    per_batch = batches.groupBy("batch_id").agg(
        F.sum("standard_shipping_fee").alias("all"),
        F.max("batch_standard_shipping_fee").alias("first"),
        F.count("filtered_amount").alias("kept"),
        F.sum(F.when(F.col("batch_rank") == 1, 1)).alias("firsts"),
    )
    assert per_batch.filter("all <> first or kept <> firsts").isEmpty()
    assert got.filter("batch_id = '' and batch_rank is not null").isEmpty()
    assert got.filter("batch_id is null").isEmpty()


def test_union_keeps_every_row_of_both_legs(spark, small):
    from parcelledger.sources.sample import MONITORING

    tables = sample_tables(spark, small, MONITORING)
    as_of = date(2001, 8, 2)
    legs = [f(tables, as_of, 3000, "Asia/Jakarta").count() for f in (monitoring._order_led, monitoring._waybill_led)]
    assert monitoring.order_base(tables, as_of, days=3000).count() == sum(legs)


def test_journey_has_one_row_per_tracking_id(spark, small):
    as_of = date(2024, 1, 31)
    rows = journey.order_journey(
        sample_tables(spark, small, JOURNEY), journey.full_window(as_of), as_of, datetime(2024, 1, 31, 7)
    )
    assert rows.groupBy("tracking_id").count().filter("count > 1").isEmpty()
    assert len(rows.columns) == 32


@pytest.mark.parametrize("days", [1, 30])
def test_billing_reads_only_its_days(spark, small, days):
    as_of = date(2001, 8, 2)
    got = billing.daily_billing(sample_tables(spark, small, BILLING), as_of, days=days)
    # A waybill counts by delivery or by returned delivery, but shows its delivery day.
    late = got.filter(F.col("pod_date") >= F.lit(as_of).cast("timestamp_ntz"))
    assert late.filter("pod_category = 'pod return'").isEmpty()
    assert tuple(got.columns) == billing.BILLING_COLUMNS
