"""The plans Spark chooses are the ones that hold at scale."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from parcelledger.functions import local_datetime
from parcelledger.operators import latest_by, lookup, on_days, ranked_with_totals, recent, tier_lookup
from parcelledger.plans import billing, oms, region
from parcelledger.sources import scratch_dir
from parcelledger.sources.sample import BILLING, FINANCE, sample_tables, view
from parcelledger.sources.tables import Tables

AS_OF = date(2001, 8, 2)
MEDIUM = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_scans_reach_the_files(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    pushed = plan(recent(orders, "o_orderdate", 62, AS_OF).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate,2001-05-31T17:00" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in pushed
    day = plan(on_days(orders, "o_orderdate", AS_OF))
    assert "GreaterThanOrEqual(o_orderdate" in day and "LessThan(o_orderdate" in day


def test_window_scans_reach_instant_columns_too(spark, small):
    path = scratch_dir(spark, "instants")
    orders = spark.read.parquet(f"{small}/orders.parquet")
    orders.withColumn("at", F.col("o_orderdate").cast("timestamp")).write.parquet(path)
    stored = spark.read.parquet(path)
    assert "GreaterThanOrEqual(at,2001-05-31" in plan(recent(stored, "at", 62, AS_OF))
    assert recent(stored, "at", 62, AS_OF).count() == recent(stored, "o_orderdate", 62, AS_OF).count()


def test_one_row_per_key_is_cut_before_the_shuffle(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    text = plan(latest_by(events, ["user_id"], "ts", ties=["event_id"]))
    lines = [line.strip(" :+-*()0123456789") for line in text.splitlines()]
    order = [line.split(" ")[0] for line in lines if line.startswith(("WindowGroupLimit", "Exchange"))]
    assert order == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_batch_rows_are_spread_once_and_by_slice(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    totals = {"total": F.col("o_totalprice"), "size": F.lit(1)}
    ranked = ranked_with_totals(orders, "o_custkey", "o_orderkey", totals, "place")
    ranked.collect()
    final = plan(ranked).split("\n+- == Initial Plan ==")[0]
    # The rows are spread by group and slice once; sums of slices alone are spread by group.
    spreads = [line for line in final.splitlines() if "REPARTITION_BY_COL" in line]
    assert len([x for x in spreads if "ReusedExchange" in x]) == 1 and len(spreads) == 2, final


def test_range_join_is_an_equi_join(spark, small):
    parcels = spark.read.parquet(f"{small}/lineitem.parquet").withColumn("w", F.col("l_quantity").cast("decimal(18,4)"))
    tiers = view(spark, small, "express_tiers")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(tier_lookup(parcels, tiers, "w", {"times": "Multiplier"}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))
    assert "SortMergeJoin" in text and "NestedLoop" not in text


def _at_scale(spark, build):
    """The plan when facts are too large to broadcast and rate cards are not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        return plan(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))


def test_billing_shuffles_its_rows_once(spark, small):
    tables = sample_tables(spark, MEDIUM, BILLING)
    text = _at_scale(spark, lambda: billing.daily_billing(tables, AS_OF, days=2500))
    # Orders, returns, partner orders, net-off, wallet and stored fees.
    assert text.count("SortMergeJoin") == 6
    spreads = [line.split("hashpartitioning(")[1] for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    # The rows themselves are spread once; six lookups, the distinct and the fallback reuse it.
    assert len([s for s in spreads if s.startswith("waybill_no#") and len(s.split("#")) == 2]) <= 2, spreads
    assert not [s for s in spreads if "pod_date" in s or "net_shipping_fee" in s], spreads


def test_extract_joins_facts_by_waybill_only(spark, small):
    tables = sample_tables(spark, MEDIUM, FINANCE)
    text = _at_scale(spark, lambda: oms.finance_extract(tables, AS_OF, days=3000))
    spreads = [line.split("hashpartitioning(")[1] for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert text.count("SortMergeJoin") >= 4
    assert len([s for s in spreads if s.startswith("waybill_no#") and len(s.split("#")) == 2]) <= 2, spreads


def test_extract_spreads_its_wide_rows_once(spark, small):
    """All went by customer first, and then by waybill; now only rows without a waybill number go by customer."""
    lines = _at_scale(spark, lambda: oms.finance_extract(sample_tables(spark, MEDIUM, FINANCE), AS_OF, days=3000)).splitlines()
    spreads = [(a.split("hashpartitioning(")[1], b) for a, b in zip(lines, lines[1:], strict=False) if "Exchange hashpartitioning(" in a]
    wide = [key.split("#")[0] for key, below in spreads if "receivable_shipping_fee" in below or "Union" in below]
    assert sorted(wide) == ["vip_customer_id", "waybill_no"], spreads
    # The rows that go by waybill are a union of those with and without a number.
    assert [key for key, below in spreads if "Union" in below and key.startswith("waybill_no#")], spreads


def test_extract_spreads_codes_not_names(spark, small):
    """The names of six codes went with each of the wide rows."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        text = _at_scale(spark, lambda: oms.finance_extract(sample_tables(spark, MEDIUM, FINANCE), AS_OF, days=3000))
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    depth = [len(a) - len(a.lstrip(" :+-")) for a in text.splitlines()]
    lines = text.splitlines()
    (spread,) = [i for i, a in enumerate(lines) if "hashpartitioning(waybill_no#" in a and "Union" in lines[i + 1]]
    below = lines[spread + 1 : next((i for i in range(spread + 1, len(lines)) if depth[i] <= depth[spread]), len(lines))]
    assert any("pod_flag" in a for a in below) and not any("option_name" in a or "pod_name" in a for a in below)


def test_extract_in_passes_is_the_extract(spark, small, monkeypatch):
    """All rows were spread at once; in passes by waybill number they are the same, also those without a number."""
    tables = sample_tables(spark, small, FINANCE)
    parcels = tables["dm_waybill_waybill"]
    key = F.when(F.col("waybill_no") != F.lit("W1"), F.col("waybill_no"))
    tables = tables.with_tables(dm_waybill_waybill=parcels.union(parcels.limit(5)).withColumn("waybill_no", key))
    want = Counter(oms.finance_extract(tables, AS_OF, days=3000).collect())
    parts, real = [], oms.finance_extract
    monkeypatch.setattr(oms, "finance_extract", lambda *x, **y: (parts.append(1), real(*x, **y))[1])
    got = oms.finance_extract_in_passes(tables, AS_OF, days=3000, rows=max(1, sum(want.values()) // 3))
    assert len(parts) >= 3
    assert got.dtypes == real(tables, AS_OF, days=3000).dtypes and Counter(got.collect()) == want


def test_billing_code_is_small_enough_to_be_compiled(spark, small):
    """The JVM compiles no method above 8,000 bytes; the rules stood in one of 20,544."""
    tables = sample_tables(spark, MEDIUM, BILLING)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        done = billing.daily_billing(tables, AS_OF, days=2500)._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(done)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert max(sizes) < 8000, sizes


def test_customer_accounts_meet_narrow_rows(spark):
    customers = [(1, None, "A", "a"), (2, 1, None, "b"), (2, 1, None, "b"), (3, 9, None, None)]
    schema = "id long, vip_parent_id long, sap_bp_code string, sap_bp_name string"
    tables = Tables({"res_vip_customer": spark.createDataFrame(customers, schema)})
    numbers = [("W1", 1), ("W1", 1), ("W1", 2), ("W2", None), (None, 2), (None, 7), (None, None), ("W3", 3), ("W4", 8)]
    rows = spark.createDataFrame([(i, *n) for i, n in enumerate(numbers)], "row int, waybill_no string, vip_customer_id long")
    accounts = oms._customer_accounts(tables)
    want = lookup(rows, accounts, {"id": "vip_customer_id"}, {"bp_code": "bp_code", "bp_name": "bp_name"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = oms._pair_accounts(oms._own_accounts(rows, accounts), rows, accounts)
        assert Counter(found.collect()) == Counter(want.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))


def test_local_times_parse_no_zone_names(spark):
    rows = spark.sql("SELECT i, timestamp_ntz'2024-03-10 04:00:00' + i * INTERVAL '31' MINUTE AS at FROM (SELECT explode(sequence(-9000, 9000, 7)) AS i)")
    for tz in ("Asia/Jakarta", "America/New_York"):
        both = rows.select(local_datetime("at", tz).alias("a"), F.convert_timezone(F.lit("UTC"), F.lit(tz), "at").alias("b"))
        assert both.filter("a IS DISTINCT FROM b").count() == 0
        assert dict(both.dtypes)["a"] == "timestamp_ntz"
    assert "convert_timezone" not in plan(rows.select(local_datetime("at")))


def _spreads(text: str) -> list[str]:
    return [line.split("hashpartitioning(")[1] for line in text.splitlines() if "Exchange hashpartitioning(" in line]


def test_net_off_rows_are_spread_by_waybill_alone(spark, small):
    tables = sample_tables(spark, MEDIUM, FINANCE)
    spreads = _spreads(_at_scale(spark, lambda: region.net_by_region(tables)))
    # The versions of waybills, two dimensions, their sellers, and the net-off rows once.
    assert len(spreads) == 5 and not [s for s in spreads if "net_shipping_fee" in s], spreads


def test_bills_are_spread_by_id_alone(spark, small):
    spreads = _spreads(_at_scale(spark, lambda: queries()["va_monitoring"](spark, small)))
    assert len([s for s in spreads if s.startswith("id#")]) == 1, spreads
    assert not [s for s in spreads if "Nama_TH" in s or "Total_Nominal" in s], spreads


def test_wallet_reads_each_fact_once(spark, small):
    text = plan(queries()["wallet_transactions"](spark, small))
    # Payments and their owners and states for both kinds; each kind's waybills; orders, waybills and returns once.
    assert text.count("FileScan") <= 9, text


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cartesian_or_python(name, spark, small):
    if name.startswith("sink_"):
        pytest.skip("runs jobs while it is built")
    text = plan(queries()[name](spark, small))
    for word in ("Cartesian", "NestedLoop", "Python", "Pandas"):
        assert word not in text
