"""Accrual report: daily picked-up and delivered volume, weight and revenue by source."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import amount, day_start, fee, local_date, weight
from parcelledger.functions.time import JAKARTA
from parcelledger.operators import decode, recent, sum_when
from parcelledger.plans import fixed_values as V
from parcelledger.plans.billing import with_finance_source
from parcelledger.sources.tables import Tables

LEG_KEYS = (
    "date_key",
    "flag",
    "parent_source",
    "waybill_finance_source_category",
    "waybill_source",
    "parent_shipping_client",
    "pod_category",
)
LEG_MEASURES = (
    "volume",
    "weight",
    "gross_shipping_fee",
    "net_shipping_fee",
    "cod_fee",
    "return_shipping_fee",
)
REPORT_KEYS = tuple(k for k in LEG_KEYS if k != "flag")


def _cargo(express_name: str) -> Column:
    return F.when(F.col(express_name) == V.CARGO_EXPRESS, "Cargo").otherwise("Non Cargo")


def _category() -> Column:
    """Seller category first; two partner categories go by their short names."""
    short = F.col("category_by_source")
    for long_name, name in V.CATEGORY_SHORT_NAMES.items():
        short = F.when(F.col("category_by_source") == long_name, name).otherwise(short)
    return F.coalesce(F.col("category_by_seller"), short)


def _leg(df: DataFrame, **measures: Column) -> DataFrame:
    """Aggregate one leg to its seven keys; measures it has not are zero."""
    zero = F.lit(0).cast("decimal(28,6)")
    found = {name: value.cast("decimal(28,6)") for name, value in measures.items() if name != "volume"}
    summed = df.groupBy(*LEG_KEYS).agg(
        measures["volume"].cast("long").alias("volume"),
        *[value.alias(name) for name, value in found.items()],
    )
    return summed.select(
        *LEG_KEYS, *[F.col(m) if m in measures else zero.alias(m) for m in LEG_MEASURES]
    )


def pickup_leg(tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 93) -> DataFrame:
    """Waybills shipped in the window, by shipping day."""
    rows = recent(tables["fact_waybill_base"], "shipping_time", days, as_of, tz).filter(
        ~F.col("pickup_branch_name").isin(*V.EXCLUDED_BRANCHES)
        & (F.col("void_flag") == "0")
        & (F.col("deleted") == "0")
    )
    codes = tables["dim_system_codes"]
    rows = decode(rows, codes, "express_type", V.EXPRESS_TYPE, "express_name")
    rows = decode(rows, codes, "waybill_source", V.WAYBILL_SOURCE, "source_name")
    rows = with_finance_source(
        rows,
        tables["dim_source_finance_mapping"],
        "source_name",
        "parent_client_identifier",
        F.col("waybill_source") == V.SOURCE_KEY_ACCOUNT,
        {"category": "finance_source_category"},
    )
    keyed = rows.select(
        local_date("shipping_time", tz).alias("date_key"),
        F.lit("pickup").alias("flag"),
        _cargo("express_name").alias("parent_source"),
        _category().alias("waybill_finance_source_category"),
        F.col("source_name").alias("waybill_source"),
        F.col("parent_client_identifier").alias("parent_shipping_client"),
        F.lit(V.POD_DELIVERY).alias("pod_category"),
        "waybill_no",
        weight("item_calculated_weight").alias("kilos"),
    )
    return _leg(keyed, volume=F.count("waybill_no"), weight=F.sum("kilos"))


def delivered_leg(tables: Tables, as_of: date, days: int = 120) -> DataFrame:
    """Billed waybills of the window, by delivery day."""
    # pod_date is already a civil datetime, so its bound is local midnight as written.
    first = day_start(F.lit(as_of - timedelta(days=days)))
    rows = tables["fact_pod_details"].filter(F.col("pod_date") >= first)
    rows = with_finance_source(
        rows,
        tables["dim_source_finance_mapping"],
        "waybill_source_name",
        "parent_shipping_client",
        F.col("waybill_source_name") == V.KEY_ACCOUNT_PORTAL,
        {"category": "finance_source_category"},
    )
    keyed = rows.select(
        F.col("pod_date").cast("date").alias("date_key"),
        F.lit("delivered").alias("flag"),
        _cargo("express_type_name").alias("parent_source"),
        _category().alias("waybill_finance_source_category"),
        F.col("waybill_source_name").alias("waybill_source"),
        "parent_shipping_client",
        "pod_category",
        "waybill_no",
        amount("cargo_weight").alias("kilos"),
        fee(F.col("total_shipping_fee")).alias("gross"),
        fee(F.col("net_shipping_fee")).alias("net"),
        fee(F.col("cod_fee")).alias("cod"),
        fee(F.col("return_shipping_fee")).alias("returned"),
    )
    return _leg(
        keyed,
        volume=F.count("waybill_no"),
        weight=F.sum("kilos"),
        gross_shipping_fee=F.sum("gross"),
        net_shipping_fee=F.sum("net"),
        cod_fee=sum_when(F.col("cod") > 0, "cod"),
        return_shipping_fee=sum_when(F.col("returned") > 0, "returned"),
    )


def crossdock_legs(tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 120) -> DataFrame:
    """Cross-docked bookings: inbound scans as pickups, invoiced print groups as deliveries."""

    def keys(day: Column, flag: str) -> list[Column]:
        return [
            day.alias("date_key"),
            F.lit(flag).alias("flag"),
            F.lit("Non Cargo").alias("parent_source"),
            F.lit("Cross Docking").alias("waybill_finance_source_category"),
            F.lit("").alias("waybill_source"),
            F.lit("").alias("parent_shipping_client"),
            F.lit(V.POD_DELIVERY).alias("pod_category"),
        ]

    inbound = recent(tables["fact_crossdock_orders"], "inbound_time", days, as_of, tz).filter(
        F.col("inbound_hub_name") != V.TEST_HUB
    )
    inbound = inbound.select(*keys(local_date("inbound_time", tz), "pickup"), "booking_code")
    invoiced = recent(tables["agg_crossdock_summary"], "print_group_time", days, as_of, "UTC")
    invoiced = invoiced.select(
        *keys(F.col("print_group_time").cast("date"), "delivered"),
        "booking_code",
        amount("invoice").alias("invoice"),
    )
    return _leg(inbound, volume=F.count("booking_code")).unionByName(
        _leg(invoiced, volume=F.count("booking_code"), net_shipping_fee=F.sum("invoice"))
    )


def accrual_legs(
    tables: Tables, as_of: date, tz: str = JAKARTA, pickup_days: int = 93, days: int = 120
) -> DataFrame:
    """All legs within the report window; each is filtered at its scan."""
    return (
        pickup_leg(tables, as_of, tz, min(pickup_days, days))
        .unionByName(delivered_leg(tables, as_of, days))
        .unionByName(crossdock_legs(tables, as_of, tz, days))
    )


def accrual_report(
    tables: Tables, as_of: date, tz: str = JAKARTA, pickup_days: int = 93, days: int = 120
) -> DataFrame:
    """Legs side by side: volumes, cargo weights, gross and rounded net revenue."""
    legs = accrual_legs(tables, as_of, tz, pickup_days, days)
    picked, done = F.col("flag") == "pickup", F.col("flag") == "delivered"
    cargo = F.col("parent_source") == "Cargo"
    extras = F.coalesce("cod_fee", F.lit(0)) + F.coalesce("return_shipping_fee", F.lit(0))
    labelled = legs.withColumn(
        "waybill_finance_source_category",
        F.coalesce("waybill_finance_source_category", F.lit("Not Defined")),
    )
    return labelled.groupBy(*REPORT_KEYS).agg(
        sum_when(picked, "volume").alias("pickup_volume"),
        sum_when(picked & cargo, "weight").alias("pickup_weight"),
        sum_when(done, "volume").alias("delivered_volume"),
        sum_when(done & cargo, "weight").alias("delivered_weight"),
        sum_when(done, F.col("gross_shipping_fee") + extras).alias("gross_revenue"),
        F.round(sum_when(done, F.col("net_shipping_fee") + extras), 0).alias("indicative_net_revenue"),
    )
