"""Net-off fees enriched with geography and finance source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import amount, local_date
from parcelledger.functions.time import JAKARTA
from parcelledger.operators import decode, fallback, latest_by, lookup
from parcelledger.plans import fixed_values as V
from parcelledger.sources.tables import Tables

NET_MEASURES = (
    "standard_shipping_fee",
    "cod_amount",
    "net_shipping_fee",
    "return_shipping_fee",
    "net_cod_fee",
    "handling_fee",
    "other_fee",
)
CARGO_EXPRESS_CODE = "06"


def with_parent_source(
    df: DataFrame, tables: Tables, client: str = "parent_shipping_cleint", single: bool = False
) -> DataFrame:
    """Decode the waybill source and map it, and portal clients, to finance sources."""
    mapping = tables["masterdata_mapping_source_finance_v2"]
    df = decode(df, tables["system_option"], "waybill_source", V.WAYBILL_SOURCE, "source_name", single=single)
    df = lookup(
        df, mapping.filter(F.col("type_option") == V.WAYBILL_SOURCE), {"waybill_source": "source_name"},
        {
            "mapped_source": "waybill_source",
            "source_parent": "parent_source",
            "source_category_name": "finance_source_category",
        },
        single=single,
    )
    return lookup(
        df, mapping.filter(F.col("type_option") == V.VIP_SELLER), {"parent_shipping_cleint": client},
        {"seller_parent": "parent_source", "seller_category_name": "finance_source_category"},
        gate=F.col("source_name") == V.VIP_PORTAL,
        single=single,
    )


def parent_source() -> Column:
    """Cargo for heavy parcels outside e-commerce, else the seller's, else the source's."""
    heavy = (F.col("express_type") == CARGO_EXPRESS_CODE) & (F.col("source_parent") != V.E_COMMERCE)
    return F.when(heavy, "Cargo").otherwise(fallback("seller_parent", "source_parent"))


def current_waybills(tables: Tables, tz: str = JAKARTA) -> DataFrame:
    """Newest snapshot per waybill; chosen first, then enriched one-to-one."""
    columns = [
        "waybill_no", "waybill_source", "vip_customer_name", "parent_shipping_cleint", "express_type",
        "sender_province_name", "sender_city_name", "pickup_branch_name", "shipping_time",
        "pod_record_time", "return_pod_record_time",
    ]
    versions = tables["waybill_waybill"].select("update_time", *columns)
    newest = latest_by(versions, ["waybill_no"], "update_time", ties=columns[1:])
    return with_parent_source(newest, tables, single=True).select(
        "waybill_no",
        F.col("mapped_source").alias("waybill_source"),
        parent_source().alias("parent_source"),
        fallback("seller_category_name", "source_category_name").alias("source_category"),
        F.col("vip_customer_name").alias("vip_username"),
        F.lit("INDONESIA").alias("country"),
        F.col("sender_province_name").alias("origin_province"),
        F.col("sender_city_name").alias("origin_city"),
        F.col("pickup_branch_name").alias("origin_branch"),
        local_date("shipping_time", tz).alias("shipping_time"),
        local_date("pod_record_time", tz).alias("pod_record_time"),
        local_date("return_pod_record_time", tz).alias("return_pod_record_time"),
    )


def net_by_region(tables: Tables, tz: str = JAKARTA, ordered: bool = True) -> DataFrame:
    """Distinct net-off rows with region and source, by delivery or return day.

    ``ordered`` adds the presentation sort; leave it out when the result is stored.
    """
    net = tables["net_off_report_daily"].select(
        "waybill_no", *[amount(m).alias(m) for m in NET_MEASURES]
    )
    described = (
        "waybill_source", "parent_source", "source_category", "vip_username",
        "country", "origin_province", "origin_city", "origin_branch",
    )
    waybills = current_waybills(tables, tz).withColumn(
        "pod_or_return_date", F.coalesce("pod_record_time", "return_pod_record_time")
    )
    # A waybill has one description, so equal rows may be merged after the join, where they
    # are spread by waybill already.
    rows = lookup(
        net, waybills, {"waybill_no": "waybill_no"}, {c: c for c in ("pod_or_return_date", *described)}
    ).select("pod_or_return_date", "waybill_no", *described, *NET_MEASURES).distinct()
    if not ordered:
        return rows
    # The waybill number lets the range sort split a day that holds most of the rows.
    return rows.orderBy(F.col("pod_or_return_date").asc_nulls_first(), "waybill_no")
