"""Disbursement by payment type: settled history and recent cash and wallet payments."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import amount, day_start, local_date
from parcelledger.functions.time import JAKARTA
from parcelledger.operators import recent, since
from parcelledger.plans.region import parent_source, with_parent_source
from parcelledger.sources.tables import Tables

KEYS = (
    "pod_record_time",
    "return_pod_record_time",
    "calculated_date",
    "waybill_source",
    "parent_source",
    "vip_customer_name",
    "payment_type",
)


def periodic(tables: Tables) -> DataFrame:
    """Stored disbursements summed over the details the report leaves out."""
    return tables["dashboard_finance_disbursement"].groupBy(*KEYS).agg(
        F.sum("count_transaction").cast("long").alias("count_transaction"),
        F.sum(amount("net_shipping_fee")).alias("net_shipping_fee"),
    )


def cash_and_wallet(tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 62) -> DataFrame:
    """Recent deliveries and returns paid in cash or from a wallet."""
    first = as_of - timedelta(days=days)
    cash, invoiced = F.col("payment_type") == "00", F.col("invoice_amount") > 0
    rows = recent(tables["dm_waybill_waybill"], "update_time", days, as_of, tz).filter(
        (since("pod_record_time", first, tz) | since("return_pod_record_time", first, tz))
        & (cash | invoiced)
    )
    mapped = with_parent_source(rows, tables)
    keyed = mapped.select(
        local_date("pod_record_time", tz).alias("pod_record_time"),
        local_date("return_pod_record_time", tz).alias("return_pod_record_time"),
        day_start(local_date(F.coalesce("pod_record_time", "return_pod_record_time"), tz)).alias("calculated_date"),
        F.col("source_name").alias("waybill_source"),
        parent_source().alias("parent_source"),
        "vip_customer_name",
        F.when(cash, "Cash").when(invoiced, "Wallet").alias("payment_type"),
        "waybill_no",
        amount("total_shipping_fee").alias("fee"),
    )
    return keyed.groupBy(*KEYS).agg(
        F.count("waybill_no").alias("count_transaction"), F.sum("fee").alias("net_shipping_fee")
    )


def disbursement_by_payment(tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 62) -> DataFrame:
    """History and recent payments one below the other."""
    return periodic(tables).unionByName(cash_and_wallet(tables, as_of, tz, days))
