"""Virtual accounts: ageing of unpaid bills and the waybill amounts behind each."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import Rule, amount, bucketise, day_age, first_match
from parcelledger.functions.columns import ColumnLike, as_column
from parcelledger.functions.time import JAKARTA
from parcelledger.operators import concat_notes, fallback, latest_by, lookup, since
from parcelledger.plans import fixed_values as V
from parcelledger.sources.tables import Tables

BILL_KEYS = (
    "id",
    "No_VA",
    "Nama_Bank",
    "Nama_Mitra",
    "Nama_TH",
    "wilayah",
    "dm",
    "Kode_TH",
    "Tanggal_Tagihan_VA",
    "Tanggal_Pembayaran",
    "Status_Transaksi",
    "Total_Nominal",
    "Nominal_Koreksi",
    "note",
    "branch_id",
    "Tanggal_Hitung",
    "overdue",
    "bucket_collection",
)


def corrections(tables: Tables) -> DataFrame:
    """Correction amounts and notes per day and branch."""
    rows = tables["branch_virtual_account_correction"].select(
        "correction_date", "branch_id", "note", amount("correction_amount").alias("correction_amount")
    )
    return concat_notes(rows, ["correction_date", "branch_id"], "note", ["correction_amount"])


def latest_bank(tables: Tables) -> DataFrame:
    """Newest bank of every account number."""
    log = tables["virtual_account_log"].select("account_number", "bank_code", "status_message", "created_at")
    return latest_by(log, ["account_number"], "created_at", ties=["bank_code", "status_message"])


def overdue_days(payment_status: ColumnLike, billed_on: ColumnLike, as_of: date) -> Column:
    """Age of a bill in days; a paid bill has none."""
    return F.when(as_column(payment_status) == V.VA_PAID, 0).otherwise(day_age(billed_on, as_of))


def ageing_bucket(payment_status: ColumnLike, billed_on: ColumnLike, as_of: date) -> Column:
    bucket = bucketise(day_age(billed_on, as_of), V.AGEING_BUCKETS, V.AGEING_BEYOND)
    return F.when(as_column(payment_status) == V.VA_PAID, V.AGEING_PAID).otherwise(bucket)


def _unless_empty(value: str, substitute: str) -> Column:
    """The substitute for an empty text; a missing one stays missing."""
    return F.when(F.col(value) == "", F.col(substitute)).otherwise(F.col(value))


def va_detail(tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 62) -> DataFrame:
    """Bills paid within the window or not paid at all, with names and ageing."""
    # Payment dates are civil dates: the window starts at midnight without a zone shift.
    paid_lately = since("payment_date", as_of - timedelta(days=days), "UTC")
    bills = tables["branch_virtual_account"].filter(paid_lately | F.col("payment_status").isin(*V.VA_OPEN))
    bills = bills.select(
        "id", "account_number", "branch_id", "branch_name", "agent_branch_name", "create_va_date",
        "payment_date", "calculate_date", "payment_status",
        amount("cod_amount").alias("va_cod"), amount("cash_settlement_amount").alias("va_cash"),
    )
    branches, areas = tables["res_branch"], tables["masterdata_finance_dm_wilayah"]
    df = lookup(bills, latest_bank(tables), {"account_number": "account_number"}, {"bank_code": "bank_code"})
    df = lookup(df, tables["vendor_bank"], {"bank_code": "bank_code"}, {"bank_name": "bank_name"})
    df = lookup(
        df, branches, {"id": "branch_id"},
        {"own_branch": "branch_name", "branch_no": "branch_no", "agent_id": "agent_branch_id"},
    )
    df = lookup(df, branches, {"id": "agent_id"}, {"agent_branch": "branch_name"})
    df = lookup(df, areas, {"branch_name": "branch_name"}, {"bill_wilayah": "wilayah", "bill_dm": "dm"})
    df = lookup(df, areas, {"branch_name": "own_branch"}, {"branch_wilayah": "wilayah", "branch_dm": "dm"})
    df = lookup(
        df, corrections(tables).withColumn("corrected_branch", F.col("branch_id")),
        {"branch_id": "branch_id", "correction_date": "calculate_date"},
        {"correction_amount": "correction_amount", "note": "note", "corrected_branch": "corrected_branch"},
    )
    status = first_match(
        [Rule(name, F.col("payment_status") == code, F.lit(name)) for code, name in V.VA_STATUS.items()],
        F.col("payment_status"),
    )
    nothing = F.lit(0).cast("decimal(18,4)")
    return df.select(
        "id",
        F.col("account_number").alias("No_VA"),
        F.col("bank_name").alias("Nama_Bank"),
        _unless_empty("agent_branch_name", "agent_branch").alias("Nama_Mitra"),
        _unless_empty("branch_name", "own_branch").alias("Nama_TH"),
        fallback("bill_wilayah", "branch_wilayah").alias("wilayah"),
        fallback("bill_dm", "branch_dm").alias("dm"),
        F.col("branch_no").alias("Kode_TH"),
        F.col("create_va_date").alias("Tanggal_Tagihan_VA"),
        F.col("payment_date").alias("Tanggal_Pembayaran"),
        status.alias("Status_Transaksi"),
        F.coalesce("va_cod", nothing).alias("va_cod_amount"),
        F.coalesce("va_cash", nothing).alias("va_cash_settlement_amount"),
        F.col("calculate_date").alias("Tanggal_Hitung"),
        overdue_days("payment_status", "create_va_date", as_of).alias("overdue"),
        ageing_bucket("payment_status", "create_va_date", as_of).alias("bucket_collection"),
        "correction_amount",
        "note",
        F.col("corrected_branch").alias("branch_id"),
    )


def waybill_amounts(tables: Tables) -> DataFrame:
    """Greatest COD and cash amount per bill and waybill, both legs combined map-side."""
    zero = F.lit(0).cast("decimal(18,4)")
    cod = tables["branch_virtual_account_detail"].filter(F.col("cod_amount") > 0).select(
        "branch_virtual_account_id", "waybill_no", amount("cod_amount").alias("cod"), zero.alias("cash")
    )
    settled = (F.col("total_shipping_fee") > 0) | (F.col("insurance_amount") > 0)
    cash = tables["cash_settlement_detail"].filter(settled).select(
        "branch_virtual_account_id",
        "waybill_no",
        zero.alias("cod"),
        (amount("total_shipping_fee") - amount("other_fee")).cast("decimal(18,4)").alias("cash"),
    )
    return cod.unionByName(cash).groupBy("branch_virtual_account_id", "waybill_no").agg(
        F.max("cod").alias("COD_Amount"), F.max("cash").alias("Cash_Amount")
    )


def va_monitoring(tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 62) -> DataFrame:
    """Bills and their waybills, one row each.

    The amounts are reduced to one row per bill and waybill before they meet the wide bill
    rows. Equal bill rows share an id: the bills are spread by it once, for merging them and
    for the join.
    """
    bills = va_detail(tables, as_of, tz, days).filter(F.col("Tanggal_Tagihan_VA").isNotNull())
    nominal = F.col("va_cod_amount") + F.col("va_cash_settlement_amount") + F.coalesce(
        "correction_amount", F.lit(0)
    )
    bills = bills.withColumns(
        {
            "Total_Nominal": nominal,
            "Nominal_Koreksi": F.col("correction_amount"),
            "Tanggal_Pembayaran": F.col("Tanggal_Pembayaran").cast("timestamp_ntz"),
        }
    ).select(*BILL_KEYS)
    rows = lookup(
        bills.repartition("id").distinct(), waybill_amounts(tables), {"branch_virtual_account_id": "id"},
        {c: c for c in ("waybill_no", "COD_Amount", "Cash_Amount")},
        how="inner",
    )
    return rows.withColumn("Total_Waybill_Amount", F.col("COD_Amount") + F.col("Cash_Amount"))
