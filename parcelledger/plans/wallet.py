"""Wallet transactions: the fees behind each payment and the discount it implies."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import Rule, amount, first_match, local_datetime
from parcelledger.functions.time import JAKARTA
from parcelledger.operators import decode, lookup, ranked_with_totals, since
from parcelledger.plans import fixed_values as V
from parcelledger.sources.tables import Tables

# Working name -> column in orders and waybills, column in returns.
MEASURES = {
    "standard_shipping_fee": ("standard_shipping_fee", "return_standard_shipping_fee"),
    "insurance_amount": ("insurance_amount", "insurance_amount"),
    "other_fee": ("other_fee", "other_fee"),
    "handling_fee": ("handling_fee", "return_handling_fee"),
    "total_shipping_fee": ("total_shipping_fee", "return_shipping_fee"),
}
TRANSACTION_COLUMNS = (
    "shipping_client",
    "tx_no",
    "tx_status",
    "tx_time",
    "pickup_time",
    "pod_record_time",
    "return_pod_record_time",
    "amount",
    "filtered_amount",
    "batch_id",
    "batch_rank",
    "waybill_no",
    "standard_shipping_fee",
    "insurance_amount",
    "other_fee",
    "handling_fee",
    "total_shipping_fee",
    "express_type",
    "request_status",
    "batch_standard_shipping_fee",
    "batch_total_shipping_fee",
    "discount_rate",
)


#: What the fees depend on; a payment of any other status, or of none, is charged like OTHER_STATUS.
FEE_STATUSES, OTHER_STATUS = ("03", "04", "06"), ""


def fee_origin(status: Column | None = None) -> Column:
    """Which document the fees of a transaction come from.

    A correction (status 03) counts the change against the order if there is one, else
    the waybill; status 04 counts the waybill, 06 the return, all others the order.
    """
    change = F.col("ww_standard_shipping_fee") - F.col("oo_standard_shipping_fee")
    status = F.col("status_code") if status is None else status
    correction = status == "03"
    return first_match(
        [
            Rule("change", correction & (change != 0), F.lit("change")),
            Rule("unchanged", correction & (change == 0), F.lit("waybill")),
            Rule("waybill", status == "04", F.lit("waybill")),
            Rule("return", status == "06", F.lit("return")),
        ],
        F.lit("order"),
    )


def _measure(name: str, origin: Column | None = None) -> Column:
    order, waybill, returned = (F.col(f"{side}_{name}") for side in ("oo", "ww", "rr"))
    origin = F.col("fee_origin") if origin is None else origin
    return first_match(
        [
            Rule("change", origin == "change", amount(waybill - order)),
            Rule("waybill", origin == "waybill", waybill),
            Rule("return", origin == "return", returned),
        ],
        order,
    )


def _share(part: Column, whole: Column) -> Column:
    """Quotient as a double; NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _payments(tables: Tables) -> DataFrame:
    """Wallet payments with their client and status name."""
    history = tables["wallet_history"].filter(F.col("tx_no").isNotNull()).select(
        F.col("id").alias("history_id"),
        "wallet_id",
        "tx_no",
        F.col("tx_status").alias("status_code"),
        "request_status",
        "batch_id",
        F.col("create_time").alias("tx_time"),
        (-amount("amount")).alias("amount"),
    )
    owned = lookup(
        history, tables["wallet"], {"id": "wallet_id"}, {"shipping_client": "shipping_client"}, how="inner"
    )
    return lookup(owned, tables["wallet_status"], {"code": "status_code"}, {"tx_status": "process_name"})


def _with_documents(paid: DataFrame, tables: Tables, floor: date, tz: str) -> DataFrame:
    """The order of the paid waybill, its waybill and return."""
    orders = tables["order_order"].filter(since("input_time", floor, tz))
    waybills = tables["waybill_waybill"].filter(since("shipping_time", floor, tz))
    common = {name: columns[0] for name, columns in MEASURES.items()}
    df = lookup(
        paid, orders, {"waybill_no": "paid_waybill"},
        {
            "oo_waybill_no": "waybill_no",
            "oo_pickup_time": "pickup_record_time",
            "oo_express_type": "express_type",
            **{f"oo_{name}": amount(column) for name, column in common.items()},
        },
        how="inner",
    )
    df = lookup(
        df, waybills, {"waybill_no": "paid_waybill"},
        {
            "ww_waybill_no": "waybill_no",
            "ww_return_waybill_no": "return_waybill_no",
            "ww_pod_time": "pod_record_time",
            "ww_return_pod_time": "return_pod_record_time",
            **{f"ww_{name}": amount(column) for name, column in common.items()},
        },
    )
    df = lookup(
        df, tables["waybill_return_bill"],
        {"waybill_no": "paid_waybill", "return_waybill_no": "ww_return_waybill_no"},
        {f"rr_{name}": amount(columns[1]) for name, columns in MEASURES.items()},
    )
    return decode(df, tables["system_option"], "oo_express_type", V.EXPRESS_TYPE, "express_type")


def _charged(df: DataFrame, tz: str, *also: str) -> DataFrame:
    """Payments beside the documents of their waybill, with the fees of the document that counts."""
    paid = df.withColumn("fee_origin", fee_origin()).select(
        "shipping_client",
        "tx_no",
        "tx_status",
        F.col("tx_time").cast("timestamp_ntz").alias("tx_time"),
        local_datetime("oo_pickup_time", tz).alias("pickup_time"),
        local_datetime("ww_pod_time", tz).alias("pod_record_time"),
        local_datetime("ww_return_pod_time", tz).alias("return_pod_record_time"),
        "amount",
        "batch_id",
        F.when(F.col("fee_origin") == "change", F.col("ww_waybill_no"))
        .otherwise(F.col("oo_waybill_no")).alias("waybill_no"),
        *[_measure(name).alias(name) for name in MEASURES],
        "express_type",
        "request_status",
        *also,
    )
    own_rate = _share(
        F.abs("total_shipping_fee") - F.abs("amount"), F.abs("standard_shipping_fee")
    )
    return paid.withColumn("discount_rate", own_rate)


def paid_singly(tables: Tables) -> DataFrame:
    """Payments outside a batch, one row per waybill of the payment."""
    return lookup(
        _payments(tables).filter(F.col("batch_id") == ""), tables["wallet_history_detail"],
        {"wallet_history_id": "history_id"}, {"paid_waybill": "waybill_no"}, how="inner",
    )


def batch_waybills(tables: Tables) -> DataFrame:
    """The waybills of each batch, once, however many payments the batch has."""
    return tables["vip_order"].filter(F.col("batch_id") != "").select("batch_id", F.col("waybill_no").alias("paid_waybill"))


def _batch_pairs(tables: Tables) -> DataFrame:
    """Batches and their waybills, from one narrow scan: what ranked rows are cut by."""
    return batch_waybills(tables).select(F.col("batch_id").alias("g"), F.col("paid_waybill").alias("o"))


#: Totals of a batch: name, fee that is summed, whether by its absolute value.
BATCH_TOTALS = (
    ("sum_standard", "standard_shipping_fee", False),
    ("sum_total", "total_shipping_fee", False),
    ("sum_abs_standard", "standard_shipping_fee", True),
    ("sum_abs_total", "total_shipping_fee", True),
)


def _fee_of_status(fee: str, status: str, absolute: bool) -> Column:
    value = _measure(fee, fee_origin(F.lit(status)))
    return F.abs(value) if absolute else value


def _payment_counts(payments: DataFrame) -> DataFrame:
    """How many payments of each status a batch has."""
    kind = F.when(F.col("status_code").isin(*FEE_STATUSES), F.col("status_code")).otherwise(OTHER_STATUS)
    return payments.groupBy("batch_id").agg(
        *[F.count(F.when(kind == status, 1)).alias(f"n_{status}") for status in (*FEE_STATUSES, OTHER_STATUS)]
    )


def _over_payments(total: str) -> Column:
    """Total over all rows of a batch, one for each payment and waybill, from the totals of its waybills by status."""
    shares = [
        F.when(F.col(f"n_{status}") > 0, F.col(f"{total}_{status}") * F.col(f"n_{status}").cast("decimal(18,0)"))
        for status in (*FEE_STATUSES, OTHER_STATUS)
    ]
    zero = F.lit(0).cast("decimal(38,4)")
    whole = sum((F.coalesce(share, zero) for share in shares[1:]), F.coalesce(shares[0], zero))
    return F.when(F.coalesce(*shares).isNotNull(), whole.cast("decimal(28,4)"))


def _paid_in_batches(tables: Tables, floor: date, tz: str) -> DataFrame:
    """Payments of a batch, one row per waybill of the batch, with the rank of the waybill and the totals of all these rows.

    Each payment of a batch meets each of its waybills. So ranks and totals follow from those of the waybills and from the
    number of payments, and what is spread and ranked has a row a waybill; the payments are joined last, and no row that
    they multiply is spread again.
    """
    statuses = (*FEE_STATUSES, OTHER_STATUS)
    ranked = ranked_with_totals(
        _with_documents(batch_waybills(tables), tables, floor, tz),
        group="batch_id",
        order="oo_waybill_no",
        totals={f"{total}_{s}": _fee_of_status(fee, s, absolute) for total, fee, absolute in BATCH_TOTALS for s in statuses},
        rank="waybill_rank",
        bounds_from=_batch_pairs(tables),
    )
    payments = _payments(tables).filter(F.col("batch_id") != "")
    of_batch = sum((F.col(f"n_{s}") for s in statuses[1:]), F.col(f"n_{statuses[0]}"))
    names = [total for total, _, _ in BATCH_TOTALS]
    counted = lookup(ranked, _payment_counts(payments), {"batch_id": "batch_id"}, {f"n_{s}": f"n_{s}" for s in statuses}, how="inner")
    placed = counted.withColumns(
        {"rank": (F.col("waybill_rank") - 1) * of_batch + 1, **{total: _over_payments(total) for total in names}}
    ).drop("waybill_rank", *[f"{total}_{s}" for total in names for s in statuses], *[f"n_{s}" for s in statuses])
    shown = {name: name for name in placed.columns if name != "batch_id"}
    return _charged(lookup(payments, placed, {"batch_id": "batch_id"}, shown, how="inner"), tz, "rank", *names)


def wallet_transactions(
    tables: Tables,
    floor: date = V.WALLET_HISTORY_START,
    tz: str = JAKARTA,
) -> DataFrame:
    """All wallet rows with the batch amount on the first row of each batch.

    Payments outside a batch are not ranked.
    """
    singly = _charged(_with_documents(paid_singly(tables), tables, floor, tz), tz)
    alone = singly.withColumns(
        {
            "batch_rank": F.lit(None).cast("bigint"),
            "filtered_amount": F.col("amount"),
            "discount_rate": F.abs("discount_rate"),
            **{f"batch_{fee}": F.col(fee).cast("decimal(28,4)") for fee in ("standard_shipping_fee", "total_shipping_fee")},
        }
    )
    first = F.col("rank") == 1
    in_batches = _paid_in_batches(tables, floor, tz).withColumns(
        {
            "batch_rank": F.col("rank"),
            "filtered_amount": F.when(first, F.col("amount")),
            "discount_rate": _share(F.col("sum_abs_total") - F.abs("amount"), F.col("sum_abs_standard")),
            "batch_standard_shipping_fee": F.when(first, F.col("sum_standard")),
            "batch_total_shipping_fee": F.when(first, F.col("sum_total")),
        }
    )
    return alone.select(*TRANSACTION_COLUMNS).unionByName(in_batches.select(*TRANSACTION_COLUMNS))


def wallet_net(transactions: DataFrame) -> DataFrame:
    """Discount and signed net fee of every wallet row that names a waybill.

    In a batch the discount is the batch rate on the waybill's standard fee; otherwise it
    is what the payment left of the total fee. It moves the fee towards zero.
    """
    named = F.col("waybill_no").isNotNull()
    in_batch = F.col("batch_rank") >= 1
    total = F.col("total_shipping_fee")
    by_rate = F.abs("standard_shipping_fee").cast("double") * F.col("discount_rate")
    by_payment = (F.abs(total) - F.abs("filtered_amount")).cast("double")
    discount = F.when(in_batch, by_rate).otherwise(by_payment)
    fee = total.cast("double")
    signed = F.when(total < 0, fee + discount).when(total >= 0, fee - discount)
    return transactions.withColumns(
        {
            "discount_amount": F.when(named, discount),
            "net_shipping_fee": F.when(named, signed),
        }
    )
