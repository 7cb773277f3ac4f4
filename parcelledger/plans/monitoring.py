"""Order monitoring: order status flags, latest scan and mile of every recent order."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import (
    Rule,
    after_underscore,
    first_match,
    first_token,
    has_prefix,
    local_date,
    local_datetime,
)
from parcelledger.functions.time import JAKARTA
from parcelledger.operators import decode, latest_by, lookup, recent
from parcelledger.plans import fixed_values as V
from parcelledger.sources.tables import Tables

WAYBILL_LED_SOURCES = ("01", "03")
FLAGS = (
    "is_first_mile_arrived",
    "is_mh_origin_arrived",
    "is_mh_transit",
    "is_mh_destination_arrived",
    "is_last_mile_arrived",
    "is_arrival_unknown",
)


def _flag(condition: Column) -> Column:
    """1 where the condition is true, else 0 (also where it is unknown)."""
    return F.when(condition, 1).otherwise(0)


def _decoded(df: DataFrame, codes: DataFrame, source: str) -> DataFrame:
    df = decode(df, codes, source, V.ORDER_SOURCE, "order_source_name")
    df = decode(df, codes, "service_type", V.SERVICE_TYPE, "service_type_name")
    return decode(df, codes, "express_type", V.EXPRESS_TYPE, "express_type_name")


def _state_flags(prefix: str) -> dict[str, Column]:
    """Void, delivered, returned and deleted state of a waybill."""

    def field(name: str) -> Column:
        return F.col(prefix + name)

    return {
        "is_void": _flag(field("void_flag") == "1"),
        "is_delivered": _flag((field("pod_flag") == "1") & field("pod_record_time").isNotNull()),
        "is_returned": _flag((field("return_flag") == "1") & field("return_pod_record_time").isNotNull()),
        "is_deleted": _flag(field("deleted") == "1"),
    }


def _order_led(tables: Tables, as_of: date, days: int, tz: str) -> DataFrame:
    orders = recent(tables["shipping_order_dm"], "update_time", days, as_of, tz)
    waybills = recent(tables["shipping_waybill_dm"], "update_time", days, as_of, tz)
    state = (
        "waybill_no", "return_flag", "void_flag", "pod_flag", "pod_record_time",
        "return_pod_record_time", "deleted", "update_time",
    )
    # Orders that are not picked up yet have no waybill number.
    df = lookup(
        orders, waybills, {"waybill_no": "waybill_no"}, {f"wb_{c}": c for c in state},
        spread_nulls_by="order_no",
    )
    df = _decoded(df, tables["system_option"], "order_source")
    flags = _state_flags("wb_")
    return df.select(
        local_datetime("input_time", tz).alias("order_input_datetime"),
        F.col("sender_province").alias("sender_province_name"),
        F.col("sender_city").alias("sender_city_name"),
        F.col("sender_district").alias("sender_district_name"),
        F.col("recipient_province").alias("recipient_province_name"),
        F.col("recipient_city").alias("recipient_city_name"),
        "recipient_address",
        "order_source_name",
        "service_type_name",
        "express_type_name",
        F.col("waybill_no").alias("waybill_number"),
        F.col("order_no").alias("order_number"),
        F.col("ecommerce_order_no").alias("ecommerce_order_number"),
        F.col("wb_return_flag").alias("is_returned_flag"),
        F.col("vip_customer_name").alias("customer_vip_name"),
        _flag(F.col("input_time").isNotNull()).alias("is_order_created"),
        _flag((F.col("order_status") == "03") | F.col("wb_waybill_no").isNotNull()).alias("is_picked_up"),
        _flag(F.col("order_status") == "04").alias("is_order_canceled"),
        *[value.alias(name) for name, value in flags.items()],
        local_date("wb_update_time", tz).alias("update_date"),
        "pickup_branch_name",
    )


def _waybill_led(tables: Tables, as_of: date, days: int, tz: str) -> DataFrame:
    waybills = recent(tables["shipping_waybill_dm"], "update_time", days, as_of, tz).filter(
        F.col("waybill_source").isin(*WAYBILL_LED_SOURCES)
    )
    df = _decoded(waybills, tables["system_option"], "waybill_source")
    return df.select(
        local_datetime("create_time", tz).alias("order_input_datetime"),
        "sender_province_name",
        "sender_city_name",
        "sender_district_name",
        "recipient_province_name",
        "recipient_city_name",
        "recipient_address",
        "order_source_name",
        "service_type_name",
        "express_type_name",
        F.col("waybill_no").alias("waybill_number"),
        F.col("order_no").alias("order_number"),
        F.col("ecommerce_order_no").alias("ecommerce_order_number"),
        F.col("return_flag").alias("is_returned_flag"),
        F.col("vip_customer_name").alias("customer_vip_name"),
        _flag(F.col("shipping_time").isNotNull()).alias("is_order_created"),
        _flag(F.col("waybill_no").isNotNull()).alias("is_picked_up"),
        F.lit(0).alias("is_order_canceled"),
        *[value.alias(name) for name, value in _state_flags("").items()],
        local_date("update_time", tz).alias("update_date"),
        "pickup_branch_name",
    )


def order_base(tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 14) -> DataFrame:
    """Recent orders, and recent waybills of the sources that have no order.

    A waybill that both parts know appears twice, as in the dashboard.
    """
    return _order_led(tables, as_of, days, tz).unionByName(_waybill_led(tables, as_of, days, tz))


def mile_rules() -> list[Rule]:
    branch, pickup_branch = F.col("operation_branch_name"), F.col("pickup_branch_name")
    scan = F.col("scan_operation_type")
    collecting = scan.isin(*V.PICKUP_SCANS)
    arriving = scan.isin(*V.ARRIVAL_SCANS)
    at_pickup = branch == pickup_branch
    last, first = F.lit("Last Mile"), F.lit("First Mile")
    away = has_prefix(branch, V.DELIVERY_PREFIXES) & ~collecting & (branch != pickup_branch)
    inbound = has_prefix("origin_branch_name", V.INBOUND_ORIGIN_PREFIXES) & arriving
    return [
        Rule("hub", has_prefix(branch, V.HUB_PREFIXES), F.lit("Medium Mile")),
        Rule("collecting at a station", has_prefix(branch, V.STATION_PREFIXES) & collecting, first),
        Rule("away from the pickup branch or inbound", away | inbound, last),
        Rule("at the pickup branch, out for delivery", at_pickup & (F.col("waybill_status") == "03"), last),
        Rule("at the pickup branch, collected", at_pickup & (F.col("waybill_status") == "05"), first),
        Rule("at the pickup branch, arriving", at_pickup & arriving, last),
    ]


def mile() -> Column:
    return first_match(mile_rules(), F.lit("Not Defined"))


def latest_scan(
    tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 1, waybill_days: int = 14
) -> DataFrame:
    """Newest scan per waybill with its mile and hub codes.

    The newest scan is chosen before the lookups, and every lookup adds at most one row.
    """
    columns = [
        "waybill_no", "operation_branch_name", "origin_branch_name", "destination_branch_name",
        "operation_type", "operation_user_name", "record_time", "problem_code", "bag_no",
    ]
    scans = recent(tables["shipping_line"], "record_time", days, as_of, tz).select(*columns)
    newest = latest_by(scans, ["waybill_no"], "record_time", ties=columns[1:6] + columns[7:])

    state = ["sorting_code", "waybill_status", "return_flag", "pickup_branch_name", "sender_district_name"]
    waybills = recent(tables["shipping_waybill_dm"], "update_time", waybill_days, as_of, tz)
    current = latest_by(
        waybills.select("waybill_no", "update_time", *state), ["waybill_no"], "update_time", ties=state
    )
    df = lookup(newest, current, {"waybill_no": "waybill_no"}, {c: c for c in state})
    df = decode(df, tables["system_option"], "operation_type", V.OPERATION_TYPE, "scan_operation_type", single=True)
    df = lookup(df, tables["res_branch"], {"branch_name": "operation_branch_name"}, {"branch_no": "branch_no"}, single=True)
    df = lookup(df, tables["res_area"], {"name": "sender_district_name"}, {"area_sorting_code": "sorting_code"}, single=True)
    df = lookup(
        df, tables["res_problem_package"], {"code": "problem_code"},
        {"problem_reason": "register_reason_bahasa"}, single=True,
    )
    return df.select(
        F.col("waybill_no").alias("waybill_number"),
        "sorting_code",
        "operation_branch_name",
        "scan_operation_type",
        "operation_user_name",
        F.col("destination_branch_name").alias("next_branch_name"),
        local_datetime("record_time", tz).alias("last_scan_time"),
        after_underscore("branch_no").alias("scan_branch_code"),
        first_token("area_sorting_code").alias("mh_origin_code"),
        first_token("sorting_code").alias("mh_destination_code"),
        "waybill_status",
        "return_flag",
        "problem_reason",
        "bag_no",
        mile().alias("process_level"),
    )


def _arrival_conditions() -> dict[str, Column]:
    level, here = F.col("process_level"), F.col("scan_branch_code")
    origin, destination = F.col("mh_origin_code"), F.col("mh_destination_code")
    medium = level == "Medium Mile"
    return dict(
        zip(
            FLAGS,
            (
                level == "First Mile",
                medium & (here == origin),
                medium & ((here != origin) | (here != destination)),
                medium & (here == destination),
                level == "Last Mile",
                level == "Not Defined",
            ),
            strict=True,
        )
    )


def _moving() -> Column:
    return ~F.col("waybill_status").isin("04", "06") & (F.col("return_flag") == "0")


def arrival_flags(scans: DataFrame) -> DataFrame:
    """One-hot arrival state of waybills still on their way out."""
    return scans.filter(_moving()).select(
        "waybill_number",
        "operation_branch_name",
        "next_branch_name",
        *[_flag(condition).alias(name) for name, condition in _arrival_conditions().items()],
    )


def order_monitoring(tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 14, scan_days: int = 1) -> DataFrame:
    """The mart: recent orders with their latest scan and arrival flags.

    Flags are columns of the scan row, NULL where the waybill is not on its way, so one
    join brings both.
    """
    base = order_base(tables, as_of, tz, days)
    scans = latest_scan(tables, as_of, tz, scan_days, days).withColumns(
        {name: F.when(_moving(), _flag(condition)) for name, condition in _arrival_conditions().items()}
    )
    return lookup(
        base, scans, {"waybill_number": "waybill_number"},
        {
            "last_scan_time": "last_scan_time",
            "scan_operation_type": "scan_operation_type",
            "last_scan_branch_name": "operation_branch_name",
            "next_branch_name": "next_branch_name",
            "problem_reason": "problem_reason",
            "process_level": "process_level",
            **{name: name for name in FLAGS},
        },
        spread_nulls_by="order_number",
    )
