"""Rule tables over whole tables: how often each arm decides and what it yields."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import Rule, fee, first_match, weight
from parcelledger.functions.rules import rule_name
from parcelledger.operators import decode, lookup
from parcelledger.plans import billing, monitoring, oms, virtual_accounts
from parcelledger.plans import fixed_values as V
from parcelledger.registry import billing_sql as B
from parcelledger.registry.core import FACTS_AS_OF, Sample, query, with_views
from parcelledger.sources import sample

ALL_DAYS = 2500
SCHEME_START = date(2000, 1, 1)


def _priced(s: Sample) -> DataFrame:
    tables = sample.sample_tables(s.spark, s.folder, sample.BILLING)
    return billing.priced_waybills(tables, FACTS_AS_OF, days=ALL_DAYS, scheme_start=SCHEME_START)


def _arms(df: DataFrame, rules: list[Rule], otherwise: Column) -> DataFrame:
    decided = df.select(rule_name(rules).alias("arm"), first_match(rules, otherwise).alias("fee"))
    return decided.groupBy("arm").agg(
        F.count(F.lit(1)).alias("waybills"), F.count("fee").alias("settled"), F.sum("fee").alias("fee")
    )


def _arms_sql(arms: list[tuple[str, str, str]], otherwise: str) -> str:
    return with_views(B.VIEWS, f""", {B.priced(ALL_DAYS)}, decided AS (SELECT {B.arm_name(arms)} AS arm,
        {B.decide(arms, otherwise)} AS fee FROM priced)
        SELECT arm, COUNT(*) AS waybills, COUNT(fee) AS settled, CAST(SUM(fee) AS DOUBLE) AS fee FROM decided GROUP BY arm""")


@query(_arms_sql(B.GROSS_ARMS, B.fee("total_shipping_fee")))
def rule_gross_fee(s: Sample) -> DataFrame:
    return _arms(_priced(s), billing.gross_fee_rules(), fee(F.col("total_fee")))


@query(_arms_sql(B.GROUPED_NET_ARMS, B.fee("total_shipping_fee")))
def rule_net_fee(s: Sample) -> DataFrame:
    decided = _priced(s).withColumn("net_arm", billing.net_arm())
    return decided.select(F.coalesce("net_arm", F.lit("otherwise")).alias("arm"), billing.net_fee().alias("fee")).groupBy(
        "arm"
    ).agg(F.count(F.lit(1)).alias("waybills"), F.count("fee").alias("settled"), F.sum("fee").alias("fee"))


@query(_arms_sql(B.MARKETPLACE_ARMS, "NULL"))
def rule_marketplace_fee(s: Sample) -> DataFrame:
    decided = _priced(s).select(
        F.coalesce("marketplace_arm", F.lit("otherwise")).alias("arm"), F.col("marketplace_fee").alias("fee")
    )
    return decided.groupBy("arm").agg(
        F.count(F.lit(1)).alias("waybills"), F.count("fee").alias("settled"), F.sum("fee").alias("fee")
    )


@query(_arms_sql(B.COD_ARMS, B.fee("0")))
def rule_cod_fee(s: Sample) -> DataFrame:
    return _arms(_priced(s), billing.cod_fee_rules(), fee(F.lit(0)))


@query(_arms_sql(B.RETURN_ARMS, B.fee("0")))
def rule_return_fee(s: Sample) -> DataFrame:
    return _arms(_priced(s), billing.return_fee_rules(), fee(F.lit(0)))


@query(with_views(["parcels"], f"""SELECT item_calculated_weight AS kilos, CAST({B.WEIGHT} AS DOUBLE) AS chargeable,
    COUNT(*) AS waybills FROM (SELECT *, TRY_CAST(item_calculated_weight AS DECIMAL(38,9)) AS calc_kg FROM parcels) GROUP BY 1, 2"""))
def rule_chargeable_weight(s: Sample) -> DataFrame:
    parcels = sample.view(s.spark, s.folder, "parcels")
    charged = billing.chargeable_weight(weight("item_calculated_weight"))
    return parcels.groupBy(F.col("item_calculated_weight").alias("kilos"), charged.alias("chargeable")).agg(
        F.count(F.lit(1)).alias("waybills")
    )


def _listed(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


PICKING, ARRIVING = _listed(V.PICKUP_SCANS), _listed(V.ARRIVAL_SCANS)
MILE_ARMS = [
    ("hub", "substr(branch, 1, 2) IN ('MH', 'DC', 'HQ')", "'Medium Mile'"),
    ("collecting at a station", f"substr(branch, 1, 2) IN ('TH', 'FB', 'PD') AND scan IN {PICKING}", "'First Mile'"),
    ("away from the pickup branch or inbound",
     f"""((substr(branch, 1, 2) IN ('VH', 'VT', 'TH', 'FB', 'PD') AND scan NOT IN {PICKING} AND branch <> home)
     OR (substr(came_from, 1, 2) IN ('MH', 'TH', 'DC') AND scan IN {ARRIVING}))""", "'Last Mile'"),
    ("at the pickup branch, out for delivery", "branch = home AND state = '03'", "'Last Mile'"),
    ("at the pickup branch, collected", "branch = home AND state = '05'", "'First Mile'"),
    ("at the pickup branch, arriving", f"branch = home AND scan IN {ARRIVING}", "'Last Mile'"),
]
MILE_SQL = B.decide(MILE_ARMS, "'Not Defined'")


@query(with_views(["scans", "waybill_states", "options"], f""", seen AS (SELECT s.operation_branch_name AS branch,
    s.origin_branch_name AS came_from, o.option_name AS scan, w.pickup_branch_name AS home, w.waybill_status AS state FROM scans s
    LEFT JOIN waybill_states w ON w.waybill_no = s.waybill_no
    LEFT JOIN options o ON o.type_option = 'operationType' AND o.option_value = s.operation_type)
    SELECT {B.arm_name(MILE_ARMS)} AS arm, {MILE_SQL} AS process_level, COUNT(*) AS scans FROM seen GROUP BY 1, 2"""))
def rule_mile(s: Sample) -> DataFrame:
    tables = sample.sample_tables(s.spark, s.folder, sample.MONITORING)
    df = lookup(
        tables["shipping_line"], tables["shipping_waybill_dm"], {"waybill_no": "waybill_no"},
        {c: c for c in ("pickup_branch_name", "waybill_status")},
    )
    df = decode(df, tables["system_option"], "operation_type", V.OPERATION_TYPE, "scan_operation_type")
    levels = df.select(rule_name(monitoring.mile_rules()).alias("arm"), monitoring.mile().alias("process_level"))
    return levels.groupBy("arm", "process_level").agg(F.count(F.lit(1)).alias("scans"))


DROPSHIP_START = date(2000, 1, 1)
_START = "DATE '2000-01-01'"
_SHIPPED = B.local_day("p.shipping_time")
_MARKET = "p.waybill_source = '756'"
TYPE_ARMS = [
    ("unlisted origin", f"""{_MARKET} AND op.sender_city_name IS NULL AND ({B.local_day("p.pod_record_time")} >= {_START}
        OR {B.local_day("p.return_pod_record_time")} >= {_START} OR {_SHIPPED} >= {_START})""", "'DROPSHIP'"),
    ("flagged city", f"""{_MARKET} AND af.dropship_flag = 1 AND {_SHIPPED} <= {_START}
        AND (af.start_date IS NULL OR {_SHIPPED} <= af.start_date)""", "'DROPSHIP'"),
    ("net-off report", f"{_MARKET} AND mr.waybill_no IS NOT NULL", "mr.transaction_type"),
    ("service fm", f"{_MARKET} AND po.role_miles = 'fm'", "'FMPU'"),
    ("service mm,lm", f"{_MARKET} AND po.role_miles = 'mm,lm'", "'MMLM'"),
    ("service fm,mm,lm", f"{_MARKET} AND po.role_miles = 'fm,mm,lm'", "'E2EPU'"),
]
TYPE_JOINS = f"""LEFT JOIN partner_orders po ON po.waybill_number = p.waybill_no AND po.booking_code = p.order_no AND {_MARKET}
    LEFT JOIN marketplace_reported mr ON mr.waybill_no = p.waybill_no AND {_MARKET}
    LEFT JOIN area_flags af ON af.sender_city_name = p.sender_city_name AND {_MARKET}
    LEFT JOIN origin_pricing op ON op.sender_city_name = p.sender_city_name AND {_MARKET}"""


@query(with_views(["parcels", "partner_orders", "marketplace_reported", "area_flags", "origin_pricing"],
    f"""SELECT {B.arm_name(TYPE_ARMS)} AS arm, {B.decide(TYPE_ARMS, "NULL")} AS transaction_type, COUNT(*) AS waybills
    FROM parcels p {TYPE_JOINS} GROUP BY 1, 2"""))
def rule_transaction_type(s: Sample) -> DataFrame:
    tables = sample.sample_tables(s.spark, s.folder, sample.FINANCE)
    df = oms.with_marketplace(tables["dm_waybill_waybill"], tables)
    rules = oms.transaction_type_rules(DROPSHIP_START)
    typed = df.select(rule_name(rules).alias("arm"), first_match(rules).alias("transaction_type"))
    return typed.groupBy("arm", "transaction_type").agg(F.count(F.lit(1)).alias("waybills"))


def ageing_sql(paid: str, age: str) -> str:
    upto = " ".join(f"WHEN {age} <= {last} THEN '{name}'" for last, name in V.AGEING_BUCKETS)
    return f"CASE WHEN {paid} THEN '{V.AGEING_PAID}' {upto} WHEN {age} IS NOT NULL THEN '{V.AGEING_BEYOND}' END"


@query(with_views(["accounts"], f"""SELECT payment_status, {ageing_sql("payment_status = '1'", "age")} AS bucket,
    COUNT(*) AS accounts, CAST(MIN(age) AS INTEGER) AS youngest, CAST(MAX(age) AS INTEGER) AS oldest FROM
    (SELECT payment_status, date_diff('day', create_va_date, {B.DAY}) AS age FROM accounts) GROUP BY 1, 2"""))
def rule_ageing(s: Sample) -> DataFrame:
    accounts = sample.view(s.spark, s.folder, "accounts")
    bucket = virtual_accounts.ageing_bucket("payment_status", "create_va_date", FACTS_AS_OF)
    age = F.datediff(F.lit(FACTS_AS_OF), F.col("create_va_date"))
    return accounts.groupBy("payment_status", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("accounts"), F.min(age).alias("youngest"), F.max(age).alias("oldest")
    )
