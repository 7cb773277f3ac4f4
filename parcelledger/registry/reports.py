"""The reports on the sample, each with its SQL statement."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelledger.operators import find_differences, merged_rows, reconcile
from parcelledger.plans import (
    accrual,
    billing,
    disbursement,
    journey,
    monitoring,
    oms,
    region,
    virtual_accounts,
    wallet,
    wallet_totals,
)
from parcelledger.registry import billing_sql as B
from parcelledger.registry.core import EVENTS_AS_OF, FACTS_AS_OF, LOADED_AT, Sample, query, with_views
from parcelledger.registry.rules import (
    ALL_DAYS,
    DROPSHIP_START,
    MILE_SQL,
    SCHEME_START,
    TYPE_ARMS,
    TYPE_JOINS,
    ageing_sql,
)
from parcelledger.sources import sample, scratch_dir, write_clustered
from parcelledger.sources.tables import Tables

local_day = B.local_day


def _tables(s: Sample, group: dict[str, str]) -> Tables:
    return sample.sample_tables(s.spark, s.folder, group)


def local(instant: str) -> str:
    return f"{instant} + INTERVAL 7 HOUR"


def double(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


# --- billing ----------------------------------------------------------------------------

def _billing(s: Sample, days: int, **options) -> DataFrame:
    options.setdefault("scheme_start", SCHEME_START)
    return billing.daily_billing(_tables(s, sample.BILLING), FACTS_AS_OF, days=days, **options)


@query(B.billing_query(1))
def billing_daily(s: Sample) -> DataFrame:
    return _billing(s, 1)


@query(B.billing_query(1))
def billing_maintained_wallet(s: Sample) -> DataFrame:
    """The day's billing from wallet sums that four loads, two of them repeated, have built up."""
    path, tables = scratch_dir(s.spark, "wallet-totals"), _tables(s, sample.BILLING)
    history = tables["agg_wallet_summary"].withColumn("load", F.pmod(F.xxhash64("waybill_no", "net_shipping_fee"), F.lit(4)))
    for load in (0, 1, 1, 2, 3, 0):
        wallet_totals.add_load(s.spark, path, history.filter(F.col("load") == load), f"load {load}", fan_in=3)
    maintained = tables.with_tables(wallet_totals=wallet_totals.totals(s.spark, path))
    return billing.daily_billing(maintained, FACTS_AS_OF, days=1, scheme_start=SCHEME_START)


@query(B.billing_query(ALL_DAYS))
def billing_backfill(s: Sample) -> DataFrame:
    return _billing(s, ALL_DAYS)


@query(B.billing_query(ALL_DAYS, B.CORRECTED_NET_ARMS))
def billing_with_standard_discount(s: Sample) -> DataFrame:
    return _billing(s, ALL_DAYS, faithful=False)


@query(with_views(["standard_rates"], f""", {B.RATES.replace("SELECT DISTINCT", "SELECT")}
    SELECT * EXCLUDE (discount_rate), CAST(discount_rate AS DOUBLE) AS discount_rate FROM live_rates"""))
def billing_active_rates(s: Sample) -> DataFrame:
    return billing.active_standard_rates(sample.view(s.spark, s.folder, "standard_rates"), FACTS_AS_OF)


@query(with_views(["wallet_summary"], f""", {B.WALLET} SELECT waybill_no, CAST(total AS DOUBLE) AS total_shipping_fee,
    CAST(discount AS DOUBLE) AS discount_amount, CAST(net AS DOUBLE) AS net_shipping_fee FROM paid_by_wallet"""))
def billing_wallet_totals(s: Sample) -> DataFrame:
    return billing.wallet_per_waybill(sample.view(s.spark, s.folder, "wallet_summary"))


@query(with_views(["returns", "codes", "source_mapping"], f""", {B.returns(ALL_DAYS)}
    SELECT return_waybill_no, waybill_no, {double("return_shipping_fee")} FROM fresh_returns"""))
def billing_returns(s: Sample) -> DataFrame:
    return billing.non_ecommerce_returns(_tables(s, sample.BILLING), FACTS_AS_OF, days=ALL_DAYS)


# --- accrual ----------------------------------------------------------------------------

BILLED_DAYS = 125
LEG = "date_key, flag, parent_source, waybill_finance_source_category, waybill_source, parent_shipping_client, pod_category"
CATEGORY = """COALESCE(m2.finance_source_category, CASE m1.finance_source_category WHEN 'Partner C Legal Entity' THEN 'PartnerC'
    WHEN 'Partner D Legal Entity' THEN 'PartnerD' ELSE m1.finance_source_category END) AS waybill_finance_source_category"""
PICKUP_SQL = f"""picked AS (SELECT {local_day("p.shipping_time")} AS date_key, 'pickup' AS flag,
    CASE WHEN e.option_name = 'iDtruck' THEN 'Cargo' ELSE 'Non Cargo' END AS parent_source, {CATEGORY},
    c.option_name AS waybill_source, p.parent_client_identifier AS parent_shipping_client, 'pod delivery' AS pod_category,
    COUNT(p.waybill_no) AS volume, SUM(TRY_CAST(p.item_calculated_weight AS DECIMAL(38,9))) AS weight,
    0 AS gross, 0 AS net, 0 AS cod, 0 AS back FROM parcels p
    LEFT JOIN codes e ON e.type_option = 'expressType' AND e.option_value = p.express_type
    LEFT JOIN codes c ON c.type_option = 'waybillSource' AND c.option_value = p.waybill_source
    {B.source_columns("m", "c.option_name", "p.parent_client_identifier", "p.waybill_source = '00'")}
    WHERE p.pickup_branch_name <> 'HEADQUARTER' AND p.void_flag = '0' AND p.deleted = '0'
    AND {local_day("p.shipping_time")} >= {B.DAY} - 93 GROUP BY ALL)"""
DELIVERED_SQL = f"""done AS (SELECT CAST(b.pod_date AS DATE) AS date_key, 'delivered' AS flag,
    CASE WHEN b.express_type_name = 'iDtruck' THEN 'Cargo' ELSE 'Non Cargo' END AS parent_source, {CATEGORY},
    b.waybill_source_name AS waybill_source, b.parent_shipping_client, b.pod_category, COUNT(b.waybill_no) AS volume,
    SUM(b.cargo_weight) AS weight, SUM(b.total_shipping_fee) AS gross, SUM(b.net_shipping_fee) AS net,
    SUM(CASE WHEN b.cod_fee > 0 THEN b.cod_fee ELSE 0 END) AS cod,
    SUM(CASE WHEN b.return_shipping_fee > 0 THEN b.return_shipping_fee ELSE 0 END) AS back FROM billing b
    {B.source_columns("m", "b.waybill_source_name", "b.parent_shipping_client", "b.waybill_source_name = 'Key Account Portal'")}
    WHERE b.pod_date >= {B.DAY} - 120 GROUP BY ALL)"""
CROSSDOCK_SQL = f"""docked AS (SELECT {local_day("inbound_time")} AS date_key, 'pickup' AS flag, 'Non Cargo' AS parent_source,
    'Cross Docking' AS waybill_finance_source_category, '' AS waybill_source, '' AS parent_shipping_client,
    'pod delivery' AS pod_category, COUNT(booking_code) AS volume, 0 AS weight, 0 AS gross, 0 AS net, 0 AS cod, 0 AS back
    FROM crossdock_orders WHERE inbound_hub_name <> 'TH TESTING HQ' GROUP BY 1
    UNION ALL SELECT CAST(print_group_time AS DATE), 'delivered', 'Non Cargo', 'Cross Docking', '', '', 'pod delivery',
    COUNT(booking_code), 0, 0, SUM(invoice), 0, 0 FROM crossdock_summary GROUP BY 1)"""
LEG_NAMES = """volume, CAST(weight AS DOUBLE) AS weight, CAST(gross AS DOUBLE) AS gross_shipping_fee,
    CAST(net AS DOUBLE) AS net_shipping_fee, CAST(cod AS DOUBLE) AS cod_fee, CAST(back AS DOUBLE) AS return_shipping_fee"""
EXTRAS = "COALESCE(cod, 0) + COALESCE(back, 0)"
ACCRUAL_SQL = f"""SELECT date_key, parent_source, COALESCE(waybill_finance_source_category, 'Not Defined')
    AS waybill_finance_source_category, waybill_source, parent_shipping_client, pod_category,
    CAST(SUM(CASE WHEN flag = 'pickup' THEN volume ELSE 0 END) AS BIGINT) AS pickup_volume,
    CAST(SUM(CASE WHEN flag = 'pickup' AND parent_source = 'Cargo' THEN weight ELSE 0 END) AS DOUBLE) AS pickup_weight,
    CAST(SUM(CASE WHEN flag = 'delivered' THEN volume ELSE 0 END) AS BIGINT) AS delivered_volume,
    CAST(SUM(CASE WHEN flag = 'delivered' AND parent_source = 'Cargo' THEN weight ELSE 0 END) AS DOUBLE) AS delivered_weight,
    CAST(SUM(CASE WHEN flag = 'delivered' THEN gross + {EXTRAS} ELSE 0 END) AS DOUBLE) AS gross_revenue,
    CAST(ROUND(SUM(CASE WHEN flag = 'delivered' THEN net + {EXTRAS} ELSE 0 END), 0) AS DOUBLE) AS indicative_net_revenue
    FROM (SELECT * FROM picked UNION ALL SELECT * FROM done UNION ALL SELECT * FROM docked)
    WHERE date_key >= {B.DAY} - 120 GROUP BY ALL"""
ACCRUAL_VIEWS = [*B.VIEWS, "crossdock_orders", "crossdock_summary"]


def _accrual_tables(s: Sample) -> Tables:
    return _tables(s, sample.ACCRUAL).with_tables(fact_pod_details=_billing(s, BILLED_DAYS))


@query(with_views(["parcels", "codes", "source_mapping"], f""", {PICKUP_SQL} SELECT {LEG}, {LEG_NAMES} FROM picked"""))
def accrual_pickup(s: Sample) -> DataFrame:
    return accrual.pickup_leg(_tables(s, sample.ACCRUAL), FACTS_AS_OF)


@query(with_views(B.VIEWS, f", {B.billing(BILLED_DAYS)}, {DELIVERED_SQL} SELECT {LEG}, {LEG_NAMES} FROM done"))
def accrual_delivered(s: Sample) -> DataFrame:
    return accrual.delivered_leg(_accrual_tables(s), FACTS_AS_OF)


@query(with_views(["crossdock_orders", "crossdock_summary"], f""", {CROSSDOCK_SQL} SELECT {LEG}, {LEG_NAMES} FROM docked
    WHERE date_key >= {B.DAY} - 120"""))
def accrual_crossdock(s: Sample) -> DataFrame:
    return accrual.crossdock_legs(_tables(s, sample.ACCRUAL), FACTS_AS_OF)


@query(with_views(ACCRUAL_VIEWS, f", {B.billing(BILLED_DAYS)}, {PICKUP_SQL}, {DELIVERED_SQL}, {CROSSDOCK_SQL} {ACCRUAL_SQL}"))
def accrual_net(s: Sample) -> DataFrame:
    return accrual.accrual_report(_accrual_tables(s), FACTS_AS_OF)


STATUS_SQL = """CASE WHEN b.at IS NULL THEN 'missing in report' WHEN a.at IS NULL THEN 'missing in raw' WHEN {same} THEN 'match'
    ELSE 'difference' END AS status"""
RECONCILED = ("date_key", "waybill_source", "parent_shipping_client", "pod_category")


def _reconciled_sql() -> str:
    keys = ", ".join(RECONCILED)
    shown = ", ".join(f"COALESCE(a.{k}, b.{k}) AS {k}" for k in RECONCILED)
    on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in RECONCILED)
    diff = lambda n: f"COALESCE(a.{n}, 0) - COALESCE(b.{n}, 0)"
    return f""", {B.billing(BILLED_DAYS)}, {PICKUP_SQL}, {DELIVERED_SQL}, {CROSSDOCK_SQL},
    a AS (SELECT 1 AS at, CAST(pod_date AS DATE) AS date_key, waybill_source_name AS waybill_source, parent_shipping_client,
        pod_category, COUNT(waybill_no) AS waybills, SUM(total_shipping_fee) AS gross FROM billing GROUP BY ALL),
    b AS (SELECT 1 AS at, {keys}, SUM(CASE WHEN flag = 'delivered' THEN volume ELSE 0 END) AS waybills,
        SUM(CASE WHEN flag = 'delivered' THEN gross + {EXTRAS} ELSE 0 END) AS gross
        FROM (SELECT * FROM picked UNION ALL SELECT * FROM done UNION ALL SELECT * FROM docked)
        WHERE date_key >= {B.DAY} - 120 GROUP BY ALL)
    SELECT {shown}, CAST(a.waybills AS BIGINT) AS waybills_raw, CAST(b.waybills AS BIGINT) AS waybills_report,
        CAST(a.gross AS DOUBLE) AS gross_raw, CAST(b.gross AS DOUBLE) AS gross_report,
        CAST({diff("waybills")} AS BIGINT) AS waybills_diff, CAST({diff("gross")} AS DOUBLE) AS gross_diff,
        {STATUS_SQL.format(same="a.waybills = b.waybills AND a.gross IS NOT DISTINCT FROM b.gross")}
    FROM a FULL JOIN b ON {on}"""


@query(with_views(ACCRUAL_VIEWS, _reconciled_sql()))
def reconcile_accrual(s: Sample) -> DataFrame:
    """Billing rows, stored once, against the accrual report made of them: days before its window, legs without billing,
    and revenue beyond the shipping fee all show."""
    path = scratch_dir(s.spark, "stored-billing")
    write_clustered(_billing(s, BILLED_DAYS), path, "pod_date", ["waybill_no"])
    stored = s.spark.read.parquet(path)
    report = accrual.accrual_report(_tables(s, sample.ACCRUAL).with_tables(fact_pod_details=stored), FACTS_AS_OF)
    raw = stored.select(
        F.col("pod_date").cast("date").alias("date_key"), F.col("waybill_source_name").alias("waybill_source"),
        "parent_shipping_client", "pod_category", "waybill_no", "total_shipping_fee",
    )
    return reconcile(
        raw, report, RECONCILED,
        {"waybills": (F.count("waybill_no"), F.sum("delivered_volume")), "gross": (F.sum("total_shipping_fee"), F.sum("gross_revenue"))},
    )


NEXT_DAY = FACTS_AS_OF + timedelta(days=1)


def _rebilled_sql() -> str:
    def side(sql: str) -> str:
        return f"""(SELECT waybill_no, 1 AS at, COUNT(*) AS rows, SUM(CAST(net_shipping_fee AS DECIMAL(18,6))) AS net,
            list_sort(list(CAST(t AS VARCHAR))) AS content FROM ({sql}) t GROUP BY waybill_no)"""

    before = side(B.billing_query(2))
    after = side(B.billing_query(2, B.CORRECTED_NET_ARMS).replace(B.DAY, f"DATE '{NEXT_DAY}'"))
    return f"""SELECT * FROM (SELECT COALESCE(a.waybill_no, b.waybill_no) AS waybill_no, CAST(a.rows AS BIGINT) AS rows_raw,
        CAST(b.rows AS BIGINT) AS rows_report, CAST(a.net AS DOUBLE) AS net_raw, CAST(b.net AS DOUBLE) AS net_report,
        CAST(COALESCE(a.rows, 0) - COALESCE(b.rows, 0) AS BIGINT) AS rows_diff,
        CAST(COALESCE(a.net, 0) - COALESCE(b.net, 0) AS DOUBLE) AS net_diff, {STATUS_SQL.format(same="a.content = b.content")}
        FROM {before} a FULL JOIN {after} b ON a.waybill_no IS NOT DISTINCT FROM b.waybill_no) WHERE status <> 'match'"""


@query(_rebilled_sql())
def reconcile_rebilled(s: Sample) -> DataFrame:
    """Two days of billing against the next two days with the standard discount applied: which waybills changed."""
    tables, sides = _tables(s, sample.BILLING), []
    for as_of, faithful in ((FACTS_AS_OF, True), (NEXT_DAY, False)):
        path = scratch_dir(s.spark, "rebilled")
        rows = billing.daily_billing(tables, as_of, days=2, faithful=faithful, scheme_start=SCHEME_START)
        write_clustered(rows, path, "pod_date", ["waybill_no"])
        sides.append(s.spark.read.parquet(path))
    return find_differences(*sides, ["waybill_no"], {"net": F.sum("net_shipping_fee")})


# --- order journey ----------------------------------------------------------------------

EVENTS_DAY = "DATE '2024-01-31'"
JOURNEY_VIEWS = [
    "registrations", "locations", "districts", "dropoffs", "hub_events", "journey_orders", "journey_tracking",
    "journey_options", "journey_failures",
]
PLACED_SQL = """placed AS (SELECT r.*, l.partner_type, d.province, d.city, d.district FROM (SELECT * FROM registrations
    QUALIFY ROW_NUMBER() OVER (PARTITION BY tracking_id ORDER BY created_time DESC, loc_code, partner_name, loc_name,
    loc_address) = 1) r LEFT JOIN locations l ON l.code = r.loc_code LEFT JOIN districts d ON d.district_id = l.region_id)"""
SUMMARY_ORDER = "CASE evt_type WHEN '61' THEN 0 ELSE 1 END, event_time, evt_type, source_hub"


def _journey_windows(kind: str) -> tuple[str, str, str]:
    def after(column: str, bound: str) -> str:
        return f"{local_day(column)} {bound}"

    if kind == "full":
        quarter, half = f">= {EVENTS_DAY} - INTERVAL 3 MONTH", f">= {EVENTS_DAY} - INTERVAL 6 MONTH"
        return after("event_time", quarter), after("updated_at", half), after("updated_at", quarter)
    return after("event_time", f"= {EVENTS_DAY} - 1"), *[after("updated_at", f">= {EVENTS_DAY} - 1")] * 2


def journey_ctes(kind: str, name: str = "journey") -> str:
    events, orders, tracking = _journey_windows(kind)
    partner = "CASE WHEN o.handled_by = 'THIRDPARTY' THEN o.partner_handler ELSE p.partner_name END"
    return f"""summary_{name} AS (SELECT * FROM hub_events WHERE {events} AND evt_type IN ('61', '02', '04', '09')
        QUALIFY ROW_NUMBER() OVER (PARTITION BY tracking_id ORDER BY {SUMMARY_ORDER}) = 1),
    arrivals_{name} AS (SELECT tracking_id, MIN(event_time) AS at FROM hub_events
        WHERE {events} AND substr(source_hub, 1, 2) IN ('MH', 'DC') GROUP BY 1),
    drops_{name} AS (SELECT tracking_id, MIN(event_time) AS at FROM dropoffs WHERE {events} GROUP BY 1),
    facts_{name} AS (SELECT p.*, o.* EXCLUDE (tracking_id, updated_at), t.cancel_flag, t.pickup_logged, t.pod_time,
        s.evt_type, s.source_hub AS summary_hub, s.event_time AS summary_at, a.at AS arrival_at, d.at AS dropoff_at,
        {partner} AS carrier FROM placed p
        LEFT JOIN (SELECT * FROM journey_orders WHERE {orders}) o ON o.tracking_id = p.tracking_id
        LEFT JOIN (SELECT * FROM journey_tracking WHERE {tracking}) t ON t.tracking_id = p.tracking_id
        LEFT JOIN summary_{name} s ON s.tracking_id = p.tracking_id LEFT JOIN arrivals_{name} a ON a.tracking_id = p.tracking_id
        LEFT JOIN drops_{name} d ON d.tracking_id = p.tracking_id WHERE p.partner_type IN ('A', 'B', 'C')),
    {name} AS (SELECT f.tracking_id, order_id, ext_order_id, {local("order_time")} AS order_time, sender_name, sender_contact,
        channel.val AS channel, service.val AS service_type, province AS sender_province, city AS sender_city,
        district AS sender_district, {local("created_time")} AS event_time, loc_name AS source_hub, loc_address, loc_code,
        partner_type, CASE WHEN handled_by = 'THIRDPARTY' THEN partner_handler ELSE 'DEFAULT' END AS final_partner,
        {local("pickup_start")} AS pickup_start, {local("pickup_end")} AS pickup_end,
        CASE WHEN cancel_flag = '1' THEN 'Canceled' ELSE state.val END AS order_status,
        {local("pickup_logged")} AS pickup_event_time,
        CASE WHEN pickup_time IS NULL THEN target_hub ELSE pickup_hub END AS pickup_target,
        CASE WHEN pickup_logged IS NULL AND status <> '04' THEN
            CAST(date_diff('day', {local_day("created_time")}, {EVENTS_DAY}) AS INTEGER) END AS backlog_days,
        CASE WHEN carrier <> 'DEFAULT' AND evt_type = '61' THEN {local("summary_at")}
            WHEN carrier = 'DEFAULT' AND evt_type IN ('02', '04') AND summary_hub = pickup_hub THEN {local("summary_at")}
            WHEN pod_time IS NOT NULL THEN {local("pod_time")} END AS delivery_time,
        CASE WHEN carrier <> 'DEFAULT' AND evt_type = '61' THEN 'Handover Complete'
            WHEN carrier = 'DEFAULT' AND evt_type = '04' THEN 'Dispatched'
            WHEN pod_time IS NOT NULL THEN 'Delivered' END AS delivery_status,
        {local("pod_time")} AS pod_time, failed_pickup_time, failure.reason AS failed_reason, cancelled.val AS cancel_status,
        TIMESTAMP '2024-01-31 07:00:00' AS data_timestamp, {local("arrival_at")} AS arrival_time,
        {local("dropoff_at")} AS dropoff_time FROM facts_{name} f
        LEFT JOIN journey_options channel ON channel.option_id = channel_id
        LEFT JOIN journey_options service ON service.option_id = service_id
        LEFT JOIN journey_options state ON state.option_id = status_id
        LEFT JOIN journey_options cancelled ON cancelled.option_id = cancel_flag
        LEFT JOIN journey_failures failure ON failure.id = failed_reason_id
        QUALIFY ROW_NUMBER() OVER (PARTITION BY f.tracking_id ORDER BY delivery_time NULLS FIRST, order_id NULLS FIRST,
            f.pod_time NULLS FIRST, pickup_logged NULLS FIRST, cancelled.val NULLS FIRST, f.order_time NULLS FIRST,
            order_status NULLS FIRST, failure.reason NULLS FIRST) = 1)"""


def _journey(s: Sample, window: journey.Window) -> DataFrame:
    return journey.order_journey(_tables(s, sample.JOURNEY), window, EVENTS_AS_OF, LOADED_AT)


@query(with_views(JOURNEY_VIEWS, f", {PLACED_SQL}, {journey_ctes('full')} SELECT * FROM journey"))
def journey_full(s: Sample) -> DataFrame:
    return _journey(s, journey.full_window(EVENTS_AS_OF))


@query(with_views(JOURNEY_VIEWS, f", {PLACED_SQL}, {journey_ctes('delta')} SELECT * FROM journey"))
def journey_delta(s: Sample) -> DataFrame:
    return _journey(s, journey.delta_window(EVENTS_AS_OF))


def _touched_sql() -> str:
    events, changed, _ = _journey_windows("delta")
    parts = [
        f"SELECT tracking_id FROM registrations WHERE {changed.replace('updated_at', 'created_time')}",
        f"SELECT tracking_id FROM journey_orders WHERE {changed}",
        f"SELECT tracking_id FROM journey_tracking WHERE {changed}",
        f"SELECT tracking_id FROM hub_events WHERE {events}",
        f"SELECT tracking_id FROM dropoffs WHERE {events}",
    ]
    return " UNION ".join(parts)


@query(with_views(JOURNEY_VIEWS, f""", {PLACED_SQL}, {journey_ctes('full')}, touched AS ({_touched_sql()})
    SELECT * FROM journey WHERE tracking_id IN (SELECT tracking_id FROM touched)"""))
def journey_delta_touched(s: Sample) -> DataFrame:
    """Only what can differ from yesterday's load: touched ids, with all that the full load knows about them."""
    tables = _tables(s, sample.JOURNEY)
    ids = journey.changed_ids(tables, journey.delta_window(EVENTS_AS_OF))
    return journey.order_journey(tables, journey.full_window(EVENTS_AS_OF), EVENTS_AS_OF, LOADED_AT, only=ids)


UPSERT_SQL = """SELECT * FROM journey WHERE tracking_id NOT IN (SELECT tracking_id FROM changes)
    UNION ALL BY NAME SELECT * FROM changes"""


@query(with_views(JOURNEY_VIEWS, f""", {PLACED_SQL}, {journey_ctes('full')}, {journey_ctes('delta', 'changed')},
    changes AS (SELECT * FROM changed) {UPSERT_SQL}"""))
def journey_upsert(s: Sample) -> DataFrame:
    target = _journey(s, journey.full_window(EVENTS_AS_OF))
    return merged_rows(target, _journey(s, journey.delta_window(EVENTS_AS_OF)), "tracking_id")


@query(with_views(["registrations", "locations", "districts"], f""", {PLACED_SQL} SELECT tracking_id, created_time, loc_code,
    partner_name, loc_name, loc_address, partner_type, province, city, district FROM placed"""))
def journey_latest_location(s: Sample) -> DataFrame:
    return journey.latest_location(_tables(s, sample.JOURNEY))


@query(with_views(["hub_events"], f"""SELECT tracking_id, source_hub, {local("event_time")} AS event_time FROM hub_events
    WHERE {_journey_windows("full")[0]} AND substr(source_hub, 1, 2) IN ('MH', 'DC')
    QUALIFY ROW_NUMBER() OVER (PARTITION BY tracking_id ORDER BY hub_events.event_time, source_hub) = 1"""))
def journey_first_hub(s: Sample) -> DataFrame:
    events = sample.view(s.spark, s.folder, "hub_events")
    return journey.first_hub_arrival(events, journey.full_window(EVENTS_AS_OF))


@query(with_views(["dropoffs"], f"""SELECT tracking_id, source_hub, {local("event_time")} AS event_time FROM dropoffs
    WHERE {_journey_windows("full")[0]}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY tracking_id ORDER BY dropoffs.event_time, source_hub) = 1"""))
def journey_first_dropoff(s: Sample) -> DataFrame:
    drops = sample.view(s.spark, s.folder, "dropoffs")
    return journey.first_dropoff(drops, journey.full_window(EVENTS_AS_OF))


@query(with_views(["hub_events"], f"""SELECT tracking_id, evt_type, source_hub, next_hub AS next_location, event_time
    FROM hub_events WHERE {_journey_windows("full")[0]} AND evt_type IN ('61', '02', '04', '09')
    QUALIFY ROW_NUMBER() OVER (PARTITION BY tracking_id ORDER BY {SUMMARY_ORDER}, next_hub) = 1"""))
def journey_summary_event(s: Sample) -> DataFrame:
    events = sample.view(s.spark, s.folder, "hub_events")
    return journey.summary_event(events, journey.full_window(EVENTS_AS_OF))


# --- order monitoring -------------------------------------------------------------------

HISTORY = 3000
MONITORING_VIEWS = ["order_states", "waybill_states", "scans", "options", "scan_branches", "areas", "problems"]
DECODED = """LEFT JOIN options src ON src.type_option = 'orderSource' AND src.option_value = {0}
    LEFT JOIN options svc ON svc.type_option = 'serviceType' AND svc.option_value = {1}.service_type
    LEFT JOIN options xpr ON xpr.type_option = 'expressType' AND xpr.option_value = {1}.express_type"""
STATE = """CASE WHEN w.void_flag = '1' THEN 1 ELSE 0 END AS is_void,
    CASE WHEN w.pod_flag = '1' AND w.pod_record_time IS NOT NULL THEN 1 ELSE 0 END AS is_delivered,
    CASE WHEN w.return_flag = '1' AND w.return_pod_record_time IS NOT NULL THEN 1 ELSE 0 END AS is_returned,
    CASE WHEN w.deleted = '1' THEN 1 ELSE 0 END AS is_deleted"""
NAMES = "src.option_name AS order_source_name, svc.option_name AS service_type_name, xpr.option_name AS express_type_name"


def base_sql(days: int) -> str:
    fresh = f"{local_day('update_time')} >= {B.DAY} - {days}"
    return f"""base AS (SELECT {local("o.input_time")} AS order_input_datetime, o.sender_province AS sender_province_name,
        o.sender_city AS sender_city_name, o.sender_district AS sender_district_name,
        o.recipient_province AS recipient_province_name, o.recipient_city AS recipient_city_name, o.recipient_address, {NAMES},
        o.waybill_no AS waybill_number, o.order_no AS order_number, o.ecommerce_order_no AS ecommerce_order_number,
        w.return_flag AS is_returned_flag, o.vip_customer_name AS customer_vip_name,
        CASE WHEN o.input_time IS NOT NULL THEN 1 ELSE 0 END AS is_order_created,
        CASE WHEN o.order_status = '03' OR w.waybill_no IS NOT NULL THEN 1 ELSE 0 END AS is_picked_up,
        CASE WHEN o.order_status = '04' THEN 1 ELSE 0 END AS is_order_canceled, {STATE},
        {local_day("w.update_time")} AS update_date, o.pickup_branch_name
        FROM (SELECT * FROM order_states WHERE {fresh}) o LEFT JOIN (SELECT * FROM waybill_states WHERE {fresh}) w
        ON w.waybill_no = o.waybill_no {DECODED.format("o.order_source", "o")}
        UNION ALL SELECT {local("w.create_time")}, w.sender_province_name, w.sender_city_name, w.sender_district_name,
        w.recipient_province_name, w.recipient_city_name, w.recipient_address, {NAMES}, w.waybill_no, w.order_no,
        w.ecommerce_order_no, w.return_flag, w.vip_customer_name, CASE WHEN w.shipping_time IS NOT NULL THEN 1 ELSE 0 END,
        1, 0, {STATE}, {local_day("w.update_time")}, w.pickup_branch_name
        FROM (SELECT * FROM waybill_states WHERE {fresh} AND waybill_source IN ('01', '03')) w
        {DECODED.format("w.waybill_source", "w")})"""


def scan_sql(days: int, waybill_days: int) -> str:
    head = "CASE WHEN regexp_matches({0}, '[^-]+') THEN regexp_extract({0}, '[^-]+') END"
    return f"""newest AS (SELECT * FROM scans WHERE {local_day("record_time")} >= {B.DAY} - {days}
        QUALIFY ROW_NUMBER() OVER (PARTITION BY waybill_no ORDER BY record_time DESC, operation_branch_name,
        origin_branch_name NULLS FIRST, destination_branch_name, operation_type, operation_user_name,
        problem_code NULLS FIRST, bag_no) = 1),
    codes_of_branches AS (SELECT branch_name, MIN(branch_no) AS branch_no FROM scan_branches GROUP BY 1),
    scanned AS (SELECT n.waybill_no AS waybill_number, w.sorting_code, n.operation_branch_name,
        t.option_name AS scan_operation_type, n.operation_user_name, n.destination_branch_name AS next_branch_name,
        {local("n.record_time")} AS last_scan_time,
        CASE WHEN contains(b.branch_no, '_') THEN regexp_extract(b.branch_no, '_(.*)', 1) END AS scan_branch_code,
        {head.format("a.sorting_code")} AS mh_origin_code, {head.format("w.sorting_code")} AS mh_destination_code,
        w.waybill_status, w.return_flag, x.register_reason_bahasa AS problem_reason, n.bag_no,
        n.operation_branch_name AS branch, n.origin_branch_name AS came_from, t.option_name AS scan,
        w.pickup_branch_name AS home, w.waybill_status AS state FROM newest n
        LEFT JOIN (SELECT * FROM waybill_states WHERE {local_day("update_time")} >= {B.DAY} - {waybill_days}) w
            ON w.waybill_no = n.waybill_no
        LEFT JOIN options t ON t.type_option = 'operationType' AND t.option_value = n.operation_type
        LEFT JOIN codes_of_branches b ON b.branch_name = n.operation_branch_name
        LEFT JOIN areas a ON a.name = w.sender_district_name LEFT JOIN problems x ON x.code = n.problem_code),
    latest AS (SELECT * EXCLUDE (branch, came_from, scan, home, state), {MILE_SQL} AS process_level FROM scanned)"""


FLAG_SQL = {
    "is_first_mile_arrived": "process_level = 'First Mile'",
    "is_mh_origin_arrived": "process_level = 'Medium Mile' AND scan_branch_code = mh_origin_code",
    "is_mh_transit": """process_level = 'Medium Mile'
        AND (scan_branch_code <> mh_origin_code OR scan_branch_code <> mh_destination_code)""",
    "is_mh_destination_arrived": "process_level = 'Medium Mile' AND scan_branch_code = mh_destination_code",
    "is_last_mile_arrived": "process_level = 'Last Mile'",
    "is_arrival_unknown": "process_level = 'Not Defined'",
}
ARRIVAL_SQL = f"""arrived AS (SELECT waybill_number, operation_branch_name, next_branch_name,
    {", ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END AS {n}" for n, c in FLAG_SQL.items())}
    FROM latest WHERE waybill_status NOT IN ('04', '06') AND return_flag = '0')"""


def monitoring_sql(days: int, scan_days: int) -> str:
    return with_views(MONITORING_VIEWS, f""", {base_sql(days)}, {scan_sql(scan_days, days)}, {ARRIVAL_SQL}
        SELECT b.*, l.last_scan_time, l.scan_operation_type, l.operation_branch_name AS last_scan_branch_name,
        l.next_branch_name, l.problem_reason, l.process_level, {", ".join("f." + n for n in FLAG_SQL)} FROM base b
        LEFT JOIN latest l ON l.waybill_number = b.waybill_number LEFT JOIN arrived f ON f.waybill_number = b.waybill_number""")


@query(monitoring_sql(14, 1))
def order_monitoring(s: Sample) -> DataFrame:
    return monitoring.order_monitoring(_tables(s, sample.MONITORING), FACTS_AS_OF)


@query(monitoring_sql(HISTORY, HISTORY))
def order_monitoring_history(s: Sample) -> DataFrame:
    return monitoring.order_monitoring(_tables(s, sample.MONITORING), FACTS_AS_OF, days=HISTORY, scan_days=HISTORY)


@query(with_views(["order_states", "waybill_states", "options"], f", {base_sql(HISTORY)} SELECT * FROM base"))
def order_base(s: Sample) -> DataFrame:
    return monitoring.order_base(_tables(s, sample.MONITORING), FACTS_AS_OF, days=HISTORY)


@query(with_views(MONITORING_VIEWS[1:], f", {scan_sql(HISTORY, HISTORY)} SELECT * FROM latest"))
def latest_scan(s: Sample) -> DataFrame:
    return monitoring.latest_scan(_tables(s, sample.MONITORING), FACTS_AS_OF, days=HISTORY, waybill_days=HISTORY)


@query(with_views(MONITORING_VIEWS[1:], f", {scan_sql(HISTORY, HISTORY)}, {ARRIVAL_SQL} SELECT * FROM arrived"))
def arrival_flags(s: Sample) -> DataFrame:
    scans = monitoring.latest_scan(_tables(s, sample.MONITORING), FACTS_AS_OF, days=HISTORY, waybill_days=HISTORY)
    return monitoring.arrival_flags(scans)


# --- finance extract, region, disbursement ----------------------------------------------

OMS_CODES = {
    "waybillSource": "waybill_source", "expressType": "express_type", "returnFlag": "return_flag",
    "podFlag": "pod_flag", "voidFlag": "void_flag", "paymentType": "payment_type",
}
OMS_SELECT = {
    "No_Waybill": "p.waybill_no", "Order_No": "p.order_no", "Sumber_Waybill": "waybillSource.option_name",
    "VIP_Username": "p.parent_shipping_cleint", "Sub_Akun": "p.vip_customer_name",
    "Tanggal_Pengiriman": local("p.shipping_time"), "Asal_Cabang": "p.pickup_branch_name",
    "Provinsi_Asal": "p.sender_province_name", "Kota_Asal": "p.sender_city_name",
    "Provinsi_Tujuan": "p.recipient_province_name", "Kota_Tujuan": "p.recipient_city_name",
    "Tujuan": "p.recipient_district_name", "Penerima": "p.recipient_name", "Nama_Item": "p.item_name",
    "Nilai_barang": "CAST(p.item_value AS DOUBLE)", "Tipe_Ekspres": "expressType.option_name",
    "Berat_Aktual": "p.item_actual_weight", "Kalkulasi_Berat": "p.item_calculated_weight",
    "Nominal_COD": "CAST(p.cod_amount AS DOUBLE)", "Biaya_Asuransi": "CAST(p.insurance_amount AS DOUBLE)",
    "Biaya_Standar_Pengiriman": "CAST(p.standard_shipping_fee AS DOUBLE)",
    "Biaya_Piutang_Pengiriman": "CAST(p.receivable_shipping_fee AS DOUBLE)",
    "Biaya_penanganan": "CAST(p.handling_fee AS DOUBLE)", "Biaya_Lain": "CAST(p.other_fee AS DOUBLE)",
    "Biaya_Total_Pengiriman": "CAST(p.total_shipping_fee AS DOUBLE)", "Status_Pembatalan": "voidFlag.option_name",
    "Waktu_Perekaman_POD": local("p.pod_record_time"), "Cabang_POD": "p.pod_branch_name",
    "Status_POD": "podFlag.option_name", "Waktu_Pengembalian": local("r.return_record_time"),
    "Waktu_Konfirmasi_Pengembalian": local("r.return_confirm_record_time"),
    "Waktu_POD_pengembalian": local("p.return_pod_record_time"), "Status_Pengembalian": "returnFlag.option_name",
    "Biaya_Return_Shipping": "CAST(r.return_shipping_fee AS DOUBLE)", "Tipe_Pembayaran": "paymentType.option_name",
    "Tanggal_Disetor": "bill.payment_date", "Using_Wallet": "CASE WHEN p.invoice_amount > 0 THEN 'YES' ELSE 'NO' END",
    "Deskripsi_Alasan_Retur": "rt.return_type", "Deskripsi": "r.description", "Pengirim": "p.sender_name",
    "No_HP_Pengirim": "p.sender_cellphone", "No_HP_Penerima": "p.recipient_cellphone",
    "Alamat_Penerima": "p.recipient_address", "Nilai_Klaim": "CAST(p.claim_value AS DOUBLE)",
    "Kurir_Pengiriman": "p.pod_courier_name", "update_time": local("p.update_time"),
    "tokopedia_transaction_type": B.decide(TYPE_ARMS, "NULL"),
    "SAP_BP_Code": "COALESCE(own.sap_bp_code, up.sap_bp_code)", "SAP_BP_Name": "COALESCE(own.sap_bp_name, up.sap_bp_name)",
}
OMS_VIEWS = [
    "parcels", "returns", "options", "return_types", "bill_waybills", "account_bills", "partner_orders",
    "marketplace_reported", "area_flags", "origin_pricing", "vip_customers",
]


def oms_sql(days: int) -> str:
    codes = "\n".join(
        f"LEFT JOIN options {kind} ON {kind}.type_option = '{kind}' AND {kind}.option_value = p.{column}"
        for kind, column in OMS_CODES.items()
    )
    return with_views(OMS_VIEWS, f"""SELECT {", ".join(f"{expr} AS {name}" for name, expr in OMS_SELECT.items())} FROM parcels p
        LEFT JOIN returns r ON r.waybill_no = p.waybill_no AND r.return_waybill_no = p.return_waybill_no
        LEFT JOIN return_types rt ON rt.id = r.return_type_id AND rt.deleted = 0 {codes} {TYPE_JOINS}
        LEFT JOIN bill_waybills bw ON bw.waybill_no = p.waybill_no LEFT JOIN account_bills bill ON bill.account_number = bw.account_number
        LEFT JOIN vip_customers own ON own.id = p.vip_customer_id LEFT JOIN vip_customers up ON up.id = own.vip_parent_id
        WHERE {local_day("p.update_time")} >= {B.DAY} - {days}""")


@query(oms_sql(62))
def oms_extract(s: Sample) -> DataFrame:
    return oms.finance_extract(_tables(s, sample.FINANCE), FACTS_AS_OF, dropship_start=DROPSHIP_START)


@query(oms_sql(HISTORY))
def oms_extract_history(s: Sample) -> DataFrame:
    return oms.finance_extract_in_passes(_tables(s, sample.FINANCE), FACTS_AS_OF, days=HISTORY, dropship_start=DROPSHIP_START)


def oms_aggregate_sql(days: int) -> str:
    return with_views(["parcels", "options"], f"""SELECT {local_day("pod_record_time")} AS pod_date, option_name AS waybill_source,
        CASE WHEN cod_amount > 0 THEN 'COD' ELSE 'Non COD' END AS cod_flag, COUNT(waybill_no) AS waybill,
        CAST(SUM(standard_shipping_fee) AS DOUBLE) AS standard_shipping_fee,
        CAST(SUM(total_shipping_fee) AS DOUBLE) AS total_shipping_fee,
        CAST(SUM(cod_amount) AS DOUBLE) AS cod_amount FROM parcels LEFT JOIN options ON type_option = 'waybillSource' AND
        option_value = waybill_source WHERE {local_day("update_time")} >= {B.DAY} - {days}
        AND {local_day("pod_record_time")} >= {B.DAY} - {days} GROUP BY 1, 2, 3""")


@query(oms_aggregate_sql(62))
def oms_aggregate(s: Sample) -> DataFrame:
    return oms.finance_aggregate(_tables(s, sample.FINANCE), FACTS_AS_OF)


@query(oms_aggregate_sql(HISTORY))
def oms_aggregate_history(s: Sample) -> DataFrame:
    return oms.finance_aggregate(_tables(s, sample.FINANCE), FACTS_AS_OF, days=HISTORY)


def finance_source_sql(alias: str) -> str:
    return f"""LEFT JOIN options c ON c.type_option = 'waybillSource' AND c.option_value = {alias}.waybill_source
        {B.source_columns("m", "c.option_name", f"{alias}.parent_shipping_cleint", "c.option_name = 'VIP Customer Portal'", "finance_mapping")}"""


PARENT_SQL = """CASE WHEN {0}.express_type = '06' AND m1.parent_source <> 'E-Commerce' THEN 'Cargo'
    WHEN m2.parent_source IS NOT NULL THEN m2.parent_source ELSE m1.parent_source END AS parent_source"""
CURRENT_SQL = f"""current AS (SELECT v.waybill_no, m1.waybill_source, {PARENT_SQL.format("v")},
    COALESCE(m2.finance_source_category, m1.finance_source_category) AS source_category, v.vip_customer_name AS vip_username,
    'INDONESIA' AS country, v.sender_province_name AS origin_province, v.sender_city_name AS origin_city,
    v.pickup_branch_name AS origin_branch, {local_day("v.shipping_time")} AS shipping_time,
    {local_day("v.pod_record_time")} AS pod_record_time, {local_day("v.return_pod_record_time")} AS return_pod_record_time
    FROM (SELECT * FROM parcels QUALIFY ROW_NUMBER() OVER (PARTITION BY waybill_no ORDER BY update_time DESC,
    waybill_source, vip_customer_name, parent_shipping_cleint, express_type, sender_province_name, sender_city_name,
    pickup_branch_name NULLS FIRST, shipping_time, pod_record_time NULLS FIRST, return_pod_record_time NULLS FIRST) = 1) v
    {finance_source_sql("v")})"""
NET = (
    "standard_shipping_fee", "cod_amount", "net_shipping_fee", "return_shipping_fee", "net_cod_fee", "handling_fee", "other_fee",
)


@query(with_views(["parcels", "options", "finance_mapping"], f", {CURRENT_SQL} SELECT * FROM current"))
def region_current_waybills(s: Sample) -> DataFrame:
    return region.current_waybills(_tables(s, sample.FINANCE))


@query(with_views(["parcels", "net_fees", "options", "finance_mapping"], f""", {CURRENT_SQL} SELECT DISTINCT
    COALESCE(w.pod_record_time, w.return_pod_record_time) AS pod_or_return_date, n.waybill_no, w.waybill_source, w.parent_source,
    w.source_category, w.vip_username, w.country, w.origin_province, w.origin_city, w.origin_branch,
    {double(*[f"n.{m}" for m in NET])} FROM net_fees n LEFT JOIN current w ON w.waybill_no = n.waybill_no"""))
def region_net(s: Sample) -> DataFrame:
    return region.net_by_region(_tables(s, sample.FINANCE))


PERIODIC_SQL = """SELECT pod_record_time, return_pod_record_time, calculated_date, waybill_source, parent_source,
    vip_customer_name, payment_type, CAST(SUM(count_transaction) AS BIGINT) AS count_transaction,
    CAST(SUM(net_shipping_fee) AS DOUBLE) AS net_shipping_fee FROM settled GROUP BY ALL"""
RECENT_PAYMENTS_SQL = f"""SELECT {local_day("p.pod_record_time")} AS pod_record_time,
    {local_day("p.return_pod_record_time")} AS return_pod_record_time,
    CAST({local_day("COALESCE(p.pod_record_time, p.return_pod_record_time)")} AS TIMESTAMP) AS calculated_date,
    c.option_name AS waybill_source, {PARENT_SQL.format("p")}, p.vip_customer_name,
    CASE WHEN p.payment_type = '00' THEN 'Cash' ELSE 'Wallet' END AS payment_type, COUNT(p.waybill_no) AS count_transaction,
    CAST(SUM(p.total_shipping_fee) AS DOUBLE) AS net_shipping_fee FROM parcels p {finance_source_sql("p")}
    WHERE {local_day("p.update_time")} >= {B.DAY} - 62 AND (p.payment_type = '00' OR p.invoice_amount > 0)
    AND ({local_day("p.pod_record_time")} >= {B.DAY} - 62 OR {local_day("p.return_pod_record_time")} >= {B.DAY} - 62) GROUP BY ALL"""


@query(with_views(["settled"], PERIODIC_SQL))
def disbursement_periodic(s: Sample) -> DataFrame:
    return disbursement.periodic(_tables(s, sample.FINANCE))


@query(with_views(["parcels", "options", "finance_mapping"], RECENT_PAYMENTS_SQL))
def disbursement_recent(s: Sample) -> DataFrame:
    return disbursement.cash_and_wallet(_tables(s, sample.FINANCE), FACTS_AS_OF)


@query(with_views(["parcels", "options", "finance_mapping", "settled"], f"{PERIODIC_SQL} UNION ALL {RECENT_PAYMENTS_SQL}"))
def disbursement_by_payment(s: Sample) -> DataFrame:
    return disbursement.disbursement_by_payment(_tables(s, sample.FINANCE), FACTS_AS_OF)


# --- virtual accounts -------------------------------------------------------------------

ACCOUNT_VIEWS = ["accounts", "account_log", "banks", "branches", "branch_areas", "account_corrections"]
CORRECTIONS_SQL = """corrected AS (SELECT correction_date, branch_id, SUM(correction_amount) AS correction_amount,
    string_agg(note, ',' ORDER BY note) AS note FROM account_corrections GROUP BY 1, 2)"""
BANK_SQL = """bank AS (SELECT account_number, bank_code, status_message, created_at FROM account_log QUALIFY ROW_NUMBER() OVER
    (PARTITION BY account_number ORDER BY created_at DESC, bank_code, status_message NULLS FIRST) = 1)"""
AGE = f"date_diff('day', a.create_va_date, {B.DAY})"
DETAIL_SQL = f"""{CORRECTIONS_SQL}, {BANK_SQL}, detail AS (SELECT a.id, a.account_number AS No_VA, v.bank_name AS Nama_Bank,
    CASE WHEN a.agent_branch_name = '' THEN up.branch_name ELSE a.agent_branch_name END AS Nama_Mitra,
    CASE WHEN a.branch_name = '' THEN own.branch_name ELSE a.branch_name END AS Nama_TH,
    COALESCE(x.wilayah, y.wilayah) AS wilayah, COALESCE(x.dm, y.dm) AS dm, own.branch_no AS Kode_TH,
    a.create_va_date AS Tanggal_Tagihan_VA, a.payment_date AS Tanggal_Pembayaran,
    CASE a.payment_status WHEN '0' THEN 'Not Paid' WHEN '1' THEN 'Paid' WHEN '2' THEN 'Expired' ELSE a.payment_status END
        AS Status_Transaksi,
    COALESCE(a.cod_amount, 0) AS va_cod_amount, COALESCE(a.cash_settlement_amount, 0) AS va_cash_settlement_amount,
    a.calculate_date AS Tanggal_Hitung, CAST(CASE WHEN a.payment_status = '1' THEN 0 ELSE {AGE} END AS INTEGER) AS overdue,
    {ageing_sql("a.payment_status = '1'", AGE)} AS bucket_collection, k.correction_amount, k.note, k.branch_id
    FROM accounts a LEFT JOIN bank b ON b.account_number = a.account_number LEFT JOIN banks v ON v.bank_code = b.bank_code
    LEFT JOIN branches own ON own.id = a.branch_id LEFT JOIN branches up ON up.id = own.agent_branch_id
    LEFT JOIN branch_areas x ON x.branch_name = a.branch_name LEFT JOIN branch_areas y ON y.branch_name = own.branch_name
    LEFT JOIN corrected k ON k.branch_id = a.branch_id AND k.correction_date = a.calculate_date
    WHERE CAST(a.payment_date AS DATE) >= {B.DAY} - 62 OR a.payment_status IN ('0', '2'))"""


@query(with_views(["account_corrections"], f""", {CORRECTIONS_SQL} SELECT correction_date, branch_id, note,
    {double("correction_amount")} FROM corrected"""))
def va_corrections(s: Sample) -> DataFrame:
    return virtual_accounts.corrections(_tables(s, sample.ACCOUNTS))


@query(with_views(["account_log"], f", {BANK_SQL} SELECT * FROM bank"))
def va_latest_bank(s: Sample) -> DataFrame:
    return virtual_accounts.latest_bank(_tables(s, sample.ACCOUNTS))


@query(with_views(ACCOUNT_VIEWS, f""", {DETAIL_SQL} SELECT * REPLACE
    ({double("va_cod_amount", "va_cash_settlement_amount", "correction_amount")}) FROM detail"""))
def va_detail(s: Sample) -> DataFrame:
    return virtual_accounts.va_detail(_tables(s, sample.ACCOUNTS), FACTS_AS_OF)


@query(with_views([*ACCOUNT_VIEWS, "account_waybills", "cash_waybills"], f""", {DETAIL_SQL}, legs AS (
    SELECT d.*, w.waybill_no, w.cod_amount AS cod, 0 AS cash FROM detail d JOIN account_waybills w
        ON w.branch_virtual_account_id = d.id AND w.cod_amount > 0
    UNION ALL SELECT d.*, c.waybill_no, 0, c.total_shipping_fee - c.other_fee FROM detail d JOIN cash_waybills c
        ON c.branch_virtual_account_id = d.id AND (c.total_shipping_fee > 0 OR c.insurance_amount > 0))
    SELECT id, No_VA, Nama_Bank, Nama_Mitra, Nama_TH, wilayah, dm, Kode_TH, Tanggal_Tagihan_VA, Tanggal_Pembayaran, Status_Transaksi,
    CAST(va_cod_amount + va_cash_settlement_amount + COALESCE(correction_amount, 0) AS DOUBLE) AS Total_Nominal,
    CAST(correction_amount AS DOUBLE) AS Nominal_Koreksi, note, branch_id, Tanggal_Hitung, overdue, bucket_collection, waybill_no,
    CAST(MAX(cod) AS DOUBLE) AS COD_Amount, CAST(MAX(cash) AS DOUBLE) AS Cash_Amount,
    CAST(MAX(cod) + MAX(cash) AS DOUBLE) AS Total_Waybill_Amount FROM legs WHERE Tanggal_Tagihan_VA IS NOT NULL GROUP BY ALL"""))
def va_monitoring(s: Sample) -> DataFrame:
    return virtual_accounts.va_monitoring(_tables(s, sample.ACCOUNTS), FACTS_AS_OF)


# --- wallet -----------------------------------------------------------------------------

WALLET_FLOOR = date(1996, 1, 1)
WALLET_VIEWS = [
    "wallets", "wallet_payments", "wallet_states", "wallet_waybills", "batch_waybills", "priced_orders", "priced_waybills",
    "priced_returns", "options",
]
FEES = {
    "standard_shipping_fee": "return_standard_shipping_fee", "insurance_amount": "insurance_amount", "other_fee": "other_fee",
    "handling_fee": "return_handling_fee", "total_shipping_fee": "return_shipping_fee",
}


def wallet_leg(name: str, link: str, batch: str) -> str:
    def pick(fee: str, returned: str) -> str:
        return f"""CASE origin WHEN 'change' THEN w_{fee} - o_{fee} WHEN 'waybill' THEN w_{fee}
            WHEN 'return' THEN r_{returned} ELSE o_{fee} END AS {fee}"""

    floor = "DATE '1996-01-01'"
    sides = ", ".join(f"o.{f} AS o_{f}, w.{f} AS w_{f}, r.{rf} AS r_{rf}" for f, rf in FEES.items())
    return f"""{name}_facts AS (SELECT u.shipping_client, h.tx_no, st.process_name AS tx_status, h.create_time AS tx_time,
        {local("o.pickup_record_time")} AS pickup_time, {local("w.pod_record_time")} AS pod_record_time,
        {local("w.return_pod_record_time")} AS return_pod_record_time, -h.amount AS amount, h.batch_id, o.waybill_no AS o_waybill,
        w.waybill_no AS w_waybill, x.option_name AS express_type, h.request_status, {sides},
        CASE WHEN h.tx_status = '03' AND w.standard_shipping_fee <> o.standard_shipping_fee THEN 'change'
            WHEN h.tx_status = '03' AND w.standard_shipping_fee = o.standard_shipping_fee THEN 'waybill'
            WHEN h.tx_status = '04' THEN 'waybill' WHEN h.tx_status = '06' THEN 'return' ELSE 'order' END AS origin
        FROM wallets u JOIN wallet_payments h ON h.wallet_id = u.id LEFT JOIN wallet_states st ON st.code = h.tx_status {link}
        JOIN priced_orders o ON o.waybill_no = t.waybill_no AND {local_day("o.input_time")} >= {floor}
        LEFT JOIN priced_waybills w ON w.waybill_no = t.waybill_no AND {local_day("w.shipping_time")} >= {floor}
        LEFT JOIN priced_returns r ON r.waybill_no = t.waybill_no AND r.return_waybill_no = w.return_waybill_no
        LEFT JOIN options x ON x.type_option = 'expressType' AND x.option_value = o.express_type
        WHERE h.tx_no IS NOT NULL AND {batch}),
    {name} AS (SELECT shipping_client, tx_no, tx_status, tx_time, pickup_time, pod_record_time, return_pod_record_time, amount,
        batch_id, CASE WHEN origin = 'change' THEN w_waybill ELSE o_waybill END AS waybill_no, o_waybill,
        {", ".join(pick(f, rf) for f, rf in FEES.items())}, express_type, request_status FROM {name}_facts)"""


def _share(total: str, amount: str, standard: str) -> str:
    return f"CAST({total} - ABS({amount}) AS DOUBLE) / NULLIF(CAST({standard} AS DOUBLE), 0)"


TRANSACTIONS_SQL = f"""{wallet_leg("singles", "JOIN wallet_waybills t ON t.wallet_history_id = h.id", "h.batch_id = ''")},
    {wallet_leg("batches", "JOIN batch_waybills t ON t.batch_id = h.batch_id", "h.batch_id <> ''")},
    ranked AS (SELECT *, RANK() OVER (PARTITION BY batch_id ORDER BY o_waybill) AS batch_rank,
        SUM(standard_shipping_fee) OVER whole AS all_standard, SUM(total_shipping_fee) OVER whole AS all_total,
        SUM(ABS(standard_shipping_fee)) OVER whole AS abs_standard, SUM(ABS(total_shipping_fee)) OVER whole AS abs_total
        FROM batches WINDOW whole AS (PARTITION BY batch_id)),
    transactions AS (SELECT * EXCLUDE (o_waybill), NULL AS batch_rank, amount AS filtered_amount,
        standard_shipping_fee AS batch_standard_shipping_fee, total_shipping_fee AS batch_total_shipping_fee,
        ABS({_share("ABS(total_shipping_fee)", "amount", "ABS(standard_shipping_fee)")}) AS discount_rate FROM singles
    UNION ALL BY NAME SELECT * EXCLUDE (o_waybill, all_standard, all_total, abs_standard, abs_total),
        CASE WHEN batch_rank = 1 THEN amount END AS filtered_amount,
        CASE WHEN batch_rank = 1 THEN all_standard END AS batch_standard_shipping_fee,
        CASE WHEN batch_rank = 1 THEN all_total END AS batch_total_shipping_fee,
        {_share("abs_total", "amount", "abs_standard")} AS discount_rate FROM ranked)"""
WALLET_MONEY = (
    "amount", "filtered_amount", "standard_shipping_fee", "insurance_amount", "other_fee", "handling_fee", "total_shipping_fee",
    "batch_standard_shipping_fee", "batch_total_shipping_fee",
)
WALLET_SHOWN = f"""SELECT * REPLACE ({double(*WALLET_MONEY)}, CAST(batch_rank AS BIGINT) AS batch_rank)"""
DISCOUNT = """CASE WHEN batch_rank >= 1 THEN CAST(ABS(standard_shipping_fee) AS DOUBLE) * discount_rate
    ELSE CAST(ABS(total_shipping_fee) - ABS(filtered_amount) AS DOUBLE) END"""


@query(with_views(WALLET_VIEWS, f", {TRANSACTIONS_SQL} {WALLET_SHOWN} FROM transactions"))
def wallet_transactions(s: Sample) -> DataFrame:
    return wallet.wallet_transactions(_tables(s, sample.WALLET), floor=WALLET_FLOOR)


@query(with_views(WALLET_VIEWS, f""", {TRANSACTIONS_SQL}, netted AS (SELECT *,
    CASE WHEN waybill_no IS NOT NULL THEN {DISCOUNT} END AS discount_amount,
    CASE WHEN waybill_no IS NOT NULL AND total_shipping_fee < 0 THEN CAST(total_shipping_fee AS DOUBLE) + {DISCOUNT}
        WHEN waybill_no IS NOT NULL AND total_shipping_fee >= 0 THEN CAST(total_shipping_fee AS DOUBLE) - {DISCOUNT} END
        AS net_shipping_fee FROM transactions) {WALLET_SHOWN} FROM netted"""))
def wallet_net(s: Sample) -> DataFrame:
    return wallet.wallet_net(wallet.wallet_transactions(_tables(s, sample.WALLET), floor=WALLET_FLOOR))


@query(with_views(WALLET_VIEWS, f""", {TRANSACTIONS_SQL} {WALLET_SHOWN} FROM transactions"""))
def wallet_transactions_sliced(s: Sample) -> DataFrame:
    """The same rows; every batch is cut into slices, whatever its size."""
    return wallet.wallet_transactions(_tables(s, sample.WALLET), floor=WALLET_FLOOR)
