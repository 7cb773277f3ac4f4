"""Order journey: one row per tracking id, as a full load or a daily delta."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import Rule, day_age, first_match, has_prefix, local_date, local_datetime
from parcelledger.functions.time import JAKARTA, months_before
from parcelledger.operators import earliest_by, latest_by, lookup, pick_first, since
from parcelledger.operators.filters import within_days
from parcelledger.plans import fixed_values as V
from parcelledger.sources.tables import Tables

KEY = "tracking_id"
DEFAULT_PARTNER = "DEFAULT"
THIRD_PARTY = "THIRDPARTY"


@dataclass(frozen=True)
class Window:
    """Which events, orders and tracking rows a load reads."""

    events: Callable[[str], Column]
    orders: Callable[[str], Column]
    tracking: Callable[[str], Column]


def full_window(as_of: date, tz: str = JAKARTA, months: int = 3, order_months: int = 6) -> Window:
    """Initial load: three months of events and tracking, six months of orders."""
    recent_rows = months_before(as_of, months)
    order_rows = months_before(as_of, order_months)
    return Window(
        events=lambda c: since(c, recent_rows, tz),
        orders=lambda c: since(c, order_rows, tz),
        tracking=lambda c: since(c, recent_rows, tz),
    )


def delta_window(as_of: date, tz: str = JAKARTA) -> Window:
    """Daily load: events of yesterday, orders and tracking changed since yesterday."""
    yesterday = as_of - timedelta(days=1)
    return Window(
        events=lambda c: within_days(c, yesterday, yesterday, tz),
        orders=lambda c: since(c, yesterday, tz),
        tracking=lambda c: since(c, yesterday, tz),
    )


def latest_location(tables: Tables) -> DataFrame:
    """Newest registration per tracking id with its partner type and region.

    The choice depends on the registration alone, so it is made before the lookups.
    """
    cols = ["loc_code", "partner_name", "loc_name", "loc_address"]
    newest = latest_by(tables["source_table"].select(KEY, "created_time", *cols), [KEY], "created_time", ties=cols)
    placed = lookup(
        newest, tables["location_ref"], {"code": "loc_code"},
        {"partner_type": "partner_type", "region_id": "region_id"}, single=True,
    )
    return lookup(
        placed, tables["region_ref"], {"district_id": "region_id"},
        {"province": "province", "city": "city", "district": "district"}, single=True,
    ).drop("region_id")


def first_dropoff(dropoffs: DataFrame, window: Window, tz: str = JAKARTA) -> DataFrame:
    """First drop-off scan per tracking id, in local time."""
    rows = dropoffs.filter(window.events("event_time")).select(KEY, "source_hub", "event_time")
    first = earliest_by(rows, [KEY], "event_time", ties=["source_hub"])
    return first.withColumn("event_time", local_datetime("event_time", tz))


def event_milestones(events: DataFrame, window: Window) -> DataFrame:
    """(arrival, summary) of every tracking id from one scan and one shuffle.

    ``arrival`` is the first scan at a main hub, ``summary`` the handover event, else the earliest relevant one. Both
    choices are minima, so they are combined map-side and a hot tracking id costs one row per task.
    """
    at_hub = has_prefix("source_hub", V.ARRIVAL_HUB_PREFIXES)
    relevant = F.col("evt_type").isin(*V.SUMMARY_EVENTS)
    place = F.when(F.col("evt_type") == V.EVENT_HANDOVER, 0).otherwise(1).alias("place")
    choice = F.struct(place, "event_time", "evt_type", "source_hub", F.col("next_hub").alias("next_location"))
    return (
        events.filter(window.events("event_time") & (at_hub | relevant))
        .groupBy(KEY)
        .agg(
            F.min(F.when(at_hub, F.struct("event_time", "source_hub"))).alias("arrival"),
            F.min(F.when(relevant, choice)).alias("summary"),
        )
    )


def first_hub_arrival(events: DataFrame, window: Window, tz: str = JAKARTA) -> DataFrame:
    """First scan at a main hub per tracking id, in local time."""
    found = event_milestones(events, window).filter("arrival is not null")
    return found.select(KEY, "arrival.source_hub", local_datetime("arrival.event_time", tz).alias("event_time"))


def summary_event(events: DataFrame, window: Window) -> DataFrame:
    """The handover event of a tracking id, else its earliest relevant event."""
    found = event_milestones(events, window).filter("summary is not null")
    return found.select(KEY, *[f"summary.{c}" for c in ("evt_type", "source_hub", "next_location", "event_time")])


def changed_ids(tables: Tables, window: Window) -> DataFrame:
    """Tracking ids with a registration, order, tracking row, event or drop-off in the window, once each."""
    touched = [
        tables["source_table"].filter(window.orders("created_time")),
        tables["orders"].filter(window.orders("updated_at")),
        tables["tracking"].filter(window.tracking("updated_at")),
        tables["event_table"].filter(window.events("event_time")),
        tables["dropoff_table"].filter(window.events("event_time")),
    ]
    return reduce(DataFrame.union, [t.select(KEY) for t in touched]).filter(F.col(KEY).isNotNull()).distinct()


def _only(tables: Tables, ids: DataFrame | None) -> Tables:
    """The sources of the journey, cut down to some tracking ids before anything else happens to them."""
    if ids is None:
        return tables
    names = ("source_table", "orders", "tracking", "event_table", "dropoff_table")
    return tables.with_tables(**{n: tables[n].join(ids, KEY, "left_semi") for n in names})


def _partner() -> Column:
    return F.when(F.col("handled_by") == THIRD_PARTY, F.col("partner_handler")).otherwise(F.col("partner_name"))


def _carrier_event() -> Column:
    """Whether the summary event tells the delivery: it depends on the order, and not on its tracking rows."""
    kind = F.col("summary.evt_type")
    handed_over = (_partner() != DEFAULT_PARTNER) & (kind == V.EVENT_HANDOVER)
    at_pickup_hub = F.col("summary.source_hub") == F.col("pickup_hub")
    collected = (_partner() == DEFAULT_PARTNER) & kind.isin(V.EVENT_PICKED_UP, V.EVENT_DISPATCHED) & at_pickup_hub
    return F.coalesce(handed_over | collected, F.lit(False))


def _order_candidates(df: DataFrame) -> DataFrame:
    """Of the orders of a tracking id those that can be in its first row, four at most.

    The first row has the least delivery time, then order, then what the tracking row says, then order time, status and
    reason. Orders whose carrier event tells the delivery all have one delivery time, the others all that of the tracking
    row; so within either kind the first order wins whatever it is paired with. Only whether a cancelled tracking row hides
    the status is open: both cases have a candidate. They are minima, combined map-side.
    """
    rest = sorted(set(df.columns) - {KEY, "order_id", "order_time", "status_name", "failed_reason"})
    shown = F.struct("order_id", "order_time", "status_name", "failed_reason", *rest)
    hidden = F.struct("order_id", "order_time", "failed_reason", "status_name", *rest)
    best = df.groupBy(KEY, _carrier_event().alias("by_carrier")).agg(F.min(shown).alias("shown"), F.min(hidden).alias("hidden"))
    same = F.struct(*[F.col(f"hidden.{f}").alias(f) for f in ("order_id", "order_time", "status_name", "failed_reason", *rest)])
    return best.select(KEY, "by_carrier", F.explode(F.array_distinct(F.array("shown", same))).alias("row")).select(
        KEY, "by_carrier", "row.*"
    )


def _tracking_candidates(tracking: DataFrame) -> DataFrame:
    """Of the tracking rows of an id the first one that is cancelled, and the first that is not.

    Whatever the order, the delivery time is fixed or rises with the time of delivery, so the first row is the least by
    that time, pickup and cancellation.
    """
    place = F.struct("pod_time", "pickup_logged", "cancel_status", "cancel_flag")
    cancelled = F.coalesce(F.col("cancel_flag") == "1", F.lit(False))
    return tracking.groupBy(KEY, cancelled.alias("cancelled")).agg(F.min(place).alias("row")).select(KEY, "row.*")


def _joined(tables: Tables, window: Window) -> DataFrame:
    """Locations with milestones, and the orders and tracking states of which one pair makes the row."""
    base = latest_location(tables).filter(F.col("partner_type").isin(*V.JOURNEY_PARTNER_TYPES))
    orders = tables["orders"].filter(window.orders("updated_at"))
    tracking = tables["tracking"].filter(window.tracking("updated_at"))
    drops = tables["dropoff_table"].filter(window.events("event_time"))
    first_drops = drops.groupBy(KEY).agg(F.min("event_time").alias("dropoff_at"))
    options = tables["options"]

    order_columns = [
        "order_id", "ext_order_id", "order_time", "sender_name", "sender_contact", "channel_id",
        "service_id", "status_id", "status", "handled_by", "partner_handler", "pickup_start",
        "pickup_end", "pickup_time", "target_hub", "pickup_hub", "failed_pickup_time", "failed_reason_id",
    ]
    df = lookup(base, event_milestones(tables["event_table"], window), {KEY: KEY}, {c: c for c in ("arrival", "summary")})
    df = lookup(df, first_drops, {KEY: KEY}, {"dropoff_at": "dropoff_at"})
    df = lookup(df, orders, {KEY: KEY}, {c: c for c in order_columns})
    df = lookup(df, options, {"option_id": "status_id"}, {"status_name": "val"})
    df = lookup(df, tables["failures"], {"id": "failed_reason_id"}, {"failed_reason": "reason"})
    states = lookup(
        tracking.select(KEY, "cancel_flag", "pickup_logged", "pod_time"),
        options, {"option_id": "cancel_flag"}, {"cancel_status": "val"},
    )
    state_columns = ("cancel_flag", "pickup_logged", "pod_time", "cancel_status")
    df = lookup(_order_candidates(df), _tracking_candidates(states), {KEY: KEY}, {c: c for c in state_columns})
    for code, name in (("channel_id", "channel"), ("service_id", "service_type")):
        df = lookup(df, options, {"option_id": code}, {name: "val"})
    return df


def order_journey(
    tables: Tables,
    window: Window,
    as_of: date,
    loaded_at: datetime,
    tz: str = JAKARTA,
    only: DataFrame | None = None,
) -> DataFrame:
    """Journey rows of the mart; ``loaded_at`` stamps the load.

    With ``only``, a table of tracking ids, all sources are cut down to these first: with ``changed_ids`` of yesterday
    and the window of a full load, the rows are those of a full load that can differ from the day before.
    """
    df = _joined(_only(tables, only), window)
    third_party = F.col("handled_by") == THIRD_PARTY
    own, foreign = _partner() == DEFAULT_PARTNER, _partner() != DEFAULT_PARTNER
    kind = F.col("summary.evt_type")
    handed_over = foreign & (kind == V.EVENT_HANDOVER)
    delivered = F.col("pod_time").isNotNull()
    delivery_time = first_match(
        [
            Rule("carrier event", F.col("by_carrier"), local_datetime("summary.event_time", tz)),
            Rule("proof of delivery", delivered, local_datetime("pod_time", tz)),
        ]
    )
    delivery_status = first_match(
        [
            Rule("handover", handed_over, F.lit("Handover Complete")),
            Rule("dispatch", own & (kind == V.EVENT_DISPATCHED), F.lit("Dispatched")),
            Rule("delivery", delivered, F.lit("Delivered")),
        ]
    )
    waiting = F.col("pickup_logged").isNull() & (F.col("status") != "04")
    rows = df.select(
        KEY,
        "order_id",
        "ext_order_id",
        local_datetime("order_time", tz).alias("order_time"),
        "sender_name",
        "sender_contact",
        "channel",
        "service_type",
        F.col("province").alias("sender_province"),
        F.col("city").alias("sender_city"),
        F.col("district").alias("sender_district"),
        local_datetime("created_time", tz).alias("event_time"),
        F.col("loc_name").alias("source_hub"),
        "loc_address",
        "loc_code",
        "partner_type",
        F.when(third_party, F.col("partner_handler")).otherwise(DEFAULT_PARTNER).alias("final_partner"),
        local_datetime("pickup_start", tz).alias("pickup_start"),
        local_datetime("pickup_end", tz).alias("pickup_end"),
        F.when(F.col("cancel_flag") == "1", "Canceled").otherwise(F.col("status_name")).alias("order_status"),
        local_datetime("pickup_logged", tz).alias("pickup_event_time"),
        F.when(F.col("pickup_time").isNull(), F.col("target_hub")).otherwise(F.col("pickup_hub")).alias("pickup_target"),
        F.when(waiting, day_age(local_date("created_time", tz), as_of)).alias("backlog_days"),
        delivery_time.alias("delivery_time"),
        delivery_status.alias("delivery_status"),
        local_datetime("pod_time", tz).alias("pod_time"),
        F.col("failed_pickup_time").cast("timestamp_ntz").alias("failed_pickup_time"),
        "failed_reason",
        "cancel_status",
        F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("data_timestamp"),
        local_datetime("arrival.event_time", tz).alias("arrival_time"),
        local_datetime("dropoff_at", tz).alias("dropoff_time"),
    )
    order = (
        "event_time", "delivery_time", "order_id", "pod_time", "pickup_event_time",
        "cancel_status", "order_time", "order_status", "failed_reason",
    )
    return pick_first(rows, [KEY], [F.col(c).asc_nulls_first() for c in order])
