"""The journey row of a tracking id is found without pairing all its orders with all its tracking rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelledger.plans import journey
from parcelledger.sources import Tables

AS_OF, LOADED = date(2024, 1, 31), datetime(2024, 1, 31, 7)
DAY = datetime(2024, 1, 29, 12)
ORDERS = (
    "tracking_id string, order_id string, ext_order_id string, order_time timestamp, sender_name string, sender_contact string,"
    " channel_id string, service_id string, status_id string, status string, handled_by string, partner_handler string,"
    " pickup_start timestamp, pickup_end timestamp, pickup_time timestamp, target_hub string, pickup_hub string,"
    " failed_pickup_time timestamp, failed_reason_id string, updated_at timestamp"
)


def _tables(spark, orders: list, tracking: list, ids: list[str], events: list) -> Tables:
    frame = spark.createDataFrame
    places = [(i, DAY, "L1", ["DEFAULT", "OTHER", None][n % 3], "loc", "street") for n, i in enumerate(ids)]
    data = {
        "source_table": frame(places, "tracking_id string, created_time timestamp, loc_code string, partner_name string, loc_name string, loc_address string"),
        "location_ref": frame([("L1", "A", "R1")], "code string, partner_type string, region_id string"),
        "region_ref": frame([("R1", "p", "c", "d")], "district_id string, province string, city string, district string"),
        "orders": frame(orders, ORDERS),
        "tracking": frame(tracking, "tracking_id string, cancel_flag string, pickup_logged timestamp, pod_time timestamp, updated_at timestamp"),
        "event_table": frame(events, "tracking_id string, event_time timestamp, evt_type string, source_hub string, next_hub string"),
        "dropoff_table": frame([], "tracking_id string, event_time timestamp, source_hub string"),
        "options": frame([("1", "Batal"), ("2", "Batal"), ("3", "A"), ("s1", "Open"), ("s2", "Zzz")], "option_id string, val string"),
        "failures": frame([("f1", "late"), ("f2", "away")], "id string, reason string"),
    }
    return Tables(data)


def _order(dice, key: str, many: int) -> tuple:
    at = [None, DAY, DAY + timedelta(hours=1)]
    return (
        key, dice.choice([None, "o1", "o1", *(f"o{n}" for n in range(many))]), "x", dice.choice(at), f"n{dice.randrange(9)}", "c", "c1",
        "v1", dice.choice(["s1", "s2", None]), dice.choice(["04", "01", None]), dice.choice(["THIRDPARTY", "own", None]),
        dice.choice(["DEFAULT", "P", None]), None, None, dice.choice(at), "t", dice.choice(["MH1", "X1"]), None,
        dice.choice(["f1", "f2", None]), DAY,
    )


def _tracking(dice, key: str) -> tuple:
    at = [None, DAY, DAY + timedelta(hours=1), DAY + timedelta(days=1)]
    return (key, dice.choice(["1", "2", "3", None]), dice.choice(at), dice.choice(at), DAY)


@pytest.mark.parametrize("seed", [1, 2])
def test_candidates_give_the_row_of_all_pairs(spark, seed, monkeypatch):
    dice = random.Random(seed)
    ids = [f"t{n}" for n in range(150)]
    orders = [_order(dice, i, 2) for i in ids for _ in range(dice.randrange(5))]
    tracking = [_tracking(dice, i) for i in ids for _ in range(dice.randrange(5))]
    events = [
        (i, DAY + timedelta(minutes=dice.randrange(90)), dice.choice(["61", "02", "04", "09"]), dice.choice(["MH1", "X1", "DC2"]), "n")
        for i in ids for _ in range(dice.randrange(3))
    ]
    tables = _tables(spark, orders, tracking, ids, events)
    keys = [
        "tracking_id", "event_time", "delivery_time", "order_id", "pod_time", "pickup_event_time", "cancel_status", "order_time",
        "order_status", "failed_reason", "delivery_status", "arrival_time",
    ]

    def run():
        rows = journey.order_journey(tables, journey.full_window(AS_OF), AS_OF, LOADED)
        return sorted((tuple(r[k] for k in keys if k != "delivery_status") for r in rows.select(keys).collect()), key=repr)

    got = run()
    monkeypatch.setattr(journey, "_order_candidates", lambda df: df.withColumn("by_carrier", journey._carrier_event()))
    monkeypatch.setattr(journey, "_tracking_candidates", lambda df: df)
    assert got == run() and len(got) == len(ids)


def test_a_hot_id_stays_linear(spark):
    dice = random.Random(3)
    orders = [_order(dice, "hot", 4000) for _ in range(4000)]
    tracking = [_tracking(dice, "hot") for _ in range(4000)]
    tables = _tables(spark, orders, tracking, ["hot"], [("hot", DAY, "02", "MH1", "n")])
    window = journey.full_window(AS_OF)
    # At most four orders meet at most two tracking rows, of sixteen million pairs.
    assert journey._joined(tables, window).count() <= 8
    assert journey.order_journey(tables, window, AS_OF, LOADED).count() == 1


def test_touched_ids_are_cut_out_of_every_source_first(spark):
    dice = random.Random(5)
    ids = [f"t{n}" for n in range(40)]
    orders, tracking = [_order(dice, i, 2) for i in ids], [_tracking(dice, i) for i in ids]
    events = [("t3", datetime(2024, 1, 30, 3), "61", "MH1", "n"), ("t4", datetime(2024, 1, 20), "61", "MH1", "n")]
    tables = _tables(spark, orders, tracking, ids, events)
    touched = journey.changed_ids(tables, journey.delta_window(AS_OF))
    assert [r[0] for r in touched.collect()] == ["t3"]
    full = journey.order_journey(tables, journey.full_window(AS_OF), AS_OF, LOADED)
    part = journey.order_journey(tables, journey.full_window(AS_OF), AS_OF, LOADED, only=touched)
    assert part.collect() == full.filter(F.col("tracking_id") == "t3").collect()
