from __future__ import annotations

import random
import subprocess
import sys
from collections import defaultdict
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelledger.functions import amount, months_before, utc_bound
from parcelledger.operators import (
    concat_notes,
    differing_buckets,
    duplicate_keys,
    earliest_by,
    find_differences,
    latest_by,
    lookup,
    merged_rows,
    merge_upsert,
    on_days,
    pick_first,
    ranked_with_totals,
    recent,
    reconcile,
    running_sums,
    tier_lookup,
)
from parcelledger.operators import hot_groups
from parcelledger.sources import Tables, append_load, create_version_table, read_version, scratch_dir, versions
from parcelledger.sources.versions import latest_version


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- one row per key --------------------------------------------------------------------

def test_latest_and_earliest_settle_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", None, "n"), ("b", 1, "m"), (None, 5, "k")],
        "key string, at int, tie string",
    )
    assert rows(latest_by(df, ["key"], "at", ties=["tie"])) == [("a", 2, "y"), ("b", 1, "m"), (None, 5, "k")]
    # Ascending order puts a missing time first.
    assert rows(earliest_by(df, ["key"], "at", ties=["tie"])) == [("a", 1, "x"), ("b", None, "n"), (None, 5, "k")]


def test_pick_first_by_priority(spark):
    df = spark.createDataFrame([("a", "02", 1), ("a", "61", 9), ("b", "09", 3)], "key string, kind string, at int")
    preferred = F.when(F.col("kind") == "61", 0).otherwise(1)
    assert rows(pick_first(df, ["key"], [preferred, F.col("at")])) == [("a", "61", 9), ("b", "09", 3)]


# --- lookups ----------------------------------------------------------------------------

def test_lookup_gate_keeps_left_rows_and_multiplies_on_duplicates(spark):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id int, k string")
    right = spark.createDataFrame([("a", "one"), ("a", "two")], "k string, v string")
    got = lookup(left, right, {"k": "k"}, {"v": "v"}, gate=F.col("id") != 2)
    assert rows(got) == [(1, "a", "one"), (1, "a", "two"), (2, "a", None), (3, None, None)]
    assert rows(lookup(left, right, {"k": "k"}, {"v": "v"}, single=True)) == [
        (1, "a", "one"), (2, "a", "one"), (3, None, None),
    ]


def test_lookup_spreads_rows_without_key(spark):
    left = spark.createDataFrame([(i, None if i % 3 else f"k{i}") for i in range(60)], "id int, k string")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(0, 60, 6)] + [(None, -1)], "k string, v int")
    plain = lookup(left, right, {"k": "k"}, {"v": "v"})
    spread = lookup(left, right, {"k": "k"}, {"v": "v"}, spread_nulls_by="id")
    assert rows(plain) == rows(spread)


def test_lookup_refuses_to_hide_a_column(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ValueError, match="exist already"):
        lookup(df, df, {"id": "id"}, {"v": "v"})


def test_tier_lookup_bounds_gaps_overlaps_and_far_values(spark):
    tiers = spark.createDataFrame(
        [(Decimal(low), Decimal(high), name) for low, high, name in (
            ("0", "1", "A"), ("1", "2.5", "B"), ("4", "300", "C"), ("280.5", "900", "D"), ("70000.5", "9000000", "G"), ("-5", "-1", "E"), ("9", "8", "F"),
        )],
        "Bottom decimal(18,4), Up decimal(18,4), name string",
    )
    weights = ["0", "1", "1.5", "2.5", "2.6", "4", "256", "257", "290", "899.9", "901", "70000.4", "70000.5", "9000000", "-2", None]
    df = spark.createDataFrame([(w,) for w in weights], "w string").withColumn("w", amount("w"))
    got = defaultdict(set)
    for w, name in tier_lookup(df, tiers, "w", {"name": "name"}).collect():
        got[None if w is None else str(w.normalize() + 0)].add(name)
    assert got["0"] == {"A"}
    assert got["1"] == {"A", "B"}
    assert got["1.5"] == {"B"} and got["2.5"] == {"B"}
    assert got["2.6"] == {None}
    assert got["4"] == {"C"}
    assert {k: v for k, v in got.items() if k and k.startswith(("25", "2.56"))}
    assert got["290"] == {"C", "D"} and got["899.9"] == {"D"} and got["901"] == {None}
    assert got["70000.4"] == {None} and got["70000.5"] == {"G"} and got["9000000"] == {"G"}
    assert got["-2"] == {"E"} and got[None] == {None}


# --- windows over hot groups ------------------------------------------------------------

def test_sliced_ranks_equal_windows(spark):
    dice = random.Random(7)
    data = [("hot", f"w{dice.randrange(300)}", Decimal(dice.randrange(100))) for _ in range(2000)]
    data += [(f"g{dice.randrange(40)}", f"w{dice.randrange(20)}", Decimal(dice.randrange(100))) for _ in range(800)]
    data += [("hot", "same", Decimal(1))] * 700 + [(None, "n", Decimal(2))] * 3 + [("gap", None, None), ("gap", "a", Decimal(4))]
    df = spark.createDataFrame(data, "g string, o string, v decimal(18,4)")
    totals = {"total": F.col("v"), "twice": F.col("v") * 2}
    group = Window.partitionBy("g")
    whole = df.select(
        "g", "o", "v", F.rank().over(group.orderBy("o")).cast("long").alias("place"),
        F.sum("v").over(group).alias("total"), F.sum(F.col("v") * 2).over(group).alias("twice"),
    )
    for slices in (1, 16, 1024):
        sliced = ranked_with_totals(df, "g", "o", totals, "place", slices=slices)
        assert rows(whole) == rows(sliced.select("g", "o", "v", "place", "total", "twice"))
    # Bounds of another table give the same ranks.
    other = spark.range(50).select(F.lit("hot").alias("g"), F.format_string("w%d", "id").alias("o"))
    sliced = ranked_with_totals(df, "g", "o", totals, "place", bounds_from=other)
    assert rows(whole) == rows(sliced.select("g", "o", "v", "place", "total", "twice"))
    assert ranked_with_totals(df.limit(0), "g", "o", totals, "place").count() == 0


def test_rows_outside_the_condition_have_no_rank(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("", 1), ("", 2), (None, 5)], "g string, o int")
    ranked = ranked_with_totals(df, "g", "o", {"n": F.lit(1)}, "place", where=F.col("g") != "")
    assert rows(ranked.select("g", "o", "place", "n")) == rows(
        spark.createDataFrame(
            [("a", 1, 1, 2), ("a", 2, 2, 2), ("", 1, None, None), ("", 2, None, None), (None, 5, None, None)],
            "g string, o int, place long, n long",
        )
    )


def test_hot_group_is_cut_into_slices(spark):
    df = spark.range(20000).select(F.lit("hot").alias("g"), F.format_string("w%06d", "id").alias("o"))
    sliced = ranked_with_totals(df, "g", "o", {}, "place")
    assert sliced.select(F.max("place"), F.count_distinct("place")).first()[:] == (20000, 20000)
    # No slice holds more than a small part of the group.
    held = hot_groups._sliced(df, "g", "o", None, None, 64).groupBy(hot_groups.HOME).count()
    assert held.agg(F.max("count")).first()[0] < 20000 * 8 / 64 and held.count() > 32
    ties = spark.range(9000).select(
        F.lit("hot").alias("g"), F.when(F.col("id") < 8000, "b").when(F.col("id") < 8500, "a").otherwise("c").alias("o"), "id"
    )
    ranked = ranked_with_totals(ties, "g", "o", {"n": F.lit(1)}, "place")
    assert rows(ranked.groupBy("o", "place", "n").count()) == [
        ("a", 1, 9000, 500), ("b", 501, 9000, 8000), ("c", 8501, 9000, 500),
    ]


def test_running_sums_equal_windows(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.xxhash64("id").alias("o"), (F.col("id") % 11).alias("v"),
    )
    before = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    whole = df.select("g", "o", "v", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("sum_before"))
    assert rows(whole) == rows(running_sums(df, "g", "o", {"sum_before": F.col("v")}))


# --- aggregation ------------------------------------------------------------------------

def test_concat_notes_against_brute_force(spark):
    dice = random.Random(3)
    data = [(dice.randrange(4), dice.choice(["b", "a", "", None, "c,c"]), dice.randrange(9)) for _ in range(300)]
    data += [(9, None, 1)]
    df = spark.createDataFrame(data, "k int, note string, v int")
    expected = []
    for k in {d[0] for d in data}:
        notes = sorted(n for g, n, _ in data if g == k and n is not None)
        expected.append((k, sum(v for g, _, v in data if g == k), ",".join(notes) if notes else None))
    assert rows(concat_notes(df, ["k"], "note", ["v"])) == sorted(expected, key=repr)


def test_reconcile_statuses(spark):
    raw = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5), (None, 4), ("c", 1)], "k string, v int")
    report = spark.createDataFrame([("a", 3), ("b", 6), (None, 4), ("d", 2)], "k string, v int")
    got = reconcile(raw, report, ["k"], {"v": (F.sum("v"), F.sum("v"))})
    assert {(r.k, r.v_diff, r.status) for r in got.collect()} == {
        ("a", 0, "match"), ("b", -1, "difference"), (None, 0, "match"),
        ("c", 1, "missing in report"), ("d", -2, "missing in raw"),
    }


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2)]


# --- time windows -----------------------------------------------------------------------

def test_local_day_edges(spark):
    # Jakarta is seven hours ahead: its day starts at 17:00 UTC of the day before.
    stamps = ["2024-01-29 16:59:59", "2024-01-29 17:00:00", "2024-01-30 16:59:59", "2024-01-30 17:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz").alias("at"))
    assert [str(r[0]) for r in on_days(df, "at", date(2024, 1, 31)).orderBy("at").collect()] == stamps[1:3]
    assert recent(df, "at", 1, date(2024, 1, 31)).count() == 3
    instants = df.select(F.col("at").cast("timestamp").alias("at"))
    assert on_days(instants, "at", date(2024, 1, 31)).count() == 2


def test_bounds_follow_daylight_saving(spark):
    got = spark.range(1).select(utc_bound(date(2024, 7, 1), "Europe/Berlin"), utc_bound(date(2024, 1, 1), "Europe/Berlin")).first()
    assert tuple(got) == (datetime(2024, 6, 30, 22), datetime(2023, 12, 31, 23))


def test_months_before_clamps():
    assert months_before(date(2024, 5, 31), 3) == date(2024, 2, 29)
    assert months_before(date(2024, 2, 1), 6) == date(2023, 8, 1)


# --- upsert -----------------------------------------------------------------------------

SCHEMA = "id int, value string, day date"
FIRST, SECOND, THIRD = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def _stored(spark):
    path = scratch_dir(spark, "upsert-test")
    old = [(1, "a", FIRST), (2, "b", FIRST), (3, "c", SECOND), (4, "d", THIRD), (5, "e", None)]
    create_version_table(spark.createDataFrame(old, SCHEMA), path, "day", ["id"])
    return path


def test_upsert_inserts_updates_moves_and_keeps(spark):
    path = _stored(spark)
    changes = spark.createDataFrame(
        [(1, "A", FIRST), (3, "c", THIRD), (6, "f", SECOND), (5, "E", None)], SCHEMA
    )
    touched = merge_upsert(path, changes, "id", "day")
    assert set(touched) == {FIRST, SECOND, THIRD, None}
    expected = [(1, "A", FIRST), (2, "b", FIRST), (3, "c", THIRD), (4, "d", THIRD), (5, "E", None), (6, "f", SECOND)]
    assert rows(read_version(spark, path).select("id", "value", "day")) == sorted(expected, key=repr)
    merge_upsert(path, changes, "id", "day")
    assert rows(read_version(spark, path).select("id", "value", "day")) == sorted(expected, key=repr)


def test_upsert_removes_a_partition_that_runs_empty(spark):
    path = _stored(spark)
    moved = spark.createDataFrame([(4, "d", FIRST), (5, "e", FIRST)], SCHEMA)
    assert set(merge_upsert(path, moved, "id", "day")) == {FIRST, THIRD, None}
    got = rows(read_version(spark, path).select("id", "day"))
    assert got == sorted([(1, FIRST), (2, FIRST), (3, SECOND), (4, FIRST), (5, FIRST)], key=repr)


def test_upsert_leaves_other_partitions_alone(spark):
    path = _stored(spark)
    before = {r[0] for r in read_version(spark, path).filter("day = '2024-01-03'").select(F.input_file_name()).collect()}
    merge_upsert(path, spark.createDataFrame([(1, "A", FIRST)], SCHEMA), "id", "day")
    after = {r[0] for r in read_version(spark, path).filter("day = '2024-01-03'").select(F.input_file_name()).collect()}
    assert before == after
    assert merge_upsert(path, spark.createDataFrame([], SCHEMA), "id", "day") == []


def test_versions_stay_readable(spark):
    path = _stored(spark)
    before = rows(read_version(spark, path))
    merge_upsert(path, spark.createDataFrame([(1, "A", SECOND)], SCHEMA), "id", "day")
    create_version_table(spark.createDataFrame([(9, "z", FIRST)], SCHEMA), path, "day", ["id"])
    assert rows(read_version(spark, path, 1)) == before
    assert rows(read_version(spark, path)) == [(9, "z", FIRST)]


WRITER = """
import os, sys
sys.path.insert(0, sys.argv[1])
from datetime import date
from parcelledger.operators import merge_upsert, upsert
from parcelledger.session import local_session
upsert.publish = lambda *a, **b: os._exit(9)
spark = local_session(2, memory="1g")
merge_upsert(sys.argv[2], spark.createDataFrame([(1, "new", date(2024, 1, 2))], "id int, value string, day date"), "id", "day")
"""


def test_a_writer_killed_before_the_switch_leaves_the_old_version(spark):
    path = _stored(spark)
    before, files = rows(read_version(spark, path)), spark.read.format("binaryFile").option("recursiveFileLookup", True)
    stored = files.load(f"{path}/data").count()
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", WRITER, root, path.removeprefix("file:")], capture_output=True, timeout=180)
    assert done.returncode == 9, done.stderr[-2000:]
    assert files.load(f"{path}/data").count() > stored  # it had written its data
    assert latest_version(spark, path) == 1 and rows(read_version(spark, path)) == before
    merge_upsert(path, spark.createDataFrame([(1, "again", SECOND)], SCHEMA), "id", "day")
    assert (1, "again", SECOND) in rows(read_version(spark, path))


def test_two_writers_of_one_version_are_found_out(spark):
    path = _stored(spark)
    versions.publish(versions.manifest(spark, path), path, 1)
    with pytest.raises(RuntimeError, match="several writers"):
        read_version(spark, path)


@pytest.mark.parametrize("values", [
    ["TIMESTAMP '2024-01-01 10:30:00'", "TIMESTAMP '2024-01-02 08:15:00'", "CAST(NULL AS TIMESTAMP)"],
    ["'a/b=c %20'", "''", "CAST(NULL AS STRING)"],
    ["1.5D", "-0.25D", "CAST(NULL AS DOUBLE)"],
])
def test_any_type_can_be_a_partition(spark, values):
    path = scratch_dir(spark, "typed")
    frame = lambda *pairs: spark.sql(" UNION ALL ".join(f"SELECT {i} AS id, {v} AS at" for i, v in pairs))
    one, two, none = values
    create_version_table(frame((1, one), (2, two), (3, none)), path, "at", ["id"])
    merge_upsert(path, frame((1, two), (3, one), (4, none)), "id", "at")
    assert rows(read_version(spark, path)) == rows(frame((1, two), (2, two), (3, one), (4, none)))
    assert versions.manifest(spark, path).count() == 3


def test_upsert_rejects_duplicate_source_keys(spark):
    path = _stored(spark)
    with pytest.raises(ValueError, match="several rows"):
        merge_upsert(path, spark.createDataFrame([(1, "x", FIRST), (1, "y", FIRST)], SCHEMA), "id", "day")


def test_upsert_policies(spark):
    target = spark.createDataFrame([(1, "a", FIRST), (2, "b", FIRST)], SCHEMA)
    source = spark.createDataFrame([(1, None, SECOND), (3, None, FIRST)], SCHEMA)
    assert rows(merged_rows(target, source, "id")) == [(1, None, SECOND), (2, "b", FIRST), (3, None, FIRST)]
    assert rows(merged_rows(target, source, "id", "coalesce")) == [(1, "a", SECOND), (2, "b", FIRST), (3, None, FIRST)]
    with pytest.raises(ValueError, match="policy"):
        merged_rows(target, source, "id", "other")


# --- tables and sinks -------------------------------------------------------------------

def test_append_needs_a_column_to_spread_a_day(spark):
    with pytest.raises(ValueError, match="cluster"):
        append_load(spark.createDataFrame([(1, "a", FIRST)], SCHEMA), "/tmp/unused", FIRST, [])


def test_tables_from_files_and_catalog(spark, small):
    tables = Tables.from_files(spark, {"fact_orders": f"{small}/orders.parquet"})
    tables["fact_orders"].createOrReplaceTempView("orders_by_name")
    assert Tables.from_catalog(spark, {"fact_orders": "orders_by_name"})["fact_orders"].count() == tables["fact_orders"].count()
    assert list(tables.with_tables(more=tables["fact_orders"])) == ["fact_orders", "more"]


def test_a_load_leaves_earlier_loads_alone(spark):
    path = scratch_dir(spark, "loads")
    first = spark.createDataFrame([(1, "a", FIRST), (2, "b", FIRST)], SCHEMA)
    late = spark.createDataFrame([(3, "c", FIRST), (4, "d", SECOND)], SCHEMA)
    for rows, day in ((first, FIRST), (late, SECOND), (late, SECOND)):
        append_load(rows, path, day, ["day", "id"])
    got = {(r.id, r.day, r.load_day) for r in spark.read.parquet(path).collect()}
    assert got == {(1, FIRST, FIRST), (2, FIRST, FIRST), (3, FIRST, SECOND), (4, SECOND, SECOND)}
    assert spark.read.parquet(path).count() == 4


# --- differences of large tables --------------------------------------------------------

def test_differences_are_those_of_a_full_comparison(spark):
    dice = random.Random(11)
    left = [(dice.randrange(400) or None, dice.choice(["a", "b", None]), Decimal(dice.randrange(5))) for _ in range(1500)]
    left.append((999, "a", Decimal(1)))
    right = [r for r in left if dice.random() > 0.02 and r[0] != 999] + [(dice.randrange(380, 450), "c", Decimal(1)) for _ in range(8)]
    right[5] = (right[5][0], "other text", right[5][2])  # no measure differs
    fields = "k int, note string, v decimal(18,4)"
    a, b = spark.createDataFrame(left, fields), spark.createDataFrame(right, fields)
    content = lambda data: {k: sorted(map(repr, (r for r in data if r[0] == k))) for k in {r[0] for r in data}}
    raw, report = content(left), content(right)
    expected = {
        k: "missing in report" if k not in report else "missing in raw" if k not in raw else "difference"
        for k in raw.keys() | report.keys() if raw.get(k) != report.get(k)
    }
    for buckets in (2, 1024):
        found = find_differences(a, b, ["k"], {"v": F.sum("v")}, buckets=buckets).collect()
        assert {r.k: r.status for r in found} == expected and len(found) == len(expected)
    assert set(expected.values()) == {"missing in report", "missing in raw", "difference"}
    assert find_differences(a, a, ["k"], {}).count() == 0


def test_equal_tables_are_compared_without_shuffling_rows(spark):
    a = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    text = find_differences(a, a, ["k"], {"v": F.sum("v")})._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert differing_buckets(a, a.filter("k <> 77"), ["k"], ["k", "v"]).collect()[0].k == 77
