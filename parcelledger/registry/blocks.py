"""Building blocks on the sample tables: scans, filters, projections, joins, windows, sets."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import (
    Rule,
    after_underscore,
    amount,
    day_start,
    fee,
    first_match,
    first_token,
    has_prefix,
    local_date,
    local_datetime,
    rate,
)
from parcelledger.functions.money import AMOUNT, WEIGHT
from parcelledger.operators import (
    concat_notes,
    decode,
    duplicate_keys,
    earliest_by,
    fallback,
    latest_by,
    lookup,
    on_days,
    pick_first,
    ranked_with_totals,
    recent,
    recent_months,
    reconcile,
    since,
    sum_when,
    tier_lookup,
    unreadable_values,
)
from parcelledger.registry.core import EVENTS_AS_OF, FACTS_AS_OF, Sample, query, with_views
from parcelledger.sources import sample

def _price() -> Column:
    return amount("l_extendedprice")

ORDER_CODES = """(VALUES ('status', 'O', 'Open'), ('status', 'F', 'Done'), ('priority', '1-URGENT', 'Urgent'),
    ('priority', '2-HIGH', 'High'), ('priority', '5-LOW', 'Low'), ('segment', 'BUILDING', 'Construction'),
    ('segment', 'MACHINERY', 'Machines')) AS t(type_option, option_value, option_name)"""
WEIGHT_TIERS = """(VALUES (CAST(1 AS DECIMAL(18,4)), CAST(10 AS DECIMAL(18,4)), CAST(1.5 AS DECIMAL(18,4))),
    (11, 20, 2), (20, 30, 3), (35, 44.5, 4.25), (46, 1000, 6)) AS t(Bottom, Up, Multiplier)"""


def _codes(s: Sample) -> DataFrame:
    return s.spark.sql(f"SELECT * FROM {ORDER_CODES}")


# --- scans ------------------------------------------------------------------------------

@query("""SELECT o_orderkey, o_orderdate, CAST(o_orderdate + INTERVAL 7 HOUR AS DATE) AS local_day FROM orders
    WHERE CAST(o_orderdate + INTERVAL 7 HOUR AS DATE) >= DATE '2001-08-02' - 62""")
def scan_recent_days(s: Sample) -> DataFrame:
    rows = recent(s.orders, "o_orderdate", 62, FACTS_AS_OF)
    return rows.select("o_orderkey", "o_orderdate", local_date("o_orderdate").alias("local_day"))


@query("""SELECT o_orderkey, o_orderstatus FROM orders
    WHERE CAST(o_orderdate + INTERVAL 7 HOUR AS DATE) >= DATE '2001-08-02' - INTERVAL 3 MONTH""")
def scan_recent_months(s: Sample) -> DataFrame:
    return recent_months(s.orders, "o_orderdate", 3, FACTS_AS_OF).select("o_orderkey", "o_orderstatus")


@query("""SELECT event_id, user_id, event_type, ts FROM events
    WHERE CAST(ts + INTERVAL 7 HOUR AS DATE) = DATE '2024-01-30'""")
def scan_on_day_tz(s: Sample) -> DataFrame:
    return on_days(s.events, "ts", EVENTS_AS_OF).select("event_id", "user_id", "event_type", "ts")


@query("""SELECT o.o_orderkey, l.l_linenumber, l.l_shipdate FROM orders o LEFT JOIN
    (SELECT * FROM lineitem WHERE CAST(l_shipdate + INTERVAL 7 HOUR AS DATE) >= DATE '2000-03-01') l
    ON l.l_orderkey = o.o_orderkey""")
def scan_fixed_floor(s: Sample) -> DataFrame:
    fresh = s.lineitem.filter(since("l_shipdate", date(2000, 3, 1)))
    return lookup(
        s.orders.select("o_orderkey"), fresh, {"l_orderkey": "o_orderkey"},
        {c: c for c in ("l_linenumber", "l_shipdate")},
    )


# --- filters ----------------------------------------------------------------------------

@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
    AND l_linenumber IN (1, 3, 5) AND l_quantity > 10 AND l_tax BETWEEN 0.02 AND 0.06""")
def filter_codes(s: Sample) -> DataFrame:
    return s.lineitem.filter(
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "F")
        & F.col("l_linenumber").isin(1, 3, 5)
        & (F.col("l_quantity") > 10)
        & F.col("l_tax").between(0.02, 0.06)
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query("""SELECT event_id, event_type FROM events WHERE substr(event_type, 1, 2) IN ('pu', 'cl') AND event_type <> 'click'
    UNION ALL SELECT event_id, event_type FROM events WHERE substr(event_type, 1, 2) = 'vi'""")
def filter_prefix(s: Sample) -> DataFrame:
    return s.events.filter(
        has_prefix("event_type", ("pu", "cl", "vi")) & (F.col("event_type") != "click")
    ).select("event_id", "event_type")


@query("""SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
    WHERE (CAST(l_shipdate + INTERVAL 7 HOUR AS DATE) >= DATE '2001-08-02' - 62 OR l_returnflag = 'R' OR l_quantity > 48)
    AND NOT (l_linestatus = 'F' AND l_tax > 0.05)""")
def filter_or_window(s: Sample) -> DataFrame:
    window = since("l_shipdate", FACTS_AS_OF - timedelta(days=62))
    kept = window | (F.col("l_returnflag") == "R") | (F.col("l_quantity") > 48)
    dropped = (F.col("l_linestatus") == "F") & (F.col("l_tax") > 0.05)
    return s.lineitem.filter(kept & ~dropped).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("""SELECT event_id, code FROM (SELECT event_id, CASE event_type WHEN 'purchase' THEN '61' WHEN 'click' THEN '02'
    WHEN 'view' THEN '' END AS code FROM events) WHERE code NOT IN ('02', '99') AND code IS NOT NULL""")
def filter_null_safe_not_in(s: Sample) -> DataFrame:
    code = F.when(F.col("event_type") == "purchase", "61").when(F.col("event_type") == "click", "02").when(
        F.col("event_type") == "view", ""
    )
    return s.events.select("event_id", code.alias("code")).filter(~F.col("code").isin("02", "99"))


# --- projections ------------------------------------------------------------------------

@query("""SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,4)) * CAST(0.11 AS DECIMAL(18,9)) AS DOUBLE) AS tax,
    CAST(-o_totalprice AS DOUBLE) AS refund, 'INDONESIA' AS country,
    TIMESTAMP '2024-01-31 07:00:00' AS loaded_at FROM orders""")
def project_star_extend(s: Sample) -> DataFrame:
    return s.orders.select(
        "*",
        (amount("o_totalprice") * F.lit(0.11).cast("decimal(18,9)")).alias("tax"),
        (F.col("o_totalprice") * -1).alias("refund"),
        F.lit("INDONESIA").alias("country"),
        F.lit("2024-01-31 07:00:00").cast("timestamp_ntz").alias("loaded_at"),
    )


@query("""SELECT o_orderkey AS "No_Waybill", o_orderstatus AS "Status", o_totalprice AS "Biaya_Total",
    o_orderdate + INTERVAL 7 HOUR AS "Tanggal" FROM orders""")
def project_localised(s: Sample) -> DataFrame:
    names = {"o_orderkey": "No_Waybill", "o_orderstatus": "Status", "o_totalprice": "Biaya_Total"}
    rows = s.orders.select(*names, local_datetime("o_orderdate").alias("Tanggal"))
    return rows.withColumnsRenamed(names)


@query("""SELECT DISTINCT l_suppkey, 'pickup' AS flag, 0 AS weight, '' AS source, CAST(0 AS DOUBLE) AS fee FROM lineitem""")
def project_literals(s: Sample) -> DataFrame:
    return s.lineitem.select(
        "l_suppkey", F.lit("pickup").alias("flag"), F.lit(0).alias("weight"), F.lit("").alias("source"),
        F.lit(0).cast("double").alias("fee"),
    ).distinct()


# --- joins ------------------------------------------------------------------------------

@query(f"""SELECT o.o_orderkey, s.option_name AS status_name, p.option_name AS priority_name, m.option_name AS segment_name
    FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    LEFT JOIN (SELECT * FROM {ORDER_CODES}) s ON s.option_value = o.o_orderstatus AND s.type_option = 'status'
    LEFT JOIN (SELECT * FROM {ORDER_CODES}) p ON p.option_value = o.o_orderpriority AND p.type_option = 'priority'
    LEFT JOIN (SELECT * FROM {ORDER_CODES}) m ON m.option_value = c.c_mktsegment AND m.type_option = 'segment'""")
def join_decode_roles(s: Sample) -> DataFrame:
    df = lookup(s.orders, s.customer, {"c_custkey": "o_custkey"}, {"segment": "c_mktsegment"})
    codes = _codes(s)
    for column, kind in (("o_orderstatus", "status"), ("o_orderpriority", "priority"), ("segment", "segment")):
        df = decode(df, codes, column, kind, f"{kind}_name")
    return df.select("o_orderkey", "status_name", "priority_name", "segment_name")


@query("""SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_returnflag AS returned FROM lineitem a LEFT JOIN
    (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'R') b
    ON b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber""")
def join_composite(s: Sample) -> DataFrame:
    returns = s.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_returnflag")
    return lookup(
        s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), returns.distinct(),
        {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"}, {"returned": "l_returnflag"},
    )


@query("""SELECT c.c_custkey, k.label FROM customer c LEFT JOIN (SELECT 'R' || n_regionkey || 'N' || n_nationkey AS code,
    n_name AS label FROM nation) k
    ON k.code = (CASE WHEN c.c_nationkey < 20 THEN 'R' || (c.c_nationkey % 5) END) || ('N' || c.c_nationkey)""")
def join_expr_key(s: Sample) -> DataFrame:
    cards = s.nation.select(
        F.concat(F.lit("R"), "n_regionkey", F.lit("N"), "n_nationkey").alias("code"), F.col("n_name").alias("label")
    )
    key = F.concat(
        F.when(F.col("c_nationkey") < 20, F.concat(F.lit("R"), F.col("c_nationkey") % 5)),
        F.concat(F.lit("N"), "c_nationkey"),
    )
    return lookup(s.customer.select("c_custkey", "c_nationkey"), cards, {"code": key}, {"label": "label"}).drop("c_nationkey")


@query("""SELECT s.s_suppkey, n.n_name FROM supplier s LEFT JOIN nation n
    ON n.n_nationkey = CASE WHEN s.s_nationkey = 3 THEN 9 ELSE s.s_nationkey END AND s.s_nationkey NOT IN (13)""")
def join_cond_key(s: Sample) -> DataFrame:
    key = F.when(F.col("s_nationkey") == 3, 9).otherwise(F.col("s_nationkey"))
    return lookup(
        s.supplier.select("s_suppkey", "s_nationkey"), s.nation, {"n_nationkey": key}, {"n_name": "n_name"},
        gate=F.col("s_nationkey") != 13,
    ).drop("s_nationkey")


@query("""SELECT l.l_orderkey, l.l_linenumber, s.s_name FROM lineitem l
    LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey AND l.l_returnflag = 'R'""")
def join_left_gate(s: Sample) -> DataFrame:
    return lookup(
        s.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"), s.supplier,
        {"s_suppkey": "l_suppkey"}, {"s_name": "s_name"}, gate=F.col("l_returnflag") == "R",
    ).drop("l_suppkey", "l_returnflag")


@query("""SELECT l.l_orderkey, l.l_linenumber, p.p_brand FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
    AND (l.l_returnflag = 'A' OR (l.l_returnflag = 'N' AND l.l_tax > 0.03 AND l.l_linestatus = 'O'))""")
def join_or_residual(s: Sample) -> DataFrame:
    narrow = (F.col("l_returnflag") == "N") & (F.col("l_tax") > 0.03) & (F.col("l_linestatus") == "O")
    return lookup(
        s.lineitem, s.part, {"p_partkey": "l_partkey"}, {"p_brand": "p_brand"},
        gate=(F.col("l_returnflag") == "A") | narrow,
    ).select("l_orderkey", "l_linenumber", "p_brand")


@query(f"""SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, CAST(t.Multiplier AS DOUBLE) AS multiplier
    FROM lineitem l LEFT JOIN (SELECT * FROM {WEIGHT_TIERS}) t
    ON l.l_quantity >= t.Bottom AND l.l_quantity <= t.Up AND l.l_returnflag <> 'N'""")
def join_range_tier(s: Sample) -> DataFrame:
    tiers = s.spark.sql(f"SELECT * FROM {WEIGHT_TIERS}")
    return tier_lookup(
        s.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"), tiers,
        amount("l_quantity"), {"multiplier": "Multiplier"}, gate=F.col("l_returnflag") != "N",
    ).drop("l_returnflag")


@query("""SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
    AND CAST(o.o_orderdate + INTERVAL 7 HOUR AS DATE) >= DATE '2001-08-02' - 120""")
def join_right_prefilter(s: Sample) -> DataFrame:
    fresh = recent(s.orders, "o_orderdate", 120, FACTS_AS_OF)
    return lookup(s.customer.select("c_custkey"), fresh, {"o_custkey": "c_custkey"}, {"o_orderkey": "o_orderkey"})


@query("""SELECT o.o_orderkey, l.l_linenumber FROM orders o FULL JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    AND l.l_returnflag = 'R' WHERE CAST(o.o_orderdate + INTERVAL 7 HOUR AS DATE) >= DATE '2001-08-02' - 400""")
def join_full_then_filter(s: Sample) -> DataFrame:
    orders = recent(s.orders, "o_orderdate", 400, FACTS_AS_OF)
    returned = s.lineitem.filter(F.col("l_returnflag") == "R")
    return lookup(orders.select("o_orderkey"), returned, {"l_orderkey": "o_orderkey"}, {"l_linenumber": "l_linenumber"})


@query("""SELECT o.o_orderkey, d.o_orderkey AS batch_orderkey FROM orders o JOIN
    (SELECT o_custkey, o_orderkey FROM orders) d ON d.o_custkey = o.o_custkey WHERE o.o_orderpriority = '1-URGENT'""")
def join_inner_batch(s: Sample) -> DataFrame:
    urgent = s.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey")
    return lookup(
        urgent, s.orders, {"o_custkey": "o_custkey"}, {"batch_orderkey": "o_orderkey"}, how="inner"
    ).drop("o_custkey")


@query("""SELECT o.o_orderkey, l.l_linenumber, l.l_tax FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE l.l_tax > 0.05 AND o.o_orderstatus <> 'P'""")
def join_left_nullified(s: Sample) -> DataFrame:
    taxed = s.lineitem.filter(F.col("l_tax") > 0.05)
    orders = s.orders.filter(F.col("o_orderstatus") != "P").select("o_orderkey")
    return lookup(
        orders, taxed, {"l_orderkey": "o_orderkey"}, {"l_linenumber": "l_linenumber", "l_tax": "l_tax"}, how="inner"
    )


@query("""SELECT c.c_custkey, n.n_name, r.r_name FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def join_chain(s: Sample) -> DataFrame:
    df = lookup(
        s.customer.select("c_custkey", "c_nationkey"), s.nation, {"n_nationkey": "c_nationkey"},
        {"n_name": "n_name", "regionkey": "n_regionkey"},
    )
    return lookup(df, s.region, {"r_regionkey": "regionkey"}, {"r_name": "r_name"}).drop("c_nationkey", "regionkey")


@query("""SELECT c.c_custkey, p.c_name AS parent_name, g.c_name AS grandparent_name FROM customer c
    LEFT JOIN customer p ON p.c_custkey = c.c_custkey // 10 LEFT JOIN customer g ON g.c_custkey = p.c_custkey // 10""")
def join_self_parent(s: Sample) -> DataFrame:
    people = s.customer.select("c_custkey", "c_name")
    up = F.floor(F.col("c_custkey") / 10)
    df = lookup(
        s.customer.select("c_custkey"), people, {"c_custkey": up}, {"parent_key": "c_custkey", "parent_name": "c_name"}
    )
    return lookup(
        df, people, {"c_custkey": F.floor(F.col("parent_key") / 10)}, {"grandparent_name": "c_name"}
    ).drop("parent_key")


@query("""SELECT c.c_custkey, COALESCE(CASE WHEN own.c_custkey % 3 <> 0 THEN own.c_name END, up.c_name) AS account_name
    FROM customer c LEFT JOIN customer own ON own.c_custkey = c.c_custkey
    LEFT JOIN customer up ON up.c_custkey = c.c_custkey // 10""")
def join_dual_fallback(s: Sample) -> DataFrame:
    named = s.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("name"))
    df = lookup(s.customer.select("c_custkey"), named, {"c_custkey": "c_custkey"}, {"own_name": "name"})
    df = lookup(df, s.customer, {"c_custkey": F.floor(F.col("c_custkey") / 10)}, {"parent_name": "c_name"})
    return df.select("c_custkey", fallback("own_name", "parent_name").alias("account_name"))


@query("""SELECT o.o_orderkey, l.l_linenumber, CAST(l.l_extendedprice AS DOUBLE) AS amount FROM orders o
    LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def join_fanout(s: Sample) -> DataFrame:
    return lookup(
        s.orders.select("o_orderkey"), s.lineitem, {"l_orderkey": "o_orderkey"},
        {"l_linenumber": "l_linenumber", "amount": "l_extendedprice"},
    )


@query("""SELECT o.o_orderkey, CASE WHEN l.k IS NOT NULL THEN 1 ELSE 0 END AS has_return FROM orders o
    LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') l ON l.k = o.o_orderkey""")
def join_presence_flag(s: Sample) -> DataFrame:
    returned = s.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey").distinct()
    df = lookup(s.orders.select("o_orderkey"), returned, {"l_orderkey": "o_orderkey"}, {"found": "l_orderkey"})
    return df.select("o_orderkey", F.when(F.col("found").isNotNull(), 1).otherwise(0).alias("has_return"))


# --- aggregations -----------------------------------------------------------------------

@query("""SELECT CAST(l_shipdate + INTERVAL 7 HOUR AS DATE) AS day,
    CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS accepted,
    CAST(SUM(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE)
    AS returned_weight, COUNT(CASE WHEN l_tax > 0.02 THEN l_tax END) AS taxed FROM lineitem GROUP BY 1""")
def agg_conditional_pivot(s: Sample) -> DataFrame:
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return s.lineitem.groupBy(local_date("l_shipdate").alias("day")).agg(
        sum_when(F.col("l_returnflag") == "A", F.lit(1)).alias("accepted"),
        sum_when(returned, amount("l_quantity")).alias("returned_weight"),
        F.count(F.when(F.col("l_tax") > 0.02, F.col("l_tax"))).alias("taxed"),
    )


@query("""SELECT l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4)) +
    COALESCE(CASE WHEN l_tax > 0.04 THEN CAST(l_extendedprice AS DECIMAL(18,4)) END, 0) +
    COALESCE(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,4)) END, 0)) AS DOUBLE) AS gross
    FROM lineitem GROUP BY l_suppkey""")
def agg_null_safe_sum(s: Sample) -> DataFrame:
    cod = F.when(F.col("l_tax") > 0.04, _price())
    returned = F.when(F.col("l_returnflag") == "R", amount("l_quantity"))
    total = _price() + F.coalesce(cod, F.lit(0)) + F.coalesce(returned, F.lit(0))
    return s.lineitem.groupBy("l_suppkey").agg(F.sum(total).alias("gross"))


@query("""SELECT l_returnflag, l_linestatus,
    CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,4))), 0) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1, 2""")
def agg_round_sum(s: Sample) -> DataFrame:
    return s.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum(_price()), 0).alias("revenue"))


@query("""SELECT l_orderkey, CAST(MAX(cod) AS DOUBLE) AS cod, CAST(MAX(cash) AS DOUBLE) AS cash,
    CAST(MAX(cod) + MAX(cash) AS DOUBLE) AS total FROM (
    SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(18,4)) AS cod, CAST(0 AS DECIMAL(18,4)) AS cash FROM lineitem
        WHERE l_returnflag = 'R' UNION ALL
    SELECT l_orderkey, 0, CAST(l_extendedprice AS DECIMAL(18,4)) FROM lineitem WHERE l_returnflag <> 'R') GROUP BY 1""")
def agg_max_plus_max(s: Sample) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    zero = F.lit(0).cast("decimal(18,4)")
    legs = s.lineitem.select(
        "l_orderkey", F.when(returned, _price()).otherwise(zero).alias("c"), F.when(returned, zero).otherwise(_price()).alias("h")
    )
    return legs.groupBy("l_orderkey").agg(
        F.max("c").alias("cod"), F.max("h").alias("cash"), (F.max("c") + F.max("h")).alias("total")
    )


@query("""SELECT l_suppkey, day, CAST(SUM(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS quantity,
    string_agg(note, ',' ORDER BY note) AS note FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, l_quantity,
    CASE WHEN l_linenumber <> 3 THEN l_returnflag || l_linestatus END AS note FROM lineitem) GROUP BY 1, 2""")
def agg_listagg(s: Sample) -> DataFrame:
    note = F.when(F.col("l_linenumber") != 3, F.concat("l_returnflag", "l_linestatus"))
    rows = s.lineitem.select(
        "l_suppkey", F.col("l_shipdate").cast("date").alias("day"), amount("l_quantity").alias("quantity"), note.alias("note")
    )
    return concat_notes(rows, ["l_suppkey", "day"], "note", ["quantity"])


@query("""SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem""")
def agg_distinct_wide(s: Sample) -> DataFrame:
    return s.lineitem.select(
        "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("ship_day")
    ).distinct()


@query("""SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders GROUP BY 1, 2, 3""")
def agg_group_all(s: Sample) -> DataFrame:
    return s.orders.select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()


@query("""SELECT day, CAST(SUM(CASE WHEN flag = 'order' THEN volume ELSE 0 END) AS BIGINT) AS orders,
    CAST(SUM(CASE WHEN flag = 'ship' THEN volume ELSE 0 END) AS BIGINT) AS shipments FROM (
    SELECT CAST(o_orderdate + INTERVAL 7 HOUR AS DATE) AS day, 'order' AS flag, COUNT(o_orderkey) AS volume FROM orders GROUP BY 1
    UNION ALL SELECT CAST(l_shipdate + INTERVAL 7 HOUR AS DATE), 'ship', COUNT(l_orderkey) FROM lineitem GROUP BY 1)
    WHERE day >= DATE '2001-08-02' - 120 GROUP BY day""")
def agg_two_level(s: Sample) -> DataFrame:
    def leg(df: DataFrame, instant: str, key: str, flag: str) -> DataFrame:
        window = recent(df, instant, 120, FACTS_AS_OF)
        counted = window.groupBy(local_date(instant).alias("day")).agg(F.count(key).alias("volume"))
        return counted.select("day", F.lit(flag).alias("flag"), "volume")

    legs = leg(s.orders, "o_orderdate", "o_orderkey", "order").unionByName(
        leg(s.lineitem, "l_shipdate", "l_orderkey", "ship")
    )
    return legs.groupBy("day").agg(
        sum_when(F.col("flag") == "order", "volume").alias("orders"),
        sum_when(F.col("flag") == "ship", "volume").alias("shipments"),
    )


# --- windows ----------------------------------------------------------------------------

VERSION_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax"
_TIES = VERSION_ORDER.split(", ")


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem QUALIFY ROW_NUMBER() OVER
    (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, {VERSION_ORDER}) = 1""")
def win_latest(s: Sample) -> DataFrame:
    newest = latest_by(s.lineitem, ["l_orderkey"], "l_shipdate", ties=_TIES)
    return newest.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("""SELECT user_id, event_id, ts FROM events WHERE event_type = 'click'
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def win_earliest(s: Sample) -> DataFrame:
    clicks = s.events.filter(F.col("event_type") == "click").select("user_id", "event_id", "ts")
    return earliest_by(clicks, ["user_id"], "ts", ties=["event_id"])


@query("""SELECT user_id, event_type, event_id FROM events WHERE event_type <> 'error' QUALIFY ROW_NUMBER() OVER
    (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, ts, event_id) = 1""")
def win_priority(s: Sample) -> DataFrame:
    rows = s.events.filter(F.col("event_type") != "error").select("user_id", "event_type", "event_id", "ts")
    preferred = F.when(F.col("event_type") == "purchase", 0).otherwise(1)
    return pick_first(rows, ["user_id"], [preferred, F.col("ts"), F.col("event_id")]).drop("ts")


@query("""SELECT o_custkey, o_orderkey, done FROM (SELECT o_custkey, o_orderkey, o_orderdate,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 5 DAY END AS done FROM orders) QUALIFY ROW_NUMBER() OVER
    (PARTITION BY o_custkey ORDER BY done ASC NULLS FIRST, o_orderdate, o_orderkey) = 1""")
def win_multi_order(s: Sample) -> DataFrame:
    done = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL '5' DAY"))
    rows = s.orders.select("o_custkey", "o_orderkey", "o_orderdate", done.alias("done"))
    order = [F.col(c).asc_nulls_first() for c in ("done", "o_orderdate", "o_orderkey")]
    return pick_first(rows, ["o_custkey"], order).drop("o_orderdate")


@query("""SELECT DISTINCT o_orderstatus, o_orderpriority FROM (SELECT * FROM orders QUALIFY ROW_NUMBER() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)""")
def win_hidden_key(s: Sample) -> DataFrame:
    newest = latest_by(s.orders, ["o_custkey"], "o_orderdate", ties=["o_orderkey"])
    return newest.select("o_orderstatus", "o_orderpriority").distinct()


_BATCHES = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'B' || o_custkey
    WHEN o_orderpriority = '3-MEDIUM' THEN '' END AS batch_id, CAST(o_totalprice AS DECIMAL(18,4)) AS total,
    CAST(CAST(o_totalprice AS DECIMAL(18,4)) * 0.9 AS DECIMAL(18,4)) AS standard, o_orderdate FROM orders"""


def _batches(s: Sample) -> DataFrame:
    named = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    batch = F.when(named, F.concat(F.lit("B"), "o_custkey")).when(F.col("o_orderpriority") == "3-MEDIUM", "")
    total = amount("o_totalprice")
    return s.orders.select(
        "o_orderkey", "o_custkey", batch.alias("batch_id"), total.alias("total"),
        (total * F.lit(0.9).cast("decimal(18,1)")).cast("decimal(18,4)").alias("standard"), "o_orderdate",
    )


@query(f"""SELECT o_orderkey, batch_id, CASE WHEN batch_id <> '' THEN
    RANK() OVER (PARTITION BY batch_id ORDER BY CAST(o_orderdate AS DATE)) END AS batch_rank FROM ({_BATCHES})""")
def win_rank_guarded(s: Sample) -> DataFrame:
    # Rows without a batch have no rank, so only batch rows are ranked.
    rows = _batches(s).select("o_orderkey", "batch_id", F.col("o_orderdate").cast("date").alias("day"))
    named = F.coalesce(F.col("batch_id") != "", F.lit(False))
    return ranked_with_totals(rows, "batch_id", "day", {}, "batch_rank", where=named).drop("day")


@query(f"""SELECT o_orderkey, CAST(SUM(total) OVER (PARTITION BY batch_id) AS DOUBLE) AS batch_total
    FROM ({_BATCHES}) WHERE batch_id <> ''""")
def win_partition_sum(s: Sample) -> DataFrame:
    rows = _batches(s).filter(F.col("batch_id") != "")
    totals = ranked_with_totals(rows, "batch_id", "o_orderkey", {"batch_total": F.col("total")}, "place")
    return totals.select("o_orderkey", "batch_total")


@query(f"""SELECT o_orderkey, (CAST(SUM(ABS(total)) OVER w AS DOUBLE) - CAST(ABS(total) AS DOUBLE))
    / NULLIF(CAST(SUM(ABS(standard)) OVER w AS DOUBLE), 0) AS discount_rate
    FROM ({_BATCHES}) WHERE batch_id <> '' WINDOW w AS (PARTITION BY batch_id)""")
def win_ratio_abs(s: Sample) -> DataFrame:
    rows = _batches(s).filter(F.col("batch_id") != "")
    sums = {"all_total": F.abs("total"), "all_standard": F.abs("standard")}
    df = ranked_with_totals(rows, "batch_id", "o_orderkey", sums, "place")
    part = F.col("all_total").cast("double") - F.abs("total").cast("double")
    return df.select("o_orderkey", F.try_divide(part, F.col("all_standard").cast("double")).alias("discount_rate"))


@query(f"""SELECT o_orderkey, CASE WHEN r > 1 THEN NULL ELSE CAST(total AS DOUBLE) END AS kept FROM (SELECT *,
    CASE WHEN batch_id <> '' THEN RANK() OVER (PARTITION BY batch_id ORDER BY o_orderkey) END AS r FROM ({_BATCHES}))""")
def win_first_only(s: Sample) -> DataFrame:
    rows = _batches(s).select("o_orderkey", "batch_id", "total")
    named = F.coalesce(F.col("batch_id") != "", F.lit(False))
    ranked = ranked_with_totals(rows, "batch_id", "o_orderkey", {}, "place", where=named)
    return ranked.select("o_orderkey", F.when(F.col("place") > 1, None).otherwise(F.col("total")).alias("kept"))


# --- sets -------------------------------------------------------------------------------

@query("""SELECT 'order' AS leg, o_orderkey AS key, o_totalprice AS amount FROM orders UNION ALL
    SELECT 'parcel', l_orderkey, l_extendedprice FROM lineitem""")
def set_union_legs(s: Sample) -> DataFrame:
    orders = s.orders.select(F.lit("order").alias("leg"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"))
    parcels = s.lineitem.select(
        F.lit("parcel").alias("leg"), F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("amount")
    )
    return orders.unionByName(parcels)


@query("""SELECT l_orderkey, l_extendedprice AS cod, CAST(0 AS DOUBLE) AS cash FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT l_orderkey, 0, l_extendedprice FROM lineitem WHERE l_linestatus = 'F'""")
def set_union_zero_fill(s: Sample) -> DataFrame:
    zero = F.lit(0).cast("double")
    cod = s.lineitem.filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", F.col("l_extendedprice").alias("cod"), zero.alias("cash")
    )
    cash = s.lineitem.filter(F.col("l_linestatus") == "F").select(
        "l_orderkey", zero.alias("cod"), F.col("l_extendedprice").alias("cash")
    )
    return cod.unionByName(cash)


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'""")
def set_union_overlap(s: Sample) -> DataFrame:
    rows = s.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    urgent = rows.filter(F.col("o_orderpriority") == "1-URGENT")
    return urgent.unionByName(rows.filter(F.col("o_orderstatus") == "P")).drop("o_orderpriority")


# --- functions --------------------------------------------------------------------------

@query("""SELECT event_id, ts + INTERVAL 7 HOUR AS local_time, CAST(ts + INTERVAL 7 HOUR AS DATE) AS local_day,
    CAST(ts AS DATE) AS utc_day, CAST(CAST(ts + INTERVAL 7 HOUR AS DATE) AS TIMESTAMP) AS day_start,
    CAST(date_diff('day', CAST(ts + INTERVAL 7 HOUR AS DATE), DATE '2024-01-31') AS INTEGER) AS age,
    CAST(CAST(ts AS DATE) - 14 AS DATE) AS two_weeks_back, CAST(CAST(ts AS DATE) - INTERVAL 3 MONTH AS DATE) AS quarter_back
    FROM events""")
def fn_datetime_tz(s: Sample) -> DataFrame:
    day = F.col("ts").cast("date")
    return s.events.select(
        "event_id",
        local_datetime("ts").alias("local_time"),
        local_date("ts").alias("local_day"),
        day.alias("utc_day"),
        day_start(local_date("ts")).alias("day_start"),
        F.datediff(F.lit(EVENTS_AS_OF), local_date("ts")).alias("age"),
        F.date_sub(day, 14).alias("two_weeks_back"),
        F.add_months(day, -3).alias("quarter_back"),
    )


@query("""SELECT event_id, code, CASE WHEN contains(code, '_') THEN regexp_extract(code, '_(.*)', 1) END AS tail,
    CASE WHEN regexp_matches(dashed, '[^-]+') THEN regexp_extract(dashed, '[^-]+') END AS head, substr(code, 1, 2) AS prefix
    FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'ID_' || event_type || '_X' WHEN 1 THEN 'ID' WHEN 2 THEN 'ID_' END AS code,
    CASE event_id % 4 WHEN 0 THEN 'MH' || (event_id % 8) || '-A-B' WHEN 1 THEN '--' WHEN 2 THEN '-Z' END AS dashed FROM events)""")
def fn_regex_codes(s: Sample) -> DataFrame:
    case = F.col("event_id") % 4
    code = (
        F.when(case == 0, F.concat(F.lit("ID_"), "event_type", F.lit("_X"))).when(case == 1, "ID").when(case == 2, "ID_")
    )
    dashed = (
        F.when(case == 0, F.concat(F.lit("MH"), F.col("event_id") % 8, F.lit("-A-B"))).when(case == 1, "--").when(case == 2, "-Z")
    )
    return s.events.select(
        "event_id", code.alias("code"), after_underscore(code).alias("tail"), first_token(dashed).alias("head"),
        F.substring(code, 1, 2).alias("prefix"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN cod = 0 THEN 'Non COD' ELSE 'COD' END AS billing_flag,
    CASE WHEN cod > 0 THEN 'COD' ELSE 'Non COD' END AS finance_flag,
    CASE WHEN l_linenumber > 5 THEN 'late' WHEN cod IS NULL THEN 'none' WHEN l_linestatus = 'F' THEN NULL END AS kind,
    COALESCE(CAST(cod AS DOUBLE), -1) AS cod, CASE WHEN note = '' THEN 'empty' ELSE note END AS note
    FROM (SELECT *, CASE WHEN l_tax > 0.04 THEN CAST(l_extendedprice AS DECIMAL(18,4)) WHEN l_tax > 0.02 THEN 0 END AS cod,
    CASE l_returnflag WHEN 'R' THEN '' WHEN 'A' THEN 'kept' END AS note FROM lineitem)""")
def fn_case_if(s: Sample) -> DataFrame:
    cod = F.when(F.col("l_tax") > 0.04, _price()).when(F.col("l_tax") > 0.02, F.lit(0).cast("decimal(18,4)"))
    note = F.when(F.col("l_returnflag") == "R", "").when(F.col("l_returnflag") == "A", "kept")
    kind = first_match(
        [
            Rule("late", F.col("l_linenumber") > 5, F.lit("late")),
            Rule("none", cod.isNull(), F.lit("none")),
            Rule("unknown", F.col("l_linestatus") == "F", F.lit(None).cast("string")),
        ]
    )
    return s.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(cod == 0, "Non COD").otherwise("COD").alias("billing_flag"),
        F.when(cod > 0, "COD").otherwise("Non COD").alias("finance_flag"),
        kind.alias("kind"),
        F.coalesce(cod.cast("double"), F.lit(-1.0)).alias("cod"),
        F.when(note == "", "empty").otherwise(note).alias("note"),
    )


@query("""SELECT l_orderkey, l_linenumber, CAST(ABS(l_quantity - 25) AS DOUBLE) AS gap,
    CAST(ROUND(CAST(l_quantity AS DECIMAL(18,4)) / 4 * 1, 0) AS DOUBLE) AS quarter, CAST(CEIL(l_quantity - 0.31) AS BIGINT) AS up,
    l_quantity / NULLIF(l_linenumber - 3, 0) AS share, TRY_CAST(CASE WHEN l_returnflag = 'R' THEN 'x' ELSE '1.5' END AS DOUBLE) AS parsed,
    CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.11 AS DECIMAL(9,4)) AS DECIMAL(18,6)) AS DOUBLE) AS tax FROM lineitem""")
def fn_math(s: Sample) -> DataFrame:
    text = F.when(F.col("l_returnflag") == "R", "x").otherwise("1.5")
    return s.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.abs(F.col("l_quantity") - 25).alias("gap"),
        F.round(F.col("l_quantity") / 4, 0).alias("quarter"),
        F.ceil(F.col("l_quantity") - 0.31).alias("up"),
        F.try_divide(F.col("l_quantity"), F.col("l_linenumber") - 3).alias("share"),
        text.try_cast("double").alias("parsed"),
        fee(_price() * rate(F.lit(0.11))).alias("tax"),
    )


# --- quality ----------------------------------------------------------------------------

@query("""SELECT COALESCE(a.l_suppkey, b.l_suppkey) AS l_suppkey, CAST(a.n AS BIGINT) AS rows_raw, CAST(b.n AS BIGINT) AS rows_report,
    CAST(a.v AS DOUBLE) AS fee_raw, CAST(b.v AS DOUBLE) AS fee_report,
    CAST(COALESCE(a.n, 0) - COALESCE(b.n, 0) AS BIGINT) AS rows_diff, CAST(COALESCE(a.v, 0) - COALESCE(b.v, 0) AS DOUBLE) AS fee_diff,
    CASE WHEN b.n IS NULL THEN 'missing in report' WHEN a.n IS NULL THEN 'missing in raw'
        WHEN a.n = b.n AND a.v = b.v THEN 'match' ELSE 'difference' END AS status
    FROM (SELECT l_suppkey, COUNT(*) AS n, SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS v FROM lineitem GROUP BY 1) a
    FULL JOIN (SELECT l_suppkey, SUM(c) AS n, SUM(w) AS v FROM (SELECT l_suppkey, l_returnflag, COUNT(*) AS c,
        SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS w FROM lineitem GROUP BY 1, 2) GROUP BY 1) b ON b.l_suppkey = a.l_suppkey""")
def reconcile_report(s: Sample) -> DataFrame:
    report = s.lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("c"), F.sum(_price()).alias("w")
    )
    return reconcile(
        s.lineitem, report, ["l_suppkey"],
        {"rows": (F.count(F.lit(1)), F.sum("c")), "fee": (F.sum(_price()), F.sum("w"))},
    )


@query("""SELECT l_orderkey, l_linenumber, COUNT(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def duplicate_parcel_keys(s: Sample) -> DataFrame:
    return duplicate_keys(s.lineitem, ["l_orderkey", "l_linenumber"])


_READ_AS = {"item_calculated_weight": WEIGHT, "item_actual_weight": WEIGHT, "cod_amount": AMOUNT}


@query(with_views(["parcels"], " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", CAST({name} AS VARCHAR) AS value, COUNT(*) AS rows FROM parcels
    WHERE {name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL GROUP BY 2""" for name, kind in _READ_AS.items())))
def invalid_amounts(s: Sample) -> DataFrame:
    """Text that should hold a number and does not: what the reports count as missing."""
    return unreadable_values(sample.view(s.spark, s.folder, "parcels"), _READ_AS)
