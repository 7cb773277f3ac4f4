"""Results stay whole when a third of all rows share one key and every join is shuffled."""

from __future__ import annotations

import duckdb
import pytest
from compare import difference, sql_session

from __spark_entry__ import oracle_sql, queries
from parcelledger import session

HOT = {
    "lineitem": "* REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)",
}
SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}
NAMES = (
    "agg_listagg",
    "billing_daily",
    "journey_full",
    "latest_scan",
    "order_monitoring_history",
    "region_net",
    "va_monitoring",
    "wallet_net",
    "wallet_transactions_sliced",
    "win_latest",
    "win_partition_sum",
    "win_rank_guarded",
)


@pytest.fixture(scope="module")
def hot(tmp_path_factory, small):
    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        columns = HOT.get(table, "*")
        con.execute(f"COPY (SELECT {columns} FROM '{small}/{table}.parquet') TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture
def shuffled(spark, monkeypatch):
    before = {key: spark.conf.get(key, None) for key in SHUFFLED}
    for key, value in SHUFFLED.items():
        monkeypatch.setitem(session.SETTINGS, key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(name, spark, hot, shuffled):
    con = sql_session(hot)
    assert con.execute("SELECT max(n) > 1900 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)").fetchone()[0]
    assert difference(queries()[name], oracle_sql()[name], spark, con, hot) is None
