"""Writers: each query stores its rows below the scratch folder and reads them back."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelledger.operators import merge_upsert, pick_first
from parcelledger.plans import billing, journey, monitoring, oms
from parcelledger.registry import billing_sql as B
from parcelledger.registry import reports as R
from parcelledger.registry.core import EVENTS_AS_OF, FACTS_AS_OF, Sample, query, with_views
from parcelledger.registry.rules import SCHEME_START
from parcelledger.sources import (
    append_load,
    append_load_named,
    create_version_table,
    export_csv,
    read_version,
    replace_table,
    scratch_dir,
    write_clustered,
)
from parcelledger.sources.sample import BILLING, FINANCE, JOURNEY, MONITORING, sample_tables
from parcelledger.streaming import start_upsert

LAST_MONTHS = date(2001, 6, 1)
JOURNEY_ROWS = ", ".join(["*", "CAST(event_time AS DATE) AS event_day"])


def _daily(s: Sample, days: int) -> DataFrame:
    return oms.finance_aggregate(sample_tables(s.spark, s.folder, FINANCE), FACTS_AS_OF, days=days)


def _journey(s: Sample, window: journey.Window) -> DataFrame:
    return R._journey(s, window).withColumn("event_day", F.col("event_time").cast("date"))


@query(f"SELECT *, CAST(date_trunc('month', pod_date) AS DATE) AS pod_month FROM ({R.oms_aggregate_sql(R.HISTORY)})")
def sink_append_days(s: Sample) -> DataFrame:
    """Load the history by month, then its last months again: nothing doubles."""
    path, source = scratch_dir(s.spark, "daily"), scratch_dir(s.spark, "daily-rows")
    _daily(s, R.HISTORY).withColumn("pod_month", F.trunc("pod_date", "month")).write.parquet(source)
    rows = s.spark.read.parquet(source)
    months = sorted(r.pod_month for r in rows.select("pod_month").distinct().collect())
    for month in [*months, *[m for m in months if m >= LAST_MONTHS]]:
        append_load(rows.filter(F.col("pod_month") == month), path, month, ["pod_date", "waybill_source", "cod_flag"])
    return s.spark.read.parquet(path).drop("load_day")


LOADS = [FACTS_AS_OF - timedelta(days=n) for n in (2, 1, 0)]
LOADS_SQL = " UNION ALL ".join(
    f"SELECT *, DATE '{day - timedelta(days=1)}' AS load_day FROM ({B.billing_query(1).replace(B.DAY, f"DATE '{day}'")})"
    for day in LOADS
)


@query(LOADS_SQL)
def sink_append_billing(s: Sample) -> DataFrame:
    """Three daily loads of billing rows, the second one twice: no row is lost and none doubles."""
    path = scratch_dir(s.spark, "billing")
    tables = sample_tables(s.spark, s.folder, BILLING)
    for day in (LOADS[0], LOADS[1], LOADS[1], LOADS[2]):
        rows = billing.daily_billing(tables, day, scheme_start=SCHEME_START)
        append_load(rows, path, day - timedelta(days=1), ["pod_date", "waybill_no"])
    return s.spark.read.parquet(path)


@query(R.oms_aggregate_sql(R.HISTORY))
def sink_named_table(s: Sample) -> DataFrame:
    """A table of the catalog: two loads, the first one again with its columns turned around."""
    path = scratch_dir(s.spark, "named")
    name = path.rpartition("/")[2].replace("-", "_")
    rows = _daily(s, R.HISTORY)
    early = F.coalesce(F.col("pod_date") < F.lit(LAST_MONTHS), F.lit(False))
    order = ["pod_date", "waybill_source", "cod_flag"]
    append_load_named(rows.filter(early), name, LOADS[0], order, path)
    append_load_named(rows.filter(~early), name, LOADS[1], order)
    append_load_named(rows.filter(early).select(*reversed(rows.columns)), name, LOADS[0], order)
    return s.spark.table(name).drop("load_day")


@query(with_views(R.JOURNEY_VIEWS, f", {R.PLACED_SQL}, {R.journey_ctes('full')} SELECT {JOURNEY_ROWS} FROM journey"))
def sink_clustered(s: Sample) -> DataFrame:
    """First load of the journey mart in day folders."""
    path = scratch_dir(s.spark, "journey")
    rows = _journey(s, journey.full_window(EVENTS_AS_OF))
    write_clustered(rows, path, "event_day", ["tracking_id", "source_hub"])
    return s.spark.read.parquet(path)


@query(with_views(R.MONITORING_VIEWS, f""", {R.base_sql(R.HISTORY)} SELECT *,
    CAST(date_trunc('month', order_input_datetime) AS DATE) AS order_month FROM base"""))
def sink_replace(s: Sample) -> DataFrame:
    """Full refresh: the second load leaves nothing of the first."""
    path = scratch_dir(s.spark, "monitoring")
    tables = sample_tables(s.spark, s.folder, MONITORING)
    for days in (14, R.HISTORY):
        rows = monitoring.order_base(tables, FACTS_AS_OF, days=days)
        rows = rows.withColumn("order_month", F.trunc("order_input_datetime", "month"))
        replace_table(rows, path, "order_month", ["waybill_number", "order_source_name"])
    return s.spark.read.parquet(path)


@query(with_views(R.JOURNEY_VIEWS, f""", {R.PLACED_SQL}, {R.journey_ctes('full')}, {R.journey_ctes('delta', 'changed')},
    changes AS (SELECT * FROM changed), merged AS ({R.UPSERT_SQL}) SELECT {JOURNEY_ROWS} FROM merged"""))
def sink_upsert(s: Sample) -> DataFrame:
    """Daily delta merged into the stored journey mart."""
    path = scratch_dir(s.spark, "upsert")
    create_version_table(_journey(s, journey.full_window(EVENTS_AS_OF)), path, "event_day", ["tracking_id", "source_hub"])
    merge_upsert(path, _journey(s, journey.delta_window(EVENTS_AS_OF)), "tracking_id", "event_day")
    return read_version(s.spark, path)


@query("""SELECT user_id, event_id, event_type, ts, CAST(ts AS DATE) AS day FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_latest_event(s: Sample) -> DataFrame:
    """A stream of changes into a table of versions: files come out of order, one of them twice, one batch again."""
    target, feed, marks = (scratch_dir(s.spark, n) for n in ("latest", "latest-feed", "latest-marks"))
    rows = s.events.select("user_id", "event_id", "event_type", "ts", F.col("ts").cast("date").alias("day"))
    dealt = rows.withColumn("file", F.pmod(F.xxhash64("event_id"), F.lit(4)))
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    create_version_table(pick_first(dealt.filter("file = 3").drop("file"), ["user_id"], newest), target, "day", ["user_id"])
    for number in (2, 0, 2, 1):
        dealt.filter(F.col("file") == number).drop("file").write.mode("append").parquet(feed)
        changes = s.spark.readStream.schema(rows.schema).parquet(feed)
        start_upsert(changes, target, "user_id", "day", newest, marks, newest_by=["ts", "event_id"]).awaitTermination()
    first = pick_first(dealt.filter("file = 2").drop("file"), ["user_id"], newest)
    merge_upsert(target, first, "user_id", "day", batch="changes/0")
    return read_version(s.spark, target)


@query(R.oms_aggregate_sql(R.HISTORY))
def sink_csv(s: Sample) -> DataFrame:
    """Report export with a header line."""
    path = scratch_dir(s.spark, "export")
    rows = _daily(s, R.HISTORY)
    export_csv(rows, path)
    return s.spark.read.csv(path, header=True, schema=rows.schema)
