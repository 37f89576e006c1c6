"""Registry of runnable queries over the driver tables: ``name -> fn(spark, sf_dir)``.

Each key is an operator of the inventory; each query reads the given tables
(whole, or the date range the operator is about – turned into Parquet pushed
filters) and returns a DataFrame. Queries that exercise a sink write to a fresh
folder under the shared checkpoint root and return the read-back table.
Parameters: sample day ``DATE``; the "seen" / "batch" split at ``SPLIT``.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actimetry.config import scratch_dir
from actimetry.functions.jsonfmt import json_field, parse_logs, to_json_record
from actimetry.functions.keys import composite_key, namespaced_key, select_columns, sink_columns
from actimetry.functions.timefmt import (
    as_of_date, date_hour_text, epoch_ms_from_ntz, prev_day, prev_day_str, split_date_hour,
)
from actimetry.operators.dedup import anti_asof, anti_by_date, distinct_devices, first_per_key
from actimetry.operators.metrics import (
    dau_daily, dau_hours, dau_total, first_seen, gmv_daily, gmv_hours, gmv_total, hour_map, money_sum,
    new_devices_by_day, new_devices_by_hour, stage_counts,
)
from actimetry.operators.route import route, split_valid, tag_problems
from actimetry.plans import stream_checks
from actimetry.plans.report import (
    METRICS, dispatch, realtime_hours, realtime_total, to_json_doc, totals_json, two_day_pair,
)
from actimetry.plans.sql import dau_hours_sql, dau_total_sql, gmv_hours_sql, gmv_total_sql
from actimetry.schemas import DAU_COLUMNS
from actimetry.sinks.files import preview
from actimetry.sources.logs import read_raw_lines, seen_keys
from actimetry.sources.tables import (
    LOG_COLUMNS as LOG_OUT, STARTUP_COLUMNS as DAU_OUT, events_in_days, logs_from_events,
    orders_from_events, orders_from_orders_table, raw_lines_from_events, read_table,
)
from actimetry.streaming.collector import Collector, stamp_lines
from actimetry.streaming.dau_table import DauTable
from actimetry.streaming.first_seen import FirstSeenTable

DATE = "2024-01-15"
SPLIT = "2024-01-15 12:00:00"
NEW_DATE = "2024-01-03"         # a day with new devices, for the reports that count them
SEED_DATE = "2024-01-26"        # the first-seen table is seeded up to here and then advanced day by day
BREAK_EVERY = 50                # of so many lines four are broken for the quarantine query
HOUR_IDS = ["dau", "order_amount", "new_mid"]
DISPATCH_IDS = ["dau", "order_amount", "new_mid", "new_id", "no_such_metric"]


# ----------------------------------------------------------------------------- inputs
def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def startup_logs(spark, sf, first=None, last=None, before=None, since=None) -> DataFrame:
    ev = events_in_days(events(spark, sf), first, last, before, since)
    return logs_from_events(ev, startup_only=True).select(*DAU_OUT)


def dau(spark, sf, first=None, last=None) -> DataFrame:
    """The DAU rows (first startup log per device and day) of a day range."""
    return first_per_key(split_valid(startup_logs(spark, sf, first, last))[0], tie_break=["seq"])


def stored_dau(spark, sf, days: list[str] | None = None) -> DataFrame:
    """DAU rows of the stored table; only the folders of ``days`` are listed and read."""
    return _read_dau_table(spark, sf, dates=days).select(*DAU_OUT)


def orders(spark, sf, first=None, last=None) -> DataFrame:
    return orders_from_events(events_in_days(events(spark, sf), first, last))


def stamped_lines(spark, sf) -> DataFrame:
    """Raw lines as the collector stamps and routes them: ``(value, ts, type, topic, _raw)``."""
    return stamp_lines(raw_lines_from_events(events(spark, sf)))


def _split_batches(spark, sf):
    """(seen keys from logs before SPLIT, startup logs at/after SPLIT)."""
    before = startup_logs(spark, sf, before=SPLIT)
    seen = first_per_key(before, tie_break=["seq"]).select("mid", "log_date")
    return seen, startup_logs(spark, sf, since=SPLIT)


# ------------------------------------------------------------------- DAU table (K3)
_TABLES: dict[tuple[str, str], DauTable] = {}


def dau_table(spark: SparkSession, sf: str) -> DauTable:
    """The DAU table of two arriving batches (logs before / after SPLIT), with the sample day compacted
    after the first, built by the batch writer once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TABLES:
        path = scratch_dir(spark, "dau-table")
        table = DauTable(spark, path, startup_logs(spark, sf).schema, tie_break=["seq"])
        table.process(startup_logs(spark, sf, before=SPLIT), 0)
        table.compact(DATE)
        table.process(startup_logs(spark, sf, since=SPLIT), 1)
        _TABLES[key] = table
    return _TABLES[key]


_FIRSTS: dict[tuple[str, str], str] = {}


def first_table(spark: SparkSession, sf: str) -> FirstSeenTable:
    """The first-seen table over the stored DAU table, built once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FIRSTS:
        table = FirstSeenTable(spark, scratch_dir(spark, "first-seen"))
        days = stored_dau(spark, sf)
        table.build(days, upto=days.agg(F.max("log_date")).first()[0] or DATE)
        _FIRSTS[key] = table.path
    return FirstSeenTable(spark, _FIRSTS[key], create=False)


def _read_dau_table(spark, sf, dates=None) -> DataFrame:
    return dau_table(spark, sf).dau(dates)


# ------------------------------------------------------------------------ sources
def s1_stream_source(spark, sf):
    return stream_checks.stream_logs_to_table(spark, sf)


def s2_raw_ingest(spark, sf):
    path = scratch_dir(spark, "raw-lines")
    raw_lines_from_events(events(spark, sf)).select("value").write.mode("overwrite").text(path)
    return read_raw_lines(spark, path).select("value")


def s3_dau_scan(spark, sf):
    return _read_dau_table(spark, sf, dates=[DATE]).select(*DAU_OUT, "batch_id")


def s4_seen_keys(spark, sf):
    return seen_keys(_read_dau_table(spark, sf, dates=[DATE]), DATE).select("mid")


def s5_order_scan(spark, sf):
    return orders(spark, sf)


# -------------------------------------------------------------------------- sinks
def _collected(spark, sf) -> Collector:
    """The collector's one writer over all lines, as batch 0."""
    root = scratch_dir(spark, "collected")
    collector = Collector(f"{root}/archive", f"{root}/routed")
    collector.process(stamped_lines(spark, sf), 0)
    return collector


def k1_routed_sink(spark, sf):
    routed = _collected(spark, sf).routed_path
    return spark.read.parquet(routed).select(F.col("topic").cast("string").alias("topic"), "value")


def k2_raw_archive(spark, sf):
    archive = _collected(spark, sf).archive_path
    return spark.read.parquet(archive).select(F.col("dt").cast("string").alias("dt"), "value")


def k3_dau_sink(spark, sf):
    return _read_dau_table(spark, sf).select(*DAU_OUT, "batch_id")


def k4_seen_write(spark, sf):
    return seen_keys(_read_dau_table(spark, sf))


def k5_preview(spark, sf):
    return preview(dau(spark, sf), 10, order=("ts", "seq"))


def k6_json_result(spark, sf):
    return totals_json(u1_realtime_total(spark, sf))


# -------------------------------------------------------------------- projections
def p1_json_parse(spark, sf):
    return parse_logs(stamped_lines(spark, sf), "value")


def p2_json_field(spark, sf):
    raw = raw_lines_from_events(events(spark, sf))
    return raw.select("seq", json_field("value", "$.type").alias("type"),
                      json_field("value", "$.itemid").alias("itemid"))


def p3_stamp_ts(spark, sf):
    return stamped_lines(spark, sf).select("value")


def p4_date_hour(spark, sf):
    logs = logs_from_events(events(spark, sf))
    return logs.select("seq", "ts", date_hour_text("ts").alias("date_hour"))


def p5_split_parts(spark, sf):
    d, h = split_date_hour(date_hour_text("ts"))
    return logs_from_events(events(spark, sf)).select("seq", d.alias("log_date"), h.alias("log_hour"))


def p6_derive_cols(spark, sf):
    return logs_from_events(events(spark, sf)).select(*LOG_OUT)


def p7_composite_key(spark, sf):
    return startup_logs(spark, sf).select("seq", composite_key("mid", "log_date").alias("dedup_key"))


def p8_namespaced_key(spark, sf):
    return dau(spark, sf).select("mid", namespaced_key("log_date").alias("set_key"))


def p9_as_of_date(spark, sf):
    latest = events(spark, sf).agg(F.max(epoch_ms_from_ntz("ts")).alias("ms"))
    return latest.select(as_of_date(F.timestamp_millis("ms")).alias("as_of"))


def p10_prev_day(spark, sf):
    days = logs_from_events(events(spark, sf)).select("log_date").distinct()
    return days.select("log_date", prev_day("log_date").alias("prev_date"))


def p11_upper_columns(spark, sf):
    return sink_columns(dau(spark, sf))


def p12_select_cols(spark, sf):
    return select_columns(dau(spark, sf), DAU_COLUMNS, fill_missing=True)


def p14_result_cast(spark, sf):
    """Typed result rows of both hourly series, for every day."""
    h = dau(spark, sf).groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("ct")).select(
        F.lit("dau").alias("metric"), F.col("log_date").alias("day"), F.col("log_hour").cast("string").alias("hour"),
        F.col("ct").cast("double").alias("value"))
    g = orders(spark, sf).groupBy("create_date", "create_hour").agg(money_sum("amount").alias("sum_amount")).select(
        F.lit("order_amount").alias("metric"), F.col("create_date").alias("day"), F.col("create_hour").cast("string").alias("hour"),
        F.col("sum_amount").cast("double").alias("value"))
    return h.unionByName(g)


def p16_json_write(spark, sf):
    return dau(spark, sf).select(to_json_record().alias("line"))


# ------------------------------------------------------------------------ filters
def f1_route_startup(spark, sf):
    return route(logs_from_events(events(spark, sf)))[0].select(*DAU_OUT)


def f1_route_event(spark, sf):
    return route(logs_from_events(events(spark, sf)))[1].select(*LOG_OUT)


def f2_date_filter(spark, sf):
    return dau(spark, sf, DATE).where(F.col("log_date") == DATE)


def f3_metric_dispatch(spark, sf):
    days = [prev_day_str(NEW_DATE), NEW_DATE]
    d, o, firsts = stored_dau(spark, sf, days), orders(spark, sf, *days), first_table(spark, sf).read(days)
    aliases: dict = {}                   # ids of one metric are computed once
    for mid in DISPATCH_IDS:
        aliases.setdefault(METRICS.get(mid), []).append(mid)
    parts = [dispatch(ids[0], d, o, NEW_DATE, firsts).select(
        F.explode(F.array(*map(F.lit, ids))).alias("id"), "period", "hour", F.col("value").cast("double").alias("value"))
        for builder, ids in aliases.items() if builder is not None]
    return reduce(DataFrame.unionByName, parts)


# -------------------------------------------------------------------------- joins
def j1_anti_asof(spark, sf):
    seen, batch = _split_batches(spark, sf)
    return anti_asof(batch, seen, DATE)


def j2_anti_by_date(spark, sf):
    seen, batch = _split_batches(spark, sf)
    return anti_by_date(batch, seen)


def j3_two_day_pair(spark, sf):
    return two_day_pair(stored_dau(spark, sf, [prev_day_str(DATE), DATE]), DATE, "log_date", "log_hour",
                        F.count(F.lit(1)))


# ------------------------------------------------------------------- aggregations
def a1_dau_total(spark, sf):
    return dau_total(stored_dau(spark, sf, [DATE]), DATE)


def a1_dau_daily(spark, sf):
    return dau_daily(dau(spark, sf))


def a2_dau_hours(spark, sf):
    return dau_hours(stored_dau(spark, sf, [DATE]), DATE)


def a3_first_per_key(spark, sf):
    return dau(spark, sf)


def a4_stage_counts(spark, sf):
    seen, batch = _split_batches(spark, sf)
    return stage_counts(batch, seen)


def a5_gmv_total(spark, sf):
    return gmv_total(orders(spark, sf, DATE), DATE)


def a5_gmv_daily_orders(spark, sf):
    """Daily order amount from the ``orders`` table (dates only, so no hours)."""
    return gmv_daily(orders_from_orders_table(read_table(spark, sf, "orders")))


def a6_gmv_hours(spark, sf):
    return gmv_hours(orders(spark, sf, DATE), DATE)


def a7_hour_map(spark, sf):
    per_hour = stored_dau(spark, sf).groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("ct"))
    m = hour_map(per_hour, "log_hour", "ct", ["log_date"], "hours")
    return m.select("log_date", F.to_json("hours").alias("hours"))


def a8_new_device_total(spark, sf):
    return first_table(spark, sf).new_device_total(NEW_DATE)


def a9_new_device_hours(spark, sf):
    return first_table(spark, sf).new_device_hours([prev_day_str(NEW_DATE), NEW_DATE])


def a8_new_device_daily(spark, sf):
    """All-days form: new devices per first day ``(log_date, new_devices)``."""
    return new_devices_by_day(first_seen(dau(spark, sf)))


def a9_new_device_hours_all(spark, sf):
    """All-days form: new devices by first day and hour ``(log_date, log_hour, ct)``."""
    return new_devices_by_hour(first_seen(dau(spark, sf)))


def a9_first_seen_table(spark, sf):
    """New devices by first day and hour from the incremental first-seen table:
    seeded from history up to ``SEED_DATE``, then advanced by every later day there is."""
    table = FirstSeenTable(spark, scratch_dir(spark, "first-seen"))
    table.build(dau(spark, sf, last=SEED_DATE), upto=SEED_DATE)
    later = startup_logs(spark, sf, first=SEED_DATE).where(F.col("log_date") > SEED_DATE).select("log_date").distinct()
    for day in sorted(r[0] for r in later.collect()):          # one row per day
        table.advance(dau(spark, sf, day, day), day)
    return new_devices_by_hour(table.read())


def a1_dau_total_sql(spark, sf):
    return dau_total_sql(spark, dau(spark, sf, DATE), DATE)


def a2_dau_hours_sql(spark, sf):
    return dau_hours_sql(spark, dau(spark, sf, DATE), DATE)


def a5_gmv_total_sql(spark, sf):
    return gmv_total_sql(spark, orders(spark, sf, DATE), DATE)


def a6_gmv_hours_sql(spark, sf):
    return gmv_hours_sql(spark, orders(spark, sf, DATE), DATE)


def a10_distinct_devices(spark, sf):
    return distinct_devices(startup_logs(spark, sf))


# ------------------------------------------------------------------------- unions
def u1_realtime_total(spark, sf):
    return realtime_total(stored_dau(spark, sf, [NEW_DATE]), orders(spark, sf, NEW_DATE, NEW_DATE), NEW_DATE,
                          firsts=first_table(spark, sf).read([NEW_DATE]))


def u2_realtime_hours(spark, sf):
    days = [prev_day_str(NEW_DATE), NEW_DATE]
    d, o, firsts = stored_dau(spark, sf, days), orders(spark, sf, *days), first_table(spark, sf).read(days)
    parts = [to_json_doc(realtime_hours(m, d, o, NEW_DATE, firsts)).select(F.lit(m).alias("id"), "doc")
             for m in HOUR_IDS]
    return reduce(DataFrame.unionByName, parts)


# ----------------------------------------------------------------------- quality
def q1_quarantine(spark, sf):
    """Lines broken by a rule on the event id over the whole table: cut text, no device, no arrival time, text
    after the object. Counts by reason."""
    n = F.pmod("seq", F.lit(BREAK_EVERY))
    lines = raw_lines_from_events(events(spark, sf)).select(
        F.when(n == 1, F.substring("value", 1, 20)).when(n == 2, F.regexp_replace("value", '"mid":"[^"]*",', ""))
        .when(n == 4, F.concat("value", F.lit(" trailing"))).otherwise(F.col("value")).alias("value"),
        F.when(n != 3, F.col("arrival")).alias("arrival"))
    stamped = stamp_lines(lines).select(F.coalesce("value", "_raw").alias("value"))
    tagged = tag_problems(parse_logs(stamped, "value"))
    return tagged.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------- streaming
def r2_stream_dedup(spark, sf):
    return stream_checks.stream_run(spark, sf).dau().select(*DAU_OUT)


def r2_stream_dropdup(spark, sf):
    return stream_checks.stream_dropdup_keys(spark, sf)


def r2_stream_from_json(spark, sf):
    return stream_checks.stream_from_json(spark, sf)


def a4_stream_stage_totals(spark, sf):
    """Per-batch counts observed inside the stream, summed over its batches:
    rows that arrived and rows that became new DAU rows."""
    return stream_checks.stream_run(spark, sf).stats().agg(F.sum("rows_in").cast("long").alias("rows_in"),
                                             F.sum("rows_new").cast("long").alias("rows_new"))


def r7_stream_daily(spark, sf):
    return stream_checks.stream_daily_counts(spark, sf)


def r7_stream_hours(spark, sf):
    return stream_checks.stream_run(spark, sf).hours()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in list(globals().items())
    if callable(fn) and name[:1] in "spfjakuqr" and name[1:2].isdigit()
}
