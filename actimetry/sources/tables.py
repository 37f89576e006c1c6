"""Driver tables and how they map onto log records and orders.

``events(event_id, ts, user_id, event_type, value, props)`` plays the role of
the collected log stream:

* a ``view`` row is a startup log, every other row an event log (``evid`` = its type);
* ``mid`` (device) and ``uid`` are ``user_id`` as text;
* ``ts`` (epoch ms) is the zone-less ``ts`` read as UTC; ``seq`` = ``event_id`` is the tie-break;
* a ``purchase`` row is an order line of amount ``value`` (orders by hour).

Date filters are turned into a half-open range on the raw ``ts`` so they reach
the Parquet scan as pushed filters (row groups outside the range are skipped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actimetry.functions.timefmt import day_bounds, epoch_ms_from_ntz, with_date_hour
from actimetry.schemas import STARTUP_TYPE


# Columns of the event-derived log records: every log, and startup logs (no ``evid``).
LOG_COLUMNS = ["seq", "mid", "uid", "type", "evid", "ts", "log_date", "log_hour"]
STARTUP_COLUMNS = ["seq", "mid", "uid", "type", "ts", "log_date", "log_hour"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_in_days(events: DataFrame, first_date: str | None = None,
                   last_date: str | None = None, before: str | None = None,
                   since: str | None = None) -> DataFrame:
    """Restrict raw events to whole days ``[first_date, last_date]`` and/or to
    ``since <= ts < before`` (wall-clock text). All become comparisons on the raw
    column, i.e. Parquet pushed filters."""
    if first_date is not None or last_date is not None:
        lo, hi = day_bounds(first_date or last_date, last_date or first_date)
        if first_date is not None:
            events = events.where(F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
        events = events.where(F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
    if before is not None:
        events = events.where(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    if since is not None:
        events = events.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    return events


def logs_from_events(events: DataFrame, startup_only: bool = False, tz: str = "UTC") -> DataFrame:
    """Events as stamped log records ``(seq, mid, uid, type, evid, ts, log_date, log_hour)``."""
    if startup_only:
        events = events.where(F.col("event_type") == "view")
    et = F.col("event_type")
    logs = events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        # view -> startup; any other known type -> event; a null type stays null
        F.when(et == "view", F.lit(STARTUP_TYPE)).when(et.isNotNull(), F.lit("event")).alias("type"),
        F.when(et != "view", et).alias("evid"),
        epoch_ms_from_ntz("ts").alias("ts"),
    )
    return with_date_hour(logs, "ts", tz)


def orders_from_events(events: DataFrame, tz: str = "UTC") -> DataFrame:
    """Purchase events as order rows ``(order_id, create_date, create_hour, amount)``."""
    rows = events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("order_id"),
        epoch_ms_from_ntz("ts").alias("ts"),
        F.col("value").alias("amount"),
    )
    return with_date_hour(rows, "ts", tz, "create_date", "create_hour").drop("ts")


def orders_from_orders_table(orders: DataFrame) -> DataFrame:
    """The ``orders`` table as order rows ``(order_id, create_date, amount)``. It has an
    order date but no time of day, so it serves daily totals only (no ``create_hour``)."""
    return orders.select(F.col("o_orderkey").alias("order_id"),
                         F.col("o_orderdate").cast("date").cast("string").alias("create_date"),
                         F.col("o_totalprice").alias("amount"))


def raw_lines_from_events(events: DataFrame) -> DataFrame:
    """Events rendered as the JSON log lines a collector receives (before stamping):
    ``{"type":"startup","mid":..,"uid":..,"seq":..}`` or with ``evid`` and ``itemid`` for
    event logs (``itemid`` from ``props.k``). Arrival time travels beside the line as
    ``arrival`` (what a broker or file listing provides)."""
    et = F.col("event_type")
    is_start = et == "view"
    rec = F.struct(
        F.when(is_start, F.lit(STARTUP_TYPE)).when(et.isNotNull(), F.lit("event")).alias("type"),
        F.col("user_id").cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.when(~is_start, et).alias("evid"),
        F.when(~is_start, F.get_json_object("props", "$.k").try_cast("int")).alias("itemid"),
        F.col("event_id").alias("seq"),
    )
    return events.select(F.col("event_id").alias("seq"), F.to_json(rec).alias("value"),
                         F.timestamp_millis(epoch_ms_from_ntz("ts")).alias("arrival"))
