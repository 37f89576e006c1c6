"""The two dashboard answers.

* ``realtime_total(date)`` – three metric rows ``(id, name, value)``: DAU, new
  devices and order amount for the day.
* ``realtime_hours(id, date)`` – the metric's hourly series for the day and the day
  before, as ``{yesterday: map, today: map}`` (or long form).

Both read each input once: the two days of an hourly series come from a single
scan with ``log_date IN (d-1, d)``, labelled by period.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actimetry.functions.timefmt import check_date, prev_day_str
from actimetry.operators.metrics import dau_total, first_seen, gmv_total, money_sum
from actimetry.schemas import (
    METRIC_DAU, METRIC_DAU_NAME, METRIC_GMV, METRIC_GMV_NAME, METRIC_NEW_DEVICE_HOURS_ID,
    METRIC_NEW_DEVICE_NAME, METRIC_NEW_DEVICE_TOTAL_ID,
)


def _metric_row(df: DataFrame, value_col: str, mid: str, name: str) -> DataFrame:
    return df.select(F.lit(mid).alias("id"), F.lit(name).alias("name"),
                     F.col(value_col).cast("double").alias("value"))


def _firsts(dau: DataFrame, firsts: DataFrame | None, upto: str) -> DataFrame:
    """First-seen rows ``(mid, first_date, first_hour)``: from the maintained first-seen
    table when given (reads one or two day folders), else aggregated from history."""
    return firsts if firsts is not None else first_seen(dau, upto=upto)


def realtime_total(dau: DataFrame, orders: DataFrame, date: str,
                   new_device_id: str = METRIC_NEW_DEVICE_TOTAL_ID,
                   firsts: DataFrame | None = None) -> DataFrame:
    """``(id, name, value DOUBLE)``: dau (count), new devices (count), order_amount (sum,
    null on a day without orders). New devices come from ``firsts`` (a first-seen
    table) or, without it, from the DAU history up to ``date``."""
    date = check_date(date)
    new = _firsts(dau, firsts, date).where(F.col("first_date") == date) \
        .agg(F.count(F.lit(1)).alias("new_devices"))
    return _metric_row(dau_total(dau, date), "dau", METRIC_DAU, METRIC_DAU_NAME) \
        .unionByName(_metric_row(new, "new_devices", new_device_id, METRIC_NEW_DEVICE_NAME)) \
        .unionByName(_metric_row(gmv_total(orders, date), "gmv", METRIC_GMV, METRIC_GMV_NAME))


def two_day_pair(df: DataFrame, date: str, date_col: str, hour_col: str, value) -> DataFrame:
    """Hourly series of ``date`` and the day before from ONE scan:
    ``(period, hour, value)`` with period ``today``/``yesterday``."""
    date = check_date(date)
    days = [prev_day_str(date), date]
    period = F.when(F.col(date_col) == date, F.lit("today")).otherwise(F.lit("yesterday"))
    return df.where(F.col(date_col).isin(days)) \
        .groupBy(period.alias("period"), F.col(hour_col).alias("hour")).agg(value.alias("value"))


def _dau_pairs(dau: DataFrame, orders: DataFrame, date: str, firsts=None) -> DataFrame:
    return two_day_pair(dau, date, "log_date", "log_hour", F.count(F.lit(1)))


def _gmv_pairs(dau: DataFrame, orders: DataFrame, date: str, firsts=None) -> DataFrame:
    return two_day_pair(orders, date, "create_date", "create_hour", money_sum("amount"))


def _new_device_pairs(dau: DataFrame, orders: DataFrame, date: str, firsts=None) -> DataFrame:
    date = check_date(date)
    days = [prev_day_str(date), date]
    fs = _firsts(dau, firsts, date).where(F.col("first_date").isin(days))
    period = F.when(F.col("first_date") == date, F.lit("today")).otherwise(F.lit("yesterday"))
    return fs.groupBy(period.alias("period"), F.col("first_hour").alias("hour")) \
        .agg(F.count(F.lit(1)).alias("value"))


# Metric id → builder of its two-day long form. ``new_id`` (the id the totals
# use) is accepted as an alias of ``new_mid``.
METRICS: dict[str, Callable[..., DataFrame]] = {
    METRIC_DAU: _dau_pairs,
    METRIC_GMV: _gmv_pairs,
    METRIC_NEW_DEVICE_HOURS_ID: _new_device_pairs,
    METRIC_NEW_DEVICE_TOTAL_ID: _new_device_pairs,
}


def dispatch(metric_id: str, dau: DataFrame, orders: DataFrame, date: str,
             firsts: DataFrame | None = None) -> DataFrame | None:
    """Long form ``(period, hour, value)`` for a metric id; ``None`` for an unknown id."""
    check_date(date)
    builder = METRICS.get(metric_id)
    return None if builder is None else builder(dau, orders, date, firsts)


def realtime_hours(metric_id: str, dau: DataFrame, orders: DataFrame, date: str,
                   firsts: DataFrame | None = None) -> DataFrame:
    """One row ``(yesterday MAP, today MAP)``: hour → value, keys sorted, empty map for a
    day without rows; both null for an unknown id (renders as ``{}``)."""
    long = dispatch(metric_id, dau, orders, date, firsts)
    spark = dau.sparkSession
    if long is None:
        return spark.createDataFrame([(None, None)], "yesterday map<string,bigint>, today map<string,bigint>")

    def fold(period: str):
        e = F.when(F.col("period") == period, F.struct(F.col("hour").alias("k"), F.col("value").alias("v")))
        return F.map_from_entries(F.array_sort(F.collect_list(e))).alias(period)

    # input is at most 48 pre-aggregated rows, so this global fold is tiny
    return long.agg(fold("yesterday"), fold("today"))


def to_json_doc(df: DataFrame, name: str = "doc") -> DataFrame:
    """Render each row as one JSON object. Null fields are omitted, so an unknown id's
    ``{yesterday: null, today: null}`` prints ``{}``."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(name))


def totals_json(totals: DataFrame, name: str = "doc") -> DataFrame:
    """``realtime_total`` as the JSON list the dashboard reads, rows in the fixed order
    dau, new devices, order amount; counts print as integers, the amount as a
    decimal number (a variant per row), a null amount is left out."""
    order = F.when(F.col("id") == METRIC_DAU, 0).when(F.col("id") == METRIC_GMV, 2).otherwise(1)
    ordered = F.array_sort(F.collect_list(F.struct(order.alias("o"), "id", "name", "value")))

    def render(x):
        val = F.when(x["id"] == METRIC_GMV, x["value"].cast("variant")) \
            .otherwise(x["value"].cast("long").cast("variant"))
        return F.struct(x["id"].alias("id"), x["name"].alias("name"), val.alias("value"))

    return totals.agg(F.to_json(F.transform(ordered, render)).alias(name))
