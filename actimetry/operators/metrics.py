"""Dashboard metrics over the DAU table and order rows.

All are plain grouped aggregates (partial aggregation before the shuffle, so a
hot day or hour costs one row per task in the exchange). Results keep the
original semantics: a day with no rows has DAU 0 but GMV null; hours with no
rows are absent, not zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def by_date(df: DataFrame, date: str, date_col: str = "log_date") -> DataFrame:
    """Equality on the date column (a partition filter on the stored DAU table)."""
    return df.where(F.col(date_col) == F.lit(date))


def money_sum(col) -> Column:
    """Order-independent sum of money held as double: each amount as a decimal with eight
    places, so fractions of a cent count and the result doesn't depend on task order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(28,8)")).cast("double")


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """``count(*)`` of DAU rows on ``date`` → one row ``(dau BIGINT)`` (0 on an empty day)."""
    return by_date(dau, date).agg(F.count(F.lit(1)).alias("dau"))


def dau_daily(dau: DataFrame) -> DataFrame:
    """All-days form: ``(log_date, dau)``."""
    return dau.groupBy("log_date").agg(F.count(F.lit(1)).alias("dau"))


def dau_hours(dau: DataFrame, date: str) -> DataFrame:
    """DAU by hour on ``date``: ``(lh STRING, ct BIGINT)``."""
    return by_date(dau, date).groupBy(F.col("log_hour").alias("lh")) \
        .agg(F.count(F.lit(1)).alias("ct"))


def gmv_total(orders: DataFrame, date: str) -> DataFrame:
    """Order amount on ``date`` → one row ``(gmv DOUBLE)``, null when there are no orders."""
    return by_date(orders, date, "create_date").agg(money_sum("amount").alias("gmv"))


def gmv_daily(orders: DataFrame) -> DataFrame:
    """All-days form: ``(create_date, gmv)``."""
    return orders.groupBy("create_date").agg(money_sum("amount").alias("gmv"))


def gmv_hours(orders: DataFrame, date: str) -> DataFrame:
    """Order amount by hour: ``(create_hour, sum_amount)``."""
    return by_date(orders, date, "create_date").groupBy("create_hour") \
        .agg(money_sum("amount").alias("sum_amount"))


def hour_map(df: DataFrame, hour_col: str, value_col: str, group_cols=(), name: str = "hours") -> DataFrame:
    """Fold ``(hour, value)`` rows into an hour→value map per group (keys sorted).
    Input is already aggregated per hour, so each group holds at most 24 entries."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(hour_col).alias("k"), F.col(value_col).alias("v"))))
    agg = F.map_from_entries(entries).alias(name)
    return df.groupBy(*group_cols).agg(agg) if group_cols else df.agg(agg)


def first_seen(dau: DataFrame, upto: str | None = None) -> DataFrame:
    """First day (and that day's first hour) of every device: ``(mid, first_date, first_hour)``.

    One hash aggregate on a packed long ``unix_date * 24 + hour`` – fixed-width, so it
    stays in HashAggregate with map-side combine (a device with a third of all rows
    costs one row per task). The DAU table holds one row per device and day, so
    the hour of the first day is the hour of that day's earliest log."""
    if upto is not None:
        dau = dau.where(F.col("log_date") <= F.lit(upto))
    packed = F.unix_date(F.to_date("log_date")).cast("long") * 24 + F.col("log_hour").cast("long")
    first = dau.groupBy("mid").agg(F.min(packed).alias("_first"))
    return first.select(
        "mid",
        F.date_from_unix_date(F.floor(F.col("_first") / 24).cast("int")).cast("string").alias("first_date"),
        F.lpad(F.pmod(F.col("_first"), F.lit(24)).cast("string"), 2, "0").alias("first_hour"),
    )


def new_device_total(dau: DataFrame, date: str) -> DataFrame:
    """Devices whose first DAU day is ``date`` → one row ``(new_devices BIGINT)``."""
    return first_seen(dau, upto=date).where(F.col("first_date") == date) \
        .agg(F.count(F.lit(1)).alias("new_devices"))


def new_devices_by_hour(firsts: DataFrame) -> DataFrame:
    """First-seen rows → new devices per first day and hour ``(log_date, log_hour, ct)``."""
    return firsts.groupBy(F.col("first_date").alias("log_date"), F.col("first_hour").alias("log_hour")) \
        .agg(F.count(F.lit(1)).alias("ct"))


def new_devices_by_day(firsts: DataFrame) -> DataFrame:
    """First-seen rows → new devices per first day ``(log_date, new_devices)``."""
    return firsts.groupBy(F.col("first_date").alias("log_date")).agg(F.count(F.lit(1)).alias("new_devices"))


def new_device_hours(dau: DataFrame, dates: list[str]) -> DataFrame:
    """New devices by first hour on each of ``dates``: ``(log_date, log_hour, ct)``."""
    return new_devices_by_hour(first_seen(dau, upto=max(dates)).where(F.col("first_date").isin(list(dates))))


def stage_counts(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """Row counts at the three checkpoints of one batch, in the original order:
    ``input`` → after the set filter (``after_anti``) → after in-batch first-per-key
    (``after_dedup``). One scan and one join: rows are flagged (not dropped) by a left
    join with the distinct seen keys, then all three counts come from one aggregate.
    Returns ``(stage, n_rows)``."""
    keys = seen.select("mid", "log_date").distinct().withColumn("_seen", F.lit(True))
    # one row per key and task before the shuffle, so a hot device is one row in the join
    per_key = batch.groupBy("mid", "log_date").agg(F.count(F.lit(1)).alias("n"))
    flagged = per_key.join(keys, ["mid", "log_date"], "left")
    unseen = F.col("_seen").isNull()
    counts = flagged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_in"),
        F.coalesce(F.sum(F.when(unseen, F.col("n"))), F.lit(0)).alias("n_anti"),
        F.count(F.when(unseen, F.lit(1))).alias("n_dedup"))
    return counts.select(F.expr(
        "stack(3, 'input', n_in, 'after_anti', n_anti, 'after_dedup', n_dedup) AS (stage, n_rows)"))
