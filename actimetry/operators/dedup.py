"""First record per device per day, and cross-batch membership filters.

``first_per_key`` is ``row_number() = 1`` over ``(mid, log_date)``: Spark plans it
with a *partial* WindowGroupLimit before the shuffle, so however many rows one
hot device has, each map task forwards at most one per key – the shuffle is
bounded by keys × tasks, not by rows. The anti-joins carry no broadcast hint:
AQE broadcasts the seen side only when its measured size is under the
threshold and keeps a sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("mid", "log_date")


def first_per_key(df: DataFrame, keys=KEYS, order=("ts",), tie_break=None) -> DataFrame:
    """Keep the row with the least ``order`` per key. Ties are broken by ``tie_break``
    columns (default: every remaining column, so the choice is deterministic)."""
    keys, order = list(keys), list(order)
    if tie_break is None:
        tie_break = [f.name for f in df.schema.fields
                     if f.name not in keys and f.name not in order
                     and f.dataType.typeName() not in ("map", "variant")]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order + list(tie_break)])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_with_count(df: DataFrame, keys=KEYS, order=("ts",), tie_break=None, count: str = "rows__") -> DataFrame:
    """``first_per_key`` with the number of rows of each key, in one grouped aggregate: a hot device is one row per task
    before the shuffle. The other columns must be orderable (no map, no variant)."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    ties = list(tie_break) if tie_break is not None else [c for c in rest if c not in order]
    # nulls last, as in first_per_key
    rank = [F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(f"k{i}") for i, c in enumerate(order + ties)]
    least = F.min(F.struct(*rank, F.struct(*rest).alias("row"))).alias("least__")
    return (df.groupBy(*keys).agg(least, F.count(F.lit(1)).alias(count))
            .select(*[F.col(c) if c in keys else F.col("least__.row").getField(c).alias(c) for c in df.columns], count))


def anti_asof(batch: DataFrame, seen: DataFrame, as_of: str) -> DataFrame:
    """Drop batch rows whose device is in the set of day ``as_of`` (the set of
    'today by the clock', whatever the record's own date is)."""
    day = seen.where(F.col("log_date") == as_of).select("mid")
    return batch.join(day, "mid", "left_anti")


def anti_by_date(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop batch rows whose ``(mid, record's log_date)`` is already in the set."""
    return batch.join(seen.select("mid", "log_date"), ["mid", "log_date"], "left_anti")


def distinct_devices(df: DataFrame) -> DataFrame:
    """Distinct devices per day ``(log_date, devices)``; equals the DAU count per day."""
    return df.groupBy("log_date").agg(F.count_distinct("mid").alias("devices"))
