"""A hot device holding a third of all rows: results stay exact, and the dedup ships at
most one row per key per map task (partial WindowGroupLimit before the exchange)."""

import duckdb
from pyspark.sql import functions as F

from actimetry.config import scratch_dir
from actimetry.operators.dedup import first_per_key
from actimetry.operators.metrics import dau_hours, first_seen
from actimetry.sources.tables import logs_from_events
from tests.conftest import SF_MID


def _skewed(spark):
    path = scratch_dir(spark, "skewed") + "/events"
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))
    ev.withColumn("user_id", hot).write.parquet(path)
    return path


def test_hot_device_dedup_matches_duckdb_and_plan_is_bounded(spark):
    path = _skewed(spark)
    logs = logs_from_events(spark.read.parquet(path), startup_only=True)
    dau = first_per_key(logs.select("seq", "mid", "ts", "log_date", "log_hour"), tie_break=["seq"])
    got = sorted((r.mid, r.log_date, r.seq) for r in dau.collect())
    want = duckdb.sql(f"""
        SELECT CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d'), arg_min(event_id, (epoch_us(ts) // 1000, event_id))
        FROM read_parquet('{path}/*.parquet') WHERE event_type = 'view' GROUP BY 1, 2""").fetchall()
    assert got == sorted(want)
    hot_days = [r for r in got if r[0] == "7"]
    assert len(hot_days) == 30

    plan = dau._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # partial limit sits below the exchange: the hot key reaches the shuffle at most once per task
    assert plan.index("Exchange") < plan.rindex("Partial")

    hours = dau_hours(dau, "2024-01-15").collect()
    assert sum(r.ct for r in hours) == sum(1 for r in got if r[1] == "2024-01-15")
    fs = first_seen(dau).where(F.col("mid") == "7").collect()
    assert [(r.first_date, r.first_hour) for r in fs] == [("2024-01-01", fs[0].first_hour)]
