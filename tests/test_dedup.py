"""First-per-device-per-day, anti-joins, the DAU table (replay), time edge cases."""

import datetime as dt

import pytest

from actimetry.functions.timefmt import check_date, prev_day, prev_day_str, with_date_hour
from actimetry.operators.dedup import anti_asof, anti_by_date, first_per_key, first_with_count
from actimetry.streaming.dau_stream import DauTable

SCHEMA = "seq long, mid string, ts long"


def ms(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def logs(spark, rows):
    return with_date_hour(spark.createDataFrame(rows, SCHEMA), "ts", "UTC")


def test_tie_on_ts_is_broken_by_tie_column(spark):
    t = ms("2024-01-15 08:00:00")
    df = logs(spark, [(2, "m1", t), (1, "m1", t), (3, "m1", t + 1)])
    out = first_per_key(df, tie_break=["seq"]).collect()
    assert [(r.seq, r.mid) for r in out] == [(1, "m1")]
    # default tie-break (all remaining columns) is deterministic too
    assert first_per_key(df).collect()[0].seq == 1


def test_midnight_gives_two_rows_hours_23_and_00(spark):
    df = logs(spark, [(1, "m1", ms("2024-01-15 23:59:59.999")), (2, "m1", ms("2024-01-16 00:00:00"))])
    out = sorted((r.log_date, r.log_hour) for r in first_per_key(df).collect())
    assert out == [("2024-01-15", "23"), ("2024-01-16", "00")]


def test_leap_year_prev_day_and_bad_date(spark):
    r = spark.createDataFrame([("2024-03-01",), ("2023-03-01",)], "d string") \
        .select(prev_day("d").alias("p")).collect()
    assert [x.p for x in r] == ["2024-02-29", "2023-02-28"]
    assert prev_day_str("2024-03-01") == "2024-02-29"
    with pytest.raises(ValueError):
        check_date("2024-13-01")
    with pytest.raises(Exception):
        spark.createDataFrame([("2024-13-01",)], "d string").select(prev_day("d")).collect()


def test_first_arrived_batch_wins_even_with_smaller_ts_later(spark, tmp_root):
    df1 = logs(spark, [(1, "m1", ms("2024-01-15 10:00:00")), (2, "m2", ms("2024-01-15 11:00:00"))])
    df2 = logs(spark, [(3, "m1", ms("2024-01-15 09:00:00")), (4, "m3", ms("2024-01-15 09:30:00"))])
    table = DauTable(spark, tmp_root, df1.schema, tie_break=["seq"])
    table.process(df1, 0)
    table.process(df2, 1)
    got = sorted((r.mid, r.seq, r.batch_id) for r in table.dau().collect())
    assert got == [("m1", 1, 0), ("m2", 2, 0), ("m3", 4, 1)]
    stats = sorted((r.batch_id, r.rows_in, r.rows_first, r.rows_new) for r in table.stats().collect())
    assert stats == [(0, 2, 2, 2), (1, 2, 2, 1)]
    # replaying a committed batch id leaves the table unchanged
    table.process(df2, 1)
    again = sorted((r.mid, r.seq, r.batch_id) for r in table.dau().collect())
    assert again == got
    hours = sorted((r.log_date, r.log_hour, r.ct) for r in table.hours().collect())
    assert hours == [("2024-01-15", "09", 1), ("2024-01-15", "10", 1), ("2024-01-15", "11", 1)]


def test_late_row_asof_vs_record_date(spark):
    # seen: m1 active yesterday (14th), m2 active today (15th)
    seen = spark.createDataFrame([("m1", "2024-01-14"), ("m2", "2024-01-15")], "mid string, log_date string")
    late = logs(spark, [(1, "m1", ms("2024-01-14 23:00:00")),   # counted yesterday already
                        (2, "m2", ms("2024-01-14 22:00:00"))])  # active today only
    j2 = sorted(r.mid for r in anti_by_date(late, seen).collect())
    j1 = sorted(r.mid for r in anti_asof(late, seen, "2024-01-15").collect())
    assert j2 == ["m2"]          # record-date: m1 dropped, m2 kept
    assert j1 == ["m1"]          # as-of-today: m1 kept (not caught), m2 dropped


def test_dedup_is_idempotent_and_equals_distinct_keys(spark):
    df = logs(spark, [(i, f"m{i % 7}", ms("2024-01-15 00:00:00") + i * 3_600_000) for i in range(60)])
    once = first_per_key(df, tie_break=["seq"])
    twice = first_per_key(once, tie_break=["seq"])
    counted = first_with_count(df, tie_break=["seq"])
    assert counted.agg({"rows__": "sum"}).first()[0] == 60 and sorted(counted.drop("rows__").collect()) == sorted(once.collect())
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == df.select("mid", "log_date").distinct().count()


def test_dau_table_as_of_mode_checks_todays_set(spark, tmp_root):
    # batch 0 stores m1 for the 14th and m2 for the 15th; batch 1 brings late rows of the 14th
    b0 = logs(spark, [(1, "m1", ms("2024-01-14 10:00:00")), (2, "m2", ms("2024-01-15 08:00:00"))])
    b1 = logs(spark, [(3, "m1", ms("2024-01-14 23:00:00")), (4, "m2", ms("2024-01-14 22:00:00"))])
    by_mode = {}
    for mode in ("record_date", "as_of"):
        t = DauTable(spark, f"{tmp_root}/{mode}", b0.schema, tie_break=["seq"], seen_mode=mode,
                     as_of=lambda: "2024-01-15")
        t.process(b0, 0)
        t.process(b1, 1)
        by_mode[mode] = sorted((r.mid, r.log_date, r.seq) for r in t.dau().where("batch_id = 1").collect())
    assert by_mode["record_date"] == [("m2", "2024-01-14", 4)]   # m1 already counted on the 14th
    assert by_mode["as_of"] == [("m1", "2024-01-14", 3)]         # m2 active today -> dropped
    with pytest.raises(ValueError):
        DauTable(spark, f"{tmp_root}/bad", b0.schema, seen_mode="nope")


def test_new_checkpoint_on_existing_table_keeps_stored_rows(spark, tmp_root):
    b0 = logs(spark, [(1, "m1", ms("2024-01-15 08:00:00")), (2, "m2", ms("2024-01-15 09:00:00"))])
    b1 = logs(spark, [(3, "m3", ms("2024-01-15 10:00:00"))])
    again = logs(spark, [(4, "m3", ms("2024-01-15 11:00:00")), (5, "m9", ms("2024-01-15 12:00:00"))])
    t = DauTable(spark, tmp_root, b0.schema, tie_break=["seq"], run="first")
    t.process(b0, 0)
    t.process(b1, 1)
    t2 = DauTable(spark, tmp_root, b0.schema, tie_break=["seq"], run="second")   # ids restart at 0
    t2.process(again, 0)
    got = sorted((r.mid, r.seq) for r in t2.dau().collect())
    assert got == [("m1", 1), ("m2", 2), ("m3", 3), ("m9", 5)]


def test_checkpoint_root_falls_back_only_when_unset(tmp_path):
    from actimetry.config import checkpoint_root

    class Conf:
        def __init__(self, v): self.v = v
        def get(self, k, d=None): return self.v if k == "spark.checkpoint.dir" else d

    class SC:
        def __init__(self, v): self.conf, self.dir = Conf(v), None
        def getConf(self): return self.conf
        def getCheckpointDir(self): return self.dir
        def setCheckpointDir(self, d): self.dir = d + "/uuid"

    class S:
        def __init__(self, v): self.sparkContext = SC(v)

    assert checkpoint_root(S("hdfs://nn/ckpt/")) == "hdfs://nn/ckpt"
    s = S(None)
    root = checkpoint_root(s)
    assert root.endswith("/uuid") and s.sparkContext.dir == root
