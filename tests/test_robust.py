"""Null keys, replays, odd lines, small amounts, the trigger and the plans of the stored-table reports."""

import time

import pytest
from pyspark.sql import functions as F

from actimetry.functions.jsonfmt import parse_logs, stamp_json
from actimetry.operators.metrics import gmv_total
from actimetry.plans import catalog as C
from actimetry.sources.logs import read_dau_table
from actimetry.streaming.collector import Collector, stamp_lines
from actimetry.streaming.dau_stream import DauTable, start_dau_stream
from actimetry.streaming.first_seen import FirstSeenTable

SF_SMALL = "/root/testdata/sf0.001"
RECORD = "seq long, mid string, ts long, log_date string, log_hour string"


def rows(spark, data):
    return spark.createDataFrame(data, RECORD)


def test_null_devices_and_times_are_kept_apart_and_not_counted(spark, tmp_root):
    t = DauTable(spark, tmp_root, rows(spark, []).schema, tie_break=["seq"])
    for b in range(2):
        t.process(rows(spark, [(1 + b, None, 5, "2024-01-15", "01"), (3 + b, "a", 5, "2024-01-15", "01"),
                               (5 + b, "b", None, None, None)]), b)
    assert [r.mid for r in t.dau().collect()] == ["a"]
    assert [r.ct for r in t.hours().collect()] == [1]
    assert sorted(r.reason for r in t.quarantined().collect()) == ["null_mid"] * 2 + ["null_ts"] * 2


def test_replay_in_as_of_mode_uses_the_day_of_the_first_run(spark, tmp_root):
    day = ["2024-01-15"]
    t = DauTable(spark, tmp_root, rows(spark, []).schema, tie_break=["seq"], seen_mode="as_of", as_of=lambda: day[0])
    t.process(rows(spark, [(1, "a", 5, "2024-01-15", "01")]), 0)
    again = rows(spark, [(2, "a", 9, "2024-01-15", "02"), (3, "b", 9, "2024-01-15", "02")])
    t.process(again, 1)
    day[0] = "2024-01-16"
    t.process(again, 1)
    assert sorted((r.mid, r.batch_id) for r in t.dau().collect()) == [("a", 0), ("b", 1)]


def test_repeated_keys_and_text_after_the_object(spark):
    lines = spark.createDataFrame([('{"type":"startup","mid":"m","mid":"m2"}',), ('{"a":1} trailing',), ('{"a":1}{"b":2}',),
                                   (None,)], "value string")
    got = [r.v for r in lines.select(stamp_json("value", F.lit(7)).alias("v")).collect()]
    assert got == ['{"type":"startup","mid":"m2","ts":7}', None, None, None]
    bad = [r._corrupt_record for r in parse_logs(lines, "value").collect()]
    assert bad == [None, '{"a":1} trailing', '{"a":1}{"b":2}', ""]


def test_collector_run_twice_writes_once_and_keeps_bad_lines(spark, tmp_root):
    lines = spark.createDataFrame([('{"type":"startup","mid":"m"}', 1), ("broken", 2)], "value string, t long").select(
        "value", F.timestamp_seconds("t").alias("arrival"))
    c = Collector(f"{tmp_root}/archive", f"{tmp_root}/routed")
    for _ in range(2):
        c.process(stamp_lines(lines), 0)
    assert spark.read.parquet(c.routed_path).count() == 1
    assert spark.read.parquet(c.archive_path).count() == 1
    assert [r.raw for r in spark.read.parquet(c.quarantine_path).collect()] == ["broken"]


def test_fractions_of_a_cent_count(spark):
    o = spark.createDataFrame([("2024-01-01", 0.001)] * 10, "create_date string, amount double")
    assert gmv_total(o, "2024-01-01").first().gmv == pytest.approx(0.01)


def test_first_seen_takes_an_earlier_day_and_refuses_a_missing_path(spark, tmp_root):
    dau = spark.createDataFrame([("m1", "2024-01-03", "05"), ("m1", "2024-01-02", "07")], "mid string, log_date string, log_hour string")
    t = FirstSeenTable(spark, f"{tmp_root}/fs")
    t.advance(dau, "2024-01-03")
    assert t.advance(dau, "2024-01-02") == ["2024-01-03"]
    assert [tuple(r) for r in t.read().collect()] == [("m1", "07", "2024-01-02")]
    with pytest.raises(FileNotFoundError):
        FirstSeenTable(spark, f"{tmp_root}/nowhere", create=False)


def test_reports_read_two_days_of_the_stored_table(spark):
    C.u2_realtime_hours(spark, SF_SMALL)
    df = C.stored_dau(spark, SF_SMALL, ["2024-01-02", "2024-01-03"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [log_date" in plan
    total = C.u1_realtime_total(spark, SF_SMALL)
    assert all(r.value and r.value > 0 for r in total.where("id != 'order_amount'").collect())
    assert total._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 3


def test_files_of_a_batch_follow_its_size(spark, tmp_root):
    t = DauTable(spark, tmp_root, rows(spark, []).schema, tie_break=["seq"])
    t.process(rows(spark, [(i, f"m{i}", i, "2024-01-15", "01") for i in range(500)]), 0)
    files = read_dau_table(spark, t.dau_path, t.record).inputFiles()
    assert len(files) == 1


def test_processing_time_trigger_over_two_batches(spark, tmp_root):
    src, schema = f"{tmp_root}/src", rows(spark, []).schema
    rows(spark, [(1, "a", 5, "2024-01-15", "01")]).write.parquet(src)
    t = DauTable(spark, f"{tmp_root}/t", schema, tie_break=["seq"])
    q = start_dau_stream(spark.readStream.schema(schema).parquet(src), t, f"{tmp_root}/ck", {"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        rows(spark, [(2, "a", 6, "2024-01-15", "02"), (3, "b", 6, "2024-01-15", "02")]).write.mode("append").parquet(src)
        time.sleep(1)
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted((r.mid, r.batch_id) for r in t.dau().collect()) == [("a", 0), ("b", 1)]


def test_stage_counts_are_those_of_raw_unseen_and_new_rows(spark, tmp_root):
    t = DauTable(spark, tmp_root, rows(spark, []).schema, tie_break=["seq"])
    t.process(rows(spark, [(1, "a", 1, "2024-01-15", "01"), (2, "a", 2, "2024-01-15", "01")]), 0)
    t.process(rows(spark, [(3, "a", 3, "2024-01-15", "01"), (4, "b", 4, "2024-01-15", "01"), (5, "b", 5, "2024-01-15", "02"),
                           (6, "a", 6, "2024-01-16", "01")]), 1)
    t.process(rows(spark, [(7, "b", 7, "2024-01-15", "03")]), 2)
    assert sorted((r.batch_id, r.rows_in, r.rows_unseen, r.rows_first, r.rows_new) for r in t.stats().collect()) == [
        (0, 2, 2, 1, 1), (1, 4, 3, 3, 2), (2, 1, 0, 1, 0)]
