"""State that stays bounded without loss, a hot device in two levels of state, and bounded micro-batches."""

import os

import pytest
from pyspark.sql import functions as F

from actimetry.sources.logs import admission, read_log_stream
from actimetry.streaming.dau_stream import (
    SALTS, distinct_keys, start_bounded_stream, start_daily_count_stream, start_dau_stream, start_dropdup_stream, DailyCountSink,
)
from actimetry.streaming.dau_table import DauTable

RECORD = "seq long, mid string, ts long, log_date string, log_hour string"
DAY = 86_400_000
START = 19_000 * DAY


def logs(spark, rows):
    """rows: (seq, mid, ms after START)."""
    df = spark.createDataFrame([(i, m, None if t is None else START + t) for i, m, t in rows], "seq long, mid string, ts long")
    at = F.timestamp_millis("ts")
    return df.select("seq", "mid", "ts", F.date_format(at, "yyyy-MM-dd").alias("log_date"), F.date_format(at, "HH").alias("log_hour"))


def feed(spark, folder, batches):
    for n, rows in enumerate(batches):
        path = f"{folder}/b{n:02d}"
        logs(spark, rows).coalesce(1).write.parquet(path)
        for f in os.listdir(path):
            os.utime(os.path.join(path, f), (1_700_000_000 + 10 * n,) * 2)


def stream(spark, folder, **options):
    return read_log_stream(spark, "parquet", f"{folder}/b*", RECORD, {"maxFilesPerTrigger": "1", **options})


def run(q):
    q.awaitTermination()
    assert q.exception() is None
    return q


def days_with_late_rows():
    """Twelve days of 30 devices, each row twice, and in every batch rows of any earlier day: of devices stored then, and new ones."""
    out, seq = [], 0
    for d in range(12):
        rows = []
        for i in range(30):
            for k in range(2):
                rows.append((seq := seq + 1, f"m{i}", d * DAY + 1000 * i + 500 * k))
        for back in (1, 3, 5, 9):
            if d >= back:
                rows += [(seq := seq + 1, "m3", (d - back) * DAY + 5), (seq := seq + 1, f"late{d}", (d - back) * DAY + 77),
                         (seq := seq + 1, f"late{d}", (d - back) * DAY + 7)]
        out.append(rows + [(seq := seq + 1, None, d * DAY), (seq := seq + 1, "m1", None)])
    return out


def table_rows(t):
    return sorted(tuple(r) for r in t.dau().select("seq", "mid", "ts", "log_date", "log_hour").collect())


def test_bounded_state_loses_no_late_row(spark, tmp_root):
    feed(spark, f"{tmp_root}/in", days_with_late_rows())
    schema = logs(spark, []).schema
    want = DauTable(spark, f"{tmp_root}/plain", schema, tie_break=["seq"])
    run(start_dau_stream(stream(spark, f"{tmp_root}/in"), want, f"{tmp_root}/ck1", {"availableNow": True}))
    t = DauTable(spark, f"{tmp_root}/bounded", schema, tie_break=["seq"])
    q = run(start_bounded_stream(stream(spark, f"{tmp_root}/in"), t, f"{tmp_root}/ck2", "1 day", {"availableNow": True}))
    assert table_rows(t) == table_rows(want) and len(table_rows(t)) > 380
    assert sorted(r.reason for r in t.quarantined().collect()) == sorted(r.reason for r in want.quarantined().collect())
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(state) <= 4 * 40                                  # a few days of devices; all days hold over 380 keys
    dropped = run(start_dropdup_stream(stream(spark, f"{tmp_root}/in"), f"{tmp_root}/out", f"{tmp_root}/ck3", {"availableNow": True},
                                       within_watermark="1 day"))
    assert dropped is not None and spark.read.parquet(f"{tmp_root}/out").where("mid IS NOT NULL AND ts IS NOT NULL").count() < len(table_rows(t))


def test_bounded_stream_goes_on_after_a_batch_that_was_cut_short(spark, tmp_root, monkeypatch):
    batches = days_with_late_rows()[:6]
    feed(spark, f"{tmp_root}/in", batches)
    schema = logs(spark, []).schema
    want = DauTable(spark, f"{tmp_root}/plain", schema, tie_break=["seq"])
    for b, rows in enumerate(batches):
        want.process(logs(spark, rows), b)
    t = DauTable(spark, f"{tmp_root}/t", schema, tie_break=["seq"])
    commit = DauTable._commit
    with monkeypatch.context() as m:
        m.setattr(DauTable, "_commit", lambda self, b: commit(self, b) if b != 3 else (_ for _ in ()).throw(RuntimeError("lost")))
        q = start_bounded_stream(stream(spark, f"{tmp_root}/in"), t, f"{tmp_root}/ck", "1 day", {"availableNow": True})
        with pytest.raises(Exception):
            q.awaitTermination()
    assert t.committed() == {t.run: 2}
    run(start_bounded_stream(stream(spark, f"{tmp_root}/in"), t, f"{tmp_root}/ck", "1 day", {"availableNow": True}))
    assert table_rows(t) == table_rows(want)


def test_a_delay_under_a_day_is_refused(spark, tmp_root):
    feed(spark, f"{tmp_root}/in", [[(1, "a", 0)]])
    t = DauTable(spark, f"{tmp_root}/t", logs(spark, []).schema)
    with pytest.raises(ValueError):
        start_bounded_stream(stream(spark, f"{tmp_root}/in"), t, f"{tmp_root}/ck", "2 hours")


def hot_rows():
    """One device sends a third of all rows."""
    return [(i, "hot" if i % 3 == 0 else f"m{i % 500}", (i % 3) * 1000 + i) for i in range(9000)]


def test_a_hot_device_is_dealt_over_tasks(spark, tmp_root):
    batches = [hot_rows()[i::3] for i in range(3)]
    feed(spark, f"{tmp_root}/in", batches)
    keys = sorted(tuple(r) for r in logs(spark, hot_rows()).select("mid", "log_date").distinct().collect())
    for n in (2, 3):                                             # restarts from its checkpoint with one more file
        source = stream(spark, f"{tmp_root}/in") if n == 3 else stream(spark, f"{tmp_root}/in", pathGlobFilter="*")
        run(start_dropdup_stream(source, f"{tmp_root}/out", f"{tmp_root}/ck", {"availableNow": True}, partitions=8))
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_root}/out").select("mid", "log_date").collect()) == keys
    sink = DailyCountSink(f"{tmp_root}/daily")
    run(start_daily_count_stream(stream(spark, f"{tmp_root}/in"), sink, f"{tmp_root}/ck-daily", {"availableNow": True}, partitions=8))
    assert [r.dau for r in sink.read(spark).collect()] == [len(keys)]
    # rows per task of the two exchanges, as their keys deal them
    df = logs(spark, hot_rows())
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
    n, total = 8, 9000

    def most(frame, *by):
        return max(r["count"] for r in frame.repartition(n, *by).groupBy(F.spark_partition_id()).count().collect())

    assert most(df, "mid", "log_date") > total / 3
    assert most(df.withColumn("salt", salt), "mid", "log_date", "salt") < 2 * total / n
    once = df.withColumn("salt", salt).dropDuplicates(["mid", "log_date", "salt"])
    assert once.where("mid = 'hot'").count() <= SALTS
    assert distinct_keys(df).count() == len(keys)


def test_a_backlog_is_drained_in_bounded_batches(spark, tmp_root):
    batches = days_with_late_rows()
    feed(spark, f"{tmp_root}/in", batches)
    schema = logs(spark, []).schema
    want = DauTable(spark, f"{tmp_root}/plain", schema, tie_break=["seq"])
    for b, rows in enumerate(batches):
        want.process(logs(spark, rows), b)

    def source():
        return read_log_stream(spark, "parquet", f"{tmp_root}/in/b*", RECORD, admission(max_files=2, archive=f"{tmp_root}/done"))

    t = DauTable(spark, f"{tmp_root}/t", schema, tie_break=["seq"])
    q = start_dau_stream(source(), t, f"{tmp_root}/ck", {"processingTime": "0 seconds"})
    while t.committed().get(t.run, -1) < 1:                      # stop in the backlog, and go on from the checkpoint
        assert q.exception() is None
        q.awaitTermination(1)
    q.stop()
    q = run(start_dau_stream(source(), t, f"{tmp_root}/ck", {"availableNow": True}))
    sizes = [p["numInputRows"] for p in q.recentProgress]
    assert max(sizes) <= 2 * max(map(len, batches)) and t.stats().count() >= 6
    assert sorted((r[1], r[3]) for r in table_rows(t)) == sorted((r[1], r[3]) for r in table_rows(want))
    moved = [f for _, _, fs in os.walk(f"{tmp_root}/done") for f in fs if f.endswith(".parquet")]
    left = [f for _, _, fs in os.walk(f"{tmp_root}/in") for f in fs if f.endswith(".parquet")]
    assert len(moved) + len(left) == len(batches) and len(moved) >= 4


def test_batches_bounded_by_bytes(spark, tmp_root):
    feed(spark, f"{tmp_root}/in", days_with_late_rows()[:4])
    t = DauTable(spark, f"{tmp_root}/t", logs(spark, []).schema, tie_break=["seq"])
    source = read_log_stream(spark, "parquet", f"{tmp_root}/in/b*", RECORD, admission(max_bytes=1))
    run(start_dau_stream(source, t, f"{tmp_root}/ck", {"availableNow": True}))
    assert t.stats().count() == 4
    for bad in ({"max_files": 1, "max_bytes": 1}, {"archive": "x", "delete": True}):
        with pytest.raises(ValueError):
            admission(**bad)
