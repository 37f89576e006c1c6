"""Commits, compaction, folds and vacuum of the stored table: what readers see before, after and when a step is cut short."""

import pytest
from pyspark.sql import functions as F

from actimetry.sinks.records import Records
from actimetry.streaming import dau_table
from actimetry.streaming.dau_table import DauTable

RECORD = "seq long, mid string, ts long, log_date string, log_hour string"
D = "2024-01-15"


def rows(spark, data):
    return spark.createDataFrame(data, RECORD)


def batch(spark, b, n=20, day=D):
    """Devices b*10 .. b*10+n-1: half of them were in the batch before."""
    return rows(spark, [(100 * b + i, f"m{10 * b + i}", 100 * b + i, day, f"{(b + i) % 24:02d}") for i in range(n)]
                + [(100 * b + i, f"m{10 * b + i}", 200 * b + i + 1, day, "23") for i in range(0, n, 3)])


def table(spark, root, **kw):
    return DauTable(spark, root, rows(spark, []).schema, tie_break=["seq"], buckets=3, **kw)


def snapshot(t, dates=None):
    return (sorted(tuple(r) for r in t.dau(dates).select("seq", "mid", "ts", "log_date", "log_hour", "run", "batch_id").collect()),
            sorted(tuple(r) for r in t.hours(dates).collect()))


def agree(t):
    """Hours, rows and stats tell the same."""
    got, hours = snapshot(t)
    assert sum(h[2] for h in hours) == len(got) == (t.stats().agg(F.sum("rows_new")).first()[0] or 0)


def files(spark, t, day=D):
    return t.dau([day]).inputFiles()


def test_compaction_changes_no_row_and_bounds_the_files(spark, tmp_root):
    t = table(spark, tmp_root)
    for b in range(4):
        t.process(batch(spark, b), b)
    t.process(batch(spark, 4, day="2024-01-16"), 4)
    before = snapshot(t)
    m = t.compact(D)
    assert snapshot(t) == before and snapshot(t, [D])[0] == [r for r in before[0] if r[3] == D]
    assert sum(m["hours"].values()) == len(snapshot(t, [D])[0])
    assert t.vacuum(retain=0) >= 8                              # rows and hours of four batches
    assert snapshot(t) == before and len(files(spark, t)) <= 3
    assert not [f for f in files(spark, t) if "/dau/" in f]


def test_later_batches_and_replays_after_compaction(spark, tmp_root):
    plain, t = table(spark, f"{tmp_root}/plain"), table(spark, f"{tmp_root}/t")
    for b in range(5):
        plain.process(batch(spark, b), b)
        t.process(batch(spark, b), b)
        t.process(batch(spark, b), b)                           # again: nothing happens
        if b in (1, 3):
            t.compact(D)
        if b == 3:
            t.vacuum(retain=0)
            t.process(batch(spark, 2), 2)                       # a batch whose folders are gone
    assert snapshot(t) == snapshot(plain)
    assert t.manifest(D)["version"] == 2
    agree(t)


def test_a_batch_that_is_cut_short_shows_nowhere(spark, tmp_root, monkeypatch):
    t = table(spark, tmp_root)
    t.process(batch(spark, 0), 0)
    before = snapshot(t)
    for step in ("_write_hours", "_commit"):
        with monkeypatch.context() as m:
            m.setattr(DauTable, step, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                t.process(batch(spark, 1).union(rows(spark, [(1, None, 1, D, "01")])), 1)
        assert snapshot(t) == before and t.stats().count() == 1 and t.quarantined().count() == 0
        agree(t)
    t.process(batch(spark, 1), 1)
    agree(t)
    assert len(snapshot(t)[0]) == 30


def test_what_a_cut_attempt_left_does_not_come_back(spark, tmp_root, monkeypatch):
    """The first attempt stores a device of a day; before the second one another writer has stored it."""
    t, other = table(spark, tmp_root, run="a"), table(spark, tmp_root, run="b")
    with monkeypatch.context() as m:
        m.setattr(DauTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.process(rows(spark, [(1, "m", 1, D, "01")]), 0)
    other.process(rows(spark, [(2, "m", 2, D, "02")]), 0)
    t.process(rows(spark, [(1, "m", 1, D, "01")]), 0)
    assert [r.seq for r in t.dau().collect()] == [2]


def test_compaction_that_is_cut_short_or_loses_the_race_changes_nothing(spark, tmp_root, monkeypatch):
    t = table(spark, tmp_root)
    t.process(batch(spark, 0), 0)
    before = snapshot(t)
    with monkeypatch.context() as m:
        m.setattr(DauTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.compact(D)
    assert snapshot(t) == before and t.manifest(D) is None
    old = t.manifest(D)
    t.compact(D)
    with pytest.raises(RuntimeError):
        t._publish(D, old, {"rows": "elsewhere"})
    assert snapshot(t) == before
    t.vacuum(retain=0)                                           # the folder of the attempt goes too
    assert snapshot(t) == before and len(t.records.names(f"closed/log_date={D}")) == 1


def test_readers_go_on_while_a_day_is_rewritten(spark, tmp_root):
    t = table(spark, tmp_root)
    for b in range(3):
        t.process(batch(spark, b), b)
    early = t.dau([D])                                           # planned before, run after
    want = sorted(r.seq for r in early.collect())
    t.compact(D)
    t.vacuum(retain=3600)
    assert sorted(r.seq for r in early.collect()) == want
    middle = t.dau([D])
    t.process(batch(spark, 3), 3)
    t.compact(D)
    t.vacuum(retain=3600)
    assert sorted(r.seq for r in middle.collect()) == want
    assert t.dau([D]).count() == len(want) + 10


def test_hours_of_a_closed_day_are_one_record(spark, tmp_root):
    t = table(spark, tmp_root)
    for b in range(3):
        t.process(batch(spark, b), b)
    with pytest.raises(ValueError):
        t.fold_hours(D)
    t.compact(D)
    t.process(batch(spark, 3), 3)
    want = snapshot(t)
    m = t.fold_hours(D)
    assert m["hours_upto"] == {"batch": 3} and m["upto"] == {"batch": 2}
    assert snapshot(t) == want
    t.vacuum(retain=0)
    assert snapshot(t) == want and not [f for f in t.hours([D]).inputFiles() if "/hours/" in f]
    t.process(batch(spark, 3), 3)
    assert snapshot(t) == want


def test_the_stored_side_of_the_anti_join_is_not_exchanged(spark, tmp_root):
    t = table(spark, tmp_root)
    t.process(batch(spark, 0, 50), 0)
    t.compact(D)
    t.vacuum(retain=0)
    first = batch(spark, 1).withColumn("rows__", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t._unseen(first, 1, [D])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = plan[plan.index("Bucketed: true") - 2000:plan.index("Bucketed: true")]
    scan = [line for line in plan.splitlines() if "Bucketed: true" in line]
    assert len(scan) == 1 and "SelectedBucketsCount: 3 out of 3" in scan[0]
    above = plan[:plan.index(scan[0])].splitlines()
    depth = scan[0].index("FileScan")
    for line in reversed(above):                                 # up from the scan to its join
        name = line.lstrip(" :+-*()0123456789")
        if len(line) - len(name) < depth:
            depth = len(line) - len(name)
            assert "Exchange" not in name, stored
            if "Join" in name:
                break
    else:
        raise AssertionError(plan)


def test_batches_of_a_run_come_in_order(spark, tmp_root):
    t = table(spark, tmp_root)
    t.process(batch(spark, 5), 5)
    with pytest.raises(ValueError):
        t.process(batch(spark, 3), 3)


def test_counts_are_observed_in_the_write(spark, tmp_root):
    """One job for the days, one write of rows, one of hours: no job that only counts."""
    t = table(spark, tmp_root)
    spark.sparkContext.setJobGroup("observed", "")
    t.process(batch(spark, 0), 0)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("observed")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 9
    r = t.stats().first()
    assert (r.rows_in, r.rows_unseen, r.rows_first, r.rows_new) == (27, 27, 20, 20)
    t.process(batch(spark, 0), 1)
    r = t.stats().where("batch_id = 1").first()
    assert (r.rows_in, r.rows_unseen, r.rows_first, r.rows_new) == (27, 0, 20, 0)


def test_records_are_replaced_whole_and_names_are_locks(spark, tmp_root):
    r = Records(spark, tmp_root)
    assert r.get("a/b") is None and r.names("a") == []
    assert r.put("a/b", {"x": 1}, replace=False) and not r.put("a/b", {"x": 2}, replace=False)
    assert r.get("a/b") == {"x": 1} and r.put("a/b", {"x": "é" * 5000}) and r.get("a/b") == {"x": "é" * 5000}
    assert r.names("a") == ["b"] and r.remove("a/b") and r.get("a/b") is None


def test_an_empty_batch_and_a_missing_table(spark, tmp_root):
    t = table(spark, tmp_root)
    t.process(rows(spark, []), 0)
    assert snapshot(t) == ([], []) and t.stats().first().rows_in == 0 and dau_table.BUCKETS > 0
    with pytest.raises(FileNotFoundError):
        DauTable(spark, f"{tmp_root}/none", rows(spark, []).schema, create=False)
