"""Stream = batch: the cross-batch DAU stream over file slices; restart and replay."""

import os
import random

from pyspark.sql import functions as F

from actimetry.config import scratch_dir
from actimetry.functions.timefmt import epoch_ms_from_ntz
from actimetry.plans import catalog as C
from actimetry.sources.tables import logs_from_events
from actimetry.streaming.dau_stream import DauTable, start_dau_stream
from tests.conftest import SF_SMALL

OUT = ["seq", "mid", "uid", "type", "ts", "log_date", "log_hour"]


def _write_slices(spark, events, staging, k, ordered):
    bounds = events.agg(F.percentile_approx(epoch_ms_from_ntz("ts"), [i / k for i in range(1, k)])).first()[0]
    edges = [None] + sorted(bounds) + [None]
    order = list(range(k))
    if not ordered:
        random.Random(7).shuffle(order)
    paths = []
    for n, i in enumerate(order):
        lo, hi = edges[i], edges[i + 1]
        cond = F.lit(True)
        if lo is not None:
            cond &= epoch_ms_from_ntz("ts") >= lo
        if hi is not None:
            cond &= epoch_ms_from_ntz("ts") < hi
        p = f"{staging}/slice{n}"
        events.where(cond).coalesce(1).write.parquet(p)
        for f in os.listdir(p):  # one file per slice, mtimes in arrival order
            os.utime(os.path.join(p, f), (1_700_000_000 + n * 10, 1_700_000_000 + n * 10))
        paths.append(p)
    return paths


def _run(spark, k, ordered):
    root = scratch_dir(spark, "stream-test")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    _write_slices(spark, events, f"{root}/in", k, ordered)
    src = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{root}/in/slice*")
    logs = logs_from_events(src, startup_only=True).select(*OUT)
    table = DauTable(spark, f"{root}/table", logs.schema, tie_break=["seq"])
    q = start_dau_stream(logs, table, f"{root}/ckpt", {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    return table, root, logs


def test_ordered_slices_equal_batch_rows(spark):
    table, _, _ = _run(spark, 4, ordered=True)
    batch = sorted(tuple(r) for r in C.dau(spark, SF_SMALL).select(*OUT).collect())
    got = sorted(tuple(r) for r in table.dau().select(*OUT).collect())
    assert got == batch
    assert table.stats().count() == 4
    hours = sorted(tuple(r) for r in table.hours().collect())
    want = sorted(tuple(r) for r in C.dau(spark, SF_SMALL).groupBy("log_date", "log_hour").count().collect())
    assert hours == want


def test_random_slices_equal_batch_keys(spark):
    table, _, _ = _run(spark, 4, ordered=False)
    keys = sorted(tuple(r) for r in C.dau(spark, SF_SMALL).select("mid", "log_date").collect())
    got = sorted(tuple(r) for r in table.dau().select("mid", "log_date").collect())
    assert got == keys           # one row per key whatever the arrival order


def test_restart_from_checkpoint_processes_nothing_twice(spark):
    table, root, logs = _run(spark, 3, ordered=True)
    before = sorted(tuple(r) for r in table.dau().collect())
    q = start_dau_stream(logs, table, f"{root}/ckpt", {"availableNow": True})
    q.awaitTermination()
    assert sorted(tuple(r) for r in table.dau().collect()) == before
    assert table.stats().count() == 3


def test_dropdup_within_watermark_keeps_all_keys_on_ordered_arrival(spark):
    from actimetry.streaming.dau_stream import start_dropdup_stream
    root = scratch_dir(spark, "wm-test")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    _write_slices(spark, events, f"{root}/in", 3, ordered=True)
    src = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/slice*")
    logs = logs_from_events(src, startup_only=True).select(*OUT)
    q = start_dropdup_stream(logs, f"{root}/out", f"{root}/ckpt", {"availableNow": True},
                             within_watermark="2 days")
    q.awaitTermination()
    assert q.exception() is None
    got = sorted(tuple(r) for r in spark.read.parquet(f"{root}/out").select("mid", "log_date").collect())
    keys = sorted(tuple(r) for r in C.dau(spark, SF_SMALL).select("mid", "log_date").collect())
    assert got == keys


def test_console_preview_runs(spark):
    from actimetry.streaming.dau_stream import start_console_preview
    root = scratch_dir(spark, "preview-test")
    src = spark.readStream.schema(spark.read.parquet(f"{SF_SMALL}/events.parquet").schema) \
        .parquet(f"{SF_SMALL}/event[s].parquet")
    q = start_console_preview(logs_from_events(src, startup_only=True), 10, {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    assert q.lastProgress["numInputRows"] == 1000
