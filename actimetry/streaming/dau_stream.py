"""Streams over the stored table (``dau_table``) and their forms with state in Spark's state store."""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from actimetry.sources.logs import read_partitioned
from actimetry.streaming.dau_table import DauTable

SALTS = 16                  # first-level groups of a key: a device with a third of all rows is that many tasks


@contextmanager
def stream_partitions(spark: SparkSession, n: int | None):
    """Start a stream with ``n`` shuffle/state partitions. A stream copies the session
    conf when it starts and records the partition count in its checkpoint (it cannot
    change later), so it is set around ``start()`` only and restored after."""
    if n is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(n)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def run_token(checkpoint: str) -> str:
    """Stable writer id of a stream: derived from its checkpoint location, so a restart
    from the same checkpoint is the same run and a new checkpoint is a new one."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def start_dau_stream(logs: DataFrame, table: DauTable, checkpoint: str,
                     trigger: dict | None = None, partitions: int | None = None):
    """Start the cross-batch dedup stream. ``logs`` is a streaming frame of startup
    records with ``mid, ts, log_date, log_hour``. Default trigger: every 5 seconds.
    The table's writer id becomes the checkpoint's run token."""
    trigger = trigger or {"processingTime": "5 seconds"}
    table.run = run_token(checkpoint)
    with stream_partitions(logs.sparkSession, partitions):
        return (logs.writeStream.foreachBatch(table.process)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def distinct_keys(logs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per ``(mid, log_date)`` of a stream, by two levels of state. ``dropDuplicates`` has no map-side stage, so all
    rows of a key meet in one task; the first level deals them by a salt of the row and lets one through per key and
    salt, so the second sees at most ``salts`` rows of a key, whatever the device sends."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in logs.columns]), F.lit(salts))
    return (logs.withColumn("salt__", salt).dropDuplicates(["mid", "log_date", "salt__"])
            .drop("salt__").dropDuplicates(["mid", "log_date"]))


def start_dropdup_stream(logs: DataFrame, out_path: str, checkpoint: str,
                         trigger: dict | None = None, within_watermark: str | None = None,
                         partitions: int | None = None, salts: int = SALTS):
    """JVM-state form: the distinct ``(mid, log_date)`` into a Parquet sink (append).
    It keeps *a* row per key (not the least ts), so only the key set is meaningful.
    ``within_watermark`` (e.g. ``"2 days"``) bounds the state but drops rows later
    than the watermark; ``start_bounded_stream`` bounds it without loss."""
    trigger = trigger or {"processingTime": "5 seconds"}
    if within_watermark:
        deduped = logs.withColumn("_event_time", F.timestamp_millis("ts")) \
            .withWatermark("_event_time", within_watermark) \
            .dropDuplicatesWithinWatermark(["mid", "log_date"]).drop("_event_time")
    else:
        deduped = distinct_keys(logs, salts)
    with stream_partitions(logs.sparkSession, partitions):
        return (deduped.writeStream.format("parquet").option("path", out_path)
                .option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start())


class BoundedDedup:
    """``foreachBatch`` body of ``start_bounded_stream``.

    A batch holds all its rows, unmarked, and the rows that the state let through, marked. The keys to look at are those let
    through and those of late rows: rows at or before the watermark, which the state drops. Of these keys the rows of the batch
    go through ``DauTable.process``, which checks them against what is stored; all others are devices that the state knows.
    The watermark is the one of Spark: the largest event time of the batches before, less the delay. It is kept with the table by batch,
    before the batch is written, so a batch that runs again takes the same rows for late. The table's counts are those of the rows looked at.
    """

    def __init__(self, table: DauTable, delay_ms: int):
        self.table, self.delay_ms = table, delay_ms

    def _times(self, batch_id: int) -> dict | None:
        return self.table.records.get(f"times/{self.table.run}/{int(batch_id)}")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = self._times(batch_id - 1) or {"largest": None}
            rows = batch.where("NOT new__")
            largest = rows.agg(F.max("ts")).first()[0]
            self.table.records.put(f"times/{self.table.run}/{int(batch_id)}", {
                "largest": max((x for x in (before["largest"], largest) if x is not None), default=None)})
            late = F.lit(False) if before["largest"] is None else F.coalesce(F.col("ts") <= before["largest"] - self.delay_ms, F.lit(False))
            keys = batch.where(F.col("new__") | late).select("mid", "log_date").distinct()
            bad = F.col("mid").isNull() | F.col("ts").isNull()                      # for the quarantine
            plain = rows.drop("new__", "_event_time")
            asked = plain.where(~bad).join(keys, ["mid", "log_date"], "left_semi").unionByName(plain.where(bad))
            self.table.process(asked.select(*plain.columns), batch_id)
            self.table.records.remove(f"times/{self.table.run}/{int(batch_id) - 2}")
        finally:
            batch.unpersist()


def start_bounded_stream(logs: DataFrame, table: DauTable, checkpoint: str, delay: str = "2 days",
                         trigger: dict | None = None, partitions: int | None = None):
    """Cross-batch dedup with state that a watermark keeps bounded, and without loss: on-time rows are checked against the
    state, only new and late ones against the stored table. ``delay`` must be a day or more, the
    length of a key's day, so that a key's state outlives all its on-time rows. Same rows as ``start_dau_stream``."""
    trigger = trigger or {"processingTime": "5 seconds"}
    ms = int(logs.sparkSession.range(1).select(F.expr(f"unix_millis(timestamp_millis(0) + interval {delay})")).first()[0])
    if ms < 86_400_000:
        raise ValueError("the delay must be a day or more")
    table.run = run_token(checkpoint)
    timed = logs.withColumn("_event_time", F.timestamp_millis("ts")).withWatermark("_event_time", delay)
    let_through = timed.dropDuplicatesWithinWatermark(["mid", "log_date"]).withColumn("new__", F.lit(True))
    both = timed.withColumn("new__", F.lit(False)).unionByName(let_through)
    with stream_partitions(logs.sparkSession, partitions):
        return (both.writeStream.foreachBatch(BoundedDedup(table, ms).process)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())


class DailyCountSink:
    """foreachBatch body for an *update*-mode aggregate: the changed ``(log_date, dau)``
    rows of each trigger overwrite their own ``log_date=`` folders (idempotent upsert)."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        (batch.select("dau", "log_date").write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("log_date").parquet(self.path))

    def read(self, spark: SparkSession) -> DataFrame:
        return read_partitioned(spark, self.path, "dau long, log_date string")


def start_daily_count_stream(logs: DataFrame, sink: DailyCountSink, checkpoint: str,
                             trigger: dict | None = None, partitions: int | None = None):
    """Running daily DAU with JVM state only: the distinct ``(mid, log_date)`` of two levels of state →
    ``count`` per day, emitted in update mode. (Hours cannot be kept this way: the
    dropDuplicates row of a key is arbitrary, so its hour is too.)"""
    trigger = trigger or {"processingTime": "5 seconds"}
    daily = distinct_keys(logs).groupBy("log_date") \
        .agg(F.count(F.lit(1)).alias("dau"))
    with stream_partitions(logs.sparkSession, partitions):
        return (daily.writeStream.outputMode("update").foreachBatch(sink.process)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_console_preview(stream: DataFrame, n: int = 10, trigger: dict | None = None):
    """Print the first ``n`` rows of each micro-batch on the driver console (a preview)."""
    trigger = trigger or {"processingTime": "5 seconds"}
    return (stream.writeStream.format("console").option("numRows", n).option("truncate", False)
            .trigger(**trigger).start())


def replay_in_slices(table: DataFrame, staging: str, n_slices: int, ts_ms: Callable,
                     run_once: Callable[[], None]) -> None:
    """Feed ``table`` to a file-source stream in ``n_slices`` arrival-ordered slices:
    write slice i into ``staging``, then run the stream once (``availableNow``) so it
    consumes exactly that slice as one micro-batch. Cut points are approximate
    quantiles of the arrival time (one small aggregate). Every row is delivered."""
    probs = [i / n_slices for i in range(1, n_slices)]
    cuts = table.agg(F.percentile_approx(ts_ms(), probs, 10000).alias("q")).first()["q"] or []
    bounds = [None] + sorted(set(cuts)) + [None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (ts_ms() >= F.lit(lo))
        if hi is not None:
            cond = cond & (ts_ms() < F.lit(hi))
        else:                      # the last slice also carries rows without a time
            cond = cond | ts_ms().isNull()
        table.where(cond).write.mode("append").parquet(staging)
        run_once()
