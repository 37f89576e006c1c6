"""Streaming queries over the driver tables.

``events`` is replayed into a file-source stream in arrival-ordered slices (one
micro-batch each, checkpoint kept between runs), so the cross-batch path is
exercised exactly as in production: restart from checkpoint, read new files,
dedup against the stored table, write idempotently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from actimetry.config import scratch_dir
from actimetry.functions.timefmt import epoch_ms_from_ntz
from actimetry.schemas import STARTUP_RAW, TOPIC_START
from actimetry.sources.tables import (
    LOG_COLUMNS as LOG_OUT, STARTUP_COLUMNS as DAU_OUT, logs_from_events, raw_lines_from_events,
    read_table,
)
from actimetry.streaming.collector import (
    Collector, JsonDauConsumer, start_collector_stream, start_json_dau_stream,
)
from actimetry.streaming.dau_stream import (
    DailyCountSink, DauTable, replay_in_slices, start_daily_count_stream, start_dau_stream,
    start_dropdup_stream, stream_partitions,
)

N_SLICES = 3
_RUNS: dict = {}


def _parts(spark: SparkSession) -> int:
    """Shuffle/state partitions for these streams: the cluster's parallelism."""
    return spark.sparkContext.defaultParallelism


def _once(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _startup_stream(spark: SparkSession, staging: str, schema) -> DataFrame:
    src = spark.readStream.schema(schema).parquet(staging)
    return logs_from_events(src, startup_only=True).select(*DAU_OUT)


def stream_run(spark: SparkSession, sf: str) -> DauTable:
    """Run the foreachBatch DAU stream over ``events`` in slices; memoised per app + input."""
    key = ("dau", spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        root = scratch_dir(spark, "dau-stream")
        events = read_table(spark, sf, "events")
        record = logs_from_events(events, startup_only=True).select(*DAU_OUT).schema
        table = DauTable(spark, f"{root}/table", record, tie_break=["seq"])
        staging, ckpt = f"{root}/incoming", f"{root}/checkpoint"

        def run_once():
            _once(start_dau_stream(_startup_stream(spark, staging, events.schema), table, ckpt,
                                   {"availableNow": True}, _parts(spark)))

        replay_in_slices(events, staging, N_SLICES, lambda: epoch_ms_from_ntz("ts"), run_once)
        _RUNS[key] = table
    return _RUNS[key]


def stream_dropdup_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming ``dropDuplicates(mid, log_date)`` over the sliced replay; returns the key set."""
    root = scratch_dir(spark, "dropdup-stream")
    events = read_table(spark, sf, "events")
    staging, ckpt, out = f"{root}/incoming", f"{root}/checkpoint", f"{root}/out"

    def run_once():
        _once(start_dropdup_stream(_startup_stream(spark, staging, events.schema), out, ckpt,
                                   {"availableNow": True}, partitions=_parts(spark)))

    replay_in_slices(events, staging, N_SLICES, lambda: epoch_ms_from_ntz("ts"), run_once)
    return spark.read.parquet(out).select("mid", "log_date")


def stream_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Update-mode streaming aggregate of daily DAU over the sliced replay."""
    root = scratch_dir(spark, "daily-stream")
    events = read_table(spark, sf, "events")
    staging, ckpt = f"{root}/incoming", f"{root}/checkpoint"
    sink = DailyCountSink(f"{root}/out")

    def run_once():
        _once(start_daily_count_stream(_startup_stream(spark, staging, events.schema), sink, ckpt,
                                       {"availableNow": True}, _parts(spark)))

    replay_in_slices(events, staging, N_SLICES, lambda: epoch_ms_from_ntz("ts"), run_once)
    return sink.read(spark).select("log_date", "dau")


def stream_logs_to_table(spark: SparkSession, sf: str) -> DataFrame:
    """S1: subscribe to the log source as a stream (here the ``events`` file), type the
    records, land them in a Parquet table; return the landed table."""
    root = scratch_dir(spark, "log-stream")
    events = read_table(spark, sf, "events")
    src = spark.readStream.schema(events.schema).parquet(f"{sf.rstrip('/')}/event[s].parquet")
    logs = logs_from_events(src).select(*LOG_OUT)
    with stream_partitions(spark, _parts(spark)):
        q = (logs.writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    _once(q)
    return spark.read.schema(logs.schema).parquet(f"{root}/out")


def stream_from_json(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log path on ``events``: raw JSON lines with their arrival time (as a
    broker delivers them) → collector stream (stamp, archive, route) → START topic
    folder → JSON consumer stream (parse, quarantine, cross-batch dedup) → DAU table."""
    root = scratch_dir(spark, "json-stream")
    raw = raw_lines_from_events(read_table(spark, sf, "events")).select("value", "arrival")
    staging, routed, archive = f"{root}/incoming", f"{root}/routed", f"{root}/archive"
    collector = Collector(archive, routed)
    parsed_schema = StructType([f for f in STARTUP_RAW.fields])
    record = StructType(list(parsed_schema.fields) + [
        StructField("log_date", StringType()), StructField("log_hour", StringType())])
    table = DauTable(spark, f"{root}/table", record)
    consumer = JsonDauConsumer(table, f"{root}/quarantine")
    start_topic = f"{routed}/topic={TOPIC_START}/run=*/batch_id=*"

    def run_once():
        lines = spark.readStream.schema(raw.schema).parquet(staging)
        _once(start_collector_stream(lines, collector, f"{root}/ckpt-collector", {"availableNow": True},
                                     _parts(spark)))
        topic = spark.readStream.schema("value string").parquet(start_topic)
        _once(start_json_dau_stream(topic, consumer, f"{root}/ckpt-consumer", trigger={"availableNow": True},
                                    partitions=_parts(spark)))

    replay_in_slices(raw, staging, N_SLICES, lambda: F.unix_millis("arrival"), run_once)
    return table.dau().select("mid", "uid", "type", "ts", "log_date", "log_hour")
