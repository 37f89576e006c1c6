"""Collector and JSON consumer streams – the log path end to end.

collector:  raw JSON lines + arrival clock → stamp ``ts`` (overwrite) → archive by day
            and publish by topic (startup → START, anything else → EVENT), one
            ``foreachBatch`` over a persisted batch so the outputs share one read. A
            line that is not a JSON object cannot be stamped; it goes to the
            collector's quarantine instead of failing the batch.
consumer:   START lines → typed parse (PERMISSIVE) → derive date/hour → quarantine
            (malformed / null mid / null ts) → ``DauTable.process`` for the rest.

Every output is written into ``…/batch_id=<id>`` folders with dynamic partition
overwrite, so a replayed micro-batch rewrites its own output and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from actimetry.functions.jsonfmt import is_object, parse_logs, stamp_text
from actimetry.functions.timefmt import stamp_ms, with_date_hour
from actimetry.operators.route import split_valid, with_topic
from actimetry.schemas import STARTUP_RAW, TOPIC_EVENT, TOPIC_START
from actimetry.sinks.files import write_by_batch
from actimetry.streaming.dau_stream import DauTable, run_token, stream_partitions


def stamp_lines(lines: DataFrame, arrival_col: str = "arrival",
                topics: tuple[str, str] = (TOPIC_START, TOPIC_EVENT)) -> DataFrame:
    """``(value, arrival)`` → ``(value stamped, ts, type, topic)``; stateless, streams or batch."""
    raw = lines.select(F.col("value").alias("_raw"), stamp_ms(arrival_col).alias("ts"))
    stamped = raw.select(stamp_text("_raw", "ts").alias("value"), "ts", "_raw",
                         F.when(is_object("_raw"), F.from_json("_raw", "type string")["type"]).alias("type"))
    return with_topic(stamped, start_topic=topics[0], event_topic=topics[1])


class Collector:
    """foreachBatch body writing the daily archive and the routed topics."""

    def __init__(self, archive_path: str, routed_path: str, quarantine_path: str | None = None,
                 tz: str = "UTC", kafka_options: dict | None = None,
                 topics: tuple[str, str] = (TOPIC_START, TOPIC_EVENT)):
        self.archive_path, self.routed_path, self.tz = archive_path, routed_path, tz
        self.topics = topics
        self.run = "batch"        # set to the stream's run token when started
        self.quarantine_path = quarantine_path or routed_path.rstrip("/") + "_quarantine"
        self.kafka_options = kafka_options

    def process(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bad = batch.where(F.col("value").isNull()).select(F.col("_raw").alias("raw"), "ts")
            write_by_batch(bad, self.quarantine_path, batch_id, (), self.run)
            good = batch.where(F.col("value").isNotNull())
            arch = with_date_hour(good.select("value", "ts"), "ts", self.tz, "dt", "_h")
            write_by_batch(arch.select("value", "dt"), self.archive_path, batch_id, ("dt",), self.run)
            routed = good.select("topic", "value")
            if self.kafka_options:
                routed.write.format("kafka").options(**self.kafka_options).save()
            else:
                write_by_batch(routed, self.routed_path, batch_id, ("topic",), self.run)
        finally:
            batch.unpersist()


def start_collector_stream(lines: DataFrame, collector: Collector, checkpoint: str,
                           trigger: dict | None = None, partitions: int | None = None):
    trigger = trigger or {"processingTime": "5 seconds"}
    collector.run = run_token(checkpoint)
    with stream_partitions(lines.sparkSession, partitions):
        return (stamp_lines(lines, topics=collector.topics).writeStream.foreachBatch(collector.process)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def parse_startup(lines: DataFrame, value_col: str = "value", tz: str = "UTC", schema=STARTUP_RAW,
                  keep_line: bool = False) -> DataFrame:
    """Typed startup records with ``log_date``/``log_hour`` and ``_corrupt_record``
    (and the original text as ``_line`` when ``keep_line``)."""
    src = lines.withColumn("_line", F.col(value_col)) if keep_line else lines
    parsed = parse_logs(src, value_col, schema, keep=["_line"] if keep_line else None)
    return with_date_hour(parsed, "ts", tz)


class JsonDauConsumer:
    """foreachBatch body: quarantine bad records, then first-per-device-per-day."""

    def __init__(self, table: DauTable, quarantine_path: str):
        self.table, self.quarantine_path = table, quarantine_path

    def process(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = split_valid(batch)
            raw = F.coalesce(F.col("_corrupt_record"), F.col("_line")) if "_line" in batch.columns \
                else F.col("_corrupt_record")
            write_by_batch(bad.select(raw.alias("raw"), "mid", "ts", "reason"),
                           self.quarantine_path, batch_id, (), self.table.run)
            self.table.process(good.select(*[f.name for f in self.table.record.fields]), batch_id)
        finally:
            batch.unpersist()


def start_json_dau_stream(lines: DataFrame, consumer: JsonDauConsumer, checkpoint: str,
                          tz: str = "UTC", trigger: dict | None = None, partitions: int | None = None):
    """``lines`` is a stream with a ``value`` column of startup JSON text (the START topic)."""
    trigger = trigger or {"processingTime": "5 seconds"}
    consumer.table.run = run_token(checkpoint)
    with stream_partitions(lines.sparkSession, partitions):
        return (parse_startup(lines, "value", tz, keep_line=True).writeStream.foreachBatch(consumer.process)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())
