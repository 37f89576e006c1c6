"""Collector + JSON consumer streams on hand-made lines (bad rows included)."""

import datetime as dt

from pyspark.sql import functions as F

from actimetry.config import scratch_dir
from actimetry.schemas import TOPIC_EVENT, TOPIC_START
from actimetry.streaming.collector import (
    Collector, JsonDauConsumer, parse_startup, start_collector_stream, start_json_dau_stream,
)
from actimetry.streaming.dau_stream import DauTable

LINES = [
    ('{"type":"startup","mid":"m1","uid":"u1","os":"ios","ts":1}', "2024-01-15 08:00:00"),
    ('{"type":"startup","mid":"m1","uid":"u1","os":"ios"}', "2024-01-15 09:00:00"),
    ('{"type":"startup","uid":"u2"}', "2024-01-15 09:30:00"),            # null mid
    ('{"type":"startup","mid":"m3"', "2024-01-15 10:00:00"),              # malformed
    ('{"mid":"m4","evid":"coupon","itemid":3}', "2024-01-15 10:30:00"),   # no type -> EVENT
    ('{"type":"event","mid":"m1","evid":"addCart"}', "2024-01-15 11:00:00"),
    ('{"type":"startup","mid":"m5"}', "2024-01-15 23:59:59.999"),
    ('{"type":"startup","mid":"m5"}', "2024-01-16 00:00:00"),
]


def test_collector_then_consumer(spark):
    root = scratch_dir(spark, "collector-test")
    rows = [(v, dt.datetime.fromisoformat(a).replace(tzinfo=dt.timezone.utc)) for v, a in LINES]
    spark.createDataFrame(rows, "value string, arrival timestamp").coalesce(1).write.parquet(f"{root}/in")
    lines = spark.readStream.schema("value string, arrival timestamp").parquet(f"{root}/in")
    q = start_collector_stream(lines, Collector(f"{root}/archive", f"{root}/routed"), f"{root}/c1",
                               {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None

    archive = spark.read.parquet(f"{root}/archive")
    assert archive.count() == len(LINES) - 1          # the malformed line is quarantined
    assert [r.raw for r in spark.read.parquet(f"{root}/routed_quarantine").collect()] == [LINES[3][0]]
    assert sorted(r.dt for r in archive.select(F.col("dt").cast("string").alias("dt")).distinct().collect()) \
        == ["2024-01-15", "2024-01-16"]
    routed = spark.read.parquet(f"{root}/routed")
    by_topic = {r.topic: r["count"] for r in routed.groupBy("topic").count().collect()}
    assert by_topic == {TOPIC_START: 5, TOPIC_EVENT: 2}

    # stamped ts overwrote the incoming one
    first = [r.value for r in routed.where(F.col("value").contains('"os":"ios"')).collect()]
    assert any('"ts":1705305600000' in v for v in first)

    table = DauTable(spark, f"{root}/table", parse_startup(spark.createDataFrame([], "value string"))
                     .drop("_corrupt_record").schema)
    consumer = JsonDauConsumer(table, f"{root}/quarantine")
    topic = spark.readStream.schema("value string").parquet(f"{root}/routed/topic={TOPIC_START}/run=*/batch_id=*")
    q2 = start_json_dau_stream(topic, consumer, f"{root}/c2", trigger={"availableNow": True})
    q2.awaitTermination()
    assert q2.exception() is None

    got = sorted((r.mid, r.log_date, r.log_hour, r.ts) for r in table.dau().collect())
    assert got == [("m1", "2024-01-15", "08", 1705305600000),
                   ("m5", "2024-01-15", "23", 1705363199999),
                   ("m5", "2024-01-16", "00", 1705363200000)]
    bad = sorted(r.reason for r in spark.read.parquet(f"{root}/quarantine").collect())
    assert bad == ["null_mid"]
