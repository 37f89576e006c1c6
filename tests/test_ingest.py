"""Collector path: JSON parse, stamping, routing, quarantine."""

import json

from pyspark.sql import functions as F

from actimetry.functions.jsonfmt import json_field, parse_logs, stamp_json, to_json_record
from actimetry.operators.route import route, split_valid, with_topic
from actimetry.schemas import TOPIC_EVENT, TOPIC_START


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_null_or_missing_type_goes_to_event(spark):
    df = parse_logs(lines(spark, [
        '{"type":"startup","mid":"m1","ts":1}',
        '{"mid":"m2","ts":2}',
        '{"type":null,"mid":"m3","ts":3}',
        '{"type":"event","mid":"m4","ts":4}',
    ]))
    start, event = route(df)
    assert sorted(r.mid for r in start.collect()) == ["m1"]
    assert sorted(r.mid for r in event.collect()) == ["m2", "m3", "m4"]
    topics = {r.mid: r.topic for r in with_topic(df).collect()}
    assert topics == {"m1": TOPIC_START, "m2": TOPIC_EVENT, "m3": TOPIC_EVENT, "m4": TOPIC_EVENT}


def test_stamp_overwrites_incoming_ts_and_keeps_other_fields(spark):
    df = lines(spark, ['{"type":"startup","mid":"m1","ts":5,"extra":{"a":[1,2]}}',
                       '{"mid":"m2","evid":"coupon"}'])
    out = df.select(stamp_json("value", F.lit(1700000000123)).alias("v")).collect()
    docs = [json.loads(r.v) for r in out]
    assert docs[0] == {"type": "startup", "mid": "m1", "extra": {"a": [1, 2]}, "ts": 1700000000123}
    assert docs[1] == {"mid": "m2", "evid": "coupon", "ts": 1700000000123}
    assert list(docs[0].keys())[-1] == "ts"


def test_malformed_null_mid_null_ts_are_quarantined_batch_goes_on(spark):
    df = parse_logs(lines(spark, [
        '{"type":"startup","mid":"m1","ts":1}',
        '{"type":"startup","mid":',          # malformed
        '{"type":"startup","ts":2}',          # null mid
        '{"type":"startup","mid":"m4"}',      # null ts
        None,                                  # null line
    ]))
    good, bad = split_valid(df)
    assert [r.mid for r in good.collect()] == ["m1"]
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["malformed_json", "malformed_json", "null_mid", "null_ts"]
    # routed + quarantined = input
    start, event = route(good)
    assert start.count() + event.count() + bad.count() == df.count()


def test_json_field_and_write_roundtrip(spark):
    df = lines(spark, ['{"type":"event","mid":"m1","itemid":7,"ts":9}'])
    r = df.select(json_field("value", "$.type").alias("t"), json_field("value", "$.itemid").alias("i")).first()
    assert (r.t, r.i) == ("event", "7")
    parsed = parse_logs(df).drop("_corrupt_record")
    text = parsed.select(to_json_record(["type", "mid", "itemid", "ts"]).alias("j")).first().j
    assert json.loads(text) == {"type": "event", "mid": "m1", "itemid": 7, "ts": 9}


def test_typed_variant_field_read(spark):
    from actimetry.functions.jsonfmt import json_value
    df = lines(spark, ['{"type":"event","itemid":7,"pgid":"x"}', 'not json', None])
    r = df.select(json_value("value", "$.itemid", "int").alias("i"),
                  json_value("value", "$.pgid", "int").alias("p"),
                  json_value("value", "$.type").alias("t")).collect()
    assert [(x.i, x.p, x.t) for x in r] == [(7, None, "event"), (None, None, None), (None, None, None)]
