"""Metrics and reports: empty days, unknown ids, invariants, JSON shapes."""

import json

import pytest
from pyspark.sql import functions as F

from actimetry.operators.metrics import (
    dau_hours, dau_total, first_seen, gmv_hours, gmv_total, new_device_total,
)
from actimetry.plans import catalog as C
from actimetry.plans.report import realtime_hours, realtime_total, to_json_doc, totals_json
from tests.conftest import SF_SMALL


def test_empty_day(spark):
    dau = C.dau(spark, SF_SMALL)
    orders = C.orders(spark, SF_SMALL)
    assert dau_total(dau, "2030-01-01").first().dau == 0
    assert gmv_total(orders, "2030-01-01").first().gmv is None
    assert dau_hours(dau, "2030-01-01").count() == 0
    doc = to_json_doc(realtime_hours("dau", dau, orders, "2030-01-01")).first().doc
    assert json.loads(doc) == {"yesterday": {}, "today": {}}
    totals = {r.id: r.value for r in realtime_total(dau, orders, "2030-01-01").collect()}
    assert totals == {"dau": 0.0, "new_id": 0.0, "order_amount": None}
    js = json.loads(totals_json(realtime_total(dau, orders, "2030-01-01")).first().doc)
    assert js[0] == {"id": "dau", "name": "新增日活", "value": 0}
    assert js[2] == {"id": "order_amount", "name": "新增交易额"}     # null value omitted


def test_unknown_metric_id_is_empty_json_object(spark):
    dau, orders = C.dau(spark, SF_SMALL), C.orders(spark, SF_SMALL)
    doc = to_json_doc(realtime_hours("nope", dau, orders, "2024-01-15")).first().doc
    assert doc == "{}"


def test_bad_date_raises(spark):
    dau, orders = C.dau(spark, SF_SMALL), C.orders(spark, SF_SMALL)
    with pytest.raises(ValueError):
        realtime_hours("dau", dau, orders, "2024-13-01")


def test_hours_sum_to_total_and_total_is_distinct_devices(spark):
    dau = C.dau(spark, SF_SMALL)
    for d in ["2024-01-05", "2024-01-15", "2024-01-30"]:
        total = dau_total(dau, d).first().dau
        assert sum(r.ct for r in dau_hours(dau, d).collect()) == total
        distinct = C.startup_logs(spark, SF_SMALL).where(F.col("log_date") == d) \
            .agg(F.count_distinct("mid")).first()[0]
        assert total == distinct
    orders = C.orders(spark, SF_SMALL)
    tot = gmv_total(orders, "2024-01-15").first().gmv
    assert round(sum(r.sum_amount for r in gmv_hours(orders, "2024-01-15").collect()), 2) == round(tot, 2)


def test_sample_figures_match_survey(spark):
    # DAU on 2024-01-15 and GMV that day at sf0.001: 5 devices, 374.31
    assert C.a1_dau_total(spark, SF_SMALL).first().dau == 5
    assert C.a2_dau_hours(spark, SF_SMALL).count() == 4
    assert C.a5_gmv_total(spark, SF_SMALL).first().gmv == pytest.approx(374.31)
    assert C.a3_first_per_key(spark, SF_SMALL).count() == 153


def test_new_devices_first_day(spark):
    rows = [("m1", "2024-01-01", "05"), ("m1", "2024-01-02", "01"), ("m2", "2024-01-02", "07"),
            ("m3", "2024-01-03", "23")]
    dau = spark.createDataFrame(rows, "mid string, log_date string, log_hour string")
    fs = sorted(tuple(r) for r in first_seen(dau).collect())
    assert fs == [("m1", "2024-01-01", "05"), ("m2", "2024-01-02", "07"), ("m3", "2024-01-03", "23")]
    assert new_device_total(dau, "2024-01-02").first().new_devices == 1
    assert new_device_total(dau, "2024-01-01").first().new_devices == 1


def test_first_seen_table_advance_is_incremental_and_idempotent(spark, tmp_root):
    from actimetry.streaming.first_seen import FirstSeenTable
    rows = [("m1", "2024-01-01", "05"), ("m1", "2024-01-02", "01"), ("m2", "2024-01-02", "07"),
            ("m3", "2024-01-03", "23"), ("m2", "2024-01-03", "02")]
    dau = spark.createDataFrame(rows, "mid string, log_date string, log_hour string")
    t = FirstSeenTable(spark, tmp_root)
    t.build(dau, upto="2024-01-01")
    t.advance(dau, "2024-01-02")
    t.advance(dau, "2024-01-03")
    t.advance(dau, "2024-01-03")          # re-run of a day: unchanged
    got = sorted(tuple(r) for r in t.read().select("mid", "first_date", "first_hour").collect())
    assert got == [("m1", "2024-01-01", "05"), ("m2", "2024-01-02", "07"), ("m3", "2024-01-03", "23")]
    assert t.new_device_total("2024-01-03").first().new_devices == 1
    assert t.new_device_total("2024-02-01").first().new_devices == 0
    hours = sorted(tuple(r) for r in t.new_device_hours(["2024-01-02", "2024-01-03"]).collect())
    assert hours == [("2024-01-02", "07", 1), ("2024-01-03", "23", 1)]
