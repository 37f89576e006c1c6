"""The first-seen table against a full recount, whatever the order in which its days come in."""

import random

import pytest

from actimetry.streaming.first_seen import FirstSeenTable

SCHEMA = "mid string, log_date string, log_hour string"
DAYS = [f"2024-01-{d:02d}" for d in range(1, 9)]


def history(seed):
    rng = random.Random(seed)
    return [(f"m{i}", d, f"{rng.randrange(24):02d}") for d in DAYS if d != DAYS[4] for i in range(40) if rng.random() < 0.15]


def recount(rows, days):
    first = {}
    for m, d, h in rows:
        if d in days:
            first[m] = min(first.get(m, ("9",)), (d, h))
    return sorted((m, h, d) for m, (d, h) in first.items())


def got(t):
    return sorted(tuple(r) for r in t.read().collect())


@pytest.mark.parametrize("order", [DAYS, DAYS[::-1], [DAYS[i] for i in (3, 0, 7, 7, 1, 3, 5, 2, 6, 4)]])
def test_days_in_any_order_equal_the_recount(spark, tmp_root, order):
    rows = history(1)
    dau = spark.createDataFrame(rows, SCHEMA).cache()
    t, done = FirstSeenTable(spark, tmp_root), set()
    for n, d in enumerate(order):
        t.advance(dau, d)
        done.add(d)
        if n in (2, len(order) - 1):
            assert got(t) == recount(rows, done)
    assert t.missing_days() == [] and t.ledger()[DAYS[4]] == 0
    for d in DAYS:
        assert t.new_device_total(d).first().new_devices == sum(x[2] == d for x in recount(rows, DAYS))
    t.vacuum(retain=0)
    assert got(t) == recount(rows, DAYS) and len(t.records.names("versions")) == 1


def test_a_skipped_day_is_noticed_and_repaired(spark, tmp_root):
    rows = history(2)
    dau = spark.createDataFrame(rows, SCHEMA).cache()
    t = FirstSeenTable(spark, tmp_root)
    t.build(dau, DAYS[1])
    t.advance(dau, DAYS[3])
    t.advance(dau, DAYS[5])
    assert t.missing_days() == [DAYS[2], DAYS[4]] and t.missing_days(DAYS[6]) == [DAYS[2], DAYS[4], DAYS[6]]
    t.advance(dau, DAYS[2])
    assert got(t) == recount(rows, {*DAYS[:4], DAYS[5]}) and t.missing_days() == [DAYS[4]]


def test_late_rows_of_a_day_take_devices_back(spark, tmp_root):
    early = [("a", DAYS[0], "05"), ("b", DAYS[1], "06"), ("c", DAYS[2], "07"), ("d", DAYS[0], "23")]
    late = early + [("c", DAYS[0], "09"), ("d", DAYS[0], "03"), ("e", DAYS[1], "01")]
    t = FirstSeenTable(spark, tmp_root)
    for d in DAYS[:3]:
        t.advance(spark.createDataFrame(early, SCHEMA), d)
    assert t.advance(spark.createDataFrame(late, SCHEMA), DAYS[0]) == [DAYS[2]]
    t.advance(spark.createDataFrame(late, SCHEMA), DAYS[1])
    assert got(t) == recount(late, DAYS) and t.new_device_total(DAYS[2]).first().new_devices == 0
    hours = sorted(tuple(r) for r in t.new_device_hours(DAYS[:2]).collect())
    assert hours == [(DAYS[0], "03", 1), (DAYS[0], "05", 1), (DAYS[0], "09", 1), (DAYS[1], "01", 1), (DAYS[1], "06", 1)]


def test_a_step_that_is_cut_short_changes_nothing(spark, tmp_root, monkeypatch):
    rows = history(3)
    dau = spark.createDataFrame(rows, SCHEMA).cache()
    t = FirstSeenTable(spark, tmp_root)
    t.advance(dau, DAYS[3])
    before, old = got(t), t.version()
    with monkeypatch.context() as m:
        m.setattr(FirstSeenTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.advance(dau, DAYS[0])
    assert got(t) == before and list(t.ledger()) == [DAYS[3]]
    t.advance(dau, DAYS[0])
    assert got(t) == recount(rows, {DAYS[0], DAYS[3]})
    with pytest.raises(RuntimeError):
        t._publish(old, {}, {})
    again = FirstSeenTable(spark, tmp_root, create=False)
    assert got(again) == got(t)
    with pytest.raises(ValueError):
        t.advance(dau, "2024-13-01")
