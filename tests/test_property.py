"""Brute force vs Spark on random small log sets (Hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from actimetry.functions.timefmt import with_date_hour
from actimetry.operators.dedup import anti_by_date, first_per_key
from actimetry.operators.metrics import dau_hours

BASE = int(dt.datetime(2024, 1, 14, tzinfo=dt.timezone.utc).timestamp() * 1000)

rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d"]),
              st.integers(min_value=0, max_value=3 * 86_400_000 - 1)),
    min_size=0, max_size=40)


def _date_hour(ms):
    t = dt.datetime.fromtimestamp(ms / 1000, tz=dt.timezone.utc)
    return t.strftime("%Y-%m-%d"), t.strftime("%H")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, seen_rows=rows_st)
def test_dedup_anti_and_hours_match_brute_force(spark, rows, seen_rows):
    data = [(i, m, BASE + off) for i, (m, off) in enumerate(rows)]
    df = with_date_hour(spark.createDataFrame(data, "seq long, mid string, ts long"), "ts", "UTC")
    seen = with_date_hour(spark.createDataFrame([(m, BASE + o) for m, o in seen_rows], "mid string, ts long"),
                          "ts", "UTC").select("mid", "log_date")

    # brute force
    best = {}
    for seq, mid, ts in data:
        d, h = _date_hour(ts)
        cur = best.get((mid, d))
        if cur is None or (ts, seq) < (cur[0], cur[1]):
            best[(mid, d)] = (ts, seq, h)
    seen_keys = {(m, _date_hour(BASE + o)[0]) for m, o in seen_rows}
    kept = {k: v for k, v in best.items() if k not in seen_keys}

    first = first_per_key(df, tie_break=["seq"])
    assert sorted((r.mid, r.log_date, r.ts, r.seq) for r in first.collect()) == \
        sorted((m, d, v[0], v[1]) for (m, d), v in best.items())
    new = anti_by_date(first, seen)
    assert sorted((r.mid, r.log_date) for r in new.collect()) == sorted(kept)

    day = "2024-01-15"
    want = {}
    for (m, d), v in best.items():
        if d == day:
            want[v[2]] = want.get(v[2], 0) + 1
    assert {r.lh: r.ct for r in dau_hours(first, day).collect()} == want
