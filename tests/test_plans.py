"""Plan shape: no Python evaluation anywhere; filters reach the scan; partitions pruned."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from actimetry.operators.metrics import dau_hours
from actimetry.plans import catalog as C
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonMapInArrow")
BATCH = [n for n in E.queries() if not n.startswith(("r2_", "r7_", "s1_", "a4_stream"))]


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(BATCH))
def test_no_python_in_plan(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert not any(p in plan for p in PYTHON_NODES), plan


def test_day_filter_is_pushed_to_parquet(spark):
    plan = _plan(dau_hours(C.dau(spark, SF_SMALL, C.DATE, C.DATE), C.DATE))
    assert "PushedFilters: [IsNotNull(ts), IsNotNull(event_type), GreaterThanOrEqual(ts," in plan
    assert "EqualTo(event_type,view)" in plan
    # only the needed columns are read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_dau_table_scan_prunes_partitions(spark):
    plan = _plan(E.queries()["s3_dau_scan"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(log_date" in plan
    assert "/dau/log_date=2024-01-15]" in plan   # only that folder is listed


def test_anti_join_without_hint(spark):
    plan = _plan(E.queries()["j2_anti_by_date"](spark, SF_SMALL))
    assert "LeftAnti" in plan
