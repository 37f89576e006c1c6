"""Exact text of stamped lines, lines with text after the object, and a missing third-party module."""

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from actimetry.functions.jsonfmt import is_object, is_one_document, parse_logs, stamp_text
from actimetry.streaming.collector import Collector, stamp_lines

TAILS = ['{"a":1}],[{"b":2}', '{"a":1}],"x', '{"type":"startup","mid":"m"}],[1', '{"a":1} trailing', '{"a":1}{"b":2}', '{"a":1},{"b":2}',
         '{"a":1},"x":2', '{"a":1}}', '{"a":1', "", "  ", "null", "7", '"x"', "[1]", '{"a":1},"end":1', '{"a":1},"end":1,"y":{"v":2']

KEPT = [
    ('{"a":1.10}', '{"a":1.10,"ts":7}'),
    ('{"a":1e3, "b" : 12345678901234567890123}', '{"a":1e3, "b" : 12345678901234567890123,"ts":7}'),
    ("{}", '{"ts":7}'), (" { } ", ' { "ts":7} '), ('{"a":1}\n', '{"a":1,"ts":7}\n'),
    ('{"b":1,"a":2,"b":3}', '{"b":1,"a":2,"b":3,"ts":7}'),
    ('{"ts":1,"a":1.0}', '{"ts":7,"a":1.0}'), ('{"a":1, "ts" :  null }', '{"a":1, "ts" :  7 }'),
    ('{"ts":"x\\"y,}","a":1}', '{"ts":7,"a":1}'), ('{"ts":-1.5e-3}', '{"ts":7}'), ('{"ts":1,"a":2,"ts":3}', '{"ts":7,"a":2,"ts":7}'),
    ('{"o":{"ts":1},"l":[{"ts":2}]}', '{"o":{"ts":1},"l":[{"ts":2}],"ts":7}'),
    ('{"o":{"ts":1},"ts":5,"l":[{"ts":2}]}', '{"o":{"ts":1},"ts":7,"l":[{"ts":2}]}'),
    ('{"s":"} \\"ts\\": 3 {","t":"ts"}', '{"s":"} \\"ts\\": 3 {","t":"ts","ts":7}'),
    ('{"s":"ts","ts":"ts"}', '{"s":"ts","ts":7}'), ('{"s":"\\u00e9 é 日本","$1":"\\\\"}', '{"s":"\\u00e9 é 日本","$1":"\\\\","ts":7}'),
    ('{"s":"{{[[","ts":1}', '{"s":"{{[[","ts":7}'),
]


def values(spark, lines, make):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string").repartition(1)
    return [r.v for r in df.select("i", make("value").alias("v")).orderBy("i").collect()]


def test_every_other_byte_stays(spark):
    assert values(spark, [k for k, _ in KEPT], lambda v: stamp_text(v, F.lit(7))) == [w for _, w in KEPT]


def test_keys_in_escapes_and_containers_are_overwritten(spark):
    got = values(spark, ['{"\\u0074s":1,"a":2}', '{"ts":{"ts":1},"a":2}', '{"a":2,"ts":[1,{"ts":2}]}'], lambda v: stamp_text(v, F.lit(7)))
    assert [json.loads(g) for g in got] == [{"a": 2, "ts": 7}] * 3


def test_text_after_the_object_is_refused(spark):
    assert values(spark, TAILS, is_object) == [False] * len(TAILS)
    assert values(spark, TAILS, lambda v: stamp_text(v, F.lit(7))) == [None] * len(TAILS)
    assert values(spark, ["[1]", "7", '{"a":[{}]}'], is_one_document) == [True] * 3
    bad = parse_logs(spark.createDataFrame([(t,) for t in TAILS[:9]], "value string"), "value").collect()
    assert all(r._corrupt_record is not None for r in bad)


def test_long_lines_do_not_break_the_patterns(spark):
    long = '{"s":"' + 'x\\"' * 200_000 + '","n":' + "[" * 200 + "]" * 200 + ',"ts":1}'
    assert values(spark, [long], lambda v: stamp_text(v, F.lit(7))) == [long[:-2] + "7}"]
    many = '{"l":[' + ",".join(['{"ts":1}'] * 300) + '],"ts":2}'
    assert values(spark, [many], lambda v: stamp_text(v, F.lit(7))) == [many[:-2] + "7}"]


def test_the_archive_holds_the_text_as_it_came(spark, tmp_root):
    lines = [k for k, _ in KEPT if not k.endswith("\n")] + TAILS[:5]
    df = spark.createDataFrame([(v, 7) for v in lines], "value string, t long").select("value", F.timestamp_millis("t").alias("arrival"))
    c = Collector(f"{tmp_root}/archive", f"{tmp_root}/routed")
    c.process(stamp_lines(df), 0)
    want = sorted(w for k, w in KEPT if not k.endswith("\n"))
    assert sorted(r.value for r in spark.read.parquet(c.archive_path).collect()) == want
    assert sorted(r.raw for r in spark.read.parquet(c.quarantine_path).collect()) == sorted(TAILS[:5])


@pytest.mark.parametrize("module", ["xxhash", "zstandard", "ahocorasick", "actimetry.llm", "corpus_pipeline"])
def test_the_entry_stands_without_a_module(module):
    code = (f"import sys; sys.modules[{module!r}] = None\nimport __spark_entry__ as e\n"
            "q = e.queries(); print(len([k for k in q if not k.startswith(('op', 'pipeline'))]), len(q), sorted(set(e.oracle_sql()) - set(q)))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0])
    assert out.stdout.split() == ["60", "60", "[]"], out.stderr
