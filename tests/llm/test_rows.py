"""Rows that share an id, stated zero targets, and what an empty table makes of every stage."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from actimetry.llm import mixing, quality, simhash, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
A = " ".join(f"alpha{i}" for i in range(30))
B = " ".join(f"beta{i}" for i in range(30))


def frame(spark, rows, n=3):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS).repartition(n)


def test_a_row_follows_its_own_text(spark):
    got = simhash.keep_one(frame(spark, [(5, A, "x"), (5, B, "y"), (2, B, "z")]))
    assert sorted(tuple(r) for r in got.collect()) == [(2, B, "en", "z", len(B)), (5, A, "en", "x", len(A))]
    rows = [(None, A, "n"), (3, A, "a"), (4, A, "b"), (4, None, "c"), (9, "", "d"), (4, A, "e"), (3, A, "f")]
    got = simhash.keep_one(frame(spark, rows))
    assert sorted(r.source for r in got.collect()) == ["a", "c", "f", "n"]     # 9 is empty like a row of 4


def test_a_target_of_zero_draws_nothing(spark):
    rows = [(i, A, "web") for i in range(20)] + [(100 + i, A, "books") for i in range(20)] + [(200, None, "none")]
    for want in ({"web": 1.0}, {"web": 1.0, "books": 0.0}):
        done = mixing.report(frame(spark, rows), {"source": want, "lang": 1.0, "topic": 1.0}, rate=1.0)
        by = {r.source: r for r in done.groupBy("source").agg(F.sum("copies").alias("c"), F.max("weight").alias("w")).collect()}
        assert by["books"].c == 0 and by["books"].w == 0
        assert by["web"].c == pytest.approx(40, abs=8) and by["web"].w == pytest.approx(2, rel=1e-3)


def test_a_fit_that_does_not_end_says_so(spark):
    rows = [(i, " ".join([f"word{i % 5}x"] * (i % 7 + 1)), f"s{i % 3}") for i in range(40)]
    with pytest.warns(UserWarning, match="no fit"):
        mixing.report(frame(spark, rows), {"source": 0.1, "lang": 1.0, "topic": 0.0}, sweeps=1).collect()


def test_the_label_sample_is_bounded_by_rows(spark):
    docs = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(7, 1, 1)] * 50, "doc_id long, quality int, toxic int")
    got = quality.sample(docs, labels, "quality", 10).collect()
    assert [(r.doc_id, bytes(r.text), r.label) for r in got] == [(7, b"text 0", 1.0)]


def test_the_lexicon_keeps_every_word_that_passes(spark):
    bad = " ".join(f"vile{chr(97 + i // 26)}{chr(97 + i % 26)}q" for i in range(600))
    rows = [(bad.encode() if i % 4 == 0 else b"kind words only", float(i % 4 == 0)) for i in range(200)]
    words = toxicity.lexicon(spark.createDataFrame(rows, "text binary, label double"))
    assert len([w for w in words if w.startswith("vile")]) >= 600


def test_spared_phrases_as_a_plain_search():
    weights = {"clown": 2.0, "idiot": 3.0, "garba*": 1.0}
    text = "clown circus clown clown fish idiot garbage truck garbages the idiot by dostoevsky clown " * 3
    got = toxicity.matches(toxicity.fold(text), toxicity.automaton(weights))
    spared = [m.span() for p in toxicity.EXCEPTIONS for m in re.finditer(rf"\b{p}\b", text)]
    plain = [(m.start(), m.end()) for m in re.finditer(r"\b(?:clown|idiot)\b", text)] + [
        (m.start(), m.end()) for m in re.finditer(r"\bgarba(?=\w)", text)]
    want = sorted(x for x in plain if not any(s <= x[0] and x[1] <= e for s, e in spared))
    assert [m[:2] for m in got] == want
    long = "circus clown clown " * 40_000
    assert len(toxicity.matches(toxicity.fold(long), toxicity.automaton(weights))) == 40_000


def test_stages_on_an_empty_table_and_on_repeated_ids(spark, tmp_path):
    empty = spark.createDataFrame([], DOCS)
    folder = str(tmp_path)
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("q1", "one two three four five six seven eight nine ten eleven")], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, empty, folder)
        assert got.collect() == [] and got.columns[:5] == empty.columns, name
    rows = [(i // 2, f"{A if i % 2 else B} tail{i // 4}", "s") for i in range(80)] + [(1, None, None), (1, "", None)]
    docs = frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        assert docs.count() <= len(rows)
    docs.unpersist()
