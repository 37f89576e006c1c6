"""Phrase mining against counting everything, on messy rows, with a threshold that prunes and on an empty table."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from actimetry.llm import collocations, token_blocks

SCHEMA = "doc_id long, text string, lang string, phrase string, a long, score long, n long, tau long"


def plain(rows, keep):
    totals, counts = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    counts[lang, tuple(w[i:i + size])] += 1
    good = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= 30}
    out = {}
    for (lang, p), a in good.items():
        if any(k == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (k, q), b in good.items()):
            continue
        cuts = [(2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        s, k = min(cuts)
        out.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return {(lang, n + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, c in out.items()
            for n, (s, a, p, l, r) in enumerate(sorted(c)[:keep])}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, 2, 3, 4) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


def texts(seed, n, words):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = [" ".join(rng.choices(words, k=5)) for _ in range(6)]
    return [". ".join([" ".join(rng.choices(words, weights, k=rng.randint(1, 12))), rng.choice(fixed)]) for _ in range(n)]


def rows_of():
    rows = [(t, ["en", "fr", None][i % 3]) for i, t in enumerate(texts(1, 900, [f"w{i}" for i in range(12)] + ["É", "日本", "A b"]))]
    rows += [(None, "en"), ("", "en"), (" \t ", None), (None, None), ("und e r", "und"), ("Same Text, same text! " * 40, "de"), ("a b c d e " * 3000, "es")]
    return rows + [rows[0]] * 40


@pytest.mark.parametrize("keep", [3, 25, 2000])
def test_mining_matches_counting_everything(spark, keep):
    rows = rows_of()
    got = collocations.mine(frame(spark, rows), keep).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == plain(rows, keep)


def test_report_of_an_empty_table(spark):
    df = collocations.report(spark.createDataFrame([], SCHEMA))
    assert df.collect() == [] and df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_scores_are_exact_past_64_bits(spark):
    big = 2 ** 62
    row = spark.range(1).selectExpr(f"{big}L as a", f"{big + 1}L as l", f"{big + 3}L as r").select(collocations.exact_score("a", "l", "r").alias("s")).first()
    assert row.s == 2000000 * big // (2 * big + 4)


def test_blocks_cut_long_texts_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(token_blocks, "SLICE", 50)
    monkeypatch.setattr(collocations, "BLOCK", 40)
    rows = [("alpha beta gamma, delta epsilon zeta. " * 60, "en"), ("one two three four five " * 40, "en")]
    df = frame(spark, rows)
    assert collocations.pack(df).count() > 3
    assert {tuple(r) for r in collocations.mine(df, 10).collect()} == plain(rows, 10)


def test_nodes_are_never_missed(spark):
    phrases = [("en", f"a{i} b{i % 7}") for i in range(3000)] + [("fr", "a1 b1")]
    nodes = collocations.Nodes(spark.createDataFrame(phrases, "lang string, phrase string"), 2)
    assert nodes.has(collocations._hash_phrases("en", [p for lang, p in phrases if lang == "en"])).all()
    other = nodes.has(collocations._hash_phrases("de", [p for _, p in phrases]))
    assert np.mean(other) < 0.1
