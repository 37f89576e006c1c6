"""The Katz model against a plain one, its distributions against one, on messy rows and on an empty table."""

import math
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from actimetry.llm import katz, token_blocks

SCHEMA = "doc_id long, text string, lang string, block long, uid long, held boolean, n long, words string"
SF = "/root/testdata/sf0.001"


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^ \t\n\x0b\x0c\r]+", low) + [None]


def plain_discounts(n):
    for k in range(5, 0, -1):
        if all(n[r] for r in range(1, k + 2)):
            x = (k + 1) * n[k + 1] / n[1]
            if x < 1:
                d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - x) / (1 - x) for r in range(1, k + 1)}
                if all(0 < v < 1 for v in d.values()):
                    return d
    return {}


class Plain:
    def __init__(self, texts):
        self.c, self.pairs, self.after = Counter(), Counter(), {}
        for t in texts:
            seq = [None] + tokens_of(t)
            self.c.update(seq[1:])
            self.pairs.update(zip(seq, seq[1:]))
        for (h, w), a in self.pairs.items():
            self.after.setdefault(h, {})[w] = a
        self.N, self.V = sum(self.c.values()), len(self.c)
        n1 = Counter(self.c.values())
        d1 = plain_discounts(n1)
        taken = sum((1 - d) * r * n1[r] for r, d in d1.items())
        total = self.N if taken else self.N + 1
        self.word = {w: d1.get(c, 1) * c / total for w, c in self.c.items()}
        self.unknown = taken / self.N if taken else 1 / total
        self.d = plain_discounts(Counter(self.pairs.values()))
        self.bi, self.alpha = {}, {}
        for h, ws in self.after.items():
            c = sum(ws.values())
            total = c if any(a in self.d for a in ws.values()) else c + 1
            for w, a in ws.items():
                self.bi[h, w] = self.d.get(a, 1) * a / total
            self.alpha[h] = (1 - sum(self.bi[h, w] for w in ws)) / (1 - sum(self.word[w] for w in ws))

    def p(self, h, w):
        if (h, w) in self.bi:
            return self.bi[h, w]
        return self.alpha.get(h, 1) * self.word.get(w, self.unknown)

    def row(self, i, text):
        seq = [None] + tokens_of(text)
        return (i, held(i), len(seq) - 1, sum(w in self.c for w in seq[1:]), self.N,
                sum(math.log10((self.c[w] + 1) / (self.N + self.V + 1)) for w in seq[1:]),
                sum(math.log10(self.p(h, w)) for h, w in zip(seq, seq[1:])))


def held(i):
    return i is not None and crc32(str(i).encode()) % 7 == 2


def check(df, rows):
    model = Plain([t for i, t in rows if not held(i)])
    want = sorted((model.row(i, t) for i, t in rows), key=repr)
    got = sorted((tuple(r) for r in katz.report(df).collect()), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], abs=1e-8 * g[2] + 1e-12)
    return model


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, 2, False, 3, "w") for i, t in rows], SCHEMA).repartition(3)


def messy():
    rows = [(i, f"The cat{i % 9} saw\ta dog{i % 4}  and THE{chr(10)}owl{i * i % 31} é") for i in range(200)]
    rows += [(300, None), (301, ""), (302, " \r\n"), (None, "null id the cat1"), (5, "same id"), (5, "same id"), (5, "other"), (303, "x " * 30_000),
             (304, "日本  nbsp stays"), (305, "cat1 " * 50)]
    return rows


def test_scores_match_a_plain_model(spark):
    check(frame(spark, messy()), messy())


def test_hot_histories_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(katz, "HOT", 3)                         # nearly every frequent history is dealt over buckets
    monkeypatch.setattr(katz, "BLOCK", 200)
    monkeypatch.setattr(katz, "LEAST_BUCKETS", 8)
    monkeypatch.setattr(token_blocks, "SLICE", 300)
    check(frame(spark, messy()), messy())


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(docs, rows)
    got = katz.report(docs).groupBy("held_out").agg((F.sum("score") / F.sum("n_tokens")).alias("s"), (F.sum("base_score") / F.sum("n_tokens")).alias("b")).collect()
    assert all(r.s > r.b for r in got)                          # better than the base, on held-out texts too


def test_every_distribution_sums_to_one(spark):
    rows = messy()
    model, _ = katz.fit_and_score(frame(spark, rows))
    p = {r.id: float(model.word.p(katz.np.array([r.a]))[0]) for r in model.words.collect()}
    assert sum(p.values()) + model.word.unknown == pytest.approx(1, abs=1e-12)
    seen = {}
    for r in model.pairs.collect():
        seen.setdefault(r.h, {})[r.w] = r.a
    weights = {r.h: r for r in model.backoff().collect()}
    assert set(weights) == set(seen)
    for h, ws in seen.items():
        own = sum(float(katz.discounted(katz.np.array([a]), model.d)[0]) / weights[h].total for a in ws.values())
        rest = sum(v for w, v in p.items() if w not in ws) + model.word.unknown
        assert own + weights[h].alpha * rest == pytest.approx(1, abs=1e-9)


def test_no_training_texts_and_an_empty_table(spark):
    only = next(i for i in range(100) if held(i))
    assert [tuple(r) for r in katz.report(frame(spark, [(only, "a b")])).collect()] == [(only, True, 3, 0, 0, 0.0, 0.0)]
    df = katz.report(spark.createDataFrame([], SCHEMA))
    assert df.collect() == [] and df.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert dict(df.dtypes) | {"doc_id": "bigint"} == {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
                                                      "train_tokens": "bigint", "base_score": "double", "score": "double"}


def test_the_catalog_keeps_no_table(spark):
    katz.report(frame(spark, messy()[:5])).collect()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("katz")]


@pytest.mark.parametrize("counts", [{}, {1: 5}, {1: 100, 2: 40, 3: 20, 4: 12, 5: 8, 6: 5}, {1: 3, 2: 50, 3: 1}])
def test_discounts_are_between_0_and_1(counts):
    assert ((katz.discounts(counts) > 0) & (katz.discounts(counts) < 1)).all()
    assert list(katz.discounts(counts)) == pytest.approx(list(plain_discounts(Counter(counts)).values()))
