"""The trained scores against plain versions: every feature, step and weight written out, without numpy or automata."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from actimetry.llm import quality, toxicity
from actimetry.llm.common import held_out


def plain_matches(folded, weights, exceptions):
    """Words between letters' edges, entry by entry; a match inside an occurrence of a phrase between such edges goes."""
    def edge(i):
        return i in (0, len(folded)) or not (folded[i - 1].isalpha() and folded[i].isalpha())
    spared = [(i, i + len(p)) for p in exceptions for i in range(len(folded) - len(p) + 1)
              if folded.startswith(p, i) and (i == 0 or not folded[i - 1].isalpha())
              and (i + len(p) == len(folded) or not folded[i + len(p)].isalpha())]
    out, i = [], 0
    while i < len(folded):
        j = i + 1
        if folded[i].isalpha() and edge(i):
            while j < len(folded) and folded[j].isalpha():
                j += 1
            word = folded[i:j]
            for entry, weight in weights.items():
                if entry.endswith("*") and len(word) > len(entry) - 1 and word.startswith(entry[:-1]):
                    out.append((i, i + len(entry) - 1, weight))
                elif word == entry:
                    out.append((i, j, weight))
        i = j
    return sorted(m for m in out if not any(s <= m[0] and m[1] <= e for s, e in spared))


@pytest.mark.parametrize("seed", range(40))
def test_matches_equal_a_plain_search(seed):
    r = random.Random(seed)
    words = ["ab", "abc", "abcd", "b", "bc", "cab", "dab", "abab", "ba"]
    weights = {w + r.choice(["", "*"]): r.uniform(1, 3) for w in r.sample(words, 5)}
    phrases = [" ".join(r.choices(words, k=2)) for _ in range(3)]
    folded = "".join(r.choice([*words, " ", " ", "-", "6", "é"]) for _ in range(r.choice([0, 1, 30, 200])))
    got = toxicity.matches(folded, toxicity.automaton(weights, phrases))
    assert sorted(got) == plain_matches(folded, weights, [toxicity.fold(p) for p in phrases])


def corpus(spark, n=420):
    """Toxic texts hold a slur, sometimes in disguise; "rotten tomato" is harmless although "rotten" marks toxic texts elsewhere."""
    r = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        words = [r.choice(["tree", "river", "stone", "cloud", "paper", "light"]) for _ in range(r.randrange(5, 40))]
        if bad:
            words[r.randrange(len(words))] = r.choice(["scumbag", "5cumbag", "scumbags", "dimwit"])
            if i % 2:
                words.append("rotten")
        elif i % 20 == 1:
            words += ["dimwit", "lantern"]
        rows.append((i, None if i == 7 else " ".join(words)))
        labels.append((i, int(bad), int(not bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(5),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"), rows, labels)


def test_toxicity_scores_equal_a_plain_model(spark):
    docs, labels, rows, known = corpus(spark)
    got = {r.doc_id: r for r in toxicity.report(docs, labels).collect()}
    train = [(toxicity.fold(t), y) for (i, t), (_, y, _) in zip(rows, known) if crc32(str(i).encode()) % 5]
    total = Counter(y for _, y in train)

    def tested(sets):
        by = Counter((w, y) for s, y in sets for w in s)
        for w in {w for w, _ in by}:
            c, x = by[w, 0], by[w, 1]
            odds = math.log((x + .5) / (total[1] + 1)) - math.log((c + .5) / (total[0] + 1))
            yield w, c, x, odds, odds / math.sqrt(1 / (x + .5) + 1 / (c + .5))

    def strings(t):
        w = set(re.findall(r"[^\W\d_]+", t))
        return w | {x[:toxicity.STEM] + "*" for x in w if len(x) > toxicity.STEM}
    weights = {w: odds for w, c, x, odds, z in tested([(strings(t), y) for t, y in train])
               if x >= max(toxicity.LEAST, toxicity.SHARE * total[1]) and len(w) > 1 and z >= toxicity.DEVIATIONS and odds > toxicity.WEIGHT}
    assert {"scumbag", "scumb*"} <= set(weights)

    def feature(t):
        s = sum(m[2] for m in plain_matches(t, weights, toxicity.EXCEPTIONS))
        return [1.0, math.log1p(s), math.log1p(1000 * s / (t.count(" ") + t.count("\n") + 1))]
    data = [(feature(t), y) for t, y in train]
    b = [0.0] * 3

    def p(x):
        return 1 / (1 + math.exp(-sum(u * v for u, v in zip(b, x))))
    for _ in range(60):         # Newton steps, the 3 x 3 system by Cramer's rule
        grad = [sum(x[k] * (y - p(x)) for x, y in data) - 1e-2 * b[k] for k in range(3)]
        h = [[sum(x[k] * x[m] * p(x) * (1 - p(x)) for x, _ in data) + (1e-2 if k == m else 0) for m in range(3)] for k in range(3)]

        def det(a):
            return sum(a[0][k] * (a[1][(k + 1) % 3] * a[2][(k + 2) % 3] - a[1][(k + 2) % 3] * a[2][(k + 1) % 3]) for k in range(3))
        d = det(h)
        b = [b[k] + det([[grad[m] if q == k else h[m][q] for q in range(3)] for m in range(3)]) / d for k in range(3)]
    for i, t in rows:
        assert got[i].score == pytest.approx(p(feature(toxicity.fold(t))), abs=1e-6)
        assert got[i].predicted == int(got[i].score >= 0.5) and got[i].held_out == (crc32(str(i).encode()) % 5 == 0)


def test_harmless_phrases_are_learnt(spark):
    rows = [(b"you scumbag", 1.0)] * 100 + [(b"a tree", 0.0)] * 500 + [(b"Scumbag Hat,scumbag  boots", 0.0)] * 200
    df = spark.createDataFrame(rows, "text binary, label double").repartition(4)
    assert toxicity.harmless(df, {"scumbag": 3.5}) == ("scumbag hat",)
    assert toxicity.harmless(df, {}) == () and toxicity.harmless(df.limit(0), {"scumbag": 3.5}) == ()
    assert toxicity.neighbours("a scumbags b", {"scumb*": 1.0}) == {"a scumbags", "scumbags b"}
    a = toxicity.automaton({"scumbag": 3.5}, ("scumbag hat",))
    assert len(toxicity.matches("scumbag hat scumbag", a)) == 1


def test_quality_scores_equal_a_plain_model(spark, monkeypatch):
    monkeypatch.setattr(quality, "EPOCHS", 2)
    monkeypatch.setattr(quality.ftrl, "__defaults__", (2,))
    docs, labels, rows, known = corpus(spark, 120)
    got = {r.doc_id: r for r in quality.report(docs, labels).collect()}
    place = {r.doc_id: r for r in docs.where(~held_out("doc_id")).select(
        "doc_id", F.xxhash64("doc_id", F.lit(1)).alias("h"),
        F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(quality.SHARDS)).alias("shard")).collect()}
    m64, mix = 2 ** 64 - 1, 0x9E3779B97F4A7C15

    def streams(text):
        """The slots of each stream, n-gram by n-gram, in whole numbers modulo 2^64."""
        words = (text or "").encode().split()
        w = [crc32(x) for x in words]
        s = [crc32(re.sub(rb"(.)\1+", rb"\1", bytes(65 if chr(c).isupper() and c < 128 else 97 if c > 127 or chr(c).islower() else 48
             if chr(c).isdigit() else c for c in x), flags=re.S)) for x in words]
        two = [(a * mix & m64) ^ b for a, b in zip(s, s[1:])]
        lists = [(1, w), (2, s), (3, [(a * mix & m64) ^ b for a, b in zip(w, w[1:])]), (4, two),
                 (6, [int(a == b) for a, b in zip(w, w[1:])]), (5, [(a * mix & m64) ^ b for a, b in zip(two, s[2:])])]
        return [[((x + g & m64) * mix & m64) >> 64 - quality.BITS for x in v] for g, v in lists if v]

    def values(text):
        x = Counter()
        for v in streams(text):
            for i in v:
                x[i] += 1 / len(v)
        return x

    mean, bias = Counter(), 2 ** quality.BITS
    for shard in range(quality.SHARDS):
        z, n = Counter(), Counter()

        def weight(i):
            if abs(z[i]) <= quality.L1:
                return 0.0
            return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)
        own = sorted((place[i].h, i, t, q) for (i, t), (_, _, q) in zip(rows, known) if i in place and place[i].shard == shard)
        for _ in range(2):
            for _, i, t, y in own:
                x = {**values(t), bias: 1.0}
                w = {k: weight(k) for k in x}
                p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
                for k, v in x.items():
                    g = (p - y) * v
                    z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / quality.ALPHA * w[k]
                    n[k] += g * g
        for k in list(z):
            mean[k] += weight(k) / quality.SHARDS
    for i, t in rows:
        p = 1 / (1 + math.exp(-mean[bias] - sum(mean[k] * v for k, v in values(t).items())))
        assert got[i].score == pytest.approx(p, abs=1e-4)
        assert got[i].predicted == int(got[i].score >= quality.THRESHOLD)
