"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases the text and maps look-alike letters of other scripts, digits and signs that
stand for letters to those letters, so ``1d10t`` and a Cyrillic look-alike meet the same entry. The
lexicon is learnt from labelled rows outside the held-out fold: a word enters with its smoothed
log odds between the two labels if it is in at least ``LEAST`` toxic documents and the share ``SHARE`` of them,
and its odds are over ``WEIGHT`` and ``DEVIATIONS`` standard errors above even. So does the stem (the first ``STEM``
letters) of longer words, written with a star, which matches at the start of any longer word. Matches inside an
exception phrase don't count. Exception phrases are stated ones (a parameter) and learnt ones: two neighbouring words, one of them an
entry, that stand in at least ``LEAST`` documents without the label and the share ``SPARED`` of them, and whose odds are over
``DEVIATIONS`` standard errors below even.

A text's features are the sum of the weights of its matches, once as it is and once over its
length, both on a logarithmic scale; a logistic function of them, fitted on the same rows, is the score.

At most ``SAMPLE`` labelled rows are read for training; they are written once, in the shared folder, and every count reads them there. A
word of the lexicon stands in ``SHARE`` of the toxic ones and a learnt phrase in ``SPARED`` of the others, so the automaton has a
size bound. Scoring reads every whole text.

Defined results: a null or empty text has no match and the score of that; a null doc_id is scored and
never trained on; null labels are ignored, conflicting ones count as 1; with no labelled row every score is 0.5;
repeated rows are scored one by one; extra columns don't matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actimetry.llm.common import held_out, map_text, materialise
from actimetry.llm.quality import sample

SAMPLE = 20_000
LEAST = 4
SHARE = 0.01
SPARED = 0.001
WEIGHT = 3.0
STEM = 5
DEVIATIONS = 2.5
# What is read as which letter, and phrases in which an entry is harmless.
FOLD = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "|": "l",
        "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s",
        "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ε": "e",
        "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "ı": "i", "ɡ": "g"}
EXCEPTIONS = ("circus clown", "clown fish", "rodeo clown", "the idiot by dostoevsky", "worthless stock",
              "pathetic fallacy", "trash can", "garbage collection", "garbage truck")
_TABLE = str.maketrans(FOLD)
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    return (text or "").lower().translate(_TABLE)


def automaton(weights: dict[str, float], exceptions=EXCEPTIONS) -> "ahocorasick.Automaton":
    """Entries carry (length, weight as a word, weight as a stem); exception phrases (length, None, None)."""
    a = ahocorasick.Automaton()
    for w in {x.rstrip("*") for x in weights}:
        a.add_word(w, (len(w), weights.get(w, 0.0), weights.get(w + "*", 0.0)))
    for p in exceptions:
        p = fold(p)
        a.add_word(p, (len(p), None, None))
    a.make_automaton()
    return a


def matches(folded: str, a: "ahocorasick.Automaton") -> list[tuple[int, int, float]]:
    """(start, end, weight) of words and stems outside exception phrases."""
    found, spared, n = [], [], len(folded)
    for last, (size, weight, stem) in a.iter(folded):
        s, e = last - size + 1, last + 1
        if s and folded[s - 1].isalpha():
            continue
        whole = e == n or not folded[e].isalpha()
        if weight is None:
            if whole:
                spared.append((s, e))
        elif weight and whole or stem and not whole:
            found.append((s, e, weight if whole else stem))
    if not spared:
        return found
    # both lists in order: of the phrases that start at or before a match only the one that ends last counts
    spared.sort()
    found.sort()
    kept, at, end = [], 0, -1
    for m in found:
        while at < len(spared) and spared[at][0] <= m[0]:
            end = max(end, spared[at][1])
            at += 1
        if m[1] > end:
            kept.append(m)
    return kept


def features(text: str | None, a: "ahocorasick.Automaton") -> tuple[float, float]:
    folded = fold(text)
    total = sum(w for _, _, w in matches(folded, a))
    return math.log1p(total), math.log1p(1000.0 * total / (folded.count(" ") + folded.count("\n") + 1))


def _counted(rows: DataFrame, found, name: str) -> tuple[DataFrame, int, int]:
    """(counts, clean, toxic): in how many texts of ``rows`` (text as bytes, label) of either kind each string of ``found``(folded text)
    stands, as (word, clean, toxic, odds, z), and how many there are of each kind."""
    def count(c):
        by = (Counter(), Counter())
        n = [0, 0]
        for t, y in zip(c["text"], c["label"]):
            by[int(y)].update(found(fold(t.decode() if t else "")))
            n[int(y)] += 1
        words = [w for w in {*by[0], *by[1]}]
        return {"word": [*words, None], "clean": [*(by[0][w] for w in words), n[0]], "toxic": [*(by[1][w] for w in words), n[1]]}

    counts = map_text(rows.select("text", "label"), count, "word string, clean long, toxic long")
    counts = materialise(counts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), name)
    all_ = counts.where("word IS NULL").first()
    clean, toxic = (all_["clean"], all_["toxic"]) if all_ else (0, 0)
    odds = F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(clean + 1.0))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    return counts.where("word IS NOT NULL").withColumns({"odds": odds, "z": odds / error}), clean, toxic


def lexicon(rows: DataFrame) -> dict[str, float]:
    """Weights of the words that mark label 1 in ``rows`` (text as bytes, label): every word that passes the test. As each has to stand in
    ``SHARE`` of the texts with label 1, there are no more than 1 / ``SHARE`` times the words of such a text."""
    def found(folded):
        words = set(_WORD.findall(folded))
        return words | {w[:STEM] + "*" for w in words if len(w) > STEM}

    counts, clean, toxic = _counted(rows, found, "toxicity-words")
    if not toxic or not clean:
        return {}
    picked = counts.where((F.col("toxic") >= max(LEAST, SHARE * toxic)) & (F.length("word") > 1)
                          & (F.col("z") >= DEVIATIONS) & (F.col("odds") > WEIGHT))
    return {r["word"]: float(r["odds"]) for r in picked.select("word", "odds").collect()}


def neighbours(folded: str, weights: dict[str, float]) -> set[str]:
    """Pairs of words with one space between them of which one is matched by an entry."""
    out, before, end, was = set(), "", -1, False
    for m in _WORD.finditer(folded):
        w = m.group()
        entry = w in weights or any(w[:k] + "*" in weights for k in range(1, min(len(w), STEM + 1)))
        if (entry or was) and m.start() == end + 1 and folded[end] == " ":
            out.add(f"{before} {w}")
        before, end, was = w, m.end(), entry
    return out


def harmless(rows: DataFrame, weights: dict[str, float]) -> tuple[str, ...]:
    """Learnt exception phrases, in order: every pair that passes the test. As each has to stand in ``SPARED`` of the texts without
    the label, there are no more than 1 / ``SPARED`` times the pairs of such a text."""
    if not weights:
        return ()
    counts, clean, _ = _counted(rows, lambda folded: neighbours(folded, weights), "toxicity-pairs")
    picked = counts.where((F.col("clean") >= max(LEAST, SPARED * clean)) & (F.col("z") <= -DEVIATIONS))
    return tuple(sorted(r["word"] for r in picked.select("word").collect()))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton steps for a ridge logistic regression; the first coefficient is the intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        grad = x.T @ (y - p) - ridge * b
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), grad)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE,
          exceptions: tuple[str, ...] = EXCEPTIONS) -> tuple[dict[str, float], tuple[str, ...], np.ndarray]:
    """(lexicon, exception phrases, coefficients)."""
    rows = materialise(sample(docs, labels, label, bound), "toxicity-sample")
    words = lexicon(rows)
    spared = tuple(dict.fromkeys([*exceptions, *harmless(rows, words)]))

    def featured(c):
        a = automaton(words, spared)
        got = [features(t.decode() if t else "", a) for t in c["text"]]
        return {"a": [g[0] for g in got], "b": [g[1] for g in got], "y": c["label"]}

    # at most ``bound`` rows of three numbers
    got = map_text(rows.select("text", "label"), featured, "a double, b double, y double").toPandas()
    if not len(got):
        return words, spared, np.zeros(3)
    return words, spared, logistic(got[["a", "b"]].to_numpy(), got["y"].to_numpy())


def score(docs: DataFrame, model: tuple[dict[str, float], tuple[str, ...], np.ndarray], column: str = "score") -> DataFrame:
    words, spared, b = model
    cols = docs.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    held: list = []

    def run(c):
        if not held:
            held.append(automaton(words, spared))
        out = []
        for t in c["text"]:
            x = features(t, held[0])
            out.append(1 / (1 + math.exp(-max(min(b[0] + b[1] * x[0] + b[2] * x[1], 35), -35))))
        return {**{k: c[k] for k in cols}, column: out}

    return map_text(docs, run, f"{ddl}, `{column}` double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
