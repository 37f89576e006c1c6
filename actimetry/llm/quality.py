"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A word is what stands between ASCII white space. Two streams of n-grams are hashed to 2^18
weights: the words as they are (one and two words), and their shapes (one to three), where a
shape keeps the classes of a word's characters: capitals, small letters, digits and each other
sign, with repeats squeezed. A word equal to the one before it is a feature of its own. The value of
a feature is its share of its stream, so a score is a sparse dot product that doesn't depend on
the length of the text.

Training reads a sample of at most ``SAMPLE`` labelled rows (the least hashes of doc_id) outside the
held-out fold. It is dealt to ``SHARDS`` shards; each runs FTRL-proximal with its own
per-coordinate rates, and the weights are averaged. The weight vector has a fixed size, whatever the input, so it
can be broadcast. Scoring reads every whole text.

Defined results: a null, empty or blank text has the bias alone; a null doc_id is scored, is not
held out and is never trained on; conflicting label rows of one document count as label 1; null labels are
ignored; with no labelled row at all every score is 0.5; extra columns don't matter.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actimetry.llm.common import held_out, map_text, neutral, restored

BITS = 18
SAMPLE = 20_000
SHARDS = 4
EPOCHS = 8
ALPHA, BETA, L1, L2 = 8.0, 1.0, 1e-3, 1e-4
THRESHOLD = 0.3
CACHE = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BITS)
_CLASS = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c
               for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)
_seen: dict[bytes, int] = {}


def _codes(words: list[bytes]) -> np.ndarray:
    """Per word the hash of the word in the high half and of its shape in the low half."""
    if len(_seen) > CACHE:
        _seen.clear()
    out = []
    for w in words:
        code = _seen.get(w)
        if code is None:
            code = _seen[w] = crc32(w) << 32 | crc32(_RUN.sub(rb"\1", w.translate(_CLASS)))
        out.append(code)
    return np.array(out, dtype=np.uint64)


def _slots(h: np.ndarray, group: int) -> np.ndarray:
    return (((h + np.uint64(group)) * _MIX) >> _SHIFT).astype(np.int32)


def groups(text: bytes | None) -> list[np.ndarray]:
    """The slots of every n-gram of ``text``, one array per stream and n, repeats included."""
    words = (text or b"").split()
    if not words:
        return []
    code = _codes(words)
    w, s = code >> np.uint64(32), code & np.uint64(0xFFFFFFFF)
    out = [_slots(w, 1), _slots(s, 2)]
    if len(w) > 1:
        out.append(_slots(w[:-1] * _MIX ^ w[1:], 3))
        two = s[:-1] * _MIX ^ s[1:]
        out.append(_slots(two, 4))
        out.append(_slots((w[:-1] == w[1:]).astype(np.uint64), 6))
        if len(w) > 2:
            out.append(_slots(two[:-1] * _MIX ^ s[2:], 5))
    return out


def sparse(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values): each slot once."""
    found = groups(text)
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    value = np.concatenate([np.full(len(g), 1 / len(g)) for g in found])
    slots, at = np.unique(np.concatenate(found), return_inverse=True)
    return slots, np.bincount(at, value).astype(np.float32)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over ``rows`` (slots, values, label); the last one is the bias."""
    z = np.zeros(2 ** BITS + 1)
    n = np.zeros(2 ** BITS + 1)

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        w[np.abs(z[i]) <= L1] = 0
        return w

    for _ in range(epochs):
        for slots, values, label in rows:
            i, x = np.append(slots, 2 ** BITS), np.append(values, 1.0)
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / ALPHA * w
            n[i] = grown
    return weights(np.arange(2 ** BITS + 1))


def sample(docs: DataFrame, labels: DataFrame, label: str, bound: int = SAMPLE) -> DataFrame:
    """(doc_id, text as bytes, label): at most ``bound`` labelled documents outside the held-out fold, of rows with the same
    doc_id the one with the smallest text.

    Before the sort, hashes beyond the share that twice the bound needs go, so the rows that meet
    in one task stay near twice the bound however many labels and partitions there are."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max(label).cast("double").alias("label")))
    size = known.count()
    order = F.xxhash64("doc_id")
    if size > 2 * bound:
        known = known.where(order < int(2.0 ** 64 * (2 * bound / size) - 2.0 ** 63))
    picked = known.orderBy(order, "doc_id").limit(bound)
    return (docs.select("doc_id", F.col("text").cast("binary").alias("text"))
            .join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE) -> np.ndarray:
    def parse(c):
        got = [sparse(t) for t in c["text"]]
        return {"doc_id": c["doc_id"], "label": c["label"], "slots": [g[0] for g in got], "vals": [g[1] for g in got]}

    rows = map_text(sample(docs, labels, label, bound), parse,
                    "doc_id long, label double, slots array<int>, vals array<float>")

    def fit(part: pa.Table) -> pa.Table:
        part = part.sort_by([("h", "ascending"), ("doc_id", "ascending")]).combine_chunks()
        slots, values = (part[c].combine_chunks() for c in ("slots", "vals"))
        at = slots.offsets.to_numpy()
        slots, values = slots.values.to_numpy(), values.values.to_numpy()
        w = ftrl([(slots[i:j], values[i:j], y) for i, j, y in zip(at, at[1:], part["label"].to_pylist())])
        at = np.flatnonzero(w)
        return pa.table({"slot": pa.array(at.astype(np.int32)), "w": w[at]})

    fitted = (rows.withColumns({"h": F.xxhash64("doc_id", F.lit(1)), "shard": F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(SHARDS))})
              .groupBy("shard").applyInArrow(fit, "slot int, w double"))
    mean = fitted.groupBy("slot").agg((F.sum("w") / SHARDS).alias("w")).toPandas()
    w = np.zeros(2 ** BITS + 1, dtype=np.float32)
    w[mean["slot"].to_numpy(dtype=np.int64)] = mean["w"].to_numpy()
    return w


def probability(text: bytes | None, w: np.ndarray) -> float:
    total = float(w[-1]) + sum(float(w[g].mean(dtype=np.float64)) for g in groups(text))
    return 1 / (1 + np.exp(-min(max(total, -35.0), 35.0)))


def score(docs: DataFrame, w: np.ndarray, column: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``column``."""
    sent = docs.sparkSession.sparkContext.broadcast(w)
    cols = docs.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(c):
        return {**{x: c[x] for x in cols},
                column: [probability(t.encode() if isinstance(t, str) else t, sent.value) for t in c["text"]]}

    return map_text(docs, run, f"{ddl}, `{column}` double")


def report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    w = train(docs, labels)
    scored = score(docs.select("doc_id", F.col("text").cast("binary").alias("text")), w).drop("text")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold."""
    plain = neutral(docs, "doc_id", "text")
    good = score(plain, train(docs, labels), "score__").where(F.col("score__") >= threshold)
    return good.select(*restored(good, plain, docs))
