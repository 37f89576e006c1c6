"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The tokens of the cells are raked: one
dimension after the other, every value's factor is set to its target over the tokens that the
other dimensions' factors give it, until no factor moves by more than ``TOLERANCE``. A cell's weight is
the product of its three factors, so what iterates is three small tables; the cells themselves
are written once. Only sums by one key are shuffled, with partial sums first, so a source that
holds a third of all rows costs one row per task.

A document's expected number of copies is the rate times its cell's weight. It gets the whole part, and one more
with the probability of the rest, by a hash of its doc_id: the calibration is exact in expectation, and the same
document gets the same answer wherever and however often it is drawn.

The topic of a text is the bucket of its most frequent word of ``LONG`` or more characters
(the smallest such word on ties), or of the empty word.

Targets: a dict of value to share (values not listed keep their token shares of what is left), or an
exponent p: shares in proportion to the token share to the power p (1 keeps, 0 is uniform).

Defined results: a null source or language is the value "(none)"; a null or empty text has no tokens
and the bucket of the empty word; a value without tokens gets factor 1, one with tokens and a target of zero factor 0; rows with equal or null doc_id
are drawn alike; an empty table gives no rows; extra columns are ignored, or kept by ``sample``.
"""

from __future__ import annotations

import warnings
from collections import Counter
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actimetry.llm.common import map_text, materialise, neutral, restored

TOPICS = 8
LONG = 5
SWEEPS = 20
TOLERANCE = 1e-4
SEED = 2024
TARGETS = {"source": 0.5, "lang": 0.7, "topic": 0.0}
NONE = "(none)"


def topic_and_tokens(text: str | None, topics: int = TOPICS) -> tuple[int, int]:
    words = (text or "").split()
    count = Counter(w for w in words if len(w) >= LONG)
    most = max(count.values(), default=0)
    word = min((w for w, c in count.items() if c == most), default="")
    return crc32(word.encode()) % topics, len(words)


def with_cells(docs: DataFrame, topics: int = TOPICS, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the cell of every document: source__, lang__, topic__, n_tokens__."""
    keep = docs.columns if keep is None else keep
    ddl = "".join(f"`{docs.schema[c].name}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    def run(c):
        got = [topic_and_tokens(t, topics) for t in c["text"]]
        return {**{x: c[x] for x in keep}, "source__": [NONE if v is None else v for v in c["source__"]],
                "lang__": [NONE if v is None else v for v in c["lang__"]],
                "topic__": [str(g[0]) for g in got], "n_tokens__": [g[1] for g in got]}

    wide = docs.select(*dict.fromkeys([*keep, "text"]), F.col("source").cast("string").alias("source__"),
                       F.col("lang").cast("string").alias("lang__"))
    return map_text(wide, run, ddl + "source__ string, lang__ string, topic__ string, n_tokens__ long")


def _target(cells: DataFrame, dim: str, want: dict | float) -> DataFrame:
    """(value, goal): tokens that each value of ``dim`` should have."""
    own = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").cast("double").alias("t"))
    if isinstance(want, dict):
        listed = F.coalesce(F.lit(None).cast("double"),
                            *[F.when(F.col("value") == str(v), F.lit(float(x))) for v, x in want.items()])
        own = own.withColumn("share", listed)
        rest = own.where("share IS NULL").agg(F.sum("t")).first()[0]
        left = max(0.0, 1.0 - sum(want.values()))
        own = own.withColumn("g", F.coalesce("share", F.col("t") / F.lit(rest or 1.0) * left, F.lit(0.0)))
    else:
        own = own.withColumn("g", F.when(F.col("t") > 0, F.pow("t", F.lit(float(want)))).otherwise(0.0))
    sums = own.agg(F.sum("t").alias("t"), F.sum("g").alias("g")).first()
    return own.select("value", "t", (F.col("g") / F.lit(sums["g"] or 1.0) * F.lit(sums["t"] or 0.0)).alias("goal"))


def rake(cells: DataFrame, targets: dict | None = None, sweeps: int = SWEEPS,
         tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (source__, lang__, topic__, tokens) with ``weight``."""
    targets = targets or TARGETS
    dims = {f"{d}__": want for d, want in targets.items()}
    goal = {d: materialise(_target(cells, d, want), "mix-goal") for d, want in dims.items()}
    factor = {d: goal[d].select("value", F.lit(1.0).alias("f")) for d in dims}

    def named(d):
        return factor[d].select(F.col("value").alias(d), F.col("f").alias(f"f_{d}"))

    for _ in range(sweeps):
        moved = 0.0
        for d in dims:
            others = [x for x in dims if x != d]
            rows = cells.select(d, *others, "tokens")
            mass = F.col("tokens").cast("double")
            for x in others:
                rows, mass = rows.join(named(x), x), mass * F.col(f"f_{x}")
            got = rows.groupBy(F.col(d).alias("value")).agg(F.sum(mass).alias("got"))
            new = (goal[d].join(got, "value", "left").join(factor[d].withColumnRenamed("f", "old"), "value")
                   .select("value", F.when((F.col("goal") <= 0) & (F.col("t") > 0), F.lit(0.0))
                           .when((F.col("got") > 0) & (F.col("goal") > 0), F.col("goal") / F.col("got"))
                           .otherwise(F.lit(1.0)).alias("f"), "old"))
            new = materialise(new, "mix-factor")
            moved = max(moved, new.agg(F.max(F.when(F.col("old") > 0, F.abs(F.col("f") / F.col("old") - 1)).otherwise(0.0)))
                        .first()[0] or 0.0)
            factor[d] = new.select("value", "f")
        if moved <= tolerance:
            break
    else:
        warnings.warn(f"no fit after {sweeps} sweeps: a factor still moved by {moved:.2g}", stacklevel=2)
    out = cells
    for d in dims:
        out = out.join(named(d), d)
    weight = F.lit(1.0)
    for d in dims:
        weight = weight * F.col(f"f_{d}")
    return out.select(*cells.columns, weight.alias("weight"))


def _drawn(df: DataFrame, rate: float, seed: int) -> DataFrame:
    """``df`` (doc_id, weight__) with expected__ and copies__."""
    expected = F.lit(float(rate)) * F.col("weight__")
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    whole = F.floor("expected__")
    return (df.withColumn("expected__", expected)
            .withColumn("copies__", (whole + (u < F.col("expected__") - whole).cast("long")).cast("long")))


def _weights(parts: DataFrame, targets: dict | None, sweeps: int) -> DataFrame:
    cells = materialise(parts.groupBy("source__", "lang__", "topic__").agg(F.sum("n_tokens__").alias("tokens")), "mix-cells")
    return materialise(rake(cells, targets, sweeps).select("source__", "lang__", "topic__", F.col("weight").alias("weight__")), "mix-weights")


def report(docs: DataFrame, targets: dict | None = None, rate: float = 0.5, seed: int = SEED,
           sweeps: int = SWEEPS) -> DataFrame:
    """Every document with its cell, its weight, its expected and its drawn number of copies."""
    parts = materialise(with_cells(docs, keep=["doc_id"]), "mix-parts")
    weights = _weights(parts, targets, sweeps)
    done = _drawn(parts.join(weights, ["source__", "lang__", "topic__"]), rate, seed)
    return done.select("doc_id", F.col("source__").alias("source"), F.col("lang__").alias("lang"),
                       F.col("topic__").alias("topic"), F.col("n_tokens__").alias("n_tokens"), F.col("weight__").alias("weight"),
                       F.col("expected__").alias("expected"), F.col("copies__").alias("copies"))


def sample(docs: DataFrame, targets: dict | None = None, rate: float = 1.0, seed: int = SEED,
           sweeps: int = SWEEPS) -> DataFrame:
    """The drawn documents, each once, with mix_topic, mix_weight and mix_copies after their own columns
    (which replace columns of these names)."""
    weights = _weights(with_cells(docs, keep=["doc_id"]), targets, sweeps)
    plain = neutral(docs, "doc_id", "text", "source", "lang")
    done = _drawn(with_cells(plain).join(weights, ["source__", "lang__", "topic__"]), rate, seed).where("copies__ > 0")
    return done.select(*restored(done, plain, docs, ("mix_topic", "mix_weight", "mix_copies")), F.col("topic__").alias("mix_topic"),
                       F.col("weight__").alias("mix_weight"), F.col("copies__").alias("mix_copies"))
