"""Phrase collocation mining: best-first branch-and-bound growth of phrases, per language.

A text, A-Z lower-cased, is split into pieces at ``.,;:!?`` and line ends, a piece into words at blanks and tabs. A phrase of two to ``LONGEST``
words that occurs ``LEAST`` times or more inside pieces is a candidate. Cut after its first k words, with l and r the counts
of the two parts, it scores floor(2000000 a / (l + r)); its lowest cut counts. A candidate inside a longer one
that has at least 80 % of its count is dropped. Each language keeps its ``KEEP`` best.

Growth, best first. Words, then pairs, are counted over all texts; a longer phrase is counted only if a node asks for it:

* a phrase p that starts with w can grow to a phrase with count a <= m(p), the lesser of its own count and of the largest pair that its last
  word starts, so no phrase grown from it scores more than floor(2000000 m / (f(w) + m)), as the first cut has l = f(w) and r >= a.
  This bound is admissible: p is expanded only if it reaches the language's threshold;
* a candidate that reaches the threshold is settled by the counts of its one-word extensions on either side: a longer
  candidate that drops it contains one of these, which drops it too.

The threshold starts at the score of the 2 ``KEEP``-th best pair of each language. What lies at or over it is settled
exactly, so a language with ``KEEP`` survivors there is done, ties included; for the others the threshold falls, to
zero in the end, and the frontier is expanded again. A round is a scan of word numbers (``token_blocks``), not of texts.

The nodes that a scan looks for go out as bitmaps of their hashes, of at most 2^``BITS`` bits whatever their number. A
false hit costs a phrase counted in vain: every phrase that is counted at all is counted at all its places.

Defined results: a null text is empty; a null lang is ``und`` and one group with that word; repeated rows count each time; an
empty table gives no rows. Arithmetic is in decimals of 38 places. Only text and lang are read. A piece is the
unit of memory: a text of any length is cut into blocks between its pieces.
"""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actimetry.llm.common import materialise
from actimetry.llm.token_blocks import hashes, mixed, numbering, slices, squeeze, unsqueeze

LEAST = 30
LONGEST = 4
KEEP = 2000
FACTOR = 2000000
BLOCK = 1 << 19             # tokens of a block here: a scan holds several arrays of that length
BITS = 27                   # of a bitmap at most: 16 MB
NO_LANG = "und"
BREAK = b"."                # stands for every separator; never part of a word
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b",;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 9 + b" ")
_ROWS = 100_000
SALTS = 32


# ---- blocks --------------------------------------------------------------------------------

def pack(docs: DataFrame) -> DataFrame:
    """Blocks (block, lang, n, words, tokens): word 0 is the break between pieces, n the number of other tokens."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        open_: dict[str, tuple] = {}
        size = 0

        def closed(lang):
            ids, tokens = open_.pop(lang)
            tokens = np.frombuffer(tokens, dtype=np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([next(number)], pa.int64()), pa.array([lang]), pa.array([int(np.count_nonzero(tokens))], pa.int64()),
                 pa.array([squeeze(b" ".join(ids))]), pa.array([squeeze(tokens.tobytes())])],
                names=["block", "lang", "n", "words", "tokens"])

        for batch in batches:
            for lang, text in zip(*((v.as_py() for v in batch.column(i)) for i in range(2))):
                for part in slices(text.translate(_FOLD).replace(BREAK, b" . "), b" . "):
                    if lang not in open_:
                        open_[lang] = numbering(BREAK), array("i")
                    ids, tokens = open_[lang]
                    before = len(tokens)
                    tokens.append(0)
                    tokens.extend(map(ids.__getitem__, part.split()))
                    size += len(tokens) - before
                    if len(tokens) >= BLOCK:
                        size -= len(tokens)
                        yield closed(lang)
                if size >= BLOCK:
                    for x in list(open_):
                        yield closed(x)
                    size = 0
        for x in list(open_):
            yield closed(x)

    return docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text")) \
        .mapInArrow(run, "block long, lang string, n long, words binary, tokens binary")


# ---- nodes as bitmaps ----------------------------------------------------------------------

def _start(lang: str) -> np.ndarray:
    return hashes([lang.encode()])


def _hash_phrases(lang: str, phrases: list[str]) -> np.ndarray:
    """One hash per phrase; the phrases have the same number of words."""
    words = [p.encode().split(b" ") for p in phrases]
    h = np.repeat(_start(lang), len(words))
    for column in zip(*words):
        h = mixed(h, hashes(list(column)))
    return h


class Nodes:
    """A set of phrases of one length as a bitmap; ``has`` is never wrong about a phrase that is in the set."""

    def __init__(self, phrases: DataFrame, length: int):
        self.length = length
        held = phrases.count()
        bits = self.bits = min(BITS, max(16, (32 * held).bit_length()))

        def places(batches):
            for batch in batches:
                langs = np.array(batch.column(0).to_pylist(), dtype=object)
                names = batch.column(1).to_pylist()
                at = np.zeros(len(names), dtype=np.int64)
                for lang in set(langs):
                    own = np.flatnonzero(langs == lang)
                    at[own] = _hash_phrases(lang, [names[i] for i in own]) >> np.uint64(64 - bits)
                yield pa.RecordBatch.from_arrays([pa.array(at + 1)], names=["at"])

        rows = (phrases.select("lang", "phrase").mapInArrow(places, "at long")
                .groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
                .collect()) if held else []                    # 2^BITS bits at most
        size = max(1, (1 << bits) // 8 // 4096) * 4096
        whole = np.zeros(size, dtype=np.uint8)
        for r in rows:
            whole[(r["k"] - 1) * 4096:r["k"] * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
        self.sent = phrases.sparkSession.sparkContext.broadcast(whole)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - self.bits)
        return ((self.sent.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)


# ---- counting ------------------------------------------------------------------------------

def _grams(tokens: np.ndarray, at: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first place and the count of each distinct phrase of ``length`` tokens that starts ``at``."""
    code = tokens[at]
    for j in range(1, length):
        if j > 1:
            code = np.unique(code, return_inverse=True)[1]
        code = code * size + tokens[at + j]
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return at[first], counts


def counted(blocks: DataFrame, length: int, inner: list[Nodes], heads: list[Nodes], tails: list[Nodes]) -> DataFrame:
    """(lang, phrase, a): the phrases of ``length`` words that occur ``LEAST`` times, all of whose parts of its length are in each of ``inner``
    and, if there are any, whose head is in one of ``heads`` or whose tail is in one of ``tails``."""
    def places(lang: str, words: list[bytes], tokens: np.ndarray) -> np.ndarray:
        m = len(tokens) - length + 1
        if m <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(m, dtype=bool)
        for j in range(length):
            ok &= tokens[j:j + m] != 0
        if not (inner or heads or tails):
            return np.flatnonzero(ok)
        value, known = hashes(words)[tokens], {}

        def of(n):
            if n not in known:
                k = len(tokens) - n + 1
                h = np.repeat(_start(lang), k)
                for j in range(n):
                    h = mixed(h, value[j:j + k])
                known[n] = h
            return known[n]

        for nodes in inner:
            good = nodes.has(of(nodes.length))
            for j in range(length - nodes.length + 1):
                ok &= good[j:j + m]
        at = np.flatnonzero(ok)
        if heads or tails:
            hit = np.zeros(len(at), dtype=bool)
            for nodes in heads:
                hit |= nodes.has(of(nodes.length)[at])
            for nodes in tails:
                hit |= nodes.has(of(nodes.length)[at + length - nodes.length])
            at = at[hit]
        return at

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, words, tokens = (batch.column(c)[i].as_py() for c in range(3))
                words = unsqueeze(words).split(b" ")
                tokens = np.frombuffer(unsqueeze(tokens), dtype=np.int32).astype(np.int64)
                at = places(lang, words, tokens)
                if not len(at):
                    continue
                first, counts = _grams(tokens, at, length, len(words))
                names = pa.array(words, pa.binary()).cast(pa.string())
                for s in range(0, len(first), _ROWS):
                    own = first[s:s + _ROWS]
                    parts = [names.take(pa.array(tokens[own + j])) for j in range(length)]
                    phrase = pc.binary_join_element_wise(*parts, " ") if length > 1 else parts[0]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own)), phrase, pa.array(counts[s:s + _ROWS])],
                                                     names=["lang", "phrase", "a"])

    return (blocks.select("lang", "words", "tokens").mapInArrow(run, "lang string, phrase string, a long")
            .groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= LEAST))


# ---- scores --------------------------------------------------------------------------------

def exact_score(a: str, l: str, r: str) -> Column:
    """floor(FACTOR a / (l + r)): whole decimals divided without a fraction, so nothing is rounded."""
    return F.expr(f"(cast({FACTOR} as decimal(7,0)) * cast({a} as decimal(19,0))) div (cast({l} as decimal(19,0)) + cast({r} as decimal(19,0)))")


def _bound(m: str, first: str) -> Column:
    """No phrase that grows to at most ``m`` occurrences and starts with a word of ``first`` scores more."""
    return F.when(F.expr(f"{m} >= {LEAST}"), exact_score(m, first, m)).otherwise(-1)


def _cut(df: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """``df`` with score, l and r of the lowest cut, the first of those that tie."""
    options = F.array(*[F.struct(exact_score("a", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
                        for k, (l, r) in enumerate(cuts)])
    return df.withColumn("cut__", F.array_min(options)).withColumns(
        {"score": F.col("cut__.score"), "l": F.col("cut__.l"), "r": F.col("cut__.r")}).drop("cut__")


def _pairs(counts: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs with the counts of both words, their score, ``grow`` (the largest pair that the second word starts) and bound."""
    pairs = counts.withColumns({"w1": F.substring_index("phrase", " ", 1), "w2": F.substring_index("phrase", " ", -1)})
    first = words.select("lang", F.col("phrase").alias("w1"), F.col("a").alias("f1"))
    second = words.select("lang", F.col("phrase").alias("w2"), F.col("a").alias("f2"))
    largest = pairs.groupBy("lang", F.col("w1").alias("w2")).agg(F.max("a").alias("grow"))
    done = (pairs.join(first, ["lang", "w1"]).join(second, ["lang", "w2"]).join(largest, ["lang", "w2"], "left")
            .withColumn("grow", F.coalesce("grow", F.lit(0).cast("long"))))
    return (_cut(done, [("f1", "f2")]).withColumn("bound", _bound("least(a, grow)", "f1"))
            .select("lang", "phrase", "a", "f1", "f2", "grow", "l", "r", "score", "bound"))


def _triples(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    both = counts.withColumns({"head": F.substring_index("phrase", " ", 2), "tail": F.substring_index("phrase", " ", -2)})
    head = pairs.select("lang", F.col("phrase").alias("head"), F.col("a").alias("a12"), "f1")
    tail = pairs.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("a23"), F.col("f2").alias("f3"), "grow")
    return (_cut(both.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]), [("f1", "a23"), ("a12", "f3")])
            .withColumn("bound", _bound("least(a, grow)", "f1"))
            .select("lang", "phrase", "head", "tail", "a", "a12", "f1", "l", "r", "score", "bound"))


def _quads(counts: DataFrame, triples: DataFrame, pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Phrases of four words whose head was counted, with ``a234`` from ``known`` where that was counted. The others are under the threshold."""
    both = counts.withColumns({"head": F.substring_index("phrase", " ", 3), "tail": F.substring_index("phrase", " ", -3),
                               "end": F.substring_index("phrase", " ", -2)})
    head = triples.select("lang", F.col("phrase").alias("head"), F.col("a").alias("a123"), "a12", "f1")
    end = pairs.select("lang", F.col("phrase").alias("end"), F.col("a").alias("a34"), F.col("f2").alias("f4"))
    tail = known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("a234"))
    return both.join(head, ["lang", "head"]).join(end, ["lang", "end"]).join(tail, ["lang", "tail"], "left")


def _undropped(phrases: DataFrame, longer: DataFrame) -> DataFrame:
    """``phrases`` but those that a longer one by a word (``longer``: lang, head, tail, a) holds at 80 % of their count or more."""
    most = (longer.select("lang", F.col("head").alias("phrase"), "a").union(longer.select("lang", F.col("tail").alias("phrase"), "a"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("most__")))
    over = F.expr("cast(100 as decimal(3,0)) * cast(most__ as decimal(19,0)) >= cast(80 as decimal(3,0)) * cast(a as decimal(19,0))")
    return phrases.join(most, ["lang", "phrase"], "left").where(~F.coalesce(over, F.lit(False)))


def _thresholds(pairs: DataFrame, langs: DataFrame, rank: int) -> DataFrame:
    """(lang, tau): the score of the ``rank``-th best pair, 0 where there are fewer."""
    per = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))          # at most FACTOR / 2 + 1 scores per lang
    upto = per.withColumn("upto", F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score"))))
    tau = upto.where(F.col("upto") >= rank).groupBy("lang").agg(F.max("score").alias("tau"))
    return langs.join(tau, "lang", "left").select("lang", F.coalesce("tau", F.lit(0).cast("long")).alias("tau"))


def _best(rows: DataFrame, keep: int) -> DataFrame:
    """Each language's first ``keep`` rows by score, count and phrase, with their rank; ranked in shares first, so that no
    task sorts all of a language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = rows.withColumn("share__", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share__").orderBy(*order))).where(F.col("rank") <= keep)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= keep).drop("share__"))


# ---- growth --------------------------------------------------------------------------------

def mine(docs: DataFrame, keep: int = KEEP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``keep`` best phrases."""
    blocks = materialise(pack(docs), "phrase-blocks")
    total = materialise(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    words = materialise(counted(blocks, 1, [], [], []), "phrase-words")
    frequent = Nodes(words, 1)
    pairs = materialise(_pairs(materialise(counted(blocks, 2, [frequent], [], []), "phrase-pair-counts"), words), "phrase-pairs")
    likely = Nodes(pairs, 2)
    found, left, rank = [], total.select("lang"), 2 * keep
    while True:
        tau = materialise(_thresholds(pairs, left, rank), "phrase-thresholds")
        done = materialise(_settle(blocks.join(tau.select("lang"), "lang", "left_semi"), pairs.join(tau, "lang"), pairs, likely, tau), "phrase-settled")
        enough = done.groupBy("lang").agg(F.count("*").alias("held")).where(F.col("held") >= keep).select("lang")
        settled = tau.join(enough, "lang", "left_semi").union(tau.where("tau = 0")).select("lang").distinct()
        found.append(done.join(settled, "lang", "left_semi"))
        left = materialise(left.join(settled, "lang", "left_anti"), "phrase-langs")
        if left.isEmpty():
            break
        rank *= 8
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return _best(rows, keep).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _settle(blocks: DataFrame, pairs: DataFrame, every: DataFrame, likely: Nodes, tau: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all candidates at or over the threshold that are not dropped."""
    def expanded(phrases: DataFrame, length: int) -> tuple[list[Nodes], list[Nodes]]:
        grow, good = F.col("bound") >= F.col("tau"), F.col("score") >= F.col("tau")
        asked = Nodes(phrases.where(good), length)
        return [Nodes(phrases.where(grow & ~good), length), asked], [asked]

    heads, tails = expanded(pairs, 2)
    triples = materialise(_triples(counted(blocks, 3, [likely], heads, tails), every), "phrase-triples").join(tau, "lang")
    heads, tails = expanded(triples, 3)
    counts = materialise(counted(blocks, 4, [likely], heads, tails), "phrase-quad-counts")
    # a tail that no node asked for is counted now, if the phrase can still reach the threshold without it
    part = _quads(counts, triples, every, triples).join(tau, "lang")
    open_ = part.where(F.col("a234").isNull() & (exact_score("a", "f1", "a") >= F.col("tau")) & (exact_score("a", "a12", "a34") >= F.col("tau"))
                       & (exact_score("a", "a123", "f4") >= F.col("tau"))).select("lang", F.col("tail").alias("phrase")).distinct()
    open_ = materialise(open_, "phrase-open")
    known = triples.select("lang", "phrase", "a")
    if not open_.isEmpty():
        more = counted(blocks, 3, [likely], [Nodes(open_, 3)], []).join(known, ["lang", "phrase"], "left_anti")
        known = known.unionByName(materialise(more, "phrase-tails"))
    quads = _quads(counts, triples, every, known).where(F.col("a234").isNotNull())
    quads = _cut(quads, [("f1", "a234"), ("a12", "a34"), ("a123", "f4")]).join(tau, "lang")
    longer = counts.select("lang", F.substring_index("phrase", " ", 3).alias("head"), F.substring_index("phrase", " ", -3).alias("tail"), "a")
    good = F.col("score") >= F.col("tau")
    kept = [_undropped(pairs.where(good), triples), _undropped(triples.where(good), longer), quads.where(good)]
    return kept[0].select("lang", "phrase", "a", "l", "r", "score").union(kept[1].select("lang", "phrase", "a", "l", "r", "score")) \
        .union(kept[2].select("lang", "phrase", "a", "l", "r", "score"))


def report(docs: DataFrame) -> DataFrame:
    return mine(docs, KEEP)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
REPORT_SQL = f"""
WITH pieces AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, row_number() OVER () AS p, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
tokens AS (SELECT lang, p, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM words),
runs AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4 FROM tokens WINDOW o AS (PARTITION BY p ORDER BY i)),
grams AS (SELECT lang, 1 AS size, w1 AS phrase FROM runs UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3) FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4) FROM runs WHERE w4 IS NOT NULL),
counts AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL),
candidates AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND a >= {LEAST}),
parts AS MATERIALIZED (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) t),
cuts AS MATERIALIZED (SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, CAST(CAST({FACTOR} AS HUGEINT) * c.a // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
  FROM parts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.head JOIN counts r ON r.lang = c.lang AND r.phrase = c.tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT DISTINCT b.lang, array_to_string(b.w[b.i:b.i + s.size - 1], ' ') AS phrase, b.a
  FROM (SELECT *, unnest(range(1, size)) AS i FROM candidates) b, range(2, {LONGEST}) s(size) WHERE s.size < b.size AND b.i + s.size - 1 <= b.size),
kept AS (SELECT * FROM lowest c WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = c.lang AND i.phrase = c.phrase
  AND CAST(100 AS HUGEINT) * i.a >= CAST(80 AS HUGEINT) * c.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {KEEP}
"""
