"""LM scoring: a Katz backoff model of word pairs with Good-Turing discounts.

A text's tokens are its words, A-Z lower-cased and split at ASCII white space, and one end; the first has the start as its history.
With c the counts of the training texts, C(h) the tokens after history h and d_r the discount of a count r,

* P(w) = d_c(w) c(w) / N for a word of the training texts; what the discounts leave is the one unknown word's;
* P(w | h) = d_c(hw) c(hw) / C(h) where the pair was seen, else alpha(h) P(w), and P(w) after a history that was not;
* alpha(h) = (1 - sum over seen w of P(w | h)) / (1 - sum over seen w of P(w)), so every distribution sums to one.

d_r is Katz's d_r = (r* / r - x) / (1 - x) with r* = (r+1) n_(r+1) / n_r and x = (k+1) n_(k+1) / n_1 for r <= k, and 1 above; k is the largest
up to ``K`` for which all are between 0 and 1. A distribution in which nothing is discounted counts one
more token, which goes to what was not seen.

In Spark: texts become blocks of word numbers (``token_blocks``). Each block sends its distinct words, once, to their buckets,
which add up c and answer with counts and a number for each word; then its distinct pairs, dealt by history, whose buckets add up
c(hw), write the model's tables and answer with counts and what alpha needs. So a token is looked up where its block is, and what
crosses the network grows with the distinct words and pairs of the blocks. A history with many tokens is dealt by its
words too, over as many buckets as its count asks for; the sums of these (at most 2^``HOT`` histories) are put together on the driver.

``model`` holds the tables by kind: words (word, id, a), pairs (h, w, a) and histories (h, m1 to mK, rest, lower): how many
words follow h once, twice, ..., the tokens of the others and the P(w) of all. ``backoff`` gives alpha from them.

Defined results: a null text is empty and has one token, the end; a null doc_id is not held out; rows with the same doc_id are scored one
by one; an empty table gives no rows; without training texts every token is unknown and has probability 1. The
log10 of a token is rounded to ``PLACES`` decimals before it is added up, so sums don't depend on the order. Only doc_id and text are
read. A text of any length is cut into blocks; a block is the unit of memory.
"""

from __future__ import annotations

import itertools
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from actimetry.config import scratch_dir
from actimetry.llm.manifest import CRC_SQL
from actimetry.llm.token_blocks import BLOCK, hashes, mixed, numbering, slices, squeeze, unsqueeze

K = 5                       # counts up to this are discounted
HOT = 17                    # no more than 2^HOT histories are dealt over several buckets
BUCKET = 1 << 21            # tokens of a bucket, about
LEAST_BUCKETS = 256
PLACES = 8
HELD_OUT = 2                # the remainder of the CRC-32 by 7 whose texts are not trained on
END = b""                   # the end of a text, and as a history its start
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
_STATS = [f"m{r}" for r in range(1, K + 1)] + ["rest", "lower"]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == HELD_OUT, F.lit(False))


# ---- the model's arithmetic ----------------------------------------------------------------

def discounts(counts: dict[int, int]) -> np.ndarray:
    """d_1, d_2, ... d_k from the numbers of words or pairs that occur once, twice, ...; empty if there are none between 0 and 1."""
    for k in range(K, 0, -1):
        n = [counts.get(r, 0) for r in range(1, k + 2)]
        if min(n) > 0 and (k + 1) * n[k] < n[0]:
            x = (k + 1) * n[k] / n[0]
            d = np.array([((r + 1) * n[r] / (r * n[r - 1]) - x) / (1 - x) for r in range(1, k + 1)])
            if (d > 0).all() and (d < 1).all():
                return d
    return np.zeros(0)


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d_c c."""
    return np.where((c >= 1) & (c <= len(d)), np.concatenate(([1.0], d, [1.0]))[np.minimum(c, len(d) + 1)], 1.0) * c


class Words:
    """P(w) of a word by its count."""

    def __init__(self, tokens: int, counts: dict[int, int]):
        self.d = discounts(counts)
        taken = sum((1 - d) * r * counts[r] for r, d in enumerate(self.d, 1))
        self.total = tokens if taken else tokens + 1
        self.unknown = taken / tokens if taken else 1 / (tokens + 1)

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.d) / self.total, self.unknown)


def totals(c: np.ndarray, stats: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that the pairs of each history are divided by, and its alpha."""
    small = stats[:, :len(d)]
    taken = small @ ((1 - d) * np.arange(1, len(d) + 1))
    free = small.sum(axis=1) == 0
    return c + free, np.where(free, 1.0, taken) / (c + free) / (1 - stats[:, K + 1])


def _rounded(p: np.ndarray) -> np.ndarray:
    """log10 as a whole number of units of the last place."""
    return np.rint(np.log10(p) * 10 ** PLACES).astype(np.int64)


# ---- blocks --------------------------------------------------------------------------------

def pack(docs: DataFrame) -> DataFrame:
    """Blocks (block, uid, doc, held, n, words, tokens). Word 0 is the end; token 0 is the history of token 1; n is the
    number of tokens of each text in the block, which may hold parts of its first and last; uid tells rows apart."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number, uid = itertools.count(first), itertools.count(first)
        ids = numbering(END)
        tokens, texts = array("i", [0]), []

        def closed():
            return pa.RecordBatch.from_arrays(
                [pa.array([next(number)], pa.int64()), *(pa.array([[t[i] for t in texts]], pa.list_(kind)) for i, kind in
                 enumerate((pa.int64(), pa.int64(), pa.bool_(), pa.int64()))),
                 pa.array([squeeze(b" ".join(ids))]), pa.array([squeeze(np.frombuffer(tokens, dtype=np.int32).tobytes())])],
                names=["block", "uid", "doc", "held", "n", "words", "tokens"])

        for batch in batches:
            for doc, held, text in zip(*((v.as_py() for v in batch.column(i)) for i in range(3))):
                row, n = next(uid), 0
                for part in slices(text.translate(_FOLD), b" "):
                    got = part.split()
                    tokens.extend(map(ids.__getitem__, got))
                    n += len(got)
                    if len(tokens) > BLOCK:
                        texts.append((row, doc, held, n))
                        yield closed()
                        ids = numbering(END)
                        tokens, texts, n = array("i", [ids[got[-1]] if got else 0]), [], 0
                tokens.append(0)
                texts.append((row, doc, held, n + 1))
                if len(tokens) > BLOCK:
                    yield closed()
                    ids = numbering(END)
                    tokens, texts = array("i", [0]), []
        if texts:
            yield closed()

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")), F.coalesce("text", F.lit("")).cast("binary")) \
        .mapInArrow(run, "block long, uid array<long>, doc array<long>, held array<boolean>, n array<long>, words binary, tokens binary")


class Block:
    def __init__(self, row: dict):
        self.block, self.uid, self.doc = row["block"], row["uid"], row["doc"]
        self.held, self.n = np.array(row["held"], dtype=bool), np.array(row["n"], dtype=np.int64)
        self.words = unsqueeze(row["words"]).split(b" ")
        tokens = np.frombuffer(unsqueeze(row["tokens"]), dtype=np.int32).astype(np.int64)
        self.before, self.tokens = tokens[:-1], tokens[1:]
        self.train = np.repeat(~self.held, self.n)


# ---- words ---------------------------------------------------------------------------------

def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its values in order) for every bucket that has some."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0))) if len(order) else []
    return zip(bucket[order][cut].tolist(), np.split(order, cut[1:]) if len(order) else [])


def _word_buckets(words: list[bytes], buckets: int) -> np.ndarray:
    return (hashes(words) % np.uint64(buckets)).astype(np.int64)


def word_requests(b: Block, buckets: int):
    c = np.bincount(b.tokens[b.train], minlength=len(b.words))
    for bucket, at in _dealt(_word_buckets(b.words, buckets)):
        yield bucket, b.block, squeeze(c[at].tobytes() + b" ".join([b.words[i] for i in at.tolist()]) + b" %d" % len(at))


def word_answers(bucket: int, parts: list[tuple[int, bytes]], buckets: int):
    """The words of one bucket: (a) to every block its counts and numbers, (b) the table's rows."""
    asked, count = [], {}
    for block, part in parts:
        data = unsqueeze(part)
        data, _, n = data.rpartition(b" ")
        c, words = np.frombuffer(data[:8 * int(n)], dtype=np.int64), data[8 * int(n):].split(b" ")
        asked.append((block, words))
        for w, k in zip(words, c.tolist()):
            count[w] = count.get(w, 0) + k
    # frequent words have small numbers; no two words share one
    ids = {w: i * buckets + bucket for i, w in enumerate(sorted(count, key=lambda w: (-count[w], w)))}
    for block, words in asked:
        both = np.array([[count[w] for w in words], [ids[w] for w in words]], dtype=np.int64)
        yield {"kind": "answer", "block": block, "part": squeeze(np.int64(bucket).tobytes() + _planes(both.ravel()))}
    for w, c in count.items():
        if c:
            yield {"kind": "words", "word": w, "h": ids[w], "a": c}


def known_words(b: Block, answers: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and number of each word of a block."""
    places = dict(_dealt(_word_buckets(b.words, buckets)))
    both = np.zeros((2, len(b.words)), dtype=np.int64)
    for part in answers:
        data = unsqueeze(part)
        both[:, places[int(np.frombuffer(data[:8], dtype=np.int64)[0])]] = _unplanes(data[8:]).reshape(2, -1)
    return both[0], both[1]


# ---- pairs ---------------------------------------------------------------------------------

def _planes(a: np.ndarray) -> bytes:
    """Whole numbers with all lowest bytes first, then all second ones, ...: what is alike stands together."""
    return np.ascontiguousarray(a.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view(np.int64).ravel()


class Pairs:
    """The distinct pairs of a block in the order in which they are sent: by bucket, then by the numbers of history and word.
    ``at``: the pair of each token."""

    def __init__(self, b: Block, count: np.ndarray, ids: np.ndarray, buckets: int, hot: int):
        size = len(b.words)
        pair, at = np.unique(b.before * size + b.tokens, return_inverse=True)
        h, w = pair // size, pair % size
        shares = count // hot + 1                               # buckets that a history is dealt over
        spread = hashes_of(ids)
        share = (mixed(spread[h], spread[w]) % shares[h].astype(np.uint64)).astype(np.int64)
        bucket = ((spread % np.uint64(buckets)).astype(np.int64)[h] + share) % buckets
        order = np.lexsort((ids[w], ids[h], bucket))
        self.h, self.w, self.shared = h[order], w[order], shares > 1
        self.trained = np.bincount(at[b.train], minlength=len(pair))[order]
        place = np.empty(len(pair), dtype=np.int64)
        place[order] = np.arange(len(pair))
        self.at = place[at]
        bucket = bucket[order]
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(pair) else np.zeros(1, int)
        self.parts = [(int(bucket[i]), slice(int(i), int(j))) for i, j in zip(cut[:-1], cut[1:])]


def hashes_of(ids: np.ndarray) -> np.ndarray:
    zero = np.zeros(len(ids), dtype=np.uint64)
    return mixed(mixed(zero, ids.astype(np.uint64) + np.uint64(1)), zero + np.uint64(7))


def _runs(h: np.ndarray) -> np.ndarray:
    """Where the next history begins."""
    return np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))


def pair_requests(b: Block, count: np.ndarray, ids: np.ndarray, buckets: int, hot: int):
    pairs = Pairs(b, count, ids, buckets, hot)
    for bucket, own in pairs.parts:
        h, w = pairs.h[own], pairs.w[own]
        lead = _runs(h)
        yield bucket, b.block, squeeze(np.array([len(lead), len(h)]).tobytes() + _planes(np.concatenate((
            np.diff(ids[h[lead]], prepend=0), np.diff(lead, append=len(h)), pairs.shared[h[lead]], ids[w], count[w], pairs.trained[own]))))


def pair_answers(bucket: int, parts: list[tuple[int, bytes]], words: Words):
    """The pairs of one bucket: (a) to every block its counts and the sums of the histories it may back off from, (b) the tables' rows."""
    blocks, got = [], []
    for block, part in parts:
        data = unsqueeze(part)
        n, m = np.frombuffer(data[:16], dtype=np.int64).tolist()
        h, runs, shared, w, c, a = np.split(_unplanes(data[16:]), np.cumsum([n, n, n, m, m]))
        h = np.cumsum(h)
        blocks.append((block, n, m))
        got.append((h, shared, np.repeat(h, runs), w, c, a, np.repeat(np.arange(n), runs)))
    every = [np.concatenate(x) for x in zip(*got)]
    names, at = np.unique(every[2], return_inverse=True)
    follow, first, place = np.unique(every[3], return_index=True, return_inverse=True)
    pair, of = np.unique(at * len(follow) + place, return_inverse=True)
    a = np.bincount(of, weights=every[5]).astype(np.int64)
    h, w = pair // len(follow), pair % len(follow)
    stats = np.zeros((len(names), K + 2))
    for r in range(1, K + 1):
        stats[:, r - 1] = np.bincount(h[a == r], minlength=len(names))
    stats[:, K] = np.bincount(h[a > K], weights=a[a > K], minlength=len(names))
    stats[:, K + 1] = np.bincount(h[a > 0], weights=words.p(every[4][first])[w[a > 0]], minlength=len(names))
    start = 0
    for (block, n, m), (own, shared, _, _, _, _, run) in zip(blocks, got):
        c = a[of[start:start + m]]
        start += m
        asks = np.zeros(n, dtype=bool)
        asks[run[(c == 0) | (c > 1)]] = True                    # may back off, or may have nothing that is discounted
        asks &= shared == 0
        at_ = np.flatnonzero(asks)
        yield {"kind": "answer", "block": block, "part": squeeze(
            np.array([bucket, m, len(at_)]).tobytes() + _planes(np.concatenate((c, at_))) + np.ascontiguousarray(
                stats[np.searchsorted(names, own[at_])].T).tobytes())}
    seen = a > 0
    yield {"kind": "pairs", "h": names[h[seen]], "w": follow[w[seen]], "a": a[seen]}
    some = np.zeros(len(names), dtype=bool)
    some[h[seen]] = True
    hot = np.zeros(len(names), dtype=bool)
    hot[np.searchsorted(names, np.concatenate([g[0][g[1] == 1] for g in got]))] = True
    yield {"kind": "histories", "h": names[some], "hot": hot[some], **{s: stats[some, i] for i, s in enumerate(_STATS)}}


def scored(b: Block, count: np.ndarray, ids: np.ndarray, buckets: int, hot: int, answers: list[bytes], shared: dict, words: Words,
           d: np.ndarray, tokens: int, distinct: int):
    """Rows (uid, doc, held, n, known, base, score) of a block, the last two in units of the last place."""
    pairs = Pairs(b, count, ids, buckets, hot)
    places = dict(pairs.parts)
    c, stats = np.zeros(len(pairs.h), dtype=np.int64), np.zeros((len(b.words), K + 2))
    stats[:, 0] = 1                                             # what no bucket tells has pairs of count 1 only
    for part in answers:
        data = unsqueeze(part)
        bucket, m, n = np.frombuffer(data[:24], dtype=np.int64).tolist()
        own = places[bucket]
        got, at = np.split(_unplanes(data[24:24 + 8 * (m + n)]), [m])
        c[own] = got
        h = pairs.h[own]
        stats[h[_runs(h)][at]] = np.frombuffer(data[24 + 8 * (m + n):]).reshape(K + 2, n).T
    for i in np.flatnonzero(pairs.shared).tolist():
        stats[i] = shared.get(int(ids[i]), 0)
    p, total, alpha = words.p(count), np.ones(len(b.words)), np.ones(len(b.words))
    seen = count > 0
    total[seen], alpha[seen] = totals(count[seen], stats[seen], d)
    h, w = pairs.h, pairs.w
    each = _rounded(np.where(c > 0, discounted(c, d) / total[h], alpha[h] * p[w]))[pairs.at]
    base = _rounded((count + 1) / (tokens + distinct + 1))[b.tokens]
    ends = np.cumsum(b.n)
    sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[ends], prepend=0) for x in (seen[b.tokens], base, each)]
    return {"uid": b.uid, "doc": b.doc, "held": b.held, "n": b.n, "known": sums[0], "base": sums[1], "score": sums[2]}


# ---- Spark ---------------------------------------------------------------------------------

def _arrow(df: DataFrame, schema: str) -> pa.Schema:
    return to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)


def _batch(rows: dict, target: pa.Schema, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) if f.name in rows else pa.nulls(size, f.type) for f in target], schema=target)


def _by_block(blocks: DataFrame) -> DataFrame:
    """The blocks in buckets in the shared folder, so that joins by block deal only their other side. The catalog
    forgets the table at once; its files stay where they are."""
    spark = blocks.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"katz_blocks_{uuid.uuid4().hex}"
    (blocks.repartition(n, "block").write.bucketBy(n, "block").option("path", scratch_dir(spark, "katz-blocks") + "/t")
     .format("parquet").saveAsTable(name))
    stored = spark.table(name)
    stored.schema
    spark.sql(f"DROP TABLE {name}")
    return stored


def _per_block(blocks: DataFrame, sides: list[DataFrame], fn: Callable, schema: str) -> DataFrame:
    """``fn(Block, parts of each side)`` yields batches of rows as columns."""
    df, columns = blocks, blocks.columns
    for i, side in enumerate(sides):
        df = df.join(side.groupBy("block").agg(F.collect_list("part").alias(f"side{i}")), "block", "left")
    target, names = _arrow(blocks, schema), [f"side{i}" for i in range(len(sides))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in columns + names}
                for rows in fn(Block(row), *(row[n] or [] for n in names)):
                    yield _batch(rows, target, 0)

    return df.select(*columns, *names).mapInArrow(run, schema)


def _requests(rows) -> Iterator[dict]:
    for several in iter(lambda: list(itertools.islice(rows, 64)), []):
        yield dict(zip(("bucket", "block", "part"), zip(*several)))


def _exchange(requests: DataFrame, fn: Callable, buckets: int, schema: str, name: str) -> str:
    """``fn(bucket, [(block, part), ...])`` for every bucket, its rows written by kind; the path."""
    spark, target = requests.sparkSession, _arrow(requests, schema)

    def rows(bucket, held):
        single: dict[str, list] = {}
        for row in fn(bucket, held):
            if row["kind"] == "answer" or row["kind"] == "words":
                single.setdefault(row["kind"], []).append(row)
            elif len(row["h"]):
                n = len(row["h"])
                yield _batch(row | {"kind": [row["kind"]] * n}, target, n)
        for some in single.values():
            for i in range(0, len(some), 10_000):
                part = some[i:i + 10_000]
                yield _batch({k: [r[k] for r in part] for k in part[0]}, target, len(part))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None                                     # sorted by bucket: one is held at a time
        for batch in batches:
            for bucket, block, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and bucket != at:
                    yield from rows(at, held)
                    held = []
                at = bucket
                held.append((block, part))
        if held:
            yield from rows(at, held)

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets // 8)
    path = scratch_dir(spark, name)
    (requests.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)
     .write.mode("overwrite").option("compression", "zstd").partitionBy("kind").parquet(path))
    return path


_WORDS = "kind string, block long, part binary, word binary, h long, a long"
_PAIRS = "kind string, block long, part binary, h long, w long, a long, hot boolean, " + ", ".join(f"{s} double" for s in _STATS)


def _kind(spark, path: str, schema: str, kind: str, *columns: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path).where(F.col("kind") == kind).select(*columns)


def _numbers(rows: DataFrame) -> dict[int, int]:
    """How many rows have a count of 1, 2, ..., K + 1."""
    return {r["a"]: r["n"] for r in rows.where(F.col("a") <= K + 1).groupBy("a").agg(F.count("*").alias("n")).collect()}


class Model:
    """The tables of a model: ``words`` (word, id, a), ``pairs`` (h, w, a), ``histories`` (h, m1, ..., rest, lower), and its few numbers."""

    def __init__(self, words: DataFrame, pairs: DataFrame, histories: DataFrame, tokens: int, distinct: int, word: Words, d: np.ndarray):
        self.words, self.pairs, self.histories = words, pairs, histories
        self.tokens, self.distinct, self.word, self.d = tokens, distinct, word, d

    def backoff(self) -> DataFrame:
        """(h, c, total, alpha): the tokens of each history, what its pairs are divided by, and its backoff weight."""
        c = self.words.select(F.col("id").alias("h"), F.col("a").alias("c"))
        d = self.d.tolist()
        taken = sum((F.col(f"m{r}") * F.lit((1 - x) * r) for r, x in enumerate(d, 1)), F.lit(0.0))
        free = sum((F.col(f"m{r}") for r in range(1, len(d) + 1)), F.lit(0.0)) == 0
        total = F.col("c") + free.cast("long")
        return self.histories.join(c, "h").select(
            "h", "c", total.alias("total"), (F.when(free, 1.0).otherwise(taken) / total / (1 - F.col("lower"))).alias("alpha"))


def fit_and_score(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the texts that are not held out, and (doc_id, held_out, n_tokens, n_known, base, score) of all texts, the last two in units
    of the last place."""
    spark = docs.sparkSession
    blocks = _by_block(pack(docs))
    size = blocks.select(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, 1 << max(0, (size // BUCKET)).bit_length())
    rows = _per_block(blocks, [], lambda b: _requests(word_requests(b, buckets)), "bucket long, block long, part binary")
    path = _exchange(rows, lambda bucket, parts: word_answers(bucket, parts, buckets), buckets, _WORDS, "katz-words")
    words = _kind(spark, path, _WORDS, "words", "word", F.col("h").alias("id"), "a")
    counts = _kind(spark, path, _WORDS, "answer", "block", "part")
    tokens, distinct = words.agg(F.coalesce(F.sum("a"), F.lit(0)), F.count("*")).first()
    word = Words(tokens, _numbers(words))
    hot = max(tokens >> HOT, tokens // (4 * buckets)) + 1

    def ask(b, parts):
        return _requests(pair_requests(b, *known_words(b, parts, buckets), buckets, hot))

    rows = _per_block(blocks, [counts], ask, "bucket long, block long, part binary")
    path = _exchange(rows, lambda bucket, parts: pair_answers(bucket, parts, word), buckets, _PAIRS, "katz-pairs")
    pairs = _kind(spark, path, _PAIRS, "pairs", "h", "w", "a")
    d = discounts(_numbers(pairs))
    sums = _kind(spark, path, _PAIRS, "histories", "h", "hot", *_STATS)
    added = sums.where("hot").groupBy("h").agg(*[F.sum(s).alias(s) for s in _STATS])
    shared = {r["h"]: np.array(r[1:]) for r in added.collect()}                      # 2^HOT rows at most
    sent = spark.sparkContext.broadcast(shared)

    def score(b, parts, answers):
        yield scored(b, *known_words(b, parts, buckets), buckets, hot, answers, sent.value, word, d, tokens, distinct)

    done = _per_block(blocks, [counts, _kind(spark, path, _PAIRS, "answer", "block", "part")], score,
                      "uid long, doc long, held boolean, n long, known long, base long, score long")
    result = done.groupBy("uid", F.col("doc").alias("doc_id"), F.col("held").alias("held_out")).agg(
        *[F.sum(c).alias(a) for c, a in (("n", "n_tokens"), ("known", "n_known"), ("base", "base"), ("score", "score"))]).drop("uid")
    histories = sums.where("not hot").select("h", *_STATS).unionByName(added)
    return Model(words, pairs, histories, tokens, distinct, word, d), result


def report(docs: DataFrame) -> DataFrame:
    model, rows = fit_and_score(docs)
    unit = 10.0 ** PLACES
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                       (F.col("base") / unit).alias("base_score"), (F.col("score") / unit).alias("score"))


def _discounts_sql(name: str, counts: str) -> str:
    """CTEs ``name``_n (how many occur r times) and ``name`` (r, d) of a table with counts ``a``."""
    return f"""{name}_n AS MATERIALIZED (SELECT a AS r, count(*) AS n FROM {counts} WHERE a <= {K + 1} GROUP BY a),
{name}_k AS (SELECT k, list(d ORDER BY r) AS d FROM (
  SELECT k, g.r, ((g.r + 1) * h.n / (g.r * g.n) - (k + 1) * t.n / o.n) / (1 - (k + 1) * t.n / o.n) AS d
  FROM range(1, {K + 1}) s(k) JOIN {name}_n g ON g.r <= k JOIN {name}_n h ON h.r = g.r + 1 JOIN {name}_n o ON o.r = 1 JOIN {name}_n t ON t.r = k + 1
  WHERE (k + 1) * t.n < o.n) x GROUP BY k HAVING count(*) = k AND min(d) > 0 AND max(d) < 1 ORDER BY k DESC LIMIT 1),
{name} AS MATERIALIZED (SELECT unnest(range(1, k + 1)) AS r, unnest(d) AS d FROM {name}_k)"""


REPORT_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(xor({CRC_SQL}, 4294967295) % 7 = {HELD_OUT}, false) AS held_out,
  list_append(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''), '') AS words FROM documents),
seq AS (SELECT row, held_out, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM texts),
tokens AS MATERIALIZED (SELECT row, held_out, w, coalesce(lag(w) OVER (PARTITION BY row ORDER BY i), '') AS h FROM seq),
c1 AS MATERIALIZED (SELECT w, count(*) AS a FROM tokens WHERE NOT held_out GROUP BY w),
c2 AS MATERIALIZED (SELECT h, w, count(*) AS a FROM tokens WHERE NOT held_out GROUP BY h, w),
size AS (SELECT CAST(coalesce(sum(a), 0) AS BIGINT) AS n, count(*) AS v FROM c1),
{_discounts_sql('d1', 'c1')},
{_discounts_sql('d2', 'c2')},
whole AS MATERIALIZED (SELECT n, v, CASE WHEN taken > 0 THEN n ELSE n + 1 END AS total, CASE WHEN taken > 0 THEN taken / n ELSE 1 / (n + 1) END AS unknown
  FROM (SELECT size.n, size.v, (SELECT sum((1 - d) * d1.r * d1_n.n) FROM d1 JOIN d1_n ON d1_n.r = d1.r) AS taken FROM size) t),
word AS MATERIALIZED (SELECT w, a, coalesce(d, 1.0) * a / total AS p FROM c1 LEFT JOIN d1 ON d1.r = a CROSS JOIN whole),
history AS MATERIALIZED (SELECT h, c + CAST(free AS INT) AS total, CASE WHEN free THEN 1.0 ELSE taken END / (c + CAST(free AS INT)) / (1 - lower) AS alpha
  FROM (SELECT h, sum(c2.a) AS c, count(d) = 0 AS free, sum((1 - d) * c2.a) AS taken, sum(p) AS lower
    FROM c2 LEFT JOIN d2 ON d2.r = c2.a JOIN word ON word.w = c2.w GROUP BY h) t),
each AS (SELECT t.row, word.w IS NOT NULL AS known, round(log10((coalesce(word.a, 0) + 1) / (n + v + 1)) * 1e{PLACES}) AS base,
    round(log10(CASE WHEN c2.a IS NOT NULL THEN coalesce(d, 1.0) * c2.a / history.total
      ELSE coalesce(alpha, 1.0) * coalesce(p, unknown) END) * 1e{PLACES}) AS score
  FROM tokens t CROSS JOIN whole LEFT JOIN word ON word.w = t.w LEFT JOIN c2 ON c2.h = t.h AND c2.w = t.w LEFT JOIN d2 ON d2.r = c2.a
  LEFT JOIN history ON history.h = t.h),
sums AS (SELECT row, count(*) AS n_tokens, count(*) FILTER (known) AS n_known, sum(CAST(base AS BIGINT)) AS base, sum(CAST(score AS BIGINT)) AS score
  FROM each GROUP BY row)
SELECT doc_id, held_out, n_tokens, n_known, (SELECT n FROM size) AS train_tokens, CAST(base AS DOUBLE) / 1e{PLACES} AS base_score,
  CAST(score AS DOUBLE) / 1e{PLACES} AS score
FROM texts JOIN sums USING (row)
"""
