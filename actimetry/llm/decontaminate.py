"""Benchmark decontamination with a generalised suffix automaton of the test items.

All items of a block go into one suffix automaton over word ids. A document's words are
streamed through it: the state and the length of the longest match that ends at each word are
tracked, and where that length reaches a window (``n`` consecutive item words, or a whole item
that has fewer) the window's words are hit and its items noted. Words and word pairs that no
item has end every match, so the automaton only walks the stretches between them.

An automaton holds at most ``BLOCK_WORDS`` item words; that bounds what is built in a task and what is broadcast. The
items never pass through the driver: tasks cut the longer ones into pieces that overlap by a window less one word, running sums
number the pieces into blocks, and one task per block builds its automaton and writes it to the shared folder. The
documents are scanned once per block, with the intermediate result written there as well.

Defined results: null texts have no words; a document without words has no hits; items without
words are ignored, an item without an id hits words but is not listed; equal items and equal
windows each count for their own item id; repeated document rows are scanned one by one; an
empty benchmark leaves every document clean; extra columns don't matter to the report and are
kept by ``remove``.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actimetry.llm.common import map_text, materialise, neutral, restored

WINDOW = 10
BLOCK_WORDS = 250_000
BUCKETS = 256               # of pieces, each numbered by itself
# Fixed value: the words of a text after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of UTF-8 ``text``: every byte that no word may hold becomes a space first."""
    return (text or b"").translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of ``items`` (id or None, words)."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], n: int):
        self.n = n
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ids: dict[bytes, int] = {}
        pairs, coded = set(), []
        for name, words in items:
            seq = [self.ids.setdefault(w, len(self.ids)) for w in words]
            coded.append((name, seq))
            pairs.update(zip(seq, seq[1:]))
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.shortest = min([n, *(len(seq) for _, seq in coded if seq)])
        v = max(len(self.ids), 1)
        self.pairs = np.array(sorted(a * v + b for a, b in pairs), dtype=np.int64)
        # the state that stands for the n-gram that ends a match, or -1
        self.gram = [-1] * len(self.next)
        self.short: list[list[tuple[int, set]]] = [[] for _ in self.next]
        self.items: dict[int, set] = {}
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if self.length[self.link[s]] < n <= self.length[s]:
                self.gram[s] = s
            elif n <= self.length[s]:
                self.gram[s] = self.gram[self.link[s]]
        own: dict[int, dict[int, set]] = {}
        for name, seq in coded:
            if not seq:
                continue
            s = 0
            for i, c in enumerate(seq):
                s = self.next[s][c]
                if i >= n - 1:
                    self.items.setdefault(self.gram[s], set()).add(name)
            if len(seq) < n:
                while self.length[self.link[s]] >= len(seq):
                    s = self.link[s]
                own.setdefault(s, {}).setdefault(len(seq), set()).add(name)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[s] = [*own.get(s, {}).items(), *self.short[self.link[s]]]

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._add(self.length[last] + 1, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        else:
            self.link[new] = 0
        return new

    def _add(self, length: int, step: dict[int, int]) -> int:
        self.next.append(step)
        self.link.append(-1)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        copy = self._add(self.length[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of known words and known pairs, at least as long as the shortest window."""
        known = ids >= 0
        if not known.any() or len(ids) < self.shortest:
            return
        joined = known[1:] & known[:-1]
        at = np.flatnonzero(joined)
        if len(at):
            code = ids[at] * len(self.ids) + ids[at + 1]
            spot = np.minimum(np.searchsorted(self.pairs, code), max(len(self.pairs) - 1, 0))
            joined[at] = self.pairs[spot] == code if len(self.pairs) else False
        edge = np.flatnonzero(np.concatenate(([True], ~joined, [True])))
        for s, e in zip(edge[:-1], edge[1:]):
            if e - s >= self.shortest and known[s]:
                yield int(s), int(e)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """(which words are hit, or None; the items whose windows occur)."""
        get = self.ids.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        hit, found = None, set()
        for s, e in self.stretches(ids):
            state, l = 0, 0
            for j in range(s, e):
                c = int(ids[j])
                while state and c not in self.next[state]:
                    state = self.link[state]
                    l = self.length[state]
                if c in self.next[state]:
                    state, l = self.next[state][c], l + 1
                long = self.n if l >= self.n else 0
                if long:
                    found |= self.items[self.gram[state]]
                for m, names in self.short[state]:
                    if l >= m:
                        found |= names
                        long = max(long, m)
                if long:
                    if hit is None:
                        hit = np.zeros(len(words), dtype=bool)
                    hit[j - long + 1:j + 1] = True
        return hit, found


def pieces(benchmark: DataFrame, n: int, most: int) -> DataFrame:
    """(name, words, size): each different item once, those of over ``most`` words as pieces of at most ``most`` words in which
    every window of ``n`` words lies whole. Items without words have none."""
    def cut(c):
        names, words = [], []
        for name, text in zip(c["name"], c["text"]):
            w = words_of(text)
            if len(w) <= most:
                parts = [w] if w else []
            else:
                parts = (w[i:i + most] for i in range(0, len(w) - n + 1, most - n + 1))
            for part in parts:
                names.append(name)
                words.append(part)
        return {"name": names, "words": [b" ".join(w) for w in words], "size": [len(w) for w in words]}

    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("binary").alias("text"))
    return map_text(items, cut, "name string, words binary, size long").distinct()


def numbered(cuts: DataFrame, half: int) -> DataFrame:
    """``cuts`` with ``block``, from 0 without gaps: the pieces lie one after the other, and those that end in the same stretch of
    ``half`` words share a block. As none is longer, a block has fewer than twice as many words."""
    cuts = cuts.withColumn("bucket", F.pmod(F.xxhash64("name", "words"), F.lit(BUCKETS)))
    sums = cuts.groupBy("bucket").agg(F.sum("size").alias("n"))
    # one row per bucket, BUCKETS at most
    first = sums.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("first"))
    upto = F.sum("size").over(Window.partitionBy("bucket").orderBy("name", "words").rowsBetween(Window.unboundedPreceding, 0))
    return (cuts.withColumn("upto", upto).join(F.broadcast(first), "bucket")
            .select("name", "words", F.floor((F.col("first") + F.col("upto") - 1) / half).cast("long").alias("block")))


def automata(benchmark: DataFrame, n: int, limit: int = BLOCK_WORDS) -> DataFrame:
    """(block, automaton): one pickled automaton of at most ``limit`` words (four windows at least) per block, each built in its own task."""
    half = max(limit // 2, 2 * n)

    def build(part: pa.Table) -> pa.Table:
        items = [(name, words.split()) for name, words in zip(part["name"].to_pylist(), part["words"].to_pylist())]
        # pickled by value, so that executors need not have this package
        return pa.table({"block": part["block"][:1], "automaton": pa.array([cloudpickle.dumps(Automaton(items, n))], pa.binary())})

    cuts = materialise(pieces(benchmark, n, half), "decontaminate-pieces")
    return materialise(numbered(cuts, half).groupBy("block").applyInArrow(build, "block long, automaton binary"), "decontaminate-automata")


def runs(hit: np.ndarray) -> list[int]:
    """Flat list of the starts and ends of the hit runs."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return edge.tolist()


def find(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, limit: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with n_words__, hits__ (starts and ends of hit word runs) and items__ (sorted ids)."""
    spark = docs.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    cols = docs.columns
    extra = ", n_words__ long, hits__ array<int>, items__ array<string>"
    done = docs.withColumns({"n_words__": F.lit(0).cast("long"), "hits__": F.array().cast("array<int>"),
                             "items__": F.array().cast("array<string>")})
    built = automata(benchmark, n, limit)
    # a benchmark without words still has the documents' words counted
    for k in range(max(1, built.count())):
        row = built.where(F.col("block") == k).first()
        sent = spark.sparkContext.broadcast(bytes(row["automaton"]) if row else cloudpickle.dumps(Automaton([], n)))
        loaded: list[Automaton] = []

        def run(c, sent=sent, loaded=loaded):
            if not loaded:
                loaded.append(pickle.loads(sent.value))
            count, hits, items = [], [], []
            for text, before, names in zip(c["text"], c["hits__"], c["items__"]):
                words = words_of(text.encode() if text else None)
                hit, found = loaded[0].scan(words)
                if hit is not None:
                    for a, b in zip(before[::2], before[1::2]):
                        hit[a:b] = True
                    before = runs(hit)
                count.append(len(words))
                hits.append(before)
                items.append(sorted({*names, *(x for x in found if x is not None)}))
            return {**{x: c[x] for x in cols}, "n_words__": count, "hits__": hits, "items__": items}

        done = map_text(materialise(done, "decontaminate") if k else done, run, schema + extra)
    return done


def report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size("hits__") - 1), F.lit(0).cast("long"),
                        lambda s, i: s + F.when(i % 2 == 1, F.col("hits__")[i]).otherwise(-F.col("hits__")[i]))
    return find(docs.select("doc_id", "text"), benchmark, n).select(
        "doc_id", F.col("n_words__").alias("n_words"),
        F.when(F.size("hits__") > 0, n_hit).otherwise(0).cast("long").alias("n_hit"),
        F.size("items__").cast("long").alias("n_items"),
        F.sha2(F.array_join("items__", ","), 256).alias("items_sha256"),
        (F.size("hits__") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, min_span: int = 1,
           max_coverage: float = 0.0) -> DataFrame:
    """``docs`` without documents whose hit words are more than ``max_coverage`` of their words;
    in the rest, hit runs of at least ``min_span`` words are cut from the text."""
    plain = neutral(docs, "doc_id", "text", "n_chars")
    cols = plain.columns
    schema = plain.schema
    word = re.compile(WORD)

    def cut(c):
        texts, keep = [], []
        for text, count, hits in zip(c["text"], c["n_words__"], c["hits__"]):
            pairs = list(zip(hits[::2], hits[1::2]))
            keep.append(sum(b - a for a, b in pairs) <= max_coverage * count)
            pairs = [(a, b) for a, b in pairs if b - a >= min_span]
            if pairs and keep[-1]:
                at = [m.span() for m in word.finditer("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text))]
                out, last = [], 0
                for a, b in pairs:
                    out.append(text[last:at[a][0]])
                    last = at[b - 1][1]
                text = "".join(out) + text[last:]
            texts.append(text)
        return {**{x: c[x] for x in cols}, "text": texts, "keep__": keep}

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    done = map_text(find(plain, benchmark, n), cut, ddl + ", keep__ boolean").where("keep__").drop("keep__")
    if "n_chars" in cols:
        done = done.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType))
    return done.select(*restored(done, plain, docs))


REPORT_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
b2 AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM b2)),
ks AS (SELECT DISTINCT k FROM win),
gram AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
           SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT gram.doc_id, gram.i, gram.k, win.item_id FROM gram JOIN win ON gram.k = win.k AND gram.g = win.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
          SELECT DISTINCT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
       FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
