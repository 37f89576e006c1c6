"""Suffix-array dedup: bytes of repeated passages, found by deep-shallow suffix sorting.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller
doc_id. The documents are packed into compressed blocks of about ``BLOCK`` bytes, and all that
crosses the network is records of a block: per distinct string one record, or two, whatever the number of copies.

1. Every text is cut into chunks where the hash of the next bytes says so. A chunk, together with the bytes
   that strings starting in it still reach, is compared by its 128-bit hash: where a
   smaller document has the same one, every string that starts in it is repeated. A string's first document
   always holds it in a chunk that no smaller document has, so only these stay in play.
2. Every string in play has a key, the least hash among its parts of ``K`` bytes; equal strings have equal
   keys. Strings whose key no other document has are unique. Neighbouring strings with one key are a run; a run that a
   smaller document has in the same bytes is repeated, and where all runs of a key are the same nothing is left to sort.
3. The suffixes that are left are sorted in their block, deep-shallow: multikey quicksort on
   characters of eight bytes to ``SHALLOW`` bytes, then a blind trie for each group that is still equal. Suffixes that
   share ``LENGTH`` bytes are one string; the smallest doc_id of each string is found over all blocks by its 128-bit hash.

Defined results: a null text has no bytes; texts under ``LENGTH`` bytes are kept; a null doc_id counts as the smallest id; rows
with the same doc_id never remove each other's bytes; an empty table gives no rows. Only doc_id and text are
read. A block is one unit of memory (about 100 bytes for each of its own); a longer document is a block of its own.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actimetry.config import scratch_dir
from actimetry.llm.common import materialise

LENGTH = 50
K = 24                      # bytes of a key part, three words of eight: LENGTH - K + 1 parts to a string
CHUNK = 128                  # mean bytes of a chunk, a power of two
SHALLOW = 16
BLOCK = 500_000
BUCKET = 16_000_000         # bytes of text for each bucket of an exchange
NO_ID = -2 ** 63
MIXED = 2 ** 63 - 1         # marks the key of several runs in an answer
NO_ANSWER = 2 ** 63 - 1     # no document is smaller
PIECE = 1 << 14             # positions hashed at a time, so that they stay in the cache

REC = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8")])
KEY_BYTES = 5               # of a key that are sent; equal keys stay equal
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


# ---- one block -----------------------------------------------------------------------------

class Block:
    """The documents of one block: bytes of all, document number and end for each byte."""

    def __init__(self, ids, sizes, blob):
        self.raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, int(np.sum(sizes))))
        self.ids = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)
        self.sizes = np.array(sizes, dtype=np.int64)
        self.end = np.cumsum(self.sizes)
        self.begin = self.end - self.sizes
        self.n = len(self.raw)
        self.owner = np.repeat(np.arange(len(sizes), dtype=np.int32), self.sizes)

    def parts(self) -> np.ndarray:
        """Mixed hash of the ``K`` bytes (three words of eight) from each position, the last ones left out."""
        m = self.n - K + 1
        word = np.ndarray(shape=(self.n - 7,), dtype="<u8", buffer=self.raw, strides=(1,))
        h = np.zeros(m, dtype=np.uint64)
        spare = np.empty(min(m, PIECE), dtype=np.uint64)
        for at in range(0, m, PIECE):
            g = h[at:at + PIECE]
            t = spare[:len(g)]
            for i, odd in enumerate(_ODD):
                g ^= np.right_shift(g, np.uint64(31), out=t)
                g += word[8 * i + at:8 * i + at + len(g)]
                g *= np.uint64(odd)
            g ^= np.right_shift(g, np.uint64(32), out=t)
            g *= np.uint64(0xD6E8FEB86659FD93)
            g ^= np.right_shift(g, np.uint64(29), out=t)
        return h

    def chunks(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First start, last start + 1 and document of every chunk that strings start in."""
        cut = np.zeros(self.n + 1, dtype=bool)
        cut[:len(h)] = (h & np.uint64(CHUNK - 1)) == 0
        cut[self.begin[self.sizes > 0]] = True
        cut[self.n] = True
        at = np.flatnonzero(cut)
        doc = self.owner[at[:-1]]
        last = np.minimum(at[1:], self.end[doc] - LENGTH + 1)
        ok = last > at[:-1]
        return at[:-1][ok], last[ok], doc[ok]


def _rec(a, b, doc) -> np.ndarray:
    rec = np.empty(len(a), dtype=REC)
    rec["a"], rec["b"], rec["doc"] = a, b, doc
    return rec


def _order(rec: np.ndarray) -> np.ndarray:
    """The order of the records by a, b and doc; b and doc are compared only where several records have one a."""
    a = rec["a"].copy()
    order = np.argsort(a)
    a = a[order]
    same = a[1:] == a[:-1]
    if same.any():
        tie = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
        of = order[tie]
        order[tie] = of[np.lexsort((rec["doc"][of], rec["b"][of], rec["a"][of]))]
    return order


def _lead(rec: np.ndarray) -> np.ndarray:
    """Which of the records, in order, are the first of their kind."""
    lead = np.ones(len(rec), dtype=bool)
    lead[1:] = (rec["a"][1:] != rec["a"][:-1]) | (rec["b"][1:] != rec["b"][:-1])
    return lead


def _merge(rec: np.ndarray) -> np.ndarray:
    """The record with the smallest doc of every kind, sorted."""
    rec = rec[_order(rec)]
    return rec[_lead(rec)]


def _lowest(own: np.ndarray, more: np.ndarray) -> np.ndarray:
    """For each of the records ``own`` the smallest doc of its kind among them and ``more``."""
    every = np.concatenate((own, more))
    order = _order(every)
    s = every[order]
    lead = _lead(s)
    low = np.empty(len(s), dtype=np.int64)
    low[order] = s["doc"][lead][np.cumsum(lead) - 1]
    return low[:len(own)]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values the sorted ``known`` has."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _cover(s: np.ndarray, e: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in the intervals from ``s`` to ``e``, which don't overlap."""
    step = np.zeros(n + 1, dtype=np.int8)
    step[s] += 1
    step[e] -= 1
    return np.cumsum(step[:n], dtype=np.int8).view(bool)


def _chunk_recs(block: Block, s: np.ndarray, e: np.ndarray, doc: np.ndarray) -> np.ndarray:
    view, h128 = memoryview(block.raw), xxhash.xxh3_128_digest
    pair = np.frombuffer(b"".join([h128(view[i:j]) for i, j in zip(s.tolist(), (e + LENGTH - 1).tolist())]), dtype="<u8")
    return _rec(pair[::2], pair[1::2], block.ids[doc])


def chunk_records(block: Block) -> np.ndarray:
    if block.n < LENGTH:
        return np.zeros(0, REC)
    return _merge(_chunk_recs(block, *block.chunks(block.parts())))


def after_chunks(block: Block, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(repeated starts, starts still in play, key of every start). ``first`` has the chunks that a
    smaller document of another block holds."""
    if block.n < LENGTH:
        return np.zeros(block.n, bool), np.zeros(block.n, bool), np.zeros(0, np.uint64)
    h = block.parts()
    s, e, d = block.chunks(h)
    own = _chunk_recs(block, s, e, d)
    again = _lowest(own, first) < own["doc"]
    dup, play = _cover(s[again], e[again], block.n), _cover(s[~again], e[~again], block.n)
    return dup, play, _least_part(h)


def _least_part(h: np.ndarray) -> np.ndarray:
    """The least hash over the LENGTH - K + 1 parts of each start."""
    parts = LENGTH - K + 1
    out = np.empty(len(h) - parts + 1, dtype=np.uint64)
    for at in range(0, len(out), PIECE):
        key, width = h[at:at + PIECE + parts - 1], 1
        while width * 2 <= parts:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        rest = parts - width
        if rest:
            key = np.minimum(key[:-rest], key[rest:])
        out[at:at + PIECE] = key
    return out


def _runs(block: Block, play: np.ndarray, key: np.ndarray):
    """Runs of starts in play that share their key and document: (first, last + 1, key, doc_id). The last bytes of a
    document are no starts, so no run goes on into the next."""
    on = play[:len(key)]
    alone = key[1:] != key[:-1]
    lead, tail = on.copy(), on.copy()
    lead[1:] &= alone | ~on[:-1]
    tail[:-1] &= alone | ~on[1:]
    s = np.flatnonzero(lead)
    return s, np.flatnonzero(tail) + 1, key[s], block.ids[block.owner[s]]


def _short(keys: np.ndarray) -> np.ndarray:
    # keys are least hashes and crowd at the low end: an odd factor spreads them
    return (keys * np.uint64(_ODD[1])) >> np.uint64(64 - 8 * KEY_BYTES)


def keys_in_play(block: Block, first: np.ndarray) -> np.ndarray:
    _, play, key = after_chunks(block, first)
    k = np.sort(_short(_runs(block, play, key)[2]))
    return k[np.concatenate(([True], k[1:] != k[:-1]))] if len(k) else k


def _several(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The groups that have more than one value, sorted."""
    if not len(group):
        return group
    order = np.argsort(group)
    g, v = group[order], value[order]
    head = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    return g[head][np.minimum.reduceat(v, head) != np.maximum.reduceat(v, head)]


def shared_runs(block: Block, first: np.ndarray, shared: np.ndarray):
    """(repeated starts, runs): the runs in play whose key another block or another document of this one has."""
    dup, play, key = after_chunks(block, first)
    s, e, k, doc = _runs(block, play, key)
    short = _short(k)
    left = _among(short, np.sort(np.concatenate((_several(short, doc), shared))))
    return dup, s[left], e[left], k[left], doc[left]


def run_hashes(block: Block, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    view, h64 = memoryview(block.raw), xxhash.xxh3_64_intdigest
    return np.array([h64(view[i:j]) for i, j in zip(s.tolist(), (e + LENGTH - 1).tolist())], dtype=np.uint64)


def run_records(block: Block, first: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """One record per different run: its key, the hash of the bytes that its strings reach, its smallest doc_id."""
    _, s, e, k, doc = shared_runs(block, first, shared)
    return _merge(_rec(k, run_hashes(block, s, e), doc))


def candidates(block: Block, first: np.ndarray, shared: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(repeated starts, positions left). A run that a smaller document has is repeated; where all runs of a
    key are the same, nothing is left; else the strings of the first documents' runs have to be sorted. ``runs`` has the
    records of this block whose key has several runs anywhere, or that a smaller document elsewhere has."""
    dup, s, e, k, doc = shared_runs(block, first, shared)
    if not len(s):
        return dup, s
    h = run_hashes(block, s, e)
    again = _lowest(_rec(k, h, doc), runs) < doc
    left = ~again & _among(k, np.sort(np.concatenate((_several(k, h), _several_keys(runs)))))
    return dup | _cover(s[again], e[again], block.n), np.flatnonzero(_cover(s[left], e[left], block.n))


def _several_keys(runs: np.ndarray) -> np.ndarray:
    """Keys told to have several runs: their records come with a marker record of hash 0 and the largest doc."""
    return runs["a"][runs["doc"] == MIXED]


# ---- deep-shallow sorting ------------------------------------------------------------------

class BlindTrie:
    """Compacted trie that branches on one byte per node; equal strings share a leaf."""

    def __init__(self):
        self.root = None

    def add(self, s: bytes, item: int) -> None:
        if self.root is None:
            self.root = (s, [item])
            return
        node = self.root
        while len(node) == 3:                       # inner node: (depth, children, None)
            child = node[1].get(s[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        leaf = node[0]
        if leaf == s:
            node[1].append(item)
            return
        depth = next(i for i, (x, y) in enumerate(zip(leaf, s)) if x != y)
        up, node = None, self.root
        while len(node) == 3 and node[0] < depth:
            up, node = node, node[1][s[node[0]]]
        if len(node) == 3 and node[0] == depth:
            node[1][s[depth]] = (s, [item])
            return
        split = (depth, {leaf[depth]: node, s[depth]: (s, [item])}, None)
        if up is None:
            self.root = split
        else:
            up[1][s[up[0]]] = split

    def groups(self) -> Iterator[list[int]]:
        """The items of each string, in the order of the strings."""
        todo = [self.root]
        while todo:
            node = todo.pop()
            if len(node) == 3:
                todo += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                yield node[1]


def multikey(word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the positions ``at`` by ``SHALLOW`` bytes, and which of them begin a group of equal ones. A step parts
    every open group, all at once, by a pivot character of eight bytes: less, equal (these go on with the next
    character) and greater."""
    pos, lead, rng = at.copy(), np.arange(len(at)) == 0, np.random.default_rng(0)
    start, size, depth = np.array([0]), np.array([len(at)]), np.array([0])
    p, char = at.copy(), word[at].astype(np.uint64)          # of the open groups, one after the other
    while True:
        todo = (size > 1) & (depth < SHALLOW)
        if not todo.all():
            done, slot = np.repeat(~todo, size), np.repeat(start - np.cumsum(size) + size, size)
            pos[(np.arange(len(p)) + slot)[done]] = p[done]
            start, size, depth, p, char = start[todo], size[todo], depth[todo], p[~done], char[~done]
        if not len(start):
            return pos, lead
        off = np.cumsum(size) - size
        x, y, z = (char[off + (rng.random(len(size)) * size).astype(np.int64)] for _ in range(3))
        pivot = np.repeat(np.maximum(np.minimum(x, y), np.minimum(np.maximum(x, y), z)), size)
        above, least = char > pivot, char >= pivot
        high, mid = np.cumsum(above), np.cumsum(least)       # so far, less those of the groups before
        high0, mid0 = high[off] - above[off], mid[off] - least[off]
        n_high, n_mid = high[off + size - 1] - high0, mid[off + size - 1] - mid0
        to = np.where(above, high + np.repeat(off + size - n_high - high0 - 1, size), np.where(
            least, mid - high + np.repeat(off + size - n_mid - mid0 + high0 - 1, size),
            np.arange(len(p)) - mid + np.repeat(mid0, size)))
        p[to], char[to] = p.copy(), char.copy()
        count = np.stack((size - n_mid, n_mid - n_high, n_high), axis=1).ravel()
        some = count > 0
        start = (np.repeat(start - off, 3) + np.cumsum(count) - count)[some]
        depth = np.repeat(depth, 3)
        depth[1::3] += 8
        further = np.repeat(np.tile([False, True, False], len(off)) & (depth < SHALLOW) & (count > 1), count)
        char[further] = word[p[further] + np.repeat(depth, count)[further]]
        depth, size = depth[some], count[some]
        lead[start] = True


def sorted_groups(raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions ``at`` in the order of the LENGTH bytes there, and where each group of equal strings begins."""
    if not len(at):
        return at, at
    word = np.ndarray(shape=(len(raw) - 7,), dtype=">u8", buffer=raw, strides=(1,))
    pos, lead = multikey(word, at)
    cut = np.concatenate((np.flatnonzero(lead), [len(pos)]))
    several = np.flatnonzero(np.diff(cut) > 1)
    for s, e in zip(cut[several].tolist(), cut[several + 1].tolist()):
        trie = BlindTrie()
        for p in pos[s:e].tolist():
            trie.add(raw[p + SHALLOW:p + LENGTH], p)
        for items in trie.groups():
            pos[s:s + len(items)] = items
            lead[s] = True
            s += len(items)
    return pos, np.flatnonzero(lead)


def string_hashes(raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the MurmurHash3 (x64, 128 bits, seed 0) of the LENGTH bytes at each position: three times two
    words of eight bytes and two bytes more."""
    word = np.ndarray(shape=(len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    one, two = np.uint64(0x87C37B91114253D5), np.uint64(0x4CF5AD432745937F)

    def turned(x, r):
        return (x << np.uint64(r)) | (x >> np.uint64(64 - r))

    def mixed(x):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
        return x

    a, b = np.zeros(len(at), dtype=np.uint64), np.zeros(len(at), dtype=np.uint64)
    for i in range(0, LENGTH - 15, 16):
        a ^= turned(word[at + i] * one, 31) * two
        a = (turned(a, 27) + b) * np.uint64(5) + np.uint64(0x52DCE729)
        b ^= turned(word[at + i + 8] * two, 33) * one
        b = (turned(b, 31) + a) * np.uint64(5) + np.uint64(0x38495AB5)
    a ^= turned((word[at + LENGTH - 8] >> np.uint64(64 - 8 * (LENGTH % 16))) * one, 31) * two
    a ^= np.uint64(LENGTH)
    b ^= np.uint64(LENGTH)
    a += b
    b += a
    a, b = mixed(a), mixed(b)
    a += b
    b += a
    return a, b


def string_records(block: Block, first: np.ndarray, shared: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """One record per string that is left: its hash and its smallest doc_id in the block. A string that larger documents
    of the block have too gets a second one, of the largest: its answer tells them that a smaller document has it."""
    pos, lead = sorted_groups(block.raw, candidates(block, first, shared, runs)[1])
    if not len(pos):
        return np.zeros(0, REC)
    ids = block.ids[block.owner[pos]]
    low, high = np.minimum.reduceat(ids, lead), np.maximum.reduceat(ids, lead)
    a, b = string_hashes(block.raw, pos[lead])
    more = low < high
    rec = np.concatenate((_rec(a, b, low), _rec(a[more], b[more], high[more])))
    return rec[_order(rec)]


def removed(block: Block, first: np.ndarray, shared: np.ndarray, runs: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Which bytes of the block go. ``strings`` has the strings that one document of the block has after a smaller one here
    or elsewhere, with the smallest."""
    dup, at = candidates(block, first, shared, runs)
    if len(at) and len(strings):
        least = _lowest(_rec(*string_hashes(block.raw, at), NO_ANSWER), strings)
        dup[at[least < block.ids[block.owner[at]]]] = True
    edge = np.flatnonzero(np.diff(np.concatenate(([0], dup.view(np.int8), [0]))))      # begin and end of every run of starts
    step = np.zeros(block.n + 1, dtype=np.int32)
    step[edge[::2]] += 1
    step[edge[1::2] + LENGTH - 1] -= 1
    return np.cumsum(step[:-1]) > 0


def spans_of(block: Block, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: its bytes that go, and the runs they form."""
    head = gone.copy()
    head[1:] &= ~gone[:-1]
    begin = block.begin[block.sizes > 0]
    head[begin] = gone[begin]

    def per_doc(flag):
        upto = np.concatenate(([0], np.cumsum(flag)))
        return upto[block.end] - upto[block.begin]

    return per_doc(gone), per_doc(head)


# ---- Spark ---------------------------------------------------------------------------------

def pack(docs: DataFrame) -> DataFrame:
    """Blocks (block, ids, sizes, blob) of consecutive documents. A block's id is its partition and its place
    there: a task that runs again gives the same blocks as long as ``docs`` gives it the same rows in the same order,
    as a scan of files does."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        number = itertools.count(TaskContext.get().partitionId() << 32)

        def block():
            blob = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([next(number)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([blob])],
                names=["block", "ids", "sizes", "blob"])

        for batch in batches:
            for i, t in zip(*((v.as_py() for v in batch.column(k)) for k in range(2))):
                t = t or b""
                if ids and size + len(t) > BLOCK:
                    yield block()
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield block()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "block long, ids array<long>, sizes array<long>, blob binary")


def _records(parts) -> np.ndarray:
    return np.concatenate([np.frombuffer(p, dtype=REC) for p in parts]) if parts else np.zeros(0, REC)


def _pack_keys(keys: np.ndarray) -> bytes:
    return keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _unpack_keys(part: bytes) -> np.ndarray:
    out = np.zeros((len(part) // KEY_BYTES, 8), dtype=np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(part, dtype=np.uint8).reshape(-1, KEY_BYTES)
    return out.view("<u8").reshape(-1)


def _keys(parts) -> np.ndarray:
    return np.concatenate([_unpack_keys(p) for p in parts]) if parts else np.zeros(0, np.uint64)


def _per_block(blocks: DataFrame, sides: list[DataFrame], fn, schema: str) -> DataFrame:
    """``fn(Block, *parts of each side)`` yields the rows (tuples) of each block."""
    df = blocks
    for i, side in enumerate(sides):
        df = df.join(side.groupBy("block").agg(F.collect_list("part").alias(f"side{i}")), "block", "left")
    n = len(sides)
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    target = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):                      # one block at a time, whatever the batch holds
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                got = list(fn(row["block"], row["ids"], Block(row["ids"], row["sizes"], row["blob"]),
                              *(row[f"side{k}"] or [] for k in range(n))))
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*got), target)], names=names)

    return df.select("block", "ids", "sizes", "blob", *(f"side{i}" for i in range(n))).mapInArrow(run, schema)


def _bucketed(block: int, values: np.ndarray, high: np.ndarray, bits: int, buckets: int, pack=lambda v: v.tobytes()):
    """Rows (bucket, block, bytes) of values sorted by ``high``, dealt by its first bits. ``buckets`` is a power of two; the
    work is that of the values, however many buckets there are."""
    if not len(values):
        return
    bucket = (high >> np.uint64(bits - (buckets.bit_length() - 1))).astype(np.int64)
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield int(bucket[i]), block, pack(values[i:j])


def _exchange(rows: DataFrame, fn, buckets: int) -> DataFrame:
    """(block, part): ``fn`` sees the parts of one bucket from all blocks and gives each block its answer."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _buckets(batches):
            got = [(block, part) for block, part in fn(parts) if len(part)]
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()),
                                                  pa.array([g[1] for g in got], pa.binary())], names=["block", "part"])

    return rows.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "block long, part binary")


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    """The parts of one bucket after the other, from rows sorted by bucket: only one is held at a time."""
    held, at = [], None
    for batch in batches:
        for b, block, part in zip(*((v.as_py() for v in batch.column(i)) for i in range(3))):
            if held and b != at:
                yield held
                held = []
            at = b
            held.append((block, part))
    if held:
        yield held


def _grouped(parts):
    """All records of a bucket in order: (record, its block, first of its kind, smallest doc of its kind)."""
    recs = [np.frombuffer(p, dtype=REC) for _, p in parts]
    who = np.repeat(np.arange(len(recs)), [len(r) for r in recs])
    every = np.concatenate(recs)
    order = _order(every)
    s, who = every[order], who[order]
    lead = _lead(s)
    return s, who, lead, s["doc"][np.flatnonzero(lead)][np.cumsum(lead) - 1]


def _answers(parts, who: np.ndarray, out: np.ndarray):
    order = np.argsort(who, kind="stable")
    who, out = who[order], out[order]
    cut = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1], [True]))) if len(who) else [0]
    for i, j in zip(cut[:-1], cut[1:]):
        yield parts[who[i]][0], out[i:j].tobytes()


def _smaller_elsewhere(parts):
    """For each block the records whose smallest document over all blocks is smaller than its own."""
    s, who, _, least = _grouped(parts)
    hit = least < s["doc"]
    out = s[hit].copy()
    out["doc"] = least[hit]
    yield from _answers(parts, who[hit], out)


def _smaller_or_mixed(parts):
    """The same, and a marker for each of the block's keys that has several runs."""
    s, who, lead, least = _grouped(parts)
    hit = least < s["doc"]
    out = s[hit].copy()
    out["doc"] = least[hit]
    kind = np.concatenate(([True], s["a"][1:] != s["a"][:-1]))
    number = np.cumsum(kind) - 1
    many = np.bincount(number[lead]) > 1
    pair = np.unique(np.stack((who[many[number]], np.flatnonzero(kind)[number[many[number]]])), axis=1)
    mark = np.zeros(pair.shape[1], dtype=REC)
    mark["a"], mark["doc"] = s["a"][pair[1]], MIXED
    yield from _answers(parts, np.concatenate((who[hit], pair[0])), np.concatenate((out, mark)))


def _in_two_blocks(parts):
    """For each block its keys that another block has too."""
    keys = [_unpack_keys(p) for _, p in parts]
    every = np.sort(np.concatenate(keys))            # a block has each of its keys once
    shared = every[1:][every[1:] == every[:-1]]
    for (block, _), k in zip(parts, keys):
        yield block, _pack_keys(k[_among(k, shared)])


def _by_block(blocks: DataFrame) -> DataFrame:
    """The blocks as a bucketed table in the shared folder: the joins below deal only their small sides."""
    spark = blocks.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    (blocks.repartition(n, "block").write.bucketBy(n, "block").option("path", scratch_dir(spark, "suffix-blocks") + "/t")
     .format("parquet").saveAsTable(name))
    stored = spark.table(name)
    stored.schema                     # resolved here: the catalog can forget the name, the files stay
    spark.sql(f"DROP TABLE {name}")
    return stored


def report(docs: DataFrame) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and the digest of the bytes kept."""
    blocks = _by_block(pack(docs))
    total = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = 1 << max(4, (total // BUCKET).bit_length())

    def chunks(block, ids, b):
        rec = chunk_records(b)
        return _bucketed(block, rec, rec["a"], 64, buckets)

    def keys(block, ids, b, first):
        k = keys_in_play(b, _records(first))
        return _bucketed(block, k, k, 8 * KEY_BYTES, buckets, _pack_keys)

    def same_runs(block, ids, b, first, shared):
        rec = run_records(b, _records(first), _keys(shared))
        # keys are least hashes and lie at the low end: the hash of the key deals them evenly
        high = rec["a"] * np.uint64(_ODD[0])
        order = np.argsort(high)
        return _bucketed(block, rec[order], high[order], 64, buckets)

    def strings(block, ids, b, first, shared, runs):
        rec = string_records(b, _records(first), _keys(shared), _records(runs))
        return _bucketed(block, rec, rec["a"], 64, buckets)

    def final(block, ids, b, first, shared, runs, least):
        gone = removed(b, _records(first), _keys(shared), _records(runs), _records(least))
        data = np.frombuffer(b.raw, dtype=np.uint8)
        for i, s, e, n, spans in zip(ids, b.begin.tolist(), b.end.tolist(), *(x.tolist() for x in spans_of(b, gone))):
            kept = data[s:e][~gone[s:e]] if n else data[s:e]
            yield i, e - s, n, spans, hashlib.sha256(kept).hexdigest()

    def asked(sides, ask, answer, name):
        rows = _per_block(blocks, sides, ask, "bucket long, block long, part binary")
        return materialise(_exchange(rows, answer, buckets), f"suffix-{name}")

    first = asked([], chunks, _smaller_elsewhere, "chunks")
    shared = asked([first], keys, _in_two_blocks, "keys")
    runs = asked([first, shared], same_runs, _smaller_or_mixed, "runs")
    least = asked([first, shared, runs], strings, _smaller_elsewhere, "strings")
    return _per_block(blocks, [first, shared, runs, least], final,
                      "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
