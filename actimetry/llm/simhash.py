"""SimHash near-dedup by pigeonhole blocks.

Every text gets a 64-bit fingerprint: the bitwise majority of the XXH64 of its word shingles.
The 64 bits are cut into ``blocks`` equal blocks. Two fingerprints that differ in at most ``k``
bits agree in at least ``blocks - k`` blocks, so for one of the choices of that many blocks
they hold the same key: joining on (choice, key) finds every close pair. With eight blocks and
two bits a key fixes 48 bits, so no bucket can hold more than 2^16 different fingerprints,
whatever the data. Equal fingerprints are one row before the join; inside a bucket the distance
of every pair is verified, and only a spanning star of each linked part leaves it.

Defined results: a null, empty or wordless text has the fingerprint zero and is linked like any
other; a null doc_id keeps its row, and its component takes the smallest id that is not null
(null if there is none); repeated rows stay; an empty table gives no rows; the names of extra
columns don't matter, as only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actimetry.llm.common import map_text, materialise, neutral, restored
from actimetry.llm.components import components

SHINGLE, DISTANCE, BLOCKS, SEED = 3, 2, 8, 42


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of the UTF-8 text, A-Z lower-cased, words cut at ASCII white space."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterable[bytes] = (b" ".join(words),)
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h64 = xxhash.xxh64_intdigest
    h = np.array([h64(g, SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 65536):
        ones += np.unpackbits(h[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def run(cols):
        fps = np.array([fingerprint(t, shingle) for t in cols["text"]], dtype=np.uint64).view(np.int64)
        return {"doc_id": cols["doc_id"], "fp": pa.array(fps)}

    return map_text(docs.select("doc_id", F.col("text").cast("binary").alias("text")), run, "doc_id long, fp long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _stars(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Star edges of the parts of one bucket that close pairs link. Rows of the pair matrix are
    verified one at a time against the fingerprints not yet reached, so memory stays linear."""
    left, edges = fps, []
    while len(left):
        root, todo, left = left[0], [left[0]], left[1:]
        while todo and len(left):
            near = _popcount(left ^ todo.pop()) <= distance
            hit, left = left[near], left[~near]
            edges += [(root, x) for x in hit]
            todo += list(hit)
    return edges


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Edges (a, b) between different fingerprints (column ``fp``, no repeats) whose components
    are those of all pairs that differ in at most ``distance`` bits."""
    size = 64 // blocks
    masks = [sum(((1 << size) - 1) << (size * b) for b in pick) for pick in combinations(range(blocks), blocks - distance)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed]))
                       .alias("pick", "key"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                     # rows of the last bucket, which may go on in the next batch
        for batch in _with_end(batches):
            if batch is not None:
                now = tuple(np.asarray(batch.column(i)) for i in range(3))
                rows = now if held is None else tuple(np.concatenate(x) for x in zip(held, now))
            else:
                rows = held
            if rows is None or not len(rows[0]):
                continue
            pick, key, fp = rows
            new = np.flatnonzero((pick[1:] != pick[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate(([0], new))
            ends = np.concatenate((new, [len(pick)]))
            if batch is not None:
                held = tuple(x[starts[-1]:] for x in rows)
                starts, ends = starts[:-1], ends[:-1]
            else:
                held = None
            u = fp.view(np.uint64)
            twos = starts[ends - starts == 2]
            twos = twos[_popcount(u[twos] ^ u[twos + 1]) <= distance]
            a, b = [fp[twos]], [fp[twos + 1]]
            for s, e in zip(starts, ends):
                if e - s > 2:
                    found = np.array(_stars(u[s:e], distance), dtype=np.uint64).reshape(-1, 2).view(np.int64)
                    a.append(found[:, 0])
                    b.append(found[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    spark = fps.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (keyed.repartition(n, "pick", "key").sortWithinPartitions("pick", "key")
            .select("pick", "key", "fp").mapInArrow(run, "a long, b long").distinct())


def _with_end(batches):
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id that links reach."""
    fps = materialise(fingerprints(docs, shingle), "simhash")
    first = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-first")
    member = components(links(first.select("fp"), distance, blocks))
    rooted = first.join(member.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    label = rooted.join(low, "root").select("fp", "component_id")
    return fps.join(label, "fp").select("doc_id", "fp", "component_id")


def report(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    return near_duplicates(docs, shingle, distance).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` without the rows whose component has a smaller doc_id; a row follows its own text, so of rows that share a
    doc_id some may go and others stay. Rows that share the smallest doc_id, and rows without one, stay."""
    near = materialise(near_duplicates(docs, shingle, distance), "simhash-members")
    gone = F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(False))
    ids = near.groupBy("doc_id").agg(F.max(gone).alias("some"), F.min(gone).alias("every"))
    plain = neutral(docs, "doc_id", "text")
    kept = plain.join(ids.where("every").select("doc_id"), "doc_id", "left_anti")
    mixed = materialise(ids.where("some AND NOT every").select("doc_id"), "simhash-mixed")
    if not mixed.isEmpty():                                    # ids whose rows have texts of several components
        ddl, columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema), plain.columns

        def run(c):
            fps = np.array([fingerprint(t if t is None else t.encode(), shingle) for t in c["text"]], dtype=np.uint64).view(np.int64)
            return {**{n: c[n] for n in columns}, "fp__": pa.array(fps)}

        told = map_text(kept.join(mixed, "doc_id", "left_semi").select(*columns), run, f"{ddl}, fp__ long")
        pairs = near.where(gone).select(F.col("doc_id").alias("id__"), F.col("fp").alias("of__")).distinct()
        stay = told.join(pairs, (told["doc_id"] == pairs["id__"]) & (told["fp__"] == pairs["of__"]), "left_anti")
        kept = kept.join(mixed, "doc_id", "left_anti").select(*plain.columns).unionByName(stay.select(*plain.columns))
    return kept.select(*restored(kept, plain, docs))
