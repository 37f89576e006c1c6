"""Merkle dataset manifest: one tree over all documents, built by pivoting slots into columns.

H is the SHA-256, in lowercase hex, of its inputs one after the other; a digest goes in as its hex text. A document's
leaf is H of doc_id, source, lang, n_chars and text, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value. Per lang
the leaves ascend by doc_id; ``FANOUT`` consecutive nodes become their H until one is left, the subroot. The
subroots ascend by lang and become the root in the same way.

A node's place in its lang is ``place``: its parent's place is ``place div FANOUT`` and its slot the rest. One grouped
aggregate per level, with a conditional maximum for every slot, spreads the children of a parent over ``FANOUT``
columns: the columns one after the other hash to the parent, and without a child's own column they are its siblings.
The way from a parent to the root (what stands left and right of it, level by level) goes down the levels with it,
so a document meets it in the row of its own parent, and no join sees a row per document.

Places come from one range partitioning of the leaves, written once: rows are numbered inside their partition, and
partitions by a small table of counts, so neither a lang nor a doc_id is gathered by one task.

Defined results: a null lang is a group of its own, before all others; null doc_ids come first in their lang; rows with the
same doc_id ascend by leaf, and equal rows are leaves of their own with proofs of their own; an empty table gives no rows. A
null doc_id is not tampered with. Only doc_id, source, lang, n_chars and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actimetry.llm.common import ascii_lower, materialise

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SLOTS = [f"x{i}" for i in range(FANOUT)]
PATH = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: dict[str, Column]) -> Column:
    """H of the fields of a document."""
    return F.sha2(F.concat(*[encoded(columns[n]) for n in FIELDS]), 256)


def tampered(doc_id: Column) -> Column:
    """Whether a row is tampered with: 3 divides the CRC-32 of its decimal doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, other): other is the leaf after tampering, null where the row is left alone."""
    plain = {n: F.col(n) for n in FIELDS}
    changed = plain | {"text": ascii_lower(F.col("text"))}
    return docs.select("doc_id", "lang", leaf(plain).alias("leaf"),
                       F.when(tampered(F.col("doc_id")), leaf(changed)).alias("other"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``place``, their number from 0 among those of their ``lang`` by ``order``, and ``last``, the largest
    place of the lang. Written to the shared folder, as all that follows relies on it."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the number inside a partition is the low part of the id; equal rows are told apart by where they were read
    dealt = materialise(
        rows.withColumn("read", F.monotonically_increasing_id()).repartitionByRange(n, "lang", *order, "read")
        .sortWithinPartitions("lang", *order, "read").withColumn("row", F.monotonically_increasing_id())
        .withColumn("part", F.spark_partition_id()).drop("read"), "manifest-rows")
    # one row per partition and lang
    counts = dealt.groupBy("lang", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    whole = Window.partitionBy("lang")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(F.col("lang").alias("of__"), F.col("part").alias("at__"), (F.sum("n").over(whole) - 1).alias("last"),
                           (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return materialise(dealt.join(begins, (dealt["part"] == begins["at__"]) & dealt["lang"].eqNullSafe(begins["of__"]))
                       .select(*rows.columns, (F.col("row") + F.col("shift")).alias("place"), "last"), "manifest-places")


def pivot(nodes: DataFrame, values: list[str]) -> DataFrame:
    """One row per parent (lang, last, place) with its children's ``values`` as a struct in one column per slot (x0, x1,
    ...) and ``node``, the H of the first value of them all. A lang's only node stays as it is."""
    slot = F.col("place") % FANOUT
    spread = [F.max(F.when(slot == i, F.struct(*values))).alias(x) for i, x in enumerate(SLOTS)]
    own = [F.col(x)[values[0]] for x in SLOTS]
    up = F.expr(f"place div {FANOUT}").alias("place")
    return (nodes.groupBy("lang", F.col("last").alias("below"), up).agg(*spread)
            .withColumn("node", F.when(F.col("below") == 0, own[0]).otherwise(F.sha2(F.concat_ws("", *own), 256)))
            .withColumn("last", F.expr(f"below div {FANOUT}")))


def _paths(value: str) -> list[Column]:
    """The path of each slot of a pivoted row: its siblings (every column but its own), then the row's own path."""
    own = [F.col(x)[value] for x in SLOTS]
    return [F.when(F.col("below") == 0, F.col("path")).otherwise(F.concat(F.array(F.struct(
        F.concat_ws("", *own[:i]).alias("left"), F.concat_ws("", *own[i + 1:]).alias("right"))), F.col("path")))
        for i in range(FANOUT)]


def climb(nodes: DataFrame, values: list[str]) -> list[DataFrame]:
    """The pivoted levels over ``nodes`` (lang, last, place, values), from the lowest to the one where every lang has one
    node: as many as the largest lang needs, one at least."""
    levels = [materialise(pivot(nodes, values), "manifest-level")]
    last = levels[0].agg(F.max("last")).first()[0] or 0
    while last > 0:
        levels.append(materialise(pivot(levels[-1], ["node"]), "manifest-level"))
        last //= FANOUT
    return levels


def descend(levels: list[DataFrame], tops: DataFrame, values: list[str]) -> DataFrame:
    """The nodes that ``levels`` stand on, with the path of each (its siblings up to the top, level by level, then the path
    of its lang in ``tops``) and the other columns of ``tops`` (lang, path, ...)."""
    kept = [c for c in tops.columns if c not in ("lang", "path")]
    known = levels[-1].join(tops.withColumnRenamed("lang", "of__"), F.col("lang").eqNullSafe(F.col("of__"))).drop("of__")
    for level in reversed(levels[:-1]):
        told = known.select(F.col("lang").alias("of__"), *kept, F.col("place").alias("over"),
                            F.posexplode(F.array(*_paths("node"))).alias("slot", "path"))
        own = level.withColumns({"over__": F.expr(f"place div {FANOUT}"), "slot__": (F.col("place") % FANOUT).cast("int")})
        known = materialise(own.join(told, own["lang"].eqNullSafe(told["of__"]) & (own["over__"] == told["over"])
                                     & (own["slot__"] == told["slot"])).select(*level.columns, *kept, "path"), "manifest-way")
    children = F.array(*[F.struct(F.col(x).alias("child"), p.alias("path")) for x, p in zip(SLOTS, _paths(values[0]))])
    return (known.select("lang", *kept, F.explode(children).alias("c")).where(F.col("c.child").isNotNull())
            .select("lang", *kept, *[F.col("c.child")[v].alias(v) for v in values], F.col("c.path").alias("path")))


def fold(node: Column, path: Column) -> Column:
    """The root that a node gives with the siblings of ``path``, step by step."""
    return F.aggregate(path, node, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof(path: Column) -> Column:
    """H of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """(lang, subroot, root, leaf, doc_id, other, path) of every document."""
    values, top = ["leaf", "doc_id", "other"], ["node", "of"]
    levels = climb(placed(leaves(docs), ["doc_id", "leaf"]), values)
    subroots = levels[-1].select(F.lit("").alias("lang"), F.col("lang").alias("of"), "node")
    over = climb(placed(subroots, ["of"]), top)
    end = over[-1].select("lang", F.array().cast(PATH).alias("path"), F.col("node").alias("root"))
    tops = descend(over, end, top).select(F.col("of").alias("lang"), "path", "root", F.col("node").alias("subroot"))
    return descend(levels, materialise(tops, "manifest-tops"), values)


def report(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, proof and the root folded from the tampered leaf, per document."""
    done = manifest(docs).withColumn("folded_root", fold(F.coalesce("other", "leaf"), F.col("path")))
    return done.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def _encoded_sql(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_encoded_sql(text if n == "text" else n) for n in FIELDS) + ")"


_CRC_BITS = "range(0, 8)"
CRC_SQL = f"""list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), {_CRC_BITS}), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"""
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# levels and folds are recursive, so the depth is that of the data
REPORT_SQL = f"""
WITH RECURSIVE base AS (SELECT *, {_leaf_sql('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND xor({CRC_SQL}, 4294967295) % 3 = 0
    THEN {_leaf_sql(_LOWER)} END AS other FROM documents),
leaves AS (SELECT doc_id, lang, leaf, other, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) - 1 AS last FROM base),
levels AS (SELECT lang, 0 AS level, place, last, leaf AS node FROM leaves
  UNION ALL SELECT lang, level + 1, place // {FANOUT}, last // {FANOUT}, sha256(string_agg(node, '' ORDER BY place))
  FROM levels WHERE last > 0 GROUP BY lang, level, place // {FANOUT}, last),
subroots AS (SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () - 1 AS last
  FROM levels WHERE last = 0),
tops AS (SELECT 0 AS level, place, last, node FROM subroots
  UNION ALL SELECT level + 1, place // {FANOUT}, last // {FANOUT}, sha256(string_agg(node, '' ORDER BY place))
  FROM tops WHERE last > 0 GROUP BY level, place // {FANOUT}, last),
ways AS (SELECT l.lang, l.place, n.level, string_agg(n.node, '' ORDER BY n.place) FILTER (WHERE n.place < l.place // CAST(power({FANOUT}, n.level) AS BIGINT)) AS before,
    string_agg(n.node, '' ORDER BY n.place) FILTER (WHERE n.place > l.place // CAST(power({FANOUT}, n.level) AS BIGINT)) AS behind
  FROM leaves l JOIN levels n ON l.lang IS NOT DISTINCT FROM n.lang AND n.last > 0
    AND n.place // {FANOUT} = l.place // CAST(power({FANOUT}, n.level + 1) AS BIGINT) GROUP BY l.lang, l.place, n.level),
over AS (SELECT s.lang, 1000 + n.level AS level, string_agg(n.node, '' ORDER BY n.place) FILTER (WHERE n.place < s.place // CAST(power({FANOUT}, n.level) AS BIGINT)) AS before,
    string_agg(n.node, '' ORDER BY n.place) FILTER (WHERE n.place > s.place // CAST(power({FANOUT}, n.level) AS BIGINT)) AS behind
  FROM subroots s JOIN tops n ON n.last > 0 AND n.place // {FANOUT} = s.place // CAST(power({FANOUT}, n.level + 1) AS BIGINT)
  GROUP BY s.lang, n.level),
steps AS (SELECT lang, place, row_number() OVER (PARTITION BY lang, place ORDER BY level) AS step, coalesce(before, '') AS before, coalesce(behind, '') AS behind
  FROM (SELECT * FROM ways UNION ALL SELECT l.lang, l.place, o.level, o.before, o.behind FROM leaves l JOIN over o ON l.lang IS NOT DISTINCT FROM o.lang) t),
folds AS (SELECT lang, place, 0 AS step, coalesce(other, leaf) AS node FROM leaves
  UNION ALL SELECT f.lang, f.place, s.step, sha256(s.before || f.node || s.behind) FROM folds f JOIN steps s
  ON f.lang IS NOT DISTINCT FROM s.lang AND f.place = s.place AND s.step = f.step + 1),
ends AS (SELECT lang, place, arg_max(node, step) AS folded_root FROM folds GROUP BY lang, place),
proofs AS (SELECT lang, place, sha256(string_agg(before || behind, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY lang, place)
SELECT l.doc_id, l.leaf, s.node AS subroot, r.node AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root,
  e.folded_root = r.node AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN ends e ON l.lang IS NOT DISTINCT FROM e.lang AND l.place = e.place
LEFT JOIN proofs p ON l.lang IS NOT DISTINCT FROM p.lang AND l.place = p.place, (SELECT node FROM tops WHERE last = 0) r
"""
