"""Document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame functions only.

A text is its lines (paragraphs); a paragraph is cut into pieces of at most ``PIECE`` characters,
at a blank where there is one. A piece's node is the MD5 of the piece, a paragraph's the SHA-256 of its
pieces' nodes, a section's the SHA-256 of its paragraphs' nodes, and the root the SHA-256 of its
sections' nodes. A section ends after a paragraph whose node starts with 0 to 3, so an edit
moves no section border that it doesn't touch.

The fingerprint is the root, a bar, and the tree below it: sections between ``/``, paragraphs as ``p``, the
first eight digits of the node, ``:`` and six digits of each piece. Equal texts have equal
fingerprints, and roots differ where texts differ. The likeness of two fingerprints is the Jaccard index
of their pieces; the paragraphs that are in one tree and not in the other locate an edit.

Defined results: a null text is the empty text, whose fingerprint has one paragraph without pieces; two texts without
pieces are alike (1) if their roots are equal, else 0. Rows with the same doc_id are fingerprinted
one by one; as the next document of another, the one with the least fingerprint stands for them. A null doc_id counts
as the smallest id. One document alone is its own next. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actimetry.llm.common import materialise

PIECE = 32
NO_ID = -2 ** 63        # stands for a null doc_id inside the joins
_PIECES = r"(?s).{1,31}[ \t]|.{1,32}"


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text that is not null."""
    def paragraph(p):
        nodes = F.transform(F.regexp_extract_all(p, F.lit(_PIECES), F.lit(0)), F.md5)
        node = F.sha2(F.array_join(nodes, ""), 256)
        short = F.array_join(F.transform(nodes, lambda h: F.substring(h, 1, 6)), "")
        return F.concat(F.lit("p"), node, F.lit(":"), short)

    # the node of a paragraph is read from its own string, so it is computed once
    lines = F.transform(F.transform(F.split(text, "\n"), paragraph),
                        lambda s: F.when(F.substring(s, 2, 1) < "4", F.concat(s, F.lit("/"))).otherwise(s))
    return F.transform(F.array(F.array_join(lines, "")), lambda body: F.concat(
        F.sha2(F.array_join(F.transform(F.split(body, "/"), lambda s: F.sha2(s, 256)), ""), 256),
        F.lit("|"), F.regexp_replace(body, "p([0-9a-f]{8})[0-9a-f]{56}", "p$1")))[0]


def pieces(fp: Column) -> Column:
    joined = F.array_join(F.regexp_extract_all(fp, F.lit(":([0-9a-f]*)"), F.lit(1)), "")
    return F.array_distinct(F.regexp_extract_all(joined, F.lit("[0-9a-f]{6}"), F.lit(0)))


def likeness(own: Column, other: Column, own_pieces: Column, other_pieces: Column) -> Column:
    """Jaccard index of the pieces; 1 for equal fingerprints, 0 if neither has any."""
    common = F.size(F.array_intersect(own_pieces, other_pieces))
    union = F.size(own_pieces) + F.size(other_pieces) - common
    return F.when(own == other, 1.0).when(union == 0, 0.0).otherwise(common / union).cast("double")


def changed_paragraphs(fp: Column, other: Column) -> Column:
    """Nodes of the paragraphs of ``fp`` that ``other`` hasn't."""
    def nodes(f):
        return F.regexp_extract_all(f, F.lit("p([0-9a-f]{8}):"), F.lit(1))
    return F.array_except(nodes(fp), nodes(other))


def next_ids(sizes: DataFrame) -> DataFrame:
    """(k, n) with next_k: the next larger k, the smallest after the largest. k has no repeats."""
    n = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(sizes.repartitionByRange(n, "k").withColumn("part", F.spark_partition_id()), "merkle-ids")
    # one row per range partition
    heads = dealt.groupBy("part").agg(F.min("k").alias("head"))
    every = Window.orderBy("part")
    heads = heads.select("part", F.coalesce(F.lead("head").over(every), F.min("head").over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = dealt.withColumn("next_k", F.lead("k").over(Window.partitionBy("part").orderBy("k")))
    return inside.join(F.broadcast(heads), "part").select("k", "n", F.coalesce("next_k", "after").alias("next_k"))


def report(docs: DataFrame) -> DataFrame:
    # the same two columns on both sides of the joins below, so the texts are dealt by k once
    texts = docs.select(F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    sizes = texts.groupBy("k").agg(F.max(F.length("text")).alias("n"))
    following = materialise(next_ids(sizes), "merkle-next")
    # every document lends the one before it the start of its text and its fingerprint
    lent = (texts.join(following.select(F.col("next_k").alias("k"), F.col("k").alias("to"), F.col("n").alias("need")), "k")
            .select("to", F.expr("substring(text, 1, cast(floor(need / 4) as int))").alias("start"),
                    fingerprint(F.col("text")).alias("next_fp"))
            .groupBy("to").agg(F.min(F.struct("next_fp", "start")).alias("next")))
    n, quarter = F.length("text"), F.expr("cast(floor(length(text) / 4) as int)")
    whole = texts.join(lent, texts["k"] == lent["to"]).select(
        F.when(F.col("k") != NO_ID, F.col("k")).alias("doc_id"), "text", n.cast("long").alias("n_chars"), F.col("next.next_fp").alias("next_fp"),
        F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next.start", F.lit(1), quarter)).alias("edited"))
    done = whole.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "next_fp",
                        fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"))
    done = done.withColumns({"own__": pieces(F.col("fingerprint")), "edited__": pieces(F.col("edited_fingerprint")),
                             "next__": pieces(F.col("next_fp"))})
    return done.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint"), F.col("own__"), F.col("edited__")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fp"), F.col("own__"), F.col("next__")).alias("near_next"),
                       F.size(changed_paragraphs(F.col("fingerprint"), F.col("edited_fingerprint"))).cast("long").alias("n_changed_paragraphs"))


def _fingerprint_sql(text: str) -> str:
    line = (f"list_transform(string_split({text}, chr(10)), lambda p: list_transform("
            r"regexp_extract_all(p, '(?s).{1,31}[ \t]|.{1,32}'), lambda x: md5(x)))")
    lines = (f"list_transform({line}, lambda m: 'p' || sha256(array_to_string(m, '')) || ':' || "
             "array_to_string(list_transform(m, lambda h: h[1:6]), ''))")
    return ("array_to_string(list_transform(" + lines
            + ", lambda s: CASE WHEN s[2] < '4' THEN s || '/' ELSE s END), '')")


def _tree_sql(body: str) -> str:
    return (f"sha256(array_to_string(list_transform(string_split({body}, '/'), lambda s: sha256(s)), '')) || '|' || "
            f"regexp_replace({body}, 'p([0-9a-f]{{8}})[0-9a-f]{{56}}', 'p\\1', 'g')")


def _pieces_sql(fp: str) -> str:
    return (f"list_distinct(regexp_extract_all(array_to_string(regexp_extract_all({fp}, ':([0-9a-f]*)', 1), ''), "
            "'[0-9a-f]{6}'))")


def _likeness_sql(a: str, b: str) -> str:
    return (f"CASE WHEN {a} = {b} THEN 1.0 WHEN len({a}_p) + len({b}_p) = 0 THEN 0.0 ELSE "
            f"len(list_intersect({a}_p, {b}_p)) / CAST(len({a}_p) + len({b}_p) - len(list_intersect({a}_p, {b}_p)) AS DOUBLE) END")


REPORT_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id)) AS nxt FROM t),
e AS (SELECT doc_id, text, nxt, CAST(length(text) AS BIGINT) AS n_chars,
        left(text, length(text) - length(text) // 4) || left(nxt, length(text) // 4) AS edited FROM n),
b AS (SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_fingerprint_sql('text')} AS tb, {_fingerprint_sql('edited')} AS eb,
        {_fingerprint_sql('nxt')} AS nb FROM e),
f AS (SELECT doc_id, n_chars, edited_sha256, {_tree_sql('tb')} AS o, {_tree_sql('eb')} AS ed, {_tree_sql('nb')} AS nx FROM b),
p AS (SELECT *, {_pieces_sql('o')} AS o_p, {_pieces_sql('ed')} AS ed_p, {_pieces_sql('nx')} AS nx_p FROM f)
SELECT doc_id, n_chars, edited_sha256, o AS fingerprint, ed AS edited_fingerprint,
  CAST({_likeness_sql('o', 'ed')} AS DOUBLE) AS near_edited, CAST({_likeness_sql('o', 'nx')} AS DOUBLE) AS near_next,
  CAST(len(list_filter(list_distinct(regexp_extract_all(o, 'p([0-9a-f]{{8}}):', 1)),
    lambda x: NOT list_contains(regexp_extract_all(ed, 'p([0-9a-f]{{8}}):', 1), x))) AS BIGINT) AS n_changed_paragraphs
FROM p
"""
