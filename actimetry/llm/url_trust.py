"""URL filters: rules first, then link-graph trust per host.

A rule names a host (with all subdomains) and a path prefix; the longest that fits decides. What no rule
decides goes by its host. Hosts are joined by the absolute links of their pages, and each host with
its parent domain in both directions, so that a host without links still has a place in the graph. Pages
that a rule allows make their hosts trusted seeds, pages that a rule blocks make theirs distrusted seeds, in proportion to
their number. Trust is the personalised PageRank from the trusted seeds along the edges, distrust the one from the
distrusted seeds against them. A host is blocked where its distrust is larger than its trust.

Both rankings run in one table (kind, host), one join and one sum by key for each round; edges are
summed by host pair before the first shuffle of them. The ranks are written every few rounds, and go on until no verdict
can change: what is left to move is at most a fixed part of what moved since the last write, and each
host with a rank has a larger gap than that, or it is under ``TOLERANCE``.

Defined results: a null url, or one without ``://``, has empty host and path and is blocked; a host that
neither seed reaches is allowed; null html has no links; repeated pages are judged one by one (and count twice as
seeds); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actimetry.llm.common import ascii_lower, materialise

# Verdict, host, path prefix.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DAMPING = 0.85
WRITE_EVERY = 5
MARGIN = 1e-12
TOLERANCE = MARGIN / 10     # summed error of all ranks
ROUNDS = math.ceil(math.log(TOLERANCE / 4) / math.log(DAMPING))        # after which it holds, whatever the graph; the SQL twin's
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def _decide(host: Column, path: Column, rules, value) -> Column:
    out = F.lit(None).cast("string")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(value(verdict, h, p))).otherwise(out)
    return out


def host_edges(judged: DataFrame) -> DataFrame:
    """(src, dst, w): links between different hosts and their number, and each host with its parent domains."""
    linked = (judged.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("l"))
              .select("src", ascii_lower(F.regexp_extract("l", r"//([^/?#]*)", 1)).alias("dst")).groupBy("src", "dst")
              .agg(F.count("*").cast("double").alias("w")))
    hosts = judged.select("host").union(linked.select("dst")).distinct().withColumnRenamed("host", "h")
    labels = F.split("h", r"\.")
    up = (hosts.select(labels.alias("l")).where("size(l) > 2")
          .select(F.explode(F.expr("transform(sequence(1, size(l) - 2), i -> struct(array_join(slice(l, i, size(l)), '.') AS a, "
                                   "array_join(slice(l, i + 1, size(l)), '.') AS b))")).alias("p")).select("p.a", "p.b").distinct())
    both = up.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(up.select("b", "a")).withColumn("w", F.lit(1.0))
    return (linked.union(both).where("src != '' AND dst != '' AND src != dst").groupBy("src", "dst").agg(F.sum("w").alias("w")))


def host_scores(judged: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) from ``judged`` (host, html, ruled)."""
    edges = materialise(host_edges(judged), "trust-edges")
    steps = edges.select(F.lit("t").alias("kind"), F.col("src").alias("u"), F.col("dst").alias("v"), "w").union(
        edges.select(F.lit("d"), "dst", "src", "w"))
    total = steps.groupBy("kind", "u").agg(F.sum("w").alias("all"))
    steps = materialise(steps.join(total, ["kind", "u"]).select("kind", "u", "v", (F.col("w") / F.col("all")).alias("p")), "trust-steps")
    votes = judged.where("host != ''").groupBy("host").agg(
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("t"), F.count(F.when(F.col("ruled") == "block", 1)).alias("d"))
    nodes = votes.select("host").union(edges.select("src")).union(edges.select("dst")).distinct().join(votes, "host", "left")
    nodes = nodes.select("host", F.explode(F.create_map(F.lit("t"), F.coalesce("t", F.lit(0)), F.lit("d"), F.coalesce("d", F.lit(0))))
                         .alias("kind", "n"))
    sums = nodes.groupBy("kind").agg(F.sum("n").alias("all"))        # two rows
    seeds = materialise(nodes.join(F.broadcast(sums), "kind").select(
        "kind", "host", F.when(F.col("all") > 0, F.col("n") / F.col("all")).otherwise(0.0).alias("seed")), "trust-seeds")
    rank, reached = seeds.withColumnRenamed("seed", "r"), -1
    shrunk = damping ** WRITE_EVERY
    # the two rankings start at most 4 from their limits, summed over all hosts, and no round grows that
    for _ in range(math.ceil(math.log(tolerance / 4) / math.log(damping) / WRITE_EVERY)):
        before = rank
        for _ in range(WRITE_EVERY):
            given = (steps.join(rank.withColumnRenamed("host", "u"), ["kind", "u"])
                     .groupBy("kind", F.col("v").alias("host")).agg(F.sum(F.col("r") * F.col("p")).alias("g")))
            rank = seeds.join(given, ["kind", "host"], "left").select(
                "kind", "host", (F.lit(1 - damping) * F.col("seed") + F.lit(damping) * F.coalesce("g", F.lit(0.0))).alias("r"))
        rank = materialise(rank, "trust-rank")
        per_host = _per_host(rank.join(before.withColumnRenamed("r", "was"), ["kind", "host"]),
                             F.sum(F.abs(F.col("r") - F.col("was"))).alias("moved"), F.sum((F.col("r") > 0).cast("long")).alias("n"))
        now = per_host.agg(F.sum("moved").alias("moved"), F.sum("n").alias("n"), F.min(F.when(F.col("n") > 0, F.abs(
            F.col("distrust") - F.col("trust") - F.lit(MARGIN)))).alias("gap")).first()
        left = (now["moved"] or 0.0) * shrunk / (1 - shrunk)
        # a host that no seed has reached so far has no gap to go by
        if left <= tolerance or (now["n"] == reached and left < now["gap"]):
            break
        reached = now["n"]
    return _per_host(rank)


def _per_host(rank: DataFrame, *more: Column) -> DataFrame:
    return rank.groupBy("host").agg(F.sum(F.when(F.col("kind") == "t", F.col("r")).otherwise(0.0)).alias("trust"),
                                    F.sum(F.when(F.col("kind") == "d", F.col("r")).otherwise(0.0)).alias("distrust"), *more)


def report(pages: DataFrame, rules=RULES) -> DataFrame:
    host, path = F.col("host"), F.col("path")
    judged = (pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
              .withColumns({"rule": _decide(host, path, rules, lambda v, h, p: h + p),
                            "ruled": _decide(host, path, rules, lambda v, h, p: v)}))
    scores = host_scores(judged)
    doubted = scores.where(F.col("distrust") > F.col("trust") + MARGIN).select("host", F.lit("block").alias("own"))
    return (judged.select("page_id", "host", "path", "rule", "ruled").join(doubted, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce(
                "ruled", "own", F.when(F.col("host") == "", "block").otherwise("allow")).alias("verdict")))


def _rules_sql(value) -> str:
    whens = " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{value(v, h, p)}'"
        for v, h, p in sorted(RULES, key=lambda r: (len(r[1]) + len(r[2]), r[1] + r[2]), reverse=True))
    return f"CASE {whens} END"


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
REPORT_SQL = f"""
WITH RECURSIVE u AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_LOWER}) AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS (SELECT *, {_rules_sql(lambda v, h, p: h + p)} AS rule, {_rules_sql(lambda v, h, p: v)} AS ruled FROM h),
l AS (SELECT host AS src, translate(regexp_extract(x, '//([^/?#]*)', 1), {_LOWER}) AS dst FROM (
  SELECT host, unnest(regexp_extract_all(html, '{_LINK.replace("'", "''")}', 1)) AS x FROM j)),
hosts AS (SELECT DISTINCT h FROM (SELECT host AS h FROM j UNION ALL SELECT dst FROM l)),
lab AS (SELECT string_split(h, '.') AS l FROM hosts WHERE len(string_split(h, '.')) > 2),
up AS (SELECT DISTINCT array_to_string(l[i:], '.') AS a, array_to_string(l[i + 1:], '.') AS b FROM (
  SELECT l, unnest(generate_series(1, len(l) - 2)) AS i FROM lab)),
e AS MATERIALIZED (SELECT src, dst, sum(w) AS w FROM (SELECT src, dst, 1.0::DOUBLE AS w FROM l UNION ALL SELECT a, b, 1.0 FROM up
  UNION ALL SELECT b, a, 1.0 FROM up) WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
st AS (SELECT 't' AS kind, src AS u, dst AS v, w FROM e UNION ALL SELECT 'd', dst, src, w FROM e),
steps AS MATERIALIZED (SELECT kind, u, v, w / sum(w) OVER (PARTITION BY kind, u) AS p FROM st),
votes AS (SELECT host, count(*) FILTER (ruled = 'allow') AS t, count(*) FILTER (ruled = 'block') AS d FROM j WHERE host <> '' GROUP BY host),
nodes AS (SELECT DISTINCT host FROM (SELECT host FROM votes UNION ALL SELECT src FROM e UNION ALL SELECT dst FROM e)),
n2 AS (SELECT k.kind, n.host, CASE k.kind WHEN 't' THEN coalesce(t, 0) ELSE coalesce(d, 0) END AS n
  FROM nodes n CROSS JOIN (VALUES ('t'), ('d')) k(kind) LEFT JOIN votes v ON n.host = v.host),
seeds AS MATERIALIZED (SELECT kind, host, CASE WHEN sum(n) OVER (PARTITION BY kind) > 0
  THEN n / CAST(sum(n) OVER (PARTITION BY kind) AS DOUBLE) ELSE 0 END AS seed FROM n2),
moves AS MATERIALIZED (SELECT kind, u, v, {DAMPING} * p AS p, CAST(0 AS DOUBLE) AS own FROM steps
  UNION ALL SELECT kind, host, host, CAST(0 AS DOUBLE), {1 - DAMPING} * seed FROM seeds),
ranks AS (SELECT kind, host, CAST(seed AS DOUBLE) AS r, 0 AS n FROM seeds
  UNION ALL SELECT k.kind, m.v, sum(k.r * m.p + m.own), k.n + 1 FROM ranks k JOIN moves m ON k.kind = m.kind AND k.host = m.u
  WHERE k.n < {ROUNDS} GROUP BY k.kind, m.v, k.n),
bad AS (SELECT host FROM ranks WHERE n = {ROUNDS} GROUP BY host
  HAVING sum(CASE kind WHEN 'd' THEN r ELSE 0 END) > sum(CASE kind WHEN 't' THEN r ELSE 0 END) + {MARGIN})
SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN bad.host IS NOT NULL OR j.host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN bad ON j.host = bad.host
"""
