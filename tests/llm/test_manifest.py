"""The manifest against a plain tree, on messy rows and on an empty table."""

from hashlib import sha256
from zlib import crc32

import pytest

from actimetry.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place long, node string, x0 string, path string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(i, source, lang, n, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def lower(t):
    return None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def tree(nodes):
    """(top, for each node the list of (left, right) up to it)."""
    paths, levels = [[] for _ in nodes], [list(nodes)]
    while len(levels[-1]) > 1:
        low = levels[-1]
        for i, path in enumerate(paths):
            at = i // 8 ** (len(levels) - 1)
            run = at // 8 * 8
            path.append(("".join(low[run:at]), "".join(low[at + 1:run + 8])))
        levels.append([h(*low[j:j + 8]) for j in range(0, len(low), 8)])
    return levels[-1][0], paths


def plain(rows):
    groups = {}
    for i, text, lang, source, n in rows:
        other = leaf(i, source, lang, n, lower(text)) if i is not None and crc32(str(i).encode()) % 3 == 0 else None
        groups.setdefault(lang, []).append((i is not None, i or 0, leaf(i, source, lang, n, text), other))
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    for v in langs:
        groups[v].sort(key=lambda g: g[:3])
    tops = {v: tree([g[2] for g in groups[v]]) for v in langs}
    root, over = tree([tops[v][0] for v in langs])
    out = []
    for v, up in zip(langs, over):
        for (known, i, own, other), path in zip(groups[v], tops[v][1]):
            acc = other or own
            for left, right in path + up:
                acc = h(left, acc, right)
            out.append((i if known else None, own, tops[v][0], root, h(*[a + b for a, b in path + up]), acc, acc == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "n", "x", "p") for r in rows], SCHEMA).repartition(3)


def got(spark, rows):
    return sorted((tuple(r) for r in manifest.report(frame(spark, rows)).collect()), key=repr)


def test_manifest_matches_a_plain_tree(spark):
    rows = [(i, f"Text {i} É" * (i % 5), ["en", "de", None, ""][i % 4 if i % 3 else 0], None if i % 7 == 0 else "web", i * 2)
            for i in range(150)]
    rows += [(5, "same", "en", "web", 1)] * 3 + [(5, None, "en", None, None), (None, "A", "en", "web", 1), (None, None, None, None, None)]
    rows += [(1000 + i, "LONG " * 50_000, f"l{i}", "s", 1) for i in range(12)]       # more langs than the fanout, one document each
    want = plain(rows)
    assert got(spark, rows) == want
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("n", [1, 8, 9, 65])
def test_sizes_around_the_fanout(spark, n):
    rows = [(i, "Ab", "en", "s", 2) for i in range(n)]
    assert got(spark, rows) == plain(rows)


def test_one_lang_holds_nearly_all_rows(spark):
    rows = [(i % 40, "Ab", "en", "s", 2) for i in range(400)] + [(7, "x", "de", "s", 1)]
    assert got(spark, rows) == plain(rows)


def test_empty_table_gives_no_rows(spark):
    df = manifest.report(spark.createDataFrame([], SCHEMA))
    assert df.collect() == [] and df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
