"""Work that follows the data: buckets of the suffix exchange, spans of personal data; and what the weak spans are worth."""

import random
import sys
import time

import numpy as np
import zstandard

from actimetry.llm import personal_data as P
from actimetry.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string"


def test_dealing_does_not_depend_on_the_number_of_buckets():
    high = np.sort(np.random.default_rng(1).integers(0, 2 ** 63, 3000, dtype=np.uint64) * np.uint64(2))
    took = {}
    for buckets in (16, 1 << 26):
        began = time.perf_counter()
        rows = list(S._bucketed(7, high, high, 64, buckets))
        took[buckets] = time.perf_counter() - began
        assert b"".join(r[2] for r in rows) == high.tobytes() and [r[0] for r in rows] == sorted({r[0] for r in rows})
        assert all(int(v) * buckets >> 64 == r[0] for r in rows for v in np.frombuffer(r[2], dtype=np.uint64))
    assert took[1 << 26] < 0.1
    assert list(S._bucketed(7, high[:0], high[:0], 64, 16)) == []
    small = np.sort(np.random.default_rng(2).integers(0, 2 ** 40, 100, dtype=np.uint64))
    assert {r[0] for r in S._bucketed(1, small, small, 40, 16)} <= set(range(16))


def test_suffix_dedup_leaves_the_session_and_the_catalog_alone(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(i, "a passage that repeats in all of these documents, word for word " * 3 + str(i)) for i in range(40)], SCHEMA)
    df = S.report(docs)
    assert spark.conf.get(key) == before and not [t.name for t in spark.catalog.listTables() if t.name.startswith("suffix")]
    assert df.where("n_removed > 0").count() == 39


def block_passes(blocks, monkeypatch):
    """Every pass of the suffix dedup over blocks of (doc_id, bytes), without Spark; (doc_id, bytes kept) of all, and how often a block was sorted."""
    sorts, plain = [], S.sorted_groups
    monkeypatch.setattr(S, "sorted_groups", lambda raw, at: sorts.append(len(at)) or plain(raw, at))
    parsed = [S.Block([i for i, _ in b], [len(t) for _, t in b], zstandard.ZstdCompressor().compress(b"".join(t for _, t in b))) for b in blocks]

    def asked(answer, given, pack=lambda r: r.tobytes()):
        got = {}
        for k, part in answer([(k, pack(r)) for k, r in enumerate(given) if len(r)] or [(0, b"")]):
            got.setdefault(k, []).append(part)
        return got

    first = asked(S._smaller_elsewhere, [S.chunk_records(b) for b in parsed])
    one = [(b, S._records(first.get(k, []))) for k, b in enumerate(parsed)]
    shared = asked(S._in_two_blocks, [S.keys_in_play(*x) for x in one], S._pack_keys)
    two = [(*x, S._keys(shared.get(k, []))) for k, x in enumerate(one)]
    runs = asked(S._smaller_or_mixed, [S.run_records(*x) for x in two])
    three = [(*x, S._records(runs.get(k, []))) for k, x in enumerate(two)]
    least = asked(S._smaller_elsewhere, [S.string_records(*x) for x in three])
    out = []
    for k, (x, b) in enumerate(zip(three, parsed)):
        gone = S.removed(*x, S._records(least.get(k, [])))
        n, spans = S.spans_of(b, gone)
        for d, (i, t) in enumerate(blocks[k]):
            flags = gone[b.begin[d]:b.end[d]].tolist()
            assert n[d] == sum(flags) and spans[d] == sum(g and not (j and flags[j - 1]) for j, g in enumerate(flags))
            out.append((i, bytes(c for c, g in zip(t, flags) if not g)))
    return out, sorts


def kept_by_brute_force(rows):
    low, out = {}, []
    for i, t in rows:
        for j in range(len(t) - 49):
            low[t[j:j + 50]] = min(low.get(t[j:j + 50], i), i)
    for i, t in rows:
        gone = set()
        for j in range(len(t) - 49):
            if low[t[j:j + 50]] < i:
                gone.update(range(j, j + 50))
        out.append((i, bytes(c for j, c in enumerate(t) if j not in gone)))
    return out


def test_a_block_is_sorted_once(monkeypatch):
    rng = random.Random(11)
    pool = [bytes(rng.choice(b"abcd ") for _ in range(rng.randint(60, 200))) for _ in range(9)]

    def text():
        pick = [rng.choice(pool) for _ in range(rng.randint(1, 4))]
        return b"".join(p[rng.randint(0, 9):len(p) - rng.randint(0, 9)] + bytes([rng.randint(97, 122)]) for p in pick)

    ids = rng.sample(range(-60, 60), 58) + [2 ** 63 - 1, 5, 5, -2 ** 63]      # one id twice, and both ends
    rows = [(i, b"" if k % 11 == 0 else b"short" if k % 11 == 1 else text()) for k, i in enumerate(ids)]
    blocks = [rows[:25], rows[25:26], [(7, b"x" * 49)], [(8, b"")], rows[26:]]
    got, sorts = block_passes(blocks, monkeypatch)
    assert got == kept_by_brute_force([r for b in blocks for r in b]) and sum(sorts) > 1000
    assert len(sorts) <= len(blocks)


def test_strings_are_hashed_without_a_call_each():
    raw = bytes(random.Random(12).choices(b"ab", k=6000))
    at = np.arange(0, len(raw) - 49)
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        a, b = S.string_hashes(raw, at)
    finally:
        sys.setprofile(None)
    assert len(calls) < 300
    assert all((int(x), int(y)) == murmur(raw[p:p + 50]) for p, x, y in zip(at.tolist(), a, b))
    assert len(set(zip(a.tolist(), b.tolist()))) == len({raw[p:p + 50] for p in at.tolist()})


def murmur(s, full=2 ** 64 - 1):
    def turned(x, r):
        return (x << r | x >> (64 - r)) & full

    def mixed(x):
        x = (x ^ x >> 33) * 0xFF51AFD7ED558CCD & full
        x = (x ^ x >> 33) * 0xC4CEB9FE1A85EC53 & full
        return x ^ x >> 33

    a = b = 0
    one, two = 0x87C37B91114253D5, 0x4CF5AD432745937F
    for i in range(0, len(s) // 16 * 16, 16):
        a ^= turned(int.from_bytes(s[i:i + 8], "little") * one & full, 31) * two & full
        a = ((turned(a, 27) + b) * 5 + 0x52DCE729) & full
        b ^= turned(int.from_bytes(s[i + 8:i + 16], "little") * two & full, 33) * one & full
        b = ((turned(b, 31) + a) * 5 + 0x38495AB5) & full
    tail = s[len(s) // 16 * 16:]
    b ^= turned(int.from_bytes(tail[8:], "little") * two & full, 33) * one & full
    a ^= turned(int.from_bytes(tail[:8], "little") * one & full, 31) * two & full
    a, b = a ^ len(s), b ^ len(s)
    a = (a + b) & full
    b = (b + a) & full
    a, b = mixed(a), mixed(b)
    a = (a + b) & full
    return a, (b + a) & full


def test_records_are_ordered_by_all_of_their_fields():
    rng = np.random.default_rng(13)
    rec = S._rec(rng.integers(0, 40, 500), rng.integers(0, 3, 500), rng.integers(-5, 5, 500))
    assert rec[S._order(rec)].tolist() == sorted(rec.tolist())
    low = {}
    for a, b, d in rec.tolist():
        low[a, b] = min(low.get((a, b), d), d)
    assert S._lowest(rec[:100], rec[100:]).tolist() == [low[a, b] for a, b, _ in rec[:100].tolist()]
    assert {(a, b): d for a, b, d in S._merge(rec).tolist()} == low and not len(S._merge(rec[:0]))


def card(rng, ok, prefix):
    body = prefix + "".join(rng.choice("0123456789") for _ in range(15 - len(prefix)))
    good = next(c for c in "0123456789" if P.luhn(body + c))
    return body + (good if ok else str((int(good) + rng.randint(1, 9)) % 10))


def planted(seed=3):
    """(text, spans that are personal data beyond the patterns, numbers that are not)."""
    rng, out = random.Random(seed), []
    for i in range(300):
        kind = i % 6
        if kind == 0:
            out.append((f"write to user{i} (at) mail{i}.example.org for more", [f"user{i} (at) mail{i}.example.org"], []))
        elif kind == 1:
            out.append((f"order {card(rng, False, rng.choice(['4111', '5500', '3400']))} shipped", [], ["order"]))
        elif kind == 2:
            out.append((f"call me at 555-{rng.randint(100, 999)}-{rng.randint(1000, 9999)} today", [], []))
        elif kind == 3:
            out.append((f"card {card(rng, True, '4111')} and mail a{i}@example.com", [], []))
        elif kind == 4:
            out.append((f"id {rng.randint(10 ** 14, 10 ** 15)} of {rng.randint(10 ** 6, 10 ** 7)} rows", [], []))
        else:
            out.append((f"plain words only {i}", [], []))
    return out


def test_weak_spans_on_planted_data(spark):
    rows = planted()
    got = {r.doc_id: r.spans for r in P.report(spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], SCHEMA)).collect()}
    true = found = right = 0
    for i, (text, want, _) in enumerate(rows):
        weak = [text[int(s):int(e)] for k, s, e in (x.split(":") for x in (got[i] or "").split(",") if x) if k == "weak"]
        for w in weak:
            digits = [c for c in w if c.isdigit()]
            assert not (13 <= len(digits) <= 19 and not P.luhn("".join(digits))), w     # not by its prefix alone
        true, found, right = true + len(want), found + len(weak), right + sum(x in weak for x in want)
    assert right == true == 50                                   # every written-out address
    phones = sum("call me at" in t for t, _, _ in rows)
    assert found - right <= phones                               # what else is taken are numbers after a cue


def test_candidates_meet_no_base_span():
    rng = random.Random(5)
    for _ in range(200):
        base = sorted((rng.randrange(4), s, s + rng.randint(1, 9)) for s in rng.sample(range(200), 12))
        spans = [(s, s + rng.randint(1, 12)) for s in rng.sample(range(200), 30)]
        want = sorted((s, e) for s, e in spans if not any(s < be and bs < e for _, bs, be in base))
        assert P._apart(spans, base) == want
    assert P._apart([(1, 2)], []) == [(1, 2)]


def test_a_long_text_takes_linear_time():
    text = "4111 1111 1111 1111, 10.0.0.1 x@y.example 1234567 and 7654321; " * 16_000
    assert len(text) > 1_000_000
    P.candidates(text[:5000], P.base_spans(text[:5000]))
    base = P.base_spans(text)
    began = time.perf_counter()
    spans = [(i * 50, i * 50 + 7) for i in range(20_000)]
    P._apart(spans, base)
    assert time.perf_counter() - began < 0.5
    began = time.perf_counter()
    assert len(P.candidates(text, base)) >= 64_000
    assert time.perf_counter() - began < 20                      # 80,000 candidates with five votes each


def test_the_classifier_follows_reliable_labelers():
    """Patterns of two groups: most labelers agree, one votes at random."""
    codes, n = [], []
    for truth in (0, 2):
        for noise in (0, 2):
            code = 4
            for v in (truth, truth, noise, truth, truth):
                code = code * 3 + v
            codes.append(code)
            n.append(100)
    p = P.classifier(np.array(codes), np.array(n, dtype=float))
    assert [round(p[c]) for c in codes] == [0, 0, 1, 1]
    assert P.classifier(np.zeros(0, np.int64), np.zeros(0)) == {}
