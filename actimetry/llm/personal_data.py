"""PII by weak supervision.

The four patterns (email, ip, card, phone) give the base spans, which always stay. Other spans
that might be personal data (long digit strings, numbers written without a plus, addresses with ``(at)``) are
candidates, and so are the base spans. Labelers vote on each candidate: a regex of usual
layouts, a gazetteer of prefixes and top-level names, the words around it, its shape and its checksum. They say yes, no or
nothing. Expectation-maximisation estimates the reliability of each labeler from the counts of the
vote patterns over all documents, and a logistic classifier is trained on the posteriors with votes and kind as
features. Candidates that it accepts are added as ``weak`` spans.

The vote patterns are a finite set (3^5 for each kind), so what reaches the driver has a fixed bound; the
texts are read once and the candidates written to the shared folder.

Defined results: a null or empty text has no spans; overlapping kinds are kept apart, a candidate that
touches a base span is not added; repeated rows are read one by one; an empty table gives no rows; only doc_id and
text are read. All scans are linear in the length of the text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actimetry.llm.common import map_text, materialise

# Kinds in report order and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

LABELERS = ("regex", "gazetteer", "context", "shape", "checksum")
_NUMBER = re.compile(r"(?<!\w)[+(]?[0-9][0-9 .()\-]{5,}+")
_AT = re.compile(r"\s?[\[(]\s?at\s?[\])]\s?", re.I)
_DOT = re.compile(r"([A-Za-z0-9-]+)\s?(?:\.|[\[(]\s?dot\s?[\])])\s?[A-Za-z]{2,}(?:\.[A-Za-z]{2,})*", re.I)
_LAYOUT = re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}")
_PLAIN = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}.*|[0-9]+\.[0-9]+|[0-9]{1,3}(?:[ .][0-9]{3})+")
PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "35", "36")
TLDS = frozenset("com net org edu gov info io de fr es uk eu".split())
CUES = frozenset("email mail e-mail contact call phone tel telephone mobile fax card visa mastercard credit ssn address "
                 "correo llamar tarjeta appel carte anruf karte".split())
COUNTER = frozenset("isbn version page total price order item date year id number figure table chapter".split())
_WORDS = re.compile(r"[a-z-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: the local part is the run before it."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > last and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            out.append((s, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def _votes(text: str, kind: int, s: int, e: int) -> int:
    """The vote pattern as one number: the kind (4: none), then each labeler's vote as 0 (no), 1 (nothing) or 2 (yes)."""
    span = text[s:e]
    d = _digits(span)
    regex = 2 if kind < 4 or _LAYOUT.fullmatch(span) else 0 if _PLAIN.fullmatch(span) else 1
    if kind == 0 or not d or "@" in span or _AT.search(span):
        known = span.rpartition(".")[2].lower() in TLDS
        gazetteer, shape, check = (2 if known else 1), 2, 1
    else:
        # an issuer's prefix says nothing about a number whose check digit is wrong
        gazetteer = 2 if (13 <= len(d) <= 19 and d.startswith(PREFIXES) and luhn(d)) or span.startswith("+") else 1 if len(d) < 13 else 0
        shape = 2 if 9 <= len(d) <= 19 else 0
        check = (2 if luhn(d) else 0) if len(d) >= 13 and kind != 1 and "+" not in span else 1
    near = _WORDS.findall(text[max(0, s - 40):s].lower()) + _WORDS.findall(text[e:e + 20].lower())
    context = 2 if any(w in CUES for w in near) else 0 if any(w in COUNTER for w in near) else 1
    code = kind
    for v in (regex, gazetteer, context, shape, check):
        code = code * 3 + v
    return code


def candidates(text: str, base) -> list[tuple[int, int, int]]:
    """(start, end, vote pattern) of the base spans and of what else might be personal data."""
    out = [(s, e, _votes(text, k, s, e)) for k, s, e in base]
    more = []
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            s, e = m.start(), m.start() + len(m.group().rstrip(" .()-"))
            if len(_digits(text[s:e])) >= 7 and not (e < len(text) and (text[e].isalnum() or text[e] == "_")):
                more.append((s, e))
    if "(" in text or "[" in text:
        for m in _AT.finditer(text):
            s = m.start()
            while s and text[s - 1] in _LOCAL:
                s -= 1
            tail = _DOT.match(text, m.end())
            if tail and s < m.start():
                more.append((s, tail.end()))
    return out + [(s, e, _votes(text, 4, s, e)) for s, e in _apart(more, base)]


def _apart(spans: list[tuple[int, int]], base) -> list[tuple[int, int]]:
    """The spans that meet no base span: two sorted lists, read once."""
    taken: list[list[int]] = []
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s <= taken[-1][1]:
            taken[-1][1] = max(e, taken[-1][1])
        else:
            taken.append([s, e])
    out, at = [], 0
    for s, e in sorted(spans):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if at == len(taken) or taken[at][0] >= e:
            out.append((s, e))
    return out


def decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kinds, votes as -1, 0, 1) of vote patterns."""
    v = np.stack([codes // 3 ** (len(LABELERS) - 1 - i) % 3 - 1 for i in range(len(LABELERS))], axis=1)
    return codes // 3 ** len(LABELERS), v


def reliabilities(votes: np.ndarray, n: np.ndarray, steps: int = 100):
    """Expectation-maximisation over vote patterns with their counts: (posterior of each pattern, share of yes
    votes of each labeler among its votes on real and on false candidates)."""
    post = np.clip(0.5 + votes.sum(axis=1) / (2 * votes.shape[1]), 0.05, 0.95)
    yes, cast = votes == 1, votes != 0
    for _ in range(steps):
        rate = []
        for w in (post * n, (1 - post) * n):
            rate.append((w @ yes + 1) / (w @ cast + 2))
        prior = np.clip((post @ n + 1) / (n.sum() + 2), 1e-3, 1 - 1e-3)
        logit = np.log(prior / (1 - prior)) + np.where(yes, np.log(rate[0] / rate[1]), np.where(
            cast, np.log((1 - rate[0]) / (1 - rate[1])), 0.0)).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post, rate


def classifier(codes: np.ndarray, n: np.ndarray) -> dict[int, float]:
    """Probability of each vote pattern: logistic regression on the posteriors, each pattern weighted by its count."""
    if not len(codes):
        return {}
    kinds, votes = decode(codes)
    post, _ = reliabilities(votes, n.astype(float))
    x = np.column_stack([votes == 1, votes == -1, kinds == 0]).astype(float)
    # every pattern as two weighted rows; weights enter through repeated logits
    w = np.sqrt(n / n.max())
    full = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(full.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(full @ b, -30, 30)))
        grad = full.T @ (w * (post - p)) - 1e-3 * b
        hess = (full * (w * p * (1 - p))[:, None]).T @ full + 1e-3 * np.eye(len(b))
        step = np.linalg.solve(hess, grad)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return dict(zip(codes.tolist(), (1 / (1 + np.exp(-np.clip(full @ b, -30, 30)))).tolist()))


def report(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    def run(c):
        out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256", "cands")}
        for t in c["text"]:
            t = t or ""
            base = base_spans(t)
            for k, name in enumerate(KINDS):
                out[f"n_{name}"].append(sum(b[0] == k for b in base))
            shown = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base)
            out["base"].append(shown)
            out["base_sha256"].append(hashlib.sha256(shown.encode()).hexdigest())
            out["cands"].append([{"s": s, "e": e, "code": v} for s, e, v in candidates(t, base)])
        return {"doc_id": c["doc_id"], **out}

    found = materialise(map_text(
        docs.select("doc_id", "text"), run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, "
        "cands array<struct<s:long,e:long,code:long>>"), "personal-data")
    # at most 5 x 3^5 rows
    patterns = found.select(F.explode("cands.code").alias("code")).groupBy("code").count().orderBy("code").toPandas()
    probability = classifier(patterns["code"].to_numpy(dtype=np.int64), patterns["count"].to_numpy(dtype=float))
    taken = [c for c, p in probability.items() if p >= threshold and c >= 4 * 3 ** len(LABELERS)]
    weak = F.array_join(F.transform(
        F.array_sort(F.filter("cands", lambda x: F.array_contains(F.array(*[F.lit(c).cast("long") for c in [-1, *taken]]), x["code"]))),
        lambda x: F.concat_ws(":", F.lit("weak"), x["s"].cast("string"), x["e"].cast("string"))), ",")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(weak != "", weak)).alias("spans"))
