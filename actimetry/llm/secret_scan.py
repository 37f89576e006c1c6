"""Secret scans: fixed patterns plus sliding-window entropy with an allow-list.

The patterns give the base spans. The entropy pass looks at every long unbroken string of
key-like characters, slides a window of ``WINDOW`` characters over it, keeps the count of each
symbol as one character leaves and one enters, and so gets the Shannon entropy of every window
in constant time per step. Each character class (hex, letters and digits, base64-like) has
its own threshold. Windows at or over it join to spans; a span that the allow-list explains is left out.
A piece between ``/`` and ``=`` that holds a placeholder's marker is left out alone: what stands before and after it
counts as strings of their own. What base spans cover is cut out of a span, and every rest that the
allow-list does not explain is kept, however short.

Defined results: a null or empty text has no spans; a very long text costs time in proportion
to its length; repeated rows are scanned one by one; extra columns are ignored by the report and
kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actimetry.llm.common import map_text, neutral, restored

# Kinds in report order and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")      # the runs of [0-9a-f]+ that have 32 or more characters

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# bits per character that a window needs, by class of the candidate string
THRESHOLD = {"hex": 3.0, "alnum": 3.8, "base64": 3.9}
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),
    re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z]+)*"),                  # words, paths and slugs of letters
    re.compile(r"[0-9]+(?:[-_/=+][0-9]+)*"),                      # plain numbers and dates
    re.compile(r"[-=_+/]+"),                                      # rules drawn with one sign
)
PIECE = re.compile(r"[^/=]+")
MARKER = re.compile(r"(?i)example|placeholder|changeme|xxxxx|12345678|abcdefgh")
SIGNS = "-=_+/"
_CLOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]


def char_class(s: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
        return "hex"
    return "alnum" if s.isalnum() else "base64"


def window_entropies(s: str, width: int = WINDOW) -> list[float]:
    """Shannon entropy, in bits, of each window of ``width`` characters (at most ``WINDOW``)."""
    count: dict[str, int] = {}
    total, out = 0.0, []
    for i, ch in enumerate(s):
        c = count.get(ch, 0)
        total += _CLOG[c + 1] - _CLOG[c]
        count[ch] = c + 1
        if i >= width:
            gone = s[i - width]
            c = count[gone]
            total += _CLOG[c - 1] - _CLOG[c]
            count[gone] = c - 1
        if i >= width - 1:
            out.append(math.log2(width) - total / width)
    return out


def allowed(s: str, allow=ALLOW) -> bool:
    return any(a.fullmatch(s) for a in allow)


def _stripped(text: str, a: int, b: int) -> tuple[int, int]:
    s = text[a:b]
    return b - len(s.lstrip(SIGNS)), a + len(s.rstrip(SIGNS))


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """The long strings of key-like characters, without their pieces that hold a marker."""
    for m in CANDIDATE.finditer(text):
        if not MARKER.search(m.group()):
            yield m.span()
            continue
        at = m.start()
        for piece in PIECE.finditer(text, *m.span()):
            if MARKER.search(piece.group()):
                yield _stripped(text, at, piece.start())
                at = piece.end()
        yield _stripped(text, at, m.end())


def entropy_spans(text: str, allow=ALLOW) -> list[tuple[int, int]]:
    """Joined windows over the threshold that hold a digit and a letter, allow-listed ones left out."""
    found: list[tuple[int, int]] = []
    for at, end in candidates(text):
        s = text[at:end]
        if len(s) < WINDOW or allowed(s, allow):
            continue
        least, runs = THRESHOLD[char_class(s)], []
        for i, h in enumerate(window_entropies(s)):
            if h < least:
                continue
            if runs and i <= runs[-1][1]:
                runs[-1][1] = i + WINDOW
            else:
                runs.append([i, i + WINDOW])
        found += [(at + a, at + b) for a, b in runs
                  if not allowed(s[a:b], allow) and re.search("[0-9]", s[a:b]) and re.search("[A-Za-z]", s[a:b])]
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, index of the kind), by start and then kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def _uncovered(text: str, spans, base) -> Iterator[tuple[int, int]]:
    """``spans`` without what ``base`` covers; both are in order."""
    i = 0
    for a, b in spans:
        at, cut, rests = a, False, []
        while i < len(base) and base[i][0] < b:
            s, e, _ = base[i]
            if e > at:
                rests.append((at, s))
                at, cut = e, True
            if e > b:               # may reach into the next span too
                break
            i += 1
        if not cut:
            yield a, b
            continue
        for x, y in [*rests, (at, b)]:
            x, y = _stripped(text, x, max(x, y))
            if x < y and not allowed(text[x:y]):
                yield x, y


def all_spans(text: str, base=None) -> list[tuple[int, int, int]]:
    base = base_spans(text) if base is None else base
    more = [(a, b, 3) for a, b in _uncovered(text, entropy_spans(text), base)]
    return sorted(base + more, key=lambda s: (s[0], s[2])) if more else base


def render(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, digest of the base spans, all spans."""
    def run(cols):
        out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for text in cols["text"]:
            base = base_spans(text or "")
            for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                out[name].append(sum(s[2] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(render(base).encode()).hexdigest())
            out["spans"].append(render(all_spans(text or "", base)))
        return {"doc_id": cols["doc_id"], **out}

    return map_text(docs.select("doc_id", "text"), run,
                    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones joined) replaced by ``mark``; other columns stay.
    A null text stays null. ``n_chars``, where present, follows the new text."""
    plain = neutral(docs, "text", "n_chars")
    cols = plain.columns
    other = [c for c in cols if c != "text"]

    def clean(text):
        if not text:
            return text
        out, at = [], 0
        for a, b, _ in all_spans(text):
            if b <= at:
                continue
            if a >= at:
                out += [text[at:a], mark]
            at = b
        return "".join(out) + text[at:] if out else text

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    done = map_text(plain, lambda c: {**{k: c[k] for k in other}, "text": [clean(t) for t in c["text"]]},
                    schema)
    if "n_chars" in cols:
        done = done.withColumn("n_chars", F.length("text").cast(plain.schema["n_chars"].dataType))
    return done.select(*restored(done, plain, docs))
