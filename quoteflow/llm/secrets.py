"""Secret scan with multipart credential linking.

Strong findings (an assigned password, an access key id, a long hex run) are reported by themselves.
Weak candidates (a named client id, a random-looking string, an endpoint) are harmless alone. Per
document the parts are interval-joined: two parts share a scope when the gap between their intervals
is at most ``reach`` code points. An identifier is reported when a secret shares its scope, a random
string when an identifier does, an endpoint when an identifier and a secret both do.

The join is a binary search over sorted intervals inside the document's task: no shuffle, and a
document with very many parts costs n log n.

Defined cases: null text counts as empty and has no findings; texts are scanned whole; positions are
code points, ends exclusive; repeated rows are scanned one by one; an empty table gives an empty
result; other columns are kept unless a result has their name.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField

from quoteflow.llm.common import others, per_text

# The strong patterns. A shorter match of one is dropped.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS = 6, 20

# Weak candidates.
IDENTIFIER = re.compile(
    r"""(?i:access_?key_?id|client_?id|account_?id|key_?id|user_?name|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]{3,})""",
    re.A,
)
RANDOM = re.compile(r"[A-Za-z0-9+/_-]{32,}")
ENDPOINT = re.compile(r"""(?i:https?|s3|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|amqp|mongodb)://[^\s"'<>]+""", re.A)

KINDS = ("assign", "access", "hex", "identifier", "random", "endpoint")
_STRONG = 3
_RANK = {kind: i for i, kind in enumerate(KINDS)}
_IDENTIFIERS, _SECRETS = {"access", "identifier"}, {"assign", "hex", "random"}

REACH = 200

FIELDS = [
    *[StructField(f"n_{kind}", LongType()) for kind in KINDS[:_STRONG]],
    StructField("base_sha256", StringType()),
    StructField("spans", StringType()),
    StructField("n_linked", LongType()),
]

Span = tuple[int, int, str]


def strong(text: str) -> list[Span]:
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    return found + [(*m.span(), "hex") for m in HEX.finditer(text)]


def looks_random(value: str) -> bool:
    """Digits and letters of both cases, spread like a key rather than like words."""
    if not (re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= 4


def weak(text: str) -> list[Span]:
    found = [(*m.span(), "identifier") for m in IDENTIFIER.finditer(text)]
    found += [(*m.span(), "random") for m in RANDOM.finditer(text) if looks_random(m[0])]
    return found + [(*m.span(), "endpoint") for m in ENDPOINT.finditer(text)]


class Near:
    """Whether an interval has one of these intervals within reach of it."""

    def __init__(self, spans: list[Span], reach: int):
        self.reach = reach
        self.spans = sorted(spans)
        self.starts = [s for s, _, _ in self.spans]
        self.ends, most = [], -1  # greatest end so far: intervals may hold one another
        for _, end, _ in self.spans:
            most = max(most, end)
            self.ends.append(most)

    def of(self, span: Span) -> bool:
        """An interval that starts by end + reach and ends no earlier than start - reach."""
        last = bisect_right(self.starts, span[1] + self.reach)
        return bisect_left(self.ends, span[0] - self.reach) < last


def linked(text: str, base: list[Span], reach: int = REACH) -> list[Span]:
    """Weak candidates whose complementary parts share their scope.

    What overlaps a strong finding is that finding; only an endpoint counts all the same, as one that
    carries its secret.
    """
    inside = Near(base, -1)  # overlapping by a character or more
    candidates = [s for s in weak(text) if s[2] == "endpoint" or not inside.of(s)]
    if not candidates:
        return []
    parts = base + candidates
    by_id = Near([s for s in parts if s[2] in _IDENTIFIERS], reach)
    by_secret = Near([s for s in parts if s[2] in _SECRETS], reach)
    needs = {"identifier": (by_secret,), "random": (by_id,), "endpoint": (by_id, by_secret)}
    return [s for s in candidates if all(near.of(s) for near in needs[s[2]])]


def written(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], _RANK[s[2]], s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Every row of ``docs`` (without its text) with the values of ``FIELDS``."""

    def run(texts: list[str | None]):
        rows = []
        for text in texts:
            base = strong(text := text or "")
            more = linked(text, base, reach)
            counts = Counter(kind for _, _, kind in base)
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            rows.append((*[counts[k] for k in KINDS[:_STRONG]], digest, written(base + more), len(more)))
        return list(zip(*rows)) or [()] * len(FIELDS)

    return per_text(docs, FIELDS, run, others(docs, [f.name for f in FIELDS] + ["text"]))


def redacted(text: str, mark: str, reach: int = REACH) -> str:
    """The text with every maximal run of overlapping or touching findings replaced by ``mark``."""
    base = strong(text)
    out, at = [], 0
    merged: list[list[int]] = []
    for start, end, _ in sorted(base + linked(text, base, reach)):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def redact(docs: DataFrame, mark: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """``docs`` in its own columns with every finding in ``text`` replaced; null texts stay null."""

    def run(texts: list[str | None]):
        return [[t if t is None else redacted(t, mark, reach) for t in texts]]

    row = F.struct(*[F.col(f"`{c}`") for c in others(docs, ["text"])]).alias("row")  # out of the way of other names
    done = per_text(docs.select(row, "text"), [StructField("clean", StringType())], run, ["row"])
    out = {c: F.col("clean") if c.lower() == "text" else F.col(f"row.`{c}`") for c in docs.columns}
    if "n_chars" in out:
        out["n_chars"] = F.length("clean").cast(docs.schema["n_chars"].dataType)
    return done.select(*[out[c].alias(c) for c in docs.columns])
