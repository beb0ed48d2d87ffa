"""Quality rules by line-first cleaning: failing lines go, then documents that lost too much.

Every line with a word is judged on its own:

* punctuation: more than ``symbol_percent`` of its characters are symbols, or it is a fragment of
  fewer than ``fragment_words`` words that no sentence punctuation ends;
* navigation: at least ``separators`` menu separators and one for every four words or more;
* boilerplate: a line of at most ``boilerplate_words`` words holding one of the fixed phrases.

A document is rejected when the failing lines hold more than ``lost_percent`` of the characters of
its lines, or when the document-wide base rules fail: fewer than ``min_words`` words, or more than
``repeat_percent`` of the words inside repeated eight-word windows. Everything is computed inside
one task per document, over whole texts.

Defined cases: a null or empty text has no words and is rejected; repeated rows and tied ids are
judged one by one; an empty table gives an empty result; other columns, also ones named like the
results (which win), do not matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField

from quoteflow.llm.common import others, per_text

SYMBOLS = "#*$%&|<>"

# Characters and phrases of the line rules.
LINE_SYMBOLS = "#*$%&|<>!=_~^"
SEPARATORS = "|»›•·"
SENTENCE_ENDS = ".!?:;…\"')]}”’»"
PHRASES = (
    "accept all cookies",
    "back to top",
    "click here",
    "cookie policy",
    "enable javascript",
    "follow us on",
    "leave a comment",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "share this",
    "sign up for our newsletter",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    repeat_percent: int = 30
    window: int = 8
    symbol_percent: int = 10
    fragment_words: int = 3
    separators: int = 3
    boilerplate_words: int = 20
    lost_percent: int = 50


FIELDS = [
    *[
        StructField(name, LongType())
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    ],
    StructField("base_failed", BooleanType()),
    StructField("kept", BooleanType()),
    *[StructField(name, LongType()) for name in ("n_lines", "n_lines_failed", "line_chars", "lost_chars")],
]

_LINE_SYMBOL = re.compile("[" + re.escape(LINE_SYMBOLS) + "]")
_SYMBOL = re.compile("[" + re.escape(SYMBOLS) + "]")
_SEPARATOR = re.compile("[" + re.escape(SEPARATORS) + "]")
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)))
_SPACE = " \t\n\r\x0b\x0c"
# A-Z only, as in SQL translate(): the phrases are ASCII.
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeated_words(words: list, window: int = 8) -> int:
    """How many words lie in a window of ``window`` words (a power of two) that occurs twice or more.

    Windows are numbered exactly by doubling: a window of 2n is the pair of its halves' numbers.
    """
    n = len(words)
    if n <= window:
        return 0
    seen: dict = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    size, kinds = 1, len(seen)
    while size < window:
        pairs = codes[:-size] * kinds + codes[size:]
        distinct, codes = np.unique(pairs, return_inverse=True)
        size, kinds = size * 2, len(distinct)
    repeated = np.flatnonzero(np.bincount(codes)[codes] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, repeated, 1)
    np.add.at(edges, repeated + window, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def line_fails(line: str, n_words: int, rules: Rules) -> bool:
    if 100 * len(_LINE_SYMBOL.findall(line)) > rules.symbol_percent * len(line):
        return True
    if n_words < rules.fragment_words and line.rstrip(_SPACE)[-1] not in SENTENCE_ENDS:
        return True
    marks = len(_SEPARATOR.findall(line))
    if marks >= rules.separators and 4 * marks >= n_words:
        return True
    return n_words <= rules.boilerplate_words and bool(_PHRASE.search(line.translate(_LOWER)))


def judge(text: str | None, rules: Rules) -> tuple[tuple, str]:
    """The values of ``FIELDS`` and the text without its failing lines."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n_words = len(words)
    n_repeat = repeated_words(words, rules.window)
    lines_seen: set[str] = set()
    kept_lines, n_lines, n_failed, n_dup, chars, lost = [], 0, 0, 0, 0, 0
    for line in text.split("\n"):
        in_line = len(line.encode().split())
        if not in_line:
            kept_lines.append(line)
            continue
        n_lines += 1
        chars += len(line)
        if line in lines_seen:
            n_dup += 1
        lines_seen.add(line)
        if line_fails(line, in_line, rules):
            n_failed += 1
            lost += len(line)
        else:
            kept_lines.append(line)
    base_failed = n_words < rules.min_words or 100 * n_repeat > rules.repeat_percent * n_words
    kept = not base_failed and 100 * lost <= rules.lost_percent * chars
    word_chars = len(text) - sum(map(text.count, _SPACE))
    values = (n_words, word_chars, len(_SYMBOL.findall(text)), n_dup, n_repeat, base_failed, kept)
    return values + (n_lines, n_failed, chars, lost), "\n".join(kept_lines) if n_failed else text


def assess(docs: DataFrame, rules: Rules = Rules(), with_text: bool = False) -> DataFrame:
    """Every row of ``docs`` with the values of ``FIELDS``; with ``with_text`` also ``cleaned``."""
    fields = FIELDS + [StructField("cleaned", StringType())] * with_text

    def run(texts: list[str | None]):
        judged = [judge(t, rules) for t in texts]
        columns = list(zip(*[v for v, _ in judged])) or [()] * len(FIELDS)
        return columns + [[c for _, c in judged]] * with_text

    return per_text(docs, fields, run, others(docs, [f.name for f in fields] + ["text"]))


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Accepted documents, in the columns of ``docs``, without their failing lines."""
    row = F.struct(*[F.col(f"`{c}`") for c in others(docs, ["text"])]).alias("row")  # out of the way of other names
    judged = assess(docs.select(row, "text"), rules, with_text=True).filter("kept")
    out = {c: F.col("cleaned") if c.lower() == "text" else F.col(f"row.`{c}`") for c in docs.columns}
    if "n_chars" in out:
        out["n_chars"] = F.length("cleaned").cast(docs.schema["n_chars"].dataType)
    return judged.select(*[out[c].alias(c) for c in docs.columns])
