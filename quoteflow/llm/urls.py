"""URL filter: host and path rules, and a bit-parallel wildcard automaton for the rest.

Glob rules (``*`` any run, ``?`` any one character) are laid side by side in 64-bit words: one bit
per character of a rule. The Shift-And step moves all rules of all URLs of a batch by one character
at once; a self-loop mask holds the bits in front of a ``*``.

The canonical URL is the host, A-Z in lower case, and the path, without query and fragment.

Defined cases: a null URL or one without ``://`` has an empty host and path, and so an empty
canonical URL; long URLs are matched whole; repeated rows are judged one by one; an empty table
gives an empty result; other columns are kept unless a result has their name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from quoteflow.llm.common import others, per_text

# Fixed values: (verdict, host, path). A rule fits its host and its subdomains, longest rule wins.
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# Globs over the canonical URL: unwanted hosts and pages without prose.
BLOCK_GLOBS = (
    "spam-*",
    "*.spam-*",
    "*cheap-pills*",
    "*casino*",
    "*porn*",
    "*adult-*",
    "*xxx*/*",
    "ads.*",
    "*.ads.*",
    "*doubleclick*",
    "*/login*",
    "*/logout*",
    "*/signup*",
    "*/cart*",
    "*/checkout*",
    "*/search*",
    "*/tag/*",
    "*/wp-admin/*",
    "*/wp-login.???",
    "*/feed/",
    "*.jpg",
    "*.jpeg",
    "*.png",
    "*.gif",
    "*.css",
    "*.js",
    "*.zip",
    "*.exe",
    "*.mp?",
)

FIELDS = [StructField(name, StringType()) for name in ("host", "path", "rule", "verdict", "matched")]

_PARTS = re.compile(r"[^/?#]*")
_PATH = re.compile(r"[^?#]*")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: str | None) -> tuple[str, str]:
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    host = _PARTS.match(url, at + 3)
    return host[0].translate(_LOWER), _PATH.match(url, host.end())[0]


def host_rule(host: str, path: str, rules=HOST_RULES) -> tuple[str, str] | None:
    """The longest fitting rule as its text and verdict; of rules with the same text the first."""
    best = None
    for verdict, of, prefix in rules:
        if (host == of or host.endswith("." + of)) and path.startswith(prefix):
            if best is None or len(of + prefix) > len(best[0]):
                best = (of + prefix, verdict)
    return best


@dataclass
class Automaton:
    """All globs packed into ``words`` 64-bit words a state set."""

    symbols: dict[str, int]  # row of a character in ``masks``; row 0: any other character
    masks: np.ndarray
    first: np.ndarray  # may begin at the first character only
    always: np.ndarray  # rules that begin with *: may begin at any character
    hold: np.ndarray
    accept: list[tuple[int, int, int]]  # (rule, word, bit)
    at_once: list[int]  # rules without a character: bare stars
    empty: list[int]  # the empty rule: matches the empty URL only

    @classmethod
    def of(cls, globs: tuple[str, ...]) -> Automaton:
        literals = sorted({c for g in globs for c in g} - {"*", "?"})
        symbols = {c: i + 1 for i, c in enumerate(literals)}
        total = sum(len(g.replace("*", "")) for g in globs)
        words = max(1, -(-total // 64))
        masks = np.zeros((len(symbols) + 1, words), np.uint64)
        first, always, hold = (np.zeros(words, np.uint64) for _ in range(3))
        accept, at_once, empty, bit = [], [], [], 0
        for rule, glob in enumerate(globs):
            begin = bit
            for c in glob:
                word, one = divmod(bit if c != "*" else bit - 1, 64)
                one = np.uint64(1 << one)
                if c == "*":
                    if bit > begin:
                        hold[word] |= one
                    continue
                if bit == begin:
                    (always if glob.startswith("*") else first)[word] |= one
                if c == "?":
                    masks[:, word] |= one
                else:
                    masks[symbols[c], word] |= one
                bit += 1
            if bit == begin:
                (at_once if glob else empty).append(rule)
            else:
                accept.append((rule, *divmod(bit - 1, 64)))
        return cls(symbols, masks, first, always, hold, accept, at_once, empty)

    def match(self, urls: list[str]) -> np.ndarray:
        """A row of booleans per URL, one per rule."""
        n, rules = len(urls), len(self.accept) + len(self.at_once) + len(self.empty)
        lengths = np.fromiter(map(len, urls), np.int64, n)
        order = np.argsort(-lengths, kind="stable")
        state = np.zeros((n, self.masks.shape[1]), np.uint64)
        shorter = -lengths[order]
        begin = 0
        while begin < n:  # runs of URLs of like length, so that the code table stays near their size
            top = int(lengths[order[begin]])
            end = int(np.searchsorted(shorter, -(top // 2), side="right")) if top else n
            end = max(begin + 1, min(end, begin + max(1, 2_000_000 // max(top, 1))))
            rows = order[begin:end]
            state[rows] = self._run([urls[i] for i in rows], lengths[rows], top)
            begin = end
        out = np.zeros((n, rules), bool)
        for rule, word, bit in self.accept:
            out[:, rule] = (state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1
        out[:, self.at_once] = True
        out[:, self.empty] = (lengths == 0)[:, None]
        return out

    def _run(self, urls: list[str], lengths: np.ndarray, top: int) -> np.ndarray:
        codes = np.zeros((top, len(urls)), np.int32)
        for i, url in enumerate(urls):
            codes[: len(url), i] = [self.symbols.get(c, 0) for c in url]
        state = np.zeros((len(urls), self.masks.shape[1]), np.uint64)
        active = np.searchsorted(-lengths, -np.arange(1, top + 1), side="right")
        one, carry = np.uint64(1), np.uint64(63)
        for t in range(top):
            k = active[t]  # the URLs, longest first, that have a character here
            now = state[:k]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> carry
            # A bit moved out of one rule may land on the first bit of the next: only the begin
            # masks may set those.
            moved &= ~(self.first | self.always)
            moved |= self.always
            if t == 0:
                moved |= self.first
            state[:k] = (moved & self.masks[codes[t, :k]]) | (now & self.hold)
        return state


def judge(pages: DataFrame, host_rules=HOST_RULES, globs: tuple[str, ...] = BLOCK_GLOBS, url: str = "url") -> DataFrame:
    """Rows of ``pages`` (without the URL) with host, path, rule, verdict and the first matching glob."""
    automaton = Automaton.of(tuple(globs))

    def run(urls: list[str | None]):
        split = [parts(u) for u in urls]
        ruled = [host_rule(host, path, host_rules) for host, path in split]
        hits = automaton.match([host + path for host, path in split])
        first = [globs[int(row.argmax())] if row.any() else None for row in hits]
        return [
            [host for host, _ in split],
            [path for _, path in split],
            [r[0] if r else None for r in ruled],
            [r[1] if r else "block" if glob else "allow" for r, glob in zip(ruled, first)],
            first,
        ]

    return per_text(pages, FIELDS, run, others(pages, [f.name for f in FIELDS] + [url]), text=url)
