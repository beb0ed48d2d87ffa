"""Small tables with every awkward case: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

WORDS = "sun rain wind stone river field cloud leaf bird road house light dark green blue old new far near high".split()

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their own columns or results.
CLASHING = "n_words long, KEPT string, spans string, shard int, _k string, row long, key string, size string, hits string, host string, ids string, Class_Id string"


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    rnd = random.Random(seed)
    return [rnd.choice(WORDS) + str(rnd.randrange(vocabulary)) for _ in range(n)]


def texts() -> list[tuple[int | None, str | None]]:
    a, b, c = prose(1, 120), prose(2, 200), prose(3, 60)
    near = list(a)
    near[40] = "changed"
    far = list(a)
    far[::4] = prose(4, len(far[::4]))
    rows: list[tuple[int | None, str | None]] = [
        (7, " ".join(a)),
        (3, " ".join(a)),  # exact copy with a smaller id
        (3, " ".join(a)),  # repeated row
        (11, " ".join(near)),
        (12, "\n".join(far)),
        (5, " ".join(b)),
        (5, " ".join(prose(5, 90))),  # another text under the same id
        (20, " ".join(c + b[50:90] + c)),  # a passage of 40 words out of 5, and one repeated inside
        (21, " \t ".join(prose(6, 13)) + "\r\n"),
        (22, "  " + " ".join(prose(6, 13))),  # the same words, other white space
        (None, " ".join(a)),
        (None, None),
        (30, None),
        (31, ""),
        (32, " \n\t "),
        (33, "one two three"),
        (34, "one two three"),
        (35, "the " * 50),
        (36, " ".join(prose(8, 30_000))),  # long
        (37, " ".join(prose(8, 30_000)[100:200])),
        (-4, "ünïcode wörds ＡＢ 中文 \U0001f600 \x00 \x1c x\u00a0y" * 3),
    ]
    for i in range(12):  # a group of near copies
        words = list(prose(9, 100))
        words[i * 8] = f"v{i}"
        rows.append((100 + i, " ".join(words)))
    return rows


def documents(spark, rows=None, clashing: bool = True):
    rows = texts() if rows is None else rows
    plain = [(i, t, "en", None if k % 3 else "src", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    if not clashing:
        return spark.createDataFrame(plain, COLUMNS)
    extra = (1, "x", "y", 2, "z", 3, "k", "s", "h", "host", "ids", "c")
    return spark.createDataFrame([p + extra for p in plain], f"{COLUMNS}, {CLASHING}")


def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
