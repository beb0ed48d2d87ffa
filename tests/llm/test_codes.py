import hashlib
import math
import random

import numpy as np
import pytest

from quoteflow.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _k string, ERROR int"


def plain(rows, parts=4, entries=256, rounds=4):
    """The result by definition: every part compared with every entry in every round."""
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[k][p] for k in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, c[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        [
            (
                i,
                "".join(f"{k:02x}" for _, k in f),
                e,
                sum(x for x, (_, _, other) in zip(errors, kept) if other == label),
                digest,
            )
            for (i, _, label), f, e in zip(kept, found, errors)
        ],
        key=repr,
    )


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", "k", 1) for r in rows], SCHEMA).repartition(3)


def found(frame):
    assert frame.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted([tuple(r) for r in frame.collect()], key=repr)


def vectors(seed, n, size=8, spread=0.05):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, 0.4) for _ in range(size)] for _ in range(6)]
    return [
        (i, [rnd.choice(middles)[k] + rnd.gauss(0, spread) for k in range(size)], rnd.choice([None, 1, 2, 2, 2]))
        for i in range(n)
    ]


def test_rounds_equal_brute_force(spark):
    rows = vectors(1, 300)
    assert found(codes.quantize(table(spark, rows), entries=16)) == plain(rows, entries=16)


def test_awkward_rows(spark):
    rows = vectors(2, 40, spread=0.0)  # few different vectors: ties everywhere
    rows += rows[:5] + [(3, rows[9][1], None), (None, rows[4][1], 5), (None, rows[3][1], 5)]
    rows += [(50, [0.0] * 8, 1), (51, [-0.0] * 8, 1), (52, [30000.0] * 8, 1), (53, [-30000.0] * 8, None)]
    dropped = [
        (-5, None, 1),
        (-4, [0.1] * 7 + [None], 1),
        (-3, [float("nan")] + [0.1] * 7, 1),
        (-2, [0.1] * 7 + [float("inf")], 1),
    ]
    assert found(codes.quantize(table(spark, rows + dropped))) == plain(rows + dropped)
    # Vectors of another length than the smallest id's, or of none, are dropped too.
    other = [(60, [0.1] * 12, 1), (-9, [0.1] * 6, 1), (-8, [], 1)]
    assert found(codes.quantize(table(spark, rows + other))) == plain(rows)
    for none in ([], dropped):
        assert codes.quantize(table(spark, none)).count() == 0


def test_components_beyond_the_bound_are_held_at_it(spark):
    rows = vectors(3, 12)
    far, held = [(20, [3e38, -3e38] * 4, 1)], [(20, [32768.0, -32768.0] * 4, 1)]
    assert found(codes.quantize(table(spark, rows + far))) == plain(rows + held)


@pytest.mark.parametrize("scale", [50, 2**24])
def test_only_moved_entries_are_compared(scale):
    rnd = np.random.default_rng(scale)
    entries = rnd.integers(-scale, scale, (12, 3))
    parts = np.concatenate([rnd.integers(-scale, scale, (200, 3)), np.repeat(entries, 4, axis=0)])
    everything = np.ones(12, bool)
    code, far = codes.assigned(parts, np.full(len(parts), -1), np.zeros(len(parts), int), entries, everything)
    for _ in range(6):
        moved = rnd.random(12) < 0.3
        entries = np.where(moved[:, None], rnd.integers(-scale, scale, entries.shape), entries)
        entries[3] = entries[5]  # two equal entries: the lower one wins
        moved[3] = True
        code, far = codes.assigned(parts, code, far, entries, moved)
        wanted = [min((int(((p - e) ** 2).sum()), k) for k, e in enumerate(entries)) for p in parts]
        assert list(zip(far.tolist(), code.tolist())) == wanted


def test_parts_whose_entry_stayed_are_compared_with_moved_entries_only(monkeypatch):
    seen, plain_distances = [], codes.distances
    monkeypatch.setattr(codes, "distances", lambda p, e: seen.append((len(p), len(e))) or plain_distances(p, e))
    parts = np.arange(20).reshape(10, 2)
    entries = parts[[0, 4, 9]]
    code, far = codes.assigned(parts, np.full(10, -1), np.zeros(10, int), entries, np.ones(3, bool))
    codes.assigned(parts, code, far, entries, np.array([False, True, False]))
    codes.assigned(parts, code, far, entries, np.zeros(3, bool))
    members = int((code == 1).sum())
    assert seen == [(10, 3), (members, 3), (10 - members, 1)]
