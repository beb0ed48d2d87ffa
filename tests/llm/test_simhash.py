import random
import re

import numpy as np
import pytest
import xxhash

from quoteflow.llm import simhash
from tests.llm import data


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, radius=2):
    """fingerprint and component of every (id, fingerprint), by comparing all with all."""
    found = {f for _, f in pairs}
    parent = {f: f for f in found}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in found:
        for b in found:
            if bin(a ^ b).count("1") <= radius:
                parent[root(a)] = root(b)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return sorted([(i, f"{f:016x}", least.get(root(f))) for i, f in pairs], key=repr)


def test_fingerprints_by_definition():
    texts = [t for _, t in data.texts()] + ["ÀB aB c", "a\x1cb c d", "x", "A b", "\n"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t") == 0


def test_fingerprints_of_long_texts_go_in_pieces(monkeypatch):
    text = " ".join(data.prose(1, 1000))
    monkeypatch.setattr(simhash, "_HASHES", 7)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 7])
def test_counters_give_the_pairs_within_the_radius(radius):
    rnd = random.Random(radius)
    made = []
    while len(made) < 300:
        base = rnd.getrandbits(64)
        made += [base] + [base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 9))) for _ in range(6)]
    values = np.array(made[:300], np.uint64)
    first = np.array([rnd.randint(0, 300) for _ in made[:300]])
    last = np.minimum(first + [rnd.randint(0, 200) for _ in made[:300]], 300)
    wanted = {
        (i, j) for i in range(300) for j in range(first[i], last[i]) if bin(made[i] ^ made[j]).count("1") <= radius
    }
    i, j = simhash.within(values, first, last, radius)
    assert len(i) == len(wanted) and set(zip(i.tolist(), j.tolist())) == wanted


def rows_of(frame):
    return sorted([tuple(r) for r in frame.collect()], key=repr)


def test_links_equal_brute_force(spark):
    made = simhash.link(data.documents(spark))
    assert made.columns == ["doc_id", "fingerprint", "component_id"]
    assert rows_of(made) == plain_components([(i, plain_fingerprint(t)) for i, t in data.texts()])
    assert simhash.link(data.nothing(spark)).count() == 0


@pytest.mark.parametrize("block, rows", [(4096, 4096), (9, 16), (4, 1)])
def test_groups_in_blocks_lose_no_link(spark, monkeypatch, block, rows):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "_ROWS", rows)
    rnd = random.Random(block)
    found = {rnd.getrandbits(64) for _ in range(20)} | {0, 1, 3, 2**64 - 1, 1 << 63}
    for base in list(found):
        now = base
        for _ in range(4):  # chains: each within the radius of the one before it
            now ^= sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 3)))
            found.add(now)
    hot = {base for base in range(0, 600, 5)}  # many that agree on most parts
    pairs = list(enumerate(sorted(found | hot)))
    frame = spark.createDataFrame([(f - (f >> 63 << 64),) for _, f in pairs], "fingerprint long")
    edges = simhash._edges(simhash._groups(frame, 2), 2).collect()
    parent = {f: f for _, f in pairs}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for e in edges:
        a, b = e.a % 2**64, e.b % 2**64
        parent[max(root(a), root(b))] = min(root(a), root(b))
    name = {f: i for i, f in pairs}
    assert sorted([(i, f"{f:016x}", name[root(f)]) for i, f in pairs], key=repr) == plain_components(pairs)
