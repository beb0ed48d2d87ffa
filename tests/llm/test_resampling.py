import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from quoteflow.llm import resampling
from tests.llm import data


def plain_features(text, longest=1):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return own, [" ".join(own[i : i + k]) for k in range(1, longest + 1) for i in range(len(own) - k + 1)]


def plain(rows, target, longest=1, buckets=10_000, percent=10, least=20):
    """The result by definition, in plain Python."""

    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t, longest)[1])

    s, t = counts(x for _, x in rows), counts(target)
    S, T = sum(s.values()), sum(t.values())
    made = []
    for i, text in rows:
        own, features = plain_features(text, longest)
        weight = 0
        for f in features:
            b = zlib.crc32(f.encode()) % buckets
            weight += math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        made.append([i, len(features), weight, score, None, len(own)])
    able = [m for m in made if m[5] >= least]
    able.sort(key=lambda m: (-m[3], m[0] is None, m[0] or 0, m[1]))
    for rank, m in enumerate(able[: percent * len(able) // 100], 1):
        m[4] = rank
    return sorted([tuple(m[:5]) for m in made], key=repr)


def found(frame):
    assert frame.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted([tuple(r) for r in frame.collect()], key=repr)


def target_of(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


@pytest.mark.parametrize("longest", [1, 2])
def test_rows_equal_brute_force(spark, longest):
    rows = data.texts() + [(500 + i, " ".join(data.prose(i % 7, 25 + i % 3, 30))) for i in range(150)]
    rows += [(600, "ÀB ab-c 1x")] * 3
    target = [" ".join(data.prose(2, 80)), None, "", "AB ab"]
    made = resampling.resample(data.documents(spark, rows), target_of(spark, target), longest)
    assert found(made) == plain(rows, target, longest)


def test_empty_tables(spark):
    none = target_of(spark, [])
    assert resampling.resample(data.nothing(spark), target_of(spark, ["a"])).count() == 0
    assert found(resampling.resample(data.documents(spark), none)) == plain(data.texts(), [])
    short = [(i, "too short") for i in range(30)]
    assert all(r[4] is None for r in found(resampling.resample(data.documents(spark, short, False), none)))


@pytest.mark.parametrize("chunk, few", [(4, 1), (50, 0), (1000, 20)])
def test_the_cutoff_is_the_key_of_the_rank(spark, monkeypatch, chunk, few):
    monkeypatch.setattr(resampling, "CHUNK", chunk)
    monkeypatch.setattr(resampling, "FEW", few)
    rnd = random.Random(chunk)
    # A third of the keys tie in score and id.
    keys = [(rnd.choice([7, 7, rnd.randrange(-50, 50)]), rnd.randrange(3), 1, k) for k in range(300)]
    frame = spark.createDataFrame(keys, "minus long, id long, n_features long, tie long").repartition(3).persist()
    for rank in (1, 30, 150, 299, 300):
        assert resampling.cutoff(frame, rank, len(keys)) == sorted(keys)[rank - 1]


def test_a_weighted_median_discards_a_quarter_on_either_side():
    rnd = random.Random(1)
    for _ in range(200):
        chunks = [[(rnd.randrange(40),) for _ in range(rnd.randint(1, 30))] for _ in range(rnd.randint(1, 12))]
        pivot = resampling.weighted_median([(sorted(c)[(len(c) - 1) // 2], len(c)) for c in chunks])
        every = [k for c in chunks for k in c]
        assert 4 * sum(k <= pivot for k in every) >= len(every) and 4 * sum(k >= pivot for k in every) >= len(every)
