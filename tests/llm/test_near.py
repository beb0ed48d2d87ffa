import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from quoteflow.llm import common, graphs, near
from tests.llm import data


def shingle_set(text):
    words = (text or "").encode().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def linked(a, b):
    common = len(a & b)
    return bool(common) and 5 * common >= 4 * (len(a) + len(b) - common)


def brute(rows):
    texts = sorted({t or "" for _, t in rows})
    sets = [shingle_set(t) for t in texts]
    root, links = list(range(len(texts))), Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    at = {t: i for i, t in enumerate(texts)}
    ids = defaultdict(list)
    for i, t in rows:
        if i is not None:
            ids[find(at[t or ""])].append(i)
    copies = Counter(t or "" for _, t in rows)
    return Counter(
        (i, min(ids[find(at[t or ""])], default=None), links[at[t or ""]], copies[t or ""] - 1) for i, t in rows
    )


def found(docs):
    rows = near.join(docs).select("doc_id", "class_id", "n_links", "n_copies").collect()
    return Counter(map(tuple, rows))


def variants(n, seed, length=120):
    """Near copies that are linked to some of each other, not to all."""
    base, rows = data.prose(seed, length), []
    for i in range(n):
        words = list(base)
        for j in range(i % 5):
            words[(i * 7 + j * 31) % length] = f"x{i}{j}"
        rows.append((1000 * seed + i, " ".join(words)))
    return rows


def test_awkward_rows_equal_brute_force(spark):
    assert found(data.documents(spark)) == brute(data.texts())


def test_a_group_of_several_blocks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 16)
    rows = variants(150, 1) + variants(20, 2) + data.texts()
    assert found(data.documents(spark, rows)) == brute(rows)


def test_an_empty_table(spark):
    assert found(data.nothing(spark)) == Counter()
    assert near.one_of_each(data.nothing(spark)).count() == 0


def stands(rows):
    """(id, text) of the row that stands for each class, by comparing all texts with all."""
    texts = sorted({t or "" for _, t in rows})
    sets, group = {t: shingle_set(t) for t in texts}, {t: {t} for t in texts}
    for a in texts:
        for b in texts:
            if group[a] is not group[b] and linked(sets[a], sets[b]):
                group[a] |= group[b]
                for t in group[b]:
                    group[t] = group[a]
    ids = defaultdict(list)
    for i, t in rows:
        ids[t or ""].append(i)
    first = {t: min((i for i in own if i is not None), default=None) for t, own in ids.items()}
    kept = []
    for own in {id(g): g for g in group.values()}.values():
        t = min(own, key=lambda t: (first[t] is None, first[t] or 0, hashlib.md5(t.encode()).digest()))
        kept.append((first[t], t))
    return Counter(kept)


def test_one_row_of_each_class_stays(spark):
    docs = data.documents(spark)
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == stands(data.texts())


def test_unrelated_texts_under_one_id_all_stay(spark):
    rows = [(1, " ".join(data.prose(s, 60))) for s in range(3)] + [(1, " ".join(data.prose(0, 60))), (2, " ".join(data.prose(1, 60)))]
    kept = near.one_of_each(data.documents(spark, rows))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(rows[:3])


def test_a_row_of_each_class_is_found_in_one_shuffle_of_the_texts(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "a b"), (None, None), (None, ""), (None, "c"), (3, "c"), (4, "d")]
    kept = near.one_of_each(data.documents(spark, rows))
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == [
        ("1", "a b"), ("3", "c"), ("4", "d"), ("None", ""),
    ]
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        kept = near.one_of_each(data.documents(spark, rows))
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    # The texts' and the classes'.
    assert plan.count("Exchange hashpartitioning") == 2


def test_wide_rows_go_to_python_in_small_batches(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def rows_of_batches(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    before = spark.conf.get(name)
    sizes = spark.range(0, 5000, 1, 1).mapInArrow(rows_of_batches, "n long")
    with common.small_batches(spark):
        assert max(r.n for r in sizes.collect()) <= 1000
    assert spark.conf.get(name) == before
    seen = {}

    def write(df, label):
        seen[label] = int(spark.conf.get(name))
        return common.stored(df, label)

    monkeypatch.setattr(near, "stored", write)
    near.one_of_each(data.documents(spark, [(1, "a b c d e f g"), (2, "a b c d e f g h")])).collect()
    assert max(seen[x] for x in ("near-rows", "near-pruned", "near-links")) <= 1000
    assert spark.conf.get(name) == before


def test_pruning_drops_hopeless_pairs_and_keeps_links():
    fewest = near.fewest_matches()
    assert sorted(fewest) == list(range(16, 97, 16))
    assert all(0 < m < 0.8 * n for n, m in fewest.items())
    same = np.zeros((2, near.HASHES), np.uint32)
    same[1, 3:] = np.arange(93) % 3 == 0
    i, _ = near.surviving((0, 0, 0, 0), np.zeros(2, int), same)
    assert len(i) == 1
    same[1, 3:] = 1
    i, _ = near.surviving((0, 0, 0, 0), np.zeros(2, int), same)
    assert len(i) == 0


def test_verification_is_exact_at_the_threshold():
    a = np.arange(100, dtype=np.uint64)
    at, below = a[:80], a[:79]
    i, j = near.verified(np.array([0, 0]), np.array([1, 2]), [a, at, below])
    assert list(zip(i, j)) == [(0, 1)]


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    made = graphs.components(spark.createDataFrame(edges, "a int, b int")).collect()
    got = {r.node: r.root for r in made}
    assert len(got) == len(made)
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200: 200, 201: 200, 202: 200}
