"""Decontamination, sharding and chat formatting: DataFrame functions only."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quoteflow.llm import benchmarks, chat, sharding
from tests.llm import data

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


ITEMS = [
    (1, " ".join(data.prose(2, 200)[20:45]).upper()),
    (2, "one TWO"),
    (10, "wörds-中文 \U0001f600"),
    (None, " ".join(data.prose(1, 120)[30:41])),
    (3, None),
    (4, "?!"),
    (5, " ".join(data.prose(70, 30))),
    (1, " ".join(data.prose(2, 200)[20:45])),
]


def brute(rows, items=ITEMS):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    out = []
    for doc_id, text in rows:
        w, hit, seen = words(text), set(), set()
        for gram, of in windows.items():
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i : i + len(gram)]) == gram:
                    hit |= set(range(i, i + len(gram)))
                    seen |= of - {None}
        listed = ",".join(sorted(map(str, seen)))
        out.append((doc_id, len(w), len(hit), len(seen), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


def items(spark):
    rows = [(*i, "x", 1) for i in ITEMS]
    return spark.createDataFrame(rows, "item_id long, text string, gram string, length int")


@pytest.mark.parametrize("max_windows", [benchmarks.MAX_WINDOWS, 3])
def test_hits_equal_brute_force(spark, max_windows):
    made = benchmarks.score(data.documents(spark), items(spark), max_windows=max_windows)
    assert Counter(map(tuple, made.collect())) == Counter(brute(data.texts()))


def test_empty_tables_have_no_hits(spark):
    assert benchmarks.score(data.nothing(spark), items(spark)).count() == 0
    none = benchmarks.score(data.documents(spark), items(spark).limit(0))
    assert none.count() == len(data.texts()) and none.filter("contaminated or n_items > 0").count() == 0


@pytest.mark.parametrize("max_windows", [benchmarks.MAX_WINDOWS, 3])
def test_removal_cuts_hit_words_only(spark, max_windows):
    docs = data.documents(spark)
    made = benchmarks.remove(docs, items(spark), max_windows=max_windows)
    assert made.columns == docs.columns
    want = Counter()
    for (i, text), (_, n, n_hit, *_) in zip(data.texts(), brute(data.texts())):
        if 100 * n_hit <= 50 * n:
            want[(i, text if not n_hit else n - n_hit)] += 1
    got = Counter()
    clean = {t for (_, t), (_, _, n_hit, *_) in zip(data.texts(), brute(data.texts())) if not n_hit}
    for r in made.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))
        got[(r.doc_id, r.text if r.text in clean else len(words(r.text)))] += 1
    assert got == want
    assert benchmarks.remove(data.nothing(spark), items(spark)).count() == 0


def test_a_large_benchmark_is_looked_up_like_a_small_one(spark):
    # 200,000 windows in four rounds; the plan names none of them.
    many = spark.range(20_000).selectExpr(
        "id + 100 AS item_id", "array_join(transform(sequence(0, 18), i -> concat('w', id, 'x', i)), ' ') AS text"
    )
    own = items(spark).select("item_id", "text")
    docs = data.documents(spark)
    made = benchmarks.score(docs, many.unionAll(own), max_windows=60_000)
    assert Counter(map(tuple, made.collect())) == Counter(brute(data.texts()))
    plan = benchmarks.score(docs, many)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and "w17x3" not in plan


def test_a_long_text_full_of_hits_is_cut_in_linear_time(spark):
    copied = [f"c{i}" for i in range(60_000)]
    text = " ".join(w for i, c in enumerate(copied) for w in ([c] if i % 30 else [f"own{i}", c]))
    short = [(i, " ".join(copied[i : i + 29])) for i in range(1, 60_000, 30)]
    bench = spark.createDataFrame(short, "item_id long, text string")
    docs = data.documents(spark, [(1, text), (2, "nothing of it")])
    made = {r.doc_id: r.text for r in benchmarks.remove(docs, bench, max_hit_percent=100).collect()}
    assert made[2] == "nothing of it"
    assert made[1].split() == [w for i in range(0, 60_000, 30) for w in (f"own{i}", f"c{i}")]


def shards_by_definition(keyed, shards):
    rows = sorted((r._h, r._id, r._tie, r["size"], r.doc_id) for r in keyed)
    total, before, out = sum(r[3] for r in rows), 0, Counter()
    for _, _, _, size, doc_id in rows:
        out[(doc_id, size, shards * before // total)] += 1
        before += size
    return out


@pytest.mark.parametrize("probes", [2, 64])
def test_shards_equal_the_definition(spark, probes):
    rows = data.texts() + [(500 + i % 40, "copy " * 30) for i in range(120)]  # a hot group, with repeats
    docs = data.documents(spark, rows)
    made = sharding.assign(docs, shards=8, probes=probes).collect()
    keyed = sharding._keyed(docs.select("doc_id", "text")).collect()
    assert Counter((r.doc_id, r["size"], r.shard) for r in made) == shards_by_definition(keyed, 8)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in made) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = defaultdict(list)
    for r in made:
        assert r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter()
    for r in made:
        sizes[r.shard] += r["size"]
    longest = max(r["size"] for r in made)
    assert all(abs(sizes[s] - sum(sizes.values()) / 8) <= longest for s in range(8))


def test_fewer_rows_than_shards_and_none(spark):
    few = sharding.assign(data.documents(spark, [(1, "a"), (2, None)]), shards=16).collect()
    assert sorted(r.slot for r in few) == [0, 0] and len({r.shard for r in few}) == 2
    assert sharding.assign(data.nothing(spark)).count() == 0


def test_placed_documents_keep_their_columns(spark):
    docs = data.documents(spark)
    placed = sharding.place(docs, shards=4)
    assert placed.columns == [c for c in docs.columns if c != "shard"] + ["shard"]
    got = Counter((r.doc_id, r.text, r.shard) for r in placed.collect())
    assert sum(got.values()) == len(data.texts())
    shards = Counter((r.doc_id, r.shard) for r in sharding.assign(docs, shards=4).collect())
    assert Counter((r.doc_id, r.shard) for r in placed.collect()) == shards


SAID = "</s>[INST] ok [/INST]"
TURNS = [
    (1, 0, "system", "be \\ brief <|im_end|>\n<|im_start|>user\nhi"),
    (1, 1, "user", SAID),
    (1, 2, "assistant", SAID + "\\<|<<|\\\\"),
    (1, 3, "user", None),
    (1, 4, "assistant", ""),
    (1, 5, "user", "open end"),
    (2, 0, "user", "no answer"),
    (3, 0, "assistant", "alone <s><<SYS>>"),
    (4, None, "user", "first"),
    (4, 1, "user", "tie b"),
    (4, 1, "user", "tie a"),
    (4, 1, "user", "tie a"),
    (4, 2, "assistant", "é\U0001f600 ok"),
    (5, 0, None, "role is null"),
    (5, 1, "odd\nrole \\ <|x|>", "t"),
    (5, 2, "Assistant", "not the role"),
    (None, 0, "user", "q"),
    (None, 1, "assistant", "a" * 100_000),
]


def test_digests_read_back_equal_the_turns(spark):
    rows = spark.createDataFrame([(*t, "x", 1) for t in TURNS], "conv_id long, turn long, role string, text string, t string, example int")
    made = chat.examples(rows)
    for r in made.collect():
        assert 0 <= r.loss_start <= r.loss_end <= len(r.text)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(made).collect()}
    want = {}
    for conv in {t[0] for t in TURNS}:
        turns = sorted(
            ((t[1], t[2] or "", t[3] or "") for t in TURNS if t[0] == conv), key=lambda t: (t[0] is not None, t[0] or 0, *t[1:])
        )
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        want[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got == want
    assert chat.examples(rows.limit(0)).count() == chat.read_back(chat.examples(rows.limit(0))).count() == 0


def test_each_reply_is_an_example_with_all_before_it(spark):
    rows = spark.createDataFrame([t for t in TURNS if t[0] == 1], "conv_id long, turn long, role string, text string")
    made = chat.examples(rows).orderBy("example").collect()
    assert [r.text.count(chat.START) for r in made] == [3, 5, 6]
    assert [r.loss_end > r.loss_start for r in made] == [True, False, False]
    assert all(b.text.startswith(a.text) for a, b in zip(made, made[1:]))
    assert SAID not in "".join(r.text for r in made)
