import itertools
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from quoteflow.llm import benchmarks, near, packing, quality, queries, secrets, tokens
from tests.llm import data
from tests.llm.test_near import linked, shingle_set
from tests.llm.test_native import words
from tests.llm.test_text_scans import slow_base

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = queries.default_tokenizer()


def plain_ids():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return lambda text: made.encode(text, add_special_tokens=False).ids


def together(own, texts):
    ids, count = own.many(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(ids, np.cumsum(count))[:-1]]


def test_ids_equal_the_tokenizer():
    rnd, own, ids = random.Random(0), tokens.Tokens(PATH), plain_ids()
    parts = ["a", "B", " ", " ", "\n", "\t", "'s", "'", "!", "1", "é", "\u00a0", "\u3000", "\r\n", "don't", "<|endoftext|>", " '", "ll", "中", "\x1c", "\x85", "\u200b", "word", "River"]
    assert own.cut
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    wanted = [ids(t) for t in texts]
    assert [own.one(t).tolist() for t in texts] == wanted
    assert together(own, texts) == wanted
    # Few texts at once, so that a batch of regular ones only, or of irregular ones only, occurs too.
    for at in range(0, 600, 3):
        assert together(own, texts[at : at + 3]) == wanted[at : at + 3]
    assert together(own, [None, "", "a b"]) == [[], [], ids("a b")] and together(own, []) == []


def test_a_vocabulary_of_another_kind_is_left_to_tokenizers():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own, made = tokens.Tokens(path), Tokenizer.from_file(path)
    made.encode_special_tokens = True
    assert not own.cut
    texts = ["The River  runs\nlow", "", "again"]
    assert together(own, texts) == [made.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("dimensions, bits", [(2, 1), (2, 4), (3, 2), (4, 2)])
def test_the_curve_visits_every_cell_by_unit_steps(dimensions, bits):
    grid = np.array(list(itertools.product(range(2**bits), repeat=dimensions)))
    keys = packing.hilbert(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert set(np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)) == {1}


def check_packed(pieces, rows, length):
    ids = plain_ids()
    wanted = [(i, ids(t or "") + [packing.END_ID]) for i, t in rows]
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    for number, held in sequences.items():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == length or number == len(sequences) - 1
    cuts = defaultdict(Counter)
    for p in pieces:
        cuts[p.doc_id][(p.start, p.length, p.ids_crc32, p.doc_tokens)] += 1
    total = sum(p.length for p in pieces)
    assert total == sum(len(i) for _, i in wanted)
    for doc_id, own in wanted:
        # Of the pieces under this id, a chain that gives the document.
        at = 0
        while at < len(own):
            fits = [
                k
                for k in cuts[doc_id]
                if cuts[doc_id][k]
                and k[0] == at
                and k[3] == len(own)
                and zlib.crc32(np.array(own[at : at + k[1]], "<u4").tobytes()) == k[2]
            ]
            assert fits
            cuts[doc_id][fits[0]] -= 1
            at += fits[0][1]
    assert not any(+c for c in cuts.values())


def test_every_id_lies_in_one_piece(spark):
    rows = data.texts() + [(300 + i, "same text") for i in range(40)]
    pieces = packing.pack(data.documents(spark, rows), PATH, length=64).collect()
    check_packed(pieces, rows, 64)
    assert packing.pack(data.nothing(spark), PATH).count() == 0


def test_like_documents_are_neighbours(spark):
    rows = [(i, " ".join(data.prose(1000 + i // 10, 60, 3))) for i in range(60)]
    pieces = sorted(packing.pack(data.documents(spark, rows), PATH).collect(), key=lambda p: (p.sequence_id, p.offset))
    order = [p.doc_id // 10 for p in pieces if p.start == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) == 5


def stages_by_definition(rows, items):
    """What each of the first four stages keeps, one after another."""
    kept = []
    for i, t in rows:
        values, cleaned = quality.judge(t, quality.Rules())
        if values[6]:
            kept.append((i, cleaned))
    classes, texts = [], sorted(set(kept), key=lambda r: r[0])
    for i, t in texts:
        own = shingle_set(t)
        touching = [c for c in classes if any(linked(own, s) or t == u for _, u, s in c)]
        classes = [c for c in classes if c not in touching] + [sum(touching, []) + [(i, t, own)]]
    kept = [min(c, key=lambda r: r[0])[:2] for c in classes]
    grams = {tuple(w[i : i + 10]) for _, t in items for w in [words(t)] for i in range(len(w) - 9)}
    return kept, grams


def test_stages_equal_brute_force(spark, tmp_path):
    leak = data.prose(77, 30)
    rows = [(i, t) for i, t in data.texts() if i not in (None, 3, 5)]
    rows += [(400 + i, " ".join(data.prose(400 + i, 60) + leak[5:20] + data.prose(500 + i, 60))) for i in range(3)]
    rows += [(410, " ".join(leak)), (420, " ".join(data.prose(420, 40)) + " password=hunter22 " + " ".join(data.prose(421, 40)))]
    data.documents(spark, rows, clashing=False).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, " ".join(leak))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, str(tmp_path))
        made.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs.collect()
        if k < 4:
            assert docs.columns == columns, name
            assert all(r.n_chars == len(r.text) for r in seen[name])
    first = {(r.doc_id, r.text) for r in seen["quality rules"]}
    assert first == {(i, c) for i, t in rows for v, c in [quality.judge(t, quality.Rules())] if v[6]}
    kept, grams = stages_by_definition(rows, items)
    assert {(r.doc_id, r.text) for r in seen["n-gram Jaccard join"]} == set(kept)
    clean = {r.doc_id: r.text for r in seen["benchmark decontamination"]}
    assert 410 not in clean
    for i, t in kept:
        own = words(t)
        hit = {k + d for k in range(len(own) - 9) if tuple(own[k : k + 10]) in grams for d in range(10)}
        if not hit:
            assert clean[i] == t
        elif i in clean:
            assert words(clean[i]) == [w for k, w in enumerate(own) if k not in hit]
    safe = {r.doc_id: r.text for r in seen["secret scans"]}
    assert safe.keys() == clean.keys() and not any(slow_base(t) for t in safe.values())
    assert all(safe[i] == t for i, t in clean.items() if not slow_base(t))
    check_packed(seen["packing"], list(safe.items()), packing.LENGTH)
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(map(tuple, ran.collect())) == Counter(map(tuple, seen["packing"]))


def test_stages_take_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = data.nothing(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_stages_leave_columns_of_any_name_alone(spark, tmp_path):
    spark.createDataFrame([(1, "no such words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = "n_words kept cleaned row key _key id first _chosen chosen clean _clean _first stands n hits".split()
    rows = [(i, " ".join(data.prose(700 + i, 40)) + ".", *[f"{n}-{i}" for n in names]) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    want = sorted(rows)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", *names] and sorted(map(tuple, docs.collect())) == want


def test_stages_take_awkward_rows(spark, tmp_path):
    spark.createDataFrame([(1, None), (None, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, data.documents(spark), str(tmp_path))
        made.collect()


SF = os.environ.get("QUOTEFLOW_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    from tests import oracle

    assert not oracle.differences(spark, oracle.connect(SF), queries.QUERIES[name], queries.ORACLE[name], SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_queries_without_sql_answer_for_every_document(spark, name):
    rows = spark.read.parquet(f"{SF}/documents.parquet").count()
    made = queries.QUERIES[name](spark, SF)
    assert made.select("doc_id").distinct().count() == rows
