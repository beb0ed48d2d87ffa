import hashlib
from collections import Counter

import pytest

from quoteflow.llm import substrings
from tests.llm import data


def brute(rows, k=substrings.K):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        if i is not None:
            for at in range(len(words) - k + 1):
                gram = tuple(words[at : at + k])
                first[gram] = min(i, first.get(gram, i))
    out = Counter()
    for i, words in split:
        gone = set()
        for at in range(len(words) - k + 1):
            if i is not None and first[tuple(words[at : at + k])] < i:
                gone.update(range(at, at + k))
        kept = b" ".join(w for at, w in enumerate(words) if at not in gone)
        out[(i, len(words), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


def found(docs):
    rows = substrings.cut(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    return Counter(map(tuple, rows))


def test_awkward_rows_equal_brute_force(spark):
    assert found(data.documents(spark)) == brute(data.texts())


def test_branching_passages_equal_brute_force(spark):
    passage, rows = data.prose(50, 60), []
    for i in range(30):
        cut = passage[i % 7 : 60 - i % 5]
        rows.append((100 - i, " ".join(data.prose(60 + i, 20) + cut + data.prose(90 + i % 3, 25))))
        rows.append((200 + i, " ".join(["a"] * 40 + cut[:20] + ["a"] * 20)))
    assert found(data.documents(spark, rows, clashing=False)) == brute(rows)


def test_texts_under_one_id_do_not_mix_their_pieces(spark):
    w = [f"w{i}" for i in range(20)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:13] + ["junk"])), (2, " ".join(["x"] + w[1:14] + ["junk"]))]
    want = brute(rows)
    assert sorted(n for _, _, n, _ in want) == [0, 13, 13]
    assert found(data.documents(spark, rows, clashing=False)) == want


def test_an_empty_table(spark):
    assert found(data.nothing(spark)) == Counter()


def test_the_kept_words_and_other_columns_come_along(spark):
    made = substrings.cut(data.documents(spark))
    row = made.filter("doc_id = 7").first()
    assert row.kept == "" and row.source == "src" and row.n_removed == 120
    assert [c for c in made.columns if c.lower() == "n_words"] == ["n_words"]


@pytest.mark.parametrize("tamper", [True, False])
def test_a_span_counts_only_if_its_words_are_those_of_the_source(tamper):
    words = [b"w%d" % i for i in range(30)]
    digest = substrings._digest(words if not tamper else words[::-1], 2, 15)
    span = {"start": 2, "length": 15, "digest": digest}
    n, removed, _, _ = substrings._cut(b" ".join(words).decode(), 13, [span], [])
    assert (n, removed) == (30, 0 if tamper else 15)
