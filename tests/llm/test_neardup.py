import random

import pytest
from brute import near_components, shingle_set
from conftest import pairs

from usageledger.llm import neardup
from usageledger.llm.neardup import components, near_duplicates


def result(frame, percent):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(frame, percent).collect()}


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_all_pairs(spark, percent):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert result(documents, percent) == near_components(pairs(documents), percent)


def test_large_group_of_near_copies(spark):
    # Copies of copies: many are similar only to some of the others.
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(4000)}" for _ in range(150)]]
    for _ in range(400):
        copy = list(rng.choice(texts[-60:] if rng.random() < 0.5 else texts[:5]))
        for _ in range(rng.choice([0, 1, 2, 4, 5])):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        texts.append(copy)
    rng.shuffle(texts)
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    want = near_components(pairs(frame), 85)
    assert len({c for _, c in want.values()}) > 1
    assert result(frame, 85) == want


def test_odd_rows(odd_docs):
    rows = near_duplicates(odd_docs, 85).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        elif r["doc_id"] in (1, 2, 3):
            assert r["n_shingles"] == 0 and r["component_id"] == r["doc_id"] and r["kept"]
        else:
            assert r["n_shingles"] > 0 and r["kept"] == (r["component_id"] == r["doc_id"])
    assert sum(r["doc_id"] == 5 and r["kept"] for r in rows) == 2


def test_empty_table_and_short_texts(spark, documents):
    assert near_duplicates(documents.limit(0)).count() == 0
    frame = spark.createDataFrame([(3, "Same Few"), (1, "same\tfew"), (2, "same few more")], "doc_id long, text string")
    assert result(frame, 85) == {3: (1, 1), 1: (1, 1), 2: (1, 2)}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 200), (500, 501)]
    labels = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for node, label in labels.items():
        groups.setdefault(label, set()).add(node)
    assert sorted(map(len, groups.values())) == [2, 42, 60]


def test_shingles_match_plain_sets(documents):
    for _, text in pairs(documents)[:50]:
        assert len(neardup.shingles(text)) == len(shingle_set(text))


def test_one_row_of_every_group_stays(spark):
    base = " ".join(f"word{i}" for i in range(40))
    other, third = base.replace("word", "term"), base.replace("word", "thing")
    rows = [(1, base), (5, base + " more"), (5, other), (7, third), (7, third), (None, third), (None, third), (9, ""), (9, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, body string")
    kept = sorted(((r["doc_id"], r["text"]) for r in neardup.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(1, base), (5, other), (7, third), (None, third), (9, ""), (9, ""), (None, None)], key=str)
    # The smallest id holds two near copies and is repeated: one row of it stays.
    docs = spark.createDataFrame([(1, base), (1, base + " more"), (1, base), (2, base + " end")], "doc_id long, text string")
    assert [r["doc_id"] for r in neardup.one_of_each(docs).collect()] == [1]
    assert neardup.one_of_each(docs.limit(0)).count() == 0


def test_late_links_join_components(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (7, 7), (8, 7)], "node long, label long")
    late = spark.createDataFrame([(2, 4), (1, 3), (4, 9), (5, 6)], "a long, b long")
    found = neardup._relabelled(labels, late).collect()
    groups = {}
    for r in found:
        groups.setdefault(r["label"], set()).add(r["node"])
    assert len(found) == 9 and sorted(map(sorted, groups.values())) == [[1, 2, 3, 4, 9], [5, 6], [7, 8]]
