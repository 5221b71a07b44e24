"""Substring dedup against a plain version that holds every window."""

import random

import brute
import numpy as np
import pytest
from conftest import pairs
from hypothesis import given, settings
from hypothesis import strategies as st

from usageledger.llm import repeats


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeats.with_spans(docs, **options).select("row.doc_id", "row.text", "begins", "ends").collect()
    window = options.get("window", 13)
    wanted = {}
    for (i, t), (words, gone) in zip(rows, brute.repeated_words(rows, window), strict=True):
        wanted[i, t] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    assert sorted(str((r[0], r[1])) for r in found) == sorted(str(r) for r in rows)
    for r in found:
        n, removed, kept = repeats.kept_words(r["text"], r["begins"], r["ends"])
        assert (n, removed, kept.decode()) == wanted[r["doc_id"], r["text"]]
        spans = list(zip(r["begins"] or [], r["ends"] or [], strict=True))
        assert all(e - b >= window for b, e in spans) and all(e < b for (_, e), (b, _) in zip(spans, spans[1:]))
    return found


def test_word_hashes_tell_words_apart_as_plain_splitting_does(monkeypatch):
    texts = ["", " ", "a", "a b", "b", "ab\ta\x0bb\x0cc\rd\n", "é é 日本語 x", "long" * 400 + " b", "a"]
    for piece in (1 << 20, 7, 64):
        monkeypatch.setattr(repeats, "PIECE", piece)
        seen = {}
        for at, words, counts in repeats.word_hashes([t.encode() for t in texts]):
            ends = np.cumsum(counts)
            for k, (a, b) in enumerate(zip(ends - counts, ends)):
                plain = texts[at + k].encode().split()
                assert len(plain) == b - a
                for w, h in zip(plain, words[a:b].tolist()):
                    assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=60), st.integers(1, 12))
def test_winnowing_takes_the_leftmost_smallest(values, window):
    found = repeats.winnowed(np.array(values, dtype=np.uint64), window)
    wanted = [min(range(i, i + window), key=lambda k: (values[k], k)) for i in range(len(values) - window + 1)]
    assert found.tolist() == wanted


def test_equals_plain_version_on_documents(spark, documents):
    assert any(r["begins"] for r in check(spark, pairs(documents)))


def test_odd_rows(spark, odd_docs):
    check(spark, [(i, t) for i, t in pairs(odd_docs)])
    changed = repeats.without_repeats(odd_docs)
    assert changed.columns == odd_docs.columns
    assert sorted(map(str, pairs(changed))) == sorted(map(str, pairs(odd_docs)))
    assert repeats.digests(odd_docs.limit(0)).collect() == [] and repeats.repeats(odd_docs.limit(0)).collect() == []


def test_overlaps_ties_and_repeated_rows(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(30):
        text = [word() for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            a = rng.randrange(50)
            text += passage[a : a + rng.randrange(5, 40)] + [word()]
        rows.append((rng.randrange(-10, 20), " ".join(text)))
    rows += [rows[3], rows[4], (None, " ".join(passage)), (None, None), (7, " ".join(passage)), (8, " ".join(passage) + " "), (8, " ".join(passage[1:]))]
    check(spark, rows)


def test_texts_of_few_words(spark):
    """Words that repeat everywhere: equal anchors inside one window, windows inside one document."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for i in range(25)] + [(50, "a " * 300), (51, "a " * 13), (52, "a " * 12)]
    check(spark, rows)
    check(spark, rows, window=6, seed=2)
    check(spark, rows[:8], window=3, seed=3)


def test_small_pieces_and_flushes(spark, documents):
    """The same result when every task flushes often and reads its texts in small pieces."""
    from pyspark import cloudpickle

    rows = pairs(documents)[:60]
    rows += [(1000 + i, t) for i, t in rows[:20]]
    held = repeats.FLUSH, repeats.PIECE
    cloudpickle.register_pickle_by_value(repeats)
    try:
        repeats.FLUSH, repeats.PIECE = 300, 900
        check(spark, rows)
    finally:
        repeats.FLUSH, repeats.PIECE = held
        cloudpickle.unregister_pickle_by_value(repeats)


def test_texts_lose_their_repeats(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "x"), (2, f"own words\n{text} end", "y"), (3, "a\n b", "z")], "doc_id long, text string, begins string")
    got = {r["doc_id"]: (r["text"], r["begins"]) for r in repeats.without_repeats(docs).collect()}
    assert got == {1: (text, "x"), 2: ("own words end", "y"), 3: ("a\n b", "z")}
    with pytest.raises(ValueError):
        repeats.repeats(docs, window=4, seed=5)
