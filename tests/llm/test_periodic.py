"""Periodic runs against a version that tries every lag at every place."""

import random
import time
import zlib

import brute
import numpy as np
import pytest
from conftest import SMALL, pairs
from hypothesis import given, settings
from hypothesis import strategies as st

from usageledger.llm import periodic, queries


def check(words):
    found = periodic.runs_of(words)
    assert found == sorted(brute.periodic_runs(words), key=lambda r: (r[0], r[2]))
    assert periodic.kept_words(words, found) == brute.without_runs(words, found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcde"), min_size=1, max_size=14), st.integers(1, 12)), max_size=7))
def test_equals_trying_everything(parts):
    check([w.encode() for unit, times in parts for w in unit * times])


def test_crafted_texts():
    split = lambda s: s.encode().split()
    check([])
    check(split("a " * 23))
    check(split("a " * 24))
    check(split("x " + "a " * 24 + "y"))
    check(split("a b " * 12))
    check(split("a b " * 40 + "a c " * 40))
    check(split(("a b c d e f g h " * 3).strip()))
    check(split(("a b c d e f g h i " * 3).strip()))
    check(split(("a b c d e f g h i " * 3).strip()[:-2]))
    check(split(("a " * 30 + "b ") * 4))
    check(split("a b a b b " * 30 + "a b a b b a b"))
    fibonacci, other = ["a"], ["a", "b"]
    while len(other) < 600:
        fibonacci, other = other, other + fibonacci
    check([w.encode() for w in other])


def test_random_texts_with_planted_tails():
    rng = random.Random(5)
    for n in (1, 5, 30, 100, 400, 900):
        for k in range(6):
            words = [f"w{rng.randrange(2 + n // (1 + 5 * k))}".encode() for _ in range(n)]
            a, p = rng.randrange(n), 1 + rng.randrange(max(1, n // 4))
            check(words[:a] + [words[a + (i - a) % p] for i in range(a, n)])


def test_segments_hold_only_frequent_words():
    rng = np.random.RandomState(2)
    for vocabulary in (3, 40, 200, 900):
        codes = rng.zipf(1.3, 4_000) % vocabulary
        segments = periodic.frequent_segments(codes)
        for (_, end), (start, _) in zip(segments, segments[1:]):
            assert end <= start
        for lo, hi in segments:
            assert hi - lo >= 24 and np.unique(codes[lo:hi], return_counts=True)[1].min() >= 3


def test_a_segment_that_crumbles_at_its_ends_is_quick():
    # Word k loses its third copy when word k - 1 has gone: the ends fall off one by one.
    n = 20_000
    codes = np.concatenate([np.arange(n), np.arange(n) + 1, np.arange(n) + 2])
    begun = time.perf_counter()
    periodic.frequent_segments(codes)
    assert time.perf_counter() - begun < 20


def test_very_long_texts_are_quick():
    begun = time.perf_counter()
    words = [b"a"] * 300_000
    assert periodic.runs_of(words) == [(0, 300_000, 1)]
    unit = [f"{i * i % 9973}".encode() for i in range(9_000)]
    assert periodic.runs_of(unit * 40)[0][:2] == (0, 360_000)
    assert time.perf_counter() - begun < 60


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_operator_keeps_rows_and_spans(spark, odd_docs):
    made = periodic.collapse(odd_docs)
    found = made.select("row.doc_id", "row.text", "row.kept", "runs", "best", "collapsed").collect()
    assert sorted(str(r[:2]) for r in found) == sorted(str(p) for p in pairs(odd_docs))
    for r in found:
        words = (r["text"] or "").encode().split()
        long = len(words) > 20_000
        runs = [(0, len(words), 1)] if long else brute.periodic_runs(words)
        assert [tuple(x) for x in r["runs"]] == sorted(runs, key=lambda x: (x[0], x[2]))
        assert r["collapsed"] == b" ".join(brute.without_runs(words, runs)).decode()
        assert (r["best"] is None) == (not runs) and r["kept"] == "k"
    assert periodic.collapse(odd_docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.collapse(odd_docs, copies=2)


def test_query_is_whole(spark, documents):
    found = queries.REGISTRY["op12_periodic_runs"](spark, SMALL).collect()
    texts = {i: t or "" for i, t in pairs(documents)}
    assert len(found) == documents.count()
    some = 0
    for r in found:
        words = planted(r["doc_id"], texts[r["doc_id"]].encode().split())
        if len(words) > 1_500:
            continue
        runs = sorted(brute.periodic_runs(words), key=lambda x: (x[0], x[2]))
        top = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *top)
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        assert r["runs_sha256"] == brute.sha("".join(f"{a},{b},{c}\n" for a, b, c in runs))
        assert r["collapsed_sha256"] == brute.sha(b" ".join(brute.without_runs(words, runs)).decode())
        some += bool(runs)
    assert some > 5
