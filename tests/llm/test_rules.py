from collections import Counter

import pytest
from brute import text_counts
from conftest import pairs
from pyspark.sql import functions as F

from usageledger.llm import rules

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counted(frame):
    out = rules.statistics(frame).select("row.doc_id", *[f"s.{n}" for n in NAMES])
    return Counter(tuple(r) for r in out.collect())


@pytest.mark.parametrize("which", ["documents", "odd_docs"])
def test_statistics_equal_plain_counts(which, request):
    frame = request.getfixturevalue(which)
    assert counted(frame) == Counter((i, *text_counts(t)) for i, t in pairs(frame))


def test_repeated_windows_overlap(spark):
    texts = ["a " * 9, "a b " * 10, " ".join(map(str, range(12))) + " x " + " ".join(map(str, range(12))), "a b c d e f g h"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert counted(frame) == Counter((i, *text_counts(t)) for i, t in enumerate(texts))


def test_rules_separate_labelled_documents(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    out = rules.judged(documents, labels).select("row.doc_id", "kept", "failed").join(labels, "doc_id").collect()
    bad, good = [r for r in out if r["quality"] == 0], [r for r in out if r["quality"] == 1 and not r["failed"]]
    assert sum(not r["kept"] for r in bad) >= 0.95 * len(bad)
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)


def test_learned_list_is_ordered_and_readable(spark):
    rows = [(i, "bad $$$ text " * 10 if i % 3 == 0 else f"good plain words number {i} " * 2, 0 if i % 3 == 0 else 1) for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    learned = rules.fit(frame, frame)
    assert learned and all(r.literals for r in learned)
    case = rules.fired(learned, F.col("s"))
    fired = rules.statistics(frame).select("row.quality", case.alias("rule")).collect()
    assert all((r["rule"] is not None) == (r["quality"] == 0) for r in fired)


def test_as_many_rules_as_kinds_of_bad_text(spark):
    # Five kinds of bad text, each told from the good ones by a statistic of its own.
    good = lambda i: " ".join(f"plain{chr(97 + (i * 7 + k) % 26)}word" for k in range(30))
    kinds = [lambda i: good(i) + " ####" * 30, lambda i: good(i).upper(), lambda i: "the same line of words\n" * 9, lambda i: "x y z " * 12, lambda i: "Verylongwordswithoutend" * 9]
    rows = [(i, kinds[i % 10](i) if i % 10 < 5 else good(i), int(i % 10 >= 5)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    learned = rules.fit(frame, frame)
    fired = rules.statistics(frame).select("row.quality", rules.fired(learned, F.col("s")).alias("rule")).collect()
    assert len(learned) >= 2 and all((r["rule"] is not None) == (r["quality"] == 0) for r in fired)


def test_odd_rows_and_no_labels(odd_docs, labels):
    out = rules.judged(odd_docs, labels.limit(0)).collect()
    assert len(out) == odd_docs.count()
    assert all(r["kept"] == (not r["failed"]) and r["rule"] is None for r in out)
    assert rules.judged(odd_docs.limit(0), labels).count() == 0


def test_labels_with_nulls_and_contradictions(spark, odd_docs):
    labels = spark.createDataFrame([(None, 0, 0), (4, None, 1), (5, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    sample = rules.labelled_sample(labels).collect()
    assert [tuple(r) for r in sample] == [(5, 1)]
    assert rules.judged(odd_docs, labels).count() == odd_docs.count()


def test_no_python_in_the_plan(documents, labels):
    plan = rules.judged(documents, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
