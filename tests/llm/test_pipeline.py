from collections import Counter

import corpus_pipeline
from brute import line_dedup, near_components, sha
from conftest import SMALL, pairs
from test_packing_topk import check_packing

from usageledger.llm.common import stored


def test_every_stage_on_what_its_predecessor_kept(spark, documents, labels):
    marks = {r["doc_id"]: r for r in labels.collect()}
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before = pairs(docs)
        out = stored(stage(spark, docs, SMALL), f"test-{name}")
        if name == "packing":
            assert check_packing(docs, out.collect()) > 0.95
            continue
        assert out.columns == documents.columns and dict(out.dtypes) == dict(documents.dtypes)
        after = pairs(out)
        if name in ("quality_classifier", "quality_rules"):
            assert not Counter(after) - Counter(before)
            gone = {i for i, _ in before} - {i for i, _ in after}
            good = [i for i in gone if i in marks and marks[i]["quality"] == 1 and len(dict(before)[i].split()) >= 20]
            assert len(good) <= 2
        elif name == "line_dedup":
            assert sorted((i, sha(t)) for i, t in after) == sorted((i, s) for i, _, _, s in line_dedup(before))
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        else:
            want = near_components(before, 80)
            assert sorted(i for i, _ in after) == sorted(i for i, (_, c) in want.items() if i == c)
        docs = out


def test_run_applies_the_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and all(r["length"] > 0 for r in rows)


def test_stages_take_odd_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SMALL), f"odd-{name}")
        if name != "packing":
            assert out.columns == odd_docs.columns
            docs = stored(odd_docs, "odd")
    for name, stage in corpus_pipeline.STAGES:
        assert stored(stage(spark, odd_docs.limit(0), SMALL), f"none-{name}").count() == 0
