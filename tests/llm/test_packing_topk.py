import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from brute import crc, top_k
from conftest import pairs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from usageledger.llm import packing, topk

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_packing(frame, rows):
    library = Tokenizer.from_file(PATH)
    ids = defaultdict(list)
    for i, text in pairs(frame):
        ids[i].append([*library.encode(text or "", add_special_tokens=False).ids, 0])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for i, copies in ids.items():
        # Every id of every row of the document lies in exactly one piece.
        assert sum(r["length"] for r in by_doc[i]) == sum(map(len, copies))
        for r in by_doc[i]:
            a, n = r["start"], r["length"]
            assert n > 0 and any(len(c) == r["doc_tokens"] and a + n <= len(c) and crc(c[a : a + n]) == r["ids_crc32"] for c in copies)
        if len(copies) == 1:
            at = 0
            for r in sorted(by_doc[i], key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]
    used = room = 0
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024 and {r["sequence_tokens"] for r in held} == {at}
        used += at
        room += at if at & (at - 1) == 0 else 1024
    return used / room


@pytest.mark.parametrize("which", ["documents", "odd_docs"])
def test_pieces_cover_every_document(which, request):
    frame = request.getfixturevalue(which)
    share = check_packing(frame, packing.pack(frame, PATH).collect())
    assert share > 0.97 or which == "odd_docs"


def test_a_row_without_end_is_spread(spark):
    text = F.lit("the very same words")
    same = spark.range(6_000).select(F.lit(None).cast("long").alias("doc_id"), text.alias("text")).coalesce(2)
    made = packing.pieces(same, PATH)
    # Only the first copy a task meets has no number of its own.
    assert made.where("copy = 0").count() == 2 and made.select("copy").distinct().count() == 5_999
    packed = packing.pack(same, PATH)
    groups = packed.groupBy(F.shiftright("sequence_id", 32)).count().collect()
    assert len(groups) == 3 and max(g["count"] for g in groups) < 3_000


def test_fragments_fill_windows():
    rng = random.Random(1)
    for lengths in ([rng.randint(1, 1023) for _ in range(2000)], [600] * 500, [1] * 50, [1023] * 9, [], [513, 512], [100] * 700, [300, 1, 2]):
        windows = packing.pack_fragments(lengths)
        taken = defaultdict(list)
        for tier, held in windows:
            assert 0 < sum(n for _, _, n in held) <= tier
            # The fragment that opens a window belongs to its tier, whole or as the rest of a cut.
            assert 2 * held[0][2] > tier or tier == 128
            for i, at, n in held:
                taken[i].append((at, n))
        for i, n in enumerate(lengths):
            at = 0
            for a, m in sorted(taken[i]):
                assert a == at and m > 0
                at += m
            assert at == n
        # Shorter tiers are full but for one window; the longest tier lacks fewer than MIN_CUT ids.
        lacking = [(tier, tier - sum(n for _, _, n in held)) for tier, held in windows]
        assert sum(gap > 0 for tier, gap in lacking if tier < 1024) + sum(gap >= packing.MIN_CUT for tier, gap in lacking if tier == 1024) <= 1
        if len(lengths) >= 500:
            used = [sum(n for _, _, n in held) for _, held in windows]
            assert sum(lengths) > 0.97 * sum(n if n & (n - 1) == 0 else 1024 for n in used)


def test_tiers_route_and_longest_fitting_comes_first():
    assert packing.tiers() == [1024, 512, 256, 128]
    assert [packing.tiers()[packing.route(n, packing.tiers())] for n in (1, 128, 129, 256, 257, 512, 513, 1024)] == [128, 128, 256, 256, 512, 512, 1024, 1024]
    # The gap of 324 takes 300 of the 512 tier, then 24 of the 128 tier; 200 and 56 fill a window of 256.
    assert packing.pack_fragments([700, 300, 200, 56, 24]) == [(1024, [(0, 0, 700), (1, 0, 300), (4, 0, 24)]), (256, [(2, 0, 200), (3, 0, 56)])]
    # Nothing fits 24: the shortest is cut, its rest is routed again.
    assert packing.pack_fragments([1000, 140]) == [(1024, [(0, 0, 1000), (1, 0, 24)]), (128, [(1, 24, 116)])]


def test_tiers_of_pieces_and_sequences(documents):
    rows = packing.pack(documents, PATH).collect()
    of_sequence = defaultdict(list)
    for r in rows:
        of_sequence[r["sequence_id"]].append(r)
    short = [held for held in of_sequence.values() if held[0]["tier"] < 1024]
    assert short and sum(held[0]["sequence_tokens"] < held[0]["tier"] for held in short) <= 1
    for held in of_sequence.values():
        assert len({r["tier"] for r in held}) == 1 and held[0]["sequence_tokens"] <= held[0]["tier"]
        # A gap is filled from the window's tier or shorter ones, except by the cut of a longer rest.
        assert all(r["routed_tier"] <= r["tier"] or r["length"] < r["routed_tier"] for r in held)


def test_step_groups_share_every_tier():
    sequences = [(1024, 1024)] * 640 + [(512, 512)] * 200 + [(256, 256)] * 90 + [(128, 128)] * 41
    groups = packing.step_groups(sequences)
    loads, kinds = Counter(), Counter()
    for (tier, n), g in zip(sequences, groups, strict=True):
        loads[g] += n
        kinds[tier, g] += 1
    assert len(loads) == 12 and max(loads.values()) - min(loads.values()) <= 1024
    for tier in (1024, 512):
        counts = [kinds[tier, g] for g in loads]
        assert max(counts) - min(counts) <= 3


def test_step_groups_are_balanced(documents):
    rows = packing.pack(documents, PATH).select("sequence_id", "sequence_tokens", "step_group").distinct().collect()
    loads = Counter()
    for r in rows:
        loads[r["step_group"]] += r["sequence_tokens"]
    assert max(loads.values()) - min(loads.values()) <= 2 * 1024


def test_empty_packing(documents):
    assert packing.pack(documents.limit(0), PATH).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<float>, rank string")


def found(frame, **more):
    out = topk.top_k(topk.scaled(frame), F.col("vec_id") % 100 == 0, **more).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out)


def test_search_equals_scores_of_all(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    assert found(frame, k=10, block=128) == top_k(rows, 10)


def test_ties_repeats_nulls_and_widths(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(900)]
    rows += [(i, [1.0, 0.5, 0.0, 0.0]) for i in range(1000, 1400)] + rows[:300]
    rows += [(None, [1.0] * 4), (2000, None), (2100, []), (2200, [1.0, None, 0.0, 0.0]), (2300, [1.0, float("nan"), 0.0, 0.0]), (2400, [float("inf")] * 4)]
    rows += [(2500, [1.0, 2.0]), (2501, [3.0, -1.0]), (2600, [0.3] * 3)]
    assert found(vectors(spark, rows), k=10, block=200) == top_k(rows, 10)
    assert found(vectors(spark, rows[:5]), k=10) == top_k(rows[:5], 10)
    assert found(vectors(spark, rows).limit(0), k=10) == []


def test_very_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(2**21 - 3 * i)]) for i in range(150)]
    assert found(vectors(spark, rows), k=3) == top_k([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 3)


def test_cover_radii_cover():
    points = np.random.default_rng(1).normal(size=(700, 8))

    def walk(node):
        rows = node.rows if node.rows is not None else np.concatenate([walk(c) for c in node.children])
        assert np.sqrt(((points[rows] - node.centre) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        return rows

    assert sorted(walk(topk.cover_tree(points)).tolist()) == list(range(700))
