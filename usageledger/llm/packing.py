"""Hierarchical packing of documents into training sequences of several lengths.

A document's ids are cut into full windows; what is left is a fragment, routed to the smallest
context tier that holds it (`routed_tier`). Fragments are dealt into groups, and each group packs its tiers
from long to short: a tier's longest fragment opens a window of the tier's length, and its gap is
filled from the queues of the shorter tiers, longest fitting fragment first. If nothing fits, the
shortest waiting fragment is cut to the gap and its rest is routed anew. A shorter tier's windows
are filled to the last id, as a sequence is padded to the longest tier unless its length is a
power of two; so only the last window of a group and gaps below MIN_CUT of the longest tier are
padded. Sequences are dealt to step groups tier by tier, so that groups have about equal token
counts and an equal share of each tier.

Defined cases: a NULL or empty text is a document of the end id alone. Repeated rows are packed
row by row, also under one id; NULL ids pass through. A very long text leaves its full windows
without their ids at once, so a task holds the ids of one text and of a group's fragments. An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.llm.common import small_batches, stored
from usageledger.llm.tokencount import merge_by_rounds
from usageledger.llm.vocabulary import Encoder, batches, vocabulary

WINDOW = 1024
# Context tiers: the window and its halves.
TIERS = 4
# A gap smaller than this is padded rather than filled with a sliver of a document.
MIN_CUT = 16
# Fragments packed together by one task.
GROUP = 2_000
STEP_WINDOWS = 64
# Documents a task remembers to tell copies of one row apart.
REMEMBERED = 200_000
_PIECE = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, copy long, ids binary"
_PLACED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "routed_tier int, tier int, sequence_tokens long, step_group long"
)


def _crc(ids: bytes) -> int:
    return zlib.crc32(ids)


def pieces(docs: DataFrame, vocab_path: str, end_id: int = 0, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Full windows (without ids) and one fragment (with its ids) of every document.

    `copy` is 0 but for rows whose id and text the task has met before; those get numbers of
    their own, so that a row repeated without end is not dealt to one group.
    """
    names = [f.strip().split(" ")[0] for f in _PIECE.split(",")]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(vocabulary(vocab_path), merge_by_rounds)
        end = np.array([end_id], dtype=np.int64)
        task, met = TaskContext.get().partitionId(), {}
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            owners = part.column(0).to_pylist()
            for a, b in batches(texts):
                rows: list[tuple] = []
                for owner, ids in zip(owners[a:b], coder.encode(texts[a:b]), strict=True):
                    data = np.concatenate([ids, end]).astype("<u4")
                    if len(met) >= REMEMBERED:
                        met.clear()
                    key = (owner, _crc(data.tobytes()))
                    before = met[key] = met.get(key, -1) + 1
                    copy = task << 32 | before if before else 0
                    whole = len(data) - len(data) % window
                    for at in range(0, whole, window):
                        rows.append((owner, at, window, len(data), _crc(data[at : at + window].tobytes()), copy, None))
                    if whole < len(data):
                        rest = data[whole:].tobytes()
                        rows.append((owner, whole, len(data) - whole, len(data), _crc(rest), copy, rest))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, _PIECE)


def tiers(window: int = WINDOW) -> list[int]:
    """The context lengths, from long to short."""
    return [window >> k for k in range(TIERS) if window >> k]


def route(length: int, sizes: list[int]) -> int:
    """The place of the smallest tier that holds the length."""
    return max(k for k, size in enumerate(sizes) if size >= length)


def pack_fragments(lengths: list[int], window: int = WINDOW, min_cut: int = MIN_CUT) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows as (tier, [(fragment, from, length)]); a fragment may be cut over windows."""
    sizes = tiers(window)
    # One queue a tier, ascending by (length, fragment, from).
    queues: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    for i, n in enumerate(lengths):
        queues[route(n, sizes)].append((n, i, 0))
    for queue in queues:
        queue.sort()
    out: list[tuple[int, list[tuple[int, int, int]]]] = []
    for own, size in enumerate(sizes):
        while queues[own]:
            n, i, at = queues[own].pop()
            held, gap = [(i, at, n)], size - n
            while gap:
                # Tiers hold disjoint lengths: the first queue with a fragment that fits has the longest.
                fits = next(((queue, k) for queue in queues[own:] if (k := bisect_right(queue, (gap, len(lengths), 0)))), None)
                if fits:
                    queue, k = fits
                    n, i, at = queue.pop(k - 1)
                    held.append((i, at, n))
                    gap -= n
                    continue
                shortest = next((queue for queue in reversed(queues) if queue), None)
                if shortest is None or (own == 0 and gap < min_cut):
                    break
                n, i, at = shortest.pop(0)
                held.append((i, at, gap))
                insort(queues[route(n - gap, sizes)], (n - gap, i, at + gap))
                gap = 0
            out.append((size, held))
    return out


def step_groups(sequences: list[tuple[int, int]], window: int = WINDOW, step_windows: int = STEP_WINDOWS) -> list[int]:
    """The step group of every (tier, tokens): long tiers first, each to the group with the fewest tokens."""
    steps = max(1, round(sum(n for _, n in sequences) / (step_windows * window)))
    loads = [(0, s) for s in range(steps)]
    found = [0] * len(sequences)
    for q in sorted(range(len(sequences)), key=lambda q: (-sequences[q][0], -sequences[q][1], q)):
        load, found[q] = loads[0]
        heapq.heapreplace(loads, (load + sequences[q][1], found[q]))
    return found


def pack(docs: DataFrame, vocab_path: str, end_id: int = 0, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece with its place: sequence, offset, tiers of the piece and of the sequence, step group."""
    small_batches(docs.sparkSession)
    made = stored(pieces(docs, vocab_path, end_id, window, doc_id, text), "packing-pieces")
    groups = -(-made.count() // GROUP) or 1
    dealt = made.withColumn("deal", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "copy"), F.lit(groups)))
    sizes = tiers(window)

    def place(key: tuple, table: pa.Table) -> pa.Table:
        base = key[0].as_py() << 32
        rows = sorted(table.drop_columns(["deal"]).to_pylist(), key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids_crc32"]))
        parts = [r for r in rows if r["ids"] is not None]
        sequences = [(window, [(r, 0, window)]) for r in rows if r["ids"] is None]
        sequences += [(tier, [(parts[i], at, n) for i, at, n in held]) for tier, held in pack_fragments([r["length"] for r in parts], window)]
        totals = [sum(n for _, _, n in held) for _, held in sequences]
        steps = step_groups([(tier, total) for (tier, _), total in zip(sequences, totals, strict=True)], window)
        out = []
        for q, (tier, held) in enumerate(sequences):
            offset = 0
            for r, at, n in held:
                crc = r["ids_crc32"] if n == r["length"] else _crc(r["ids"][4 * at : 4 * (at + n)])
                routed = sizes[route(r["length"], sizes)]
                out.append((r["doc_id"], r["start"] + at, n, crc, r["doc_tokens"], base + q, offset, routed, tier, totals[q], base + steps[q]))
                offset += n
        names = [f.strip().split(" ")[0] for f in _PLACED.split(",")]
        kinds = [pa.int32() if n.endswith("tier") else pa.int64() for n in names]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return dealt.groupBy("deal").applyInArrow(place, _PLACED)
