"""BPE encoding and decoding by an index of pair occurrences.

The distinct pre-tokens of a batch lie in one array of symbols. Every mergeable pair is mapped to
all its positions; the active ranks are applied in ascending order, each to all its positions at
once, and the positions of the pairs that arise are added to their lists. A merge only makes pairs
of higher rank, so one ascending sweep gives the ids the library gives.

Defined cases: a NULL or empty text has no ids and decodes to the empty text. Repeated rows are
encoded row by row; NULL ids pass through; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from usageledger.llm.common import small_batches
from usageledger.llm.vocabulary import NONE, Encoder, Vocabulary, batches, vocabulary


def merge_by_index(vocab: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, flat, and how many each word has."""
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    symbols = vocab.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
    n = len(symbols)
    word = np.repeat(np.arange(len(words)), sizes)
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    before[starts] = -1
    after[np.cumsum(sizes)[sizes > 0] - 1] = -1

    places: dict[int, list[np.ndarray]] = defaultdict(list)
    heap: list[int] = []

    def note(at: np.ndarray) -> None:
        """Add the pairs that start at these positions to the lists of their ranks."""
        ranks = vocab.ranks(symbols[at], symbols[after[at]])
        at, ranks = at[ranks != NONE], ranks[ranks != NONE]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        edges = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.concatenate([[0], edges])].tolist(), np.split(at, edges), strict=True):
            if rank not in places:
                heapq.heappush(heap, rank)
            places[rank].append(part)

    note(np.flatnonzero(after >= 0))
    while heap:
        rank = heapq.heappop(heap)
        found = places.pop(rank)
        at = np.unique(np.concatenate(found)) if len(found) > 1 else np.sort(found[0])
        left, right = vocab.left[rank], vocab.right[rank]
        follower = after[at]
        at = at[(symbols[at] == left) & (follower >= 0) & (symbols[follower] == right)]
        if left == right and len(at) > 1:
            # Of a run of overlapping pairs every second one merges, from the left.
            chained = np.concatenate([[False], at[1:] == after[at[:-1]]])
            begins = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - begins) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        beyond = after[gone]
        symbols[at], symbols[gone], after[at] = vocab.merged[rank], -1, beyond
        before[beyond[beyond >= 0]] = at[beyond >= 0]
        ahead = before[at]
        note(np.unique(np.concatenate([ahead[ahead >= 0], at[beyond >= 0]])))

    alive = symbols >= 0
    return symbols[alive], np.bincount(word[alive], minlength=len(words))


def encode_decode(docs: DataFrame, vocab_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): the ids of every text and the text decoded from them."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        coder = Encoder(vocab, merge_by_index)
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            for a, b in batches(texts):
                ids = coder.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(a, b - a), pa.array(ids, pa.list_(pa.int64())), pa.array([vocab.decode(x) for x in ids], pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<long>, decoded string")


def digests(docs: DataFrame, vocab_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), digested where the ids are made."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        coder = Encoder(vocab, merge_by_index)
        decimal = [str(i) for i in range(len(vocab.token_bytes))]
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            counts, shas, decoded = [], [], []
            for a, b in batches(texts):
                for ids in coder.encode(texts[a:b]):
                    counts.append(len(ids))
                    shas.append(hashlib.sha256(",".join([decimal[i] for i in ids.tolist()]).encode()).hexdigest())
                    decoded.append(hashlib.sha256(vocab.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
