"""Token counts by rank-synchronous merging of ragged arrays.

All distinct pre-tokens of a batch are held in one ragged array of symbols. In each round every
sequence applies its own lowest-ranked pair, at all its places, at the same time; sequences
without a mergeable pair leave with the number of their symbols. The rounds end when all have left.

Defined cases: a NULL or empty text has no tokens and no bytes. Repeated rows are counted row by
row; NULL ids pass through; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.llm.common import small_batches
from usageledger.llm.vocabulary import NONE, Encoder, Vocabulary, batches, vocabulary


def merge_by_rounds(vocab: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, flat, and how many each word has."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    symbols = vocab.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)] if words else np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(len(words)), sizes)
    done_symbols: list[np.ndarray] = []
    done_rows: list[np.ndarray] = []
    ranks = np.full(len(symbols), NONE, dtype=np.int64)
    stale = np.arange(len(symbols))
    while len(symbols):
        # Only pairs next to a merge have changed since the last round.
        ranks[stale] = NONE
        inside = stale[stale < len(symbols) - 1]
        inside = inside[row[inside + 1] == row[inside]]
        ranks[inside] = vocab.ranks(symbols[inside], symbols[inside + 1])
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        lowest = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, len(row))))
        over = lowest == NONE
        done_symbols.append(symbols[over])
        done_rows.append(row[over])
        at = np.flatnonzero((ranks == lowest) & ~over)
        if len(at) > 1:
            # Of a run of overlapping pairs every second one merges, from the left.
            chained = np.concatenate([[False], np.diff(at) == 1])
            begins = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - begins) % 2 == 0]
        symbols[at] = vocab.merged[ranks[at]]
        stay = ~over
        stay[at + 1] = False
        place = np.cumsum(stay)[at] - 1
        symbols, row, ranks = symbols[stay], row[stay], ranks[stay]
        near = np.zeros(len(symbols) + 1, dtype=bool)
        near[place] = near[place - 1] = True
        stale = np.flatnonzero(near[:-1])
    if not done_rows:
        return np.zeros(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
    rows = np.concatenate(done_rows)
    order = np.argsort(rows, kind="stable")
    return np.concatenate(done_symbols)[order], np.bincount(rows, minlength=len(words))


def count_tokens(docs: DataFrame, vocab_path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(vocabulary(vocab_path), merge_by_rounds)
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            counts: list[int] = []
            for a, b in batches(texts):
                pieces = coder.pieces(texts[a:b])
                counts += [int(coder.lengths[p].sum()) for p in pieces]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    body = F.coalesce(docs[text], F.lit(""))
    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), F.octet_length(body).cast("long").alias("n_bytes"))
    counted = narrow.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
