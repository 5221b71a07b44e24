"""Long passages that several documents share, by seed and extend.

Seeds are winnowed anchors: of every window of WINDOW words the leftmost of the smallest hashes of
its SEED-word grams. Equal windows choose equal anchors at equal places, so documents that share a
window share its anchor. Documents are joined on their anchors; each anchor that another document
has is extended both ways, to the windows around it that chose it, and those are joined again. A
window that a smaller document id also holds is a repeat; windows that overlap or touch are one
maximal repeat. Only spans are kept, and texts meet them again at the end.

Both joins work alike. A task gathers up to FLUSH places and sends each distinct key once, with the
smallest document id that has it there, to the range of keys it falls in; so a passage that a third
of all documents hold arrives once per task and flush, not once per document. A range answers with one
bit per key, and the places, which stayed behind in a stored table, meet the answers of their own
flush. The number of ranges follows the size of the texts.

Defined cases: a NULL text has no words. Rows with one document id are one document, told apart by
a hash of their texts: they do not take words from each other, and repeated rows get equal results.
Documents with a NULL id take no part and keep everything. Texts shorter than a window lose nothing.
An empty table gives no rows; extra columns are carried along and cannot clash. Very long texts are
read in pieces of PIECE bytes. Words are compared by 64-bit hashes, windows by 96 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.llm.common import BLANKS, small_batches, stored, stored_at
from usageledger.session import scratch_path
from usageledger.sinks.files import drop_folder

WINDOW = 13
SEED = 5
PIECE = 1 << 20
FLUSH = 1 << 20
RANGE_BYTES = 64 << 20

_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.RandomState(13).randint(1, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64)
_BLANK = np.isin(np.arange(256), [ord(c) for c in BLANKS])

# Per flush one row of the places, then a row per range with keys; see _Flush.
ASKED = "sender long, part int, keys binary, extra binary, low binary, high_at binary, high binary, ids binary, bodies binary, counts binary, starts binary, spans binary, items binary"
_ASKED = [c.rsplit(" ", 1) for c in ASKED.split(", ")]


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2^64."""
    return np.append(np.uint64(1), np.cumprod(np.full(n - 1, base, dtype=np.uint64)))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def _piece_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie end to end, and how many words each text has."""
    n = len(data)
    inside = ~_BLANK[data]
    before, behind = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    before[1:], behind[:-1] = inside[:-1], inside[1:]
    edges = bounds[(bounds > 0) & (bounds < n)]
    before[edges], behind[edges - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~behind) + 1
    size = 1 << max(10, int(n).bit_length())
    sums = np.append(np.uint64(0), np.cumsum(_BYTE[data] * _powers(_BASE, size)[:n]))
    hashes = (sums[ends] - sums[starts]) * _powers(_INVERSE, size)[starts]
    counts = np.diff(np.searchsorted(starts, bounds))
    return _mixed(hashes + (ends - starts).astype(np.uint64) * _MIX2), counts


def _cut(data: bytes, at: int) -> int:
    """The end of a piece that begins at `at`: behind a blank, unless a word is longer than a piece."""
    if len(data) - at <= PIECE:
        return len(data)
    piece = np.frombuffer(data, dtype=np.uint8, count=PIECE, offset=at)
    blanks = np.flatnonzero(_BLANK[piece])
    if len(blanks):
        return at + int(blanks[-1]) + 1
    for more in range(at + PIECE, len(data), PIECE):
        blanks = np.flatnonzero(_BLANK[np.frombuffer(data[more : more + PIECE], dtype=np.uint8)])
        if len(blanks):
            return more + int(blanks[0]) + 1
    return len(data)


def word_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, word hashes, words per text) of groups of whole texts of about a piece each."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > PIECE:
            parts, place = [], 0
            while place < len(texts[at]):
                end = _cut(texts[at], place)
                part = np.frombuffer(texts[at], dtype=np.uint8, count=end - place, offset=place)
                parts.append(_piece_hashes(part, np.array([0, len(part)]))[0])
                place = end
            whole = np.concatenate(parts)
            yield at, whole, np.array([len(whole)])
            at += 1
            continue
        last, size = at, 0
        while last < len(texts) and size + len(texts[last]) <= PIECE:
            size += len(texts[last])
            last += 1
        bounds = np.cumsum([0, *map(len, texts[at:last])])
        yield at, *_piece_hashes(np.frombuffer(b"".join(texts[at:last]), dtype=np.uint8), bounds)
        at = last


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = (out ^ words[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def winnowed(values: np.ndarray, window: int) -> np.ndarray:
    """For every `window` values in a row the place of the leftmost smallest one."""
    place = np.arange(len(values))
    wide = 1
    while wide < window:
        step = min(wide, window - wide)
        one, two = place[:-step], place[step:]
        place = np.where(values[one] <= values[two], one, two)
        wide += step
    return place


def anchors(words: np.ndarray, counts: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first window, windows) of each anchor of texts that lie end to end."""
    owner = np.repeat(np.arange(len(counts)), counts)
    if len(words) < window:
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    values = grams(words, seed)
    chosen = winnowed(values, window - seed + 1)
    at = np.flatnonzero(owner[: len(chosen)] == owner[window - 1 :])
    chosen = chosen[at]
    # Windows that follow each other in one text and choose the same place share an anchor.
    begins = np.flatnonzero(np.append(True, (np.diff(chosen) != 0) | (owner[at[1:]] != owner[at[:-1]]))) if len(at) else at
    texts = owner[at[begins]]
    first = np.cumsum(counts) - counts
    # The smallest hashes lie at one end of all hashes; mixed again they spread over the ranges.
    return _mixed(values[chosen[begins]]), texts, at[begins] - first[texts], np.diff(np.append(begins, len(at)))


def window_keys(words: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 more bits of the windows that begin at `starts`."""
    one, two = np.zeros(len(starts), dtype=np.uint64), np.zeros(len(starts), dtype=np.uint64)
    for k in range(window):
        word = words[starts + k]
        one = (one ^ word) * _MIX
        one ^= one >> np.uint64(29)
        two = (two + word) * _MIX2
        two ^= two >> np.uint64(31)
    return one, (two >> np.uint64(32)).astype(np.uint32)


class _Flush:
    """Places with keys that a task has gathered, and the rows they become."""

    def __init__(self, ranges: int):
        self.ranges, self.sent = ranges, 0
        self._clear()

    def _clear(self) -> None:
        self.size, self.docs = 0, []
        self.columns: list[tuple] = []

    def add(self, ids: np.ndarray, bodies: np.ndarray, keys: np.ndarray, extra: np.ndarray, texts: np.ndarray, starts: np.ndarray, spans: np.ndarray) -> None:
        self.columns.append((keys, extra, texts + sum(len(i) for i, _ in self.docs), starts.astype(np.int32), spans.astype(np.int32)))
        self.docs.append((ids, bodies))
        self.size += len(keys)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row of the places, and a row of distinct keys per range."""
        if not self.size:
            self._clear()
            return
        sender = (TaskContext.get().partitionId() << 32) + self.sent
        self.sent += 1
        keys, extra, texts, starts, spans = (np.concatenate(c) for c in zip(*self.columns, strict=True))
        ids, bodies = (np.concatenate(c) for c in zip(*self.docs, strict=True))
        used, texts = np.unique(texts, return_inverse=True)
        ids, bodies = ids[used], bodies[used]
        order = np.lexsort((extra, keys))
        new = np.append(True, (np.diff(keys[order]) != 0) | (np.diff(extra[order]) != 0))
        begins = np.flatnonzero(new)
        items = np.empty(len(keys), dtype=np.int32)
        items[order] = np.cumsum(new) - 1
        own = ids[texts[order]]
        low, high = np.minimum.reduceat(own, begins), np.maximum.reduceat(own, begins)
        keys, extra = keys[order][begins], extra[order][begins]
        # Places of one text follow each other.
        counts = np.bincount(texts, minlength=len(ids)).astype(np.int32)
        rows = [(sender, -1, None, None, None, None, None, ids, bodies, counts, starts, spans, items)]
        # Ranges of equal width, in the order of the keys.
        part = (keys >> np.uint64(32)) * np.uint64(self.ranges) >> np.uint64(32)
        edges = np.searchsorted(part, np.arange(self.ranges + 1, dtype=np.uint64))
        for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if b > a:
                more = np.flatnonzero(high[a:b] > low[a:b]).astype(np.int32)
                rows.append((sender, p, keys[a:b], extra[a:b], low[a:b], more, high[a:b][more], None, None, None, None, None, None))
        self._clear()
        for at in range(0, len(rows), 512):
            some = list(zip(*rows[at : at + 512], strict=True))
            packed = [pa.array([None if v is None else v.tobytes() for v in c], pa.binary()) for c in some[2:]]
            yield pa.RecordBatch.from_arrays([pa.array(some[0], pa.int64()), pa.array(some[1], pa.int32()), *packed], [n for n, _ in _ASKED])


def _owners(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    ids, bodies = (part.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2))
    return ids, bodies, part.column(2).cast(pa.binary()).to_pylist()


def _seeds(texts: DataFrame, ranges: int, window: int, seed: int) -> DataFrame:
    """The anchors of (doc_id, body, text), asked for."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Flush(ranges)
        for part in parts:
            ids, bodies, values = _owners(part)
            for at, words, counts in word_hashes(values):
                keys, own, starts, spans = anchors(words, counts, window, seed)
                held.add(ids[at : at + len(counts)], bodies[at : at + len(counts)], keys, np.zeros(len(keys), dtype=np.uint32), own, starts, spans)
                if held.size >= FLUSH:
                    yield from held.rows()
        yield from held.rows()

    return texts.mapInArrow(run, ASKED)


def _extensions(live: DataFrame, ranges: int, window: int) -> DataFrame:
    """The windows around the shared anchors of (doc_id, body, text, starts, spans), asked for."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Flush(ranges)
        for part in parts:
            ids, bodies, values = _owners(part)
            seeds = [[np.frombuffer(v, dtype=np.int32) for v in part.column(k).to_pylist()] for k in (3, 4)]
            for at, words, counts in word_hashes(values):
                first = np.cumsum(counts) - counts
                begins, spans = (s[at : at + len(counts)] for s in seeds)
                own = np.repeat(np.arange(len(counts)), [int(s.sum()) for s in spans])
                begins, spans = np.concatenate(begins).astype(np.int64), np.concatenate(spans).astype(np.int64)
                steps = np.arange(len(own)) - np.repeat(np.cumsum(spans) - spans, spans)
                starts = np.repeat(begins, spans) + steps
                keys, extra = window_keys(words, starts + first[own], window)
                held.add(ids[at : at + len(counts)], bodies[at : at + len(counts)], keys, extra, own, starts, np.ones(len(own), dtype=np.int32))
                if held.size >= FLUSH:
                    yield from held.rows()
        yield from held.rows()

    return live.mapInArrow(run, ASKED)


def _array(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _answers(asked: DataFrame, smaller: bool) -> DataFrame:
    """(sender, part, bits): of each key asked for, whether two documents have it.

    With `smaller`: whether a document with a smaller id has it than the smallest that asks.
    """

    def answer(table: pa.Table) -> pa.Table:
        sizes = [len(k) // 8 for k in table.column("keys").to_pylist()]
        keys, extra, low = _array(table.column("keys"), np.uint64), _array(table.column("extra"), np.uint32), _array(table.column("low"), np.int64)
        high = low.copy()
        offsets = np.repeat(np.cumsum([0, *sizes[:-1]]), [len(h) // 4 for h in table.column("high_at").to_pylist()])
        high[offsets + _array(table.column("high_at"), np.int32)] = _array(table.column("high"), np.int64)
        order = np.lexsort((extra, keys))
        new = np.append(True, (np.diff(keys[order]) != 0) | (np.diff(extra[order]) != 0))
        begins, run = np.flatnonzero(new), np.cumsum(new) - 1
        least, most = np.minimum.reduceat(low[order], begins), np.maximum.reduceat(high[order], begins)
        bits = np.empty(len(keys), dtype=bool)
        bits[order] = least[run] < low[order] if smaller else (least < most)[run]
        packed = [np.packbits(b).tobytes() for b in np.split(bits, np.cumsum(sizes)[:-1])]
        counts = pa.array(sizes, pa.int32())
        return pa.table([table.column("sender"), table.column("part"), counts, pa.array(packed, pa.binary())], names=["sender", "part", "n", "bits"])

    columns = ["sender", "part", "keys", "extra", "low", "high_at", "high"]
    return asked.where("part >= 0").select(*columns).groupBy("part").applyInArrow(answer, "sender long, part int, n int, bits binary")


def _places(asked: DataFrame, answers: DataFrame, finish, schema: str) -> DataFrame:
    """The places of every flush with the answers to its keys, as `finish` makes them rows."""

    def meet(own: pa.Table, told: pa.Table) -> pa.Table:
        ids, bodies = (_array(own.column(c), np.int64) for c in ("ids", "bodies"))
        counts, starts, spans, items = (_array(own.column(c), np.int32) for c in ("counts", "starts", "spans", "items"))
        order = np.argsort(told.column("part").to_numpy())
        packed, sizes = told.column("bits").to_pylist(), told.column("n").to_pylist()
        known = np.concatenate([np.unpackbits(np.frombuffer(packed[i], dtype=np.uint8), count=sizes[i]) for i in order]).astype(bool)
        return finish(ids, bodies, np.repeat(np.arange(len(ids)), counts), starts, spans, items, known)

    own = asked.where("part < 0").select("sender", "ids", "bodies", "counts", "starts", "spans", "items")
    return own.groupBy("sender").cogroup(answers.groupBy("sender")).applyInArrow(meet, schema)


def _shared_seeds(ids, bodies, texts, starts, spans, items, known) -> pa.Table:
    """(doc_id, body, starts, spans): the anchors that another document has too."""
    live = known[items]
    counts = np.bincount(texts[live], minlength=len(ids))
    keep, edges = np.flatnonzero(counts), np.cumsum(counts)[:-1]
    both = [[x.tobytes() for x in np.split(c[live], edges)] for c in (starts, spans)]
    return pa.table(
        [pa.array(ids[keep]), pa.array(bodies[keep]), *[pa.array([b[i] for i in keep], pa.binary()) for b in both]],
        names=["doc_id", "body", "starts", "spans"],
    )


def _maximal(window: int):
    def finish(ids, bodies, texts, starts, spans, items, known) -> pa.Table:
        """(doc_id, body, begins, ends): the repeats of each document, in words."""
        low = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(low, items, ids[texts])
        gone = known[items] | (ids[texts] > low[items])
        texts, starts = texts[gone], starts[gone].astype(np.int64)
        apart = (np.diff(texts) != 0) | (np.diff(starts) > window)
        first, last = (np.flatnonzero(np.append(*x)) if len(texts) else texts for x in ((True, apart), (apart, True)))
        keep, per = np.unique(texts[first], return_counts=True)
        edges = np.cumsum(per)[:-1]
        begins, ends = (np.split(c, edges) if len(keep) else [] for c in (starts[first], starts[last] + window))
        lists = [pa.array([x.tolist() for x in c], pa.list_(pa.int64())) for c in (begins, ends)]
        return pa.table([pa.array(ids[keep]), pa.array(bodies[keep]), *lists], names=["doc_id", "body", "begins", "ends"])

    return finish


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, body, begins, ends): maximal stretches of words that smaller document ids also hold.

    `body` is a hash of the text. Every stretch is a union of windows of `window` words that begin
    in a document with a smaller id; documents without one are left out.
    """
    if not 0 < seed <= window:
        raise ValueError("a seed has at most as many words as a window")
    spark = docs.sparkSession
    small_batches(spark)
    whole = docs[text]
    narrow = docs.where(docs[doc_id].isNotNull() & whole.isNotNull()).select(docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(whole).alias("body"), whole.alias("text"))
    # One number reaches the driver: it makes the ranges as many as the texts need.
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))

    seeds, windows = scratch_path(spark, "repeat-seeds"), scratch_path(spark, "repeat-windows")
    asked = stored_at(_seeds(narrow, ranges, window, seed), seeds)
    found = _places(asked, stored(_answers(asked, False), "repeat-seed-answers"), _shared_seeds, "doc_id long, body long, starts binary, spans binary")
    # Repeated rows have the same anchors: any one of them will do.
    live = stored(found, "repeat-shared").dropDuplicates(["doc_id", "body"])
    drop_folder(spark, seeds)
    once = narrow.join(live.hint("merge"), ["doc_id", "body"]).select("doc_id", "body", "text", "starts", "spans")
    asked = stored_at(_extensions(once, ranges, window), windows)
    found = _places(asked, stored(_answers(asked, True), "repeat-window-answers"), _maximal(window), "doc_id long, body long, begins array<long>, ends array<long>")
    spans = stored(found, "repeat-spans").dropDuplicates(["doc_id", "body"])
    drop_folder(spark, windows)
    return spans


def with_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Every document as `row` with the `begins` and `ends` of its repeats, NULL if it has none."""
    spans = repeats(docs, doc_id, text, window, seed).withColumnsRenamed({"doc_id": "span_id", "body": "span_body"})
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].cast("long").alias("own_id"), F.xxhash64(docs[text]).alias("own_body"))
    # Spans grow with the corpus: one merge join at every size, never a broadcast.
    joined = rows.join(spans.hint("merge"), (F.col("own_id") == F.col("span_id")) & (F.col("own_body") == F.col("span_body")), "left")
    return joined.select("row", "begins", "ends")


def kept_words(text: str | None, begins: list[int] | None, ends: list[int] | None) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by one space) of a text."""
    words = (text or "").encode("utf-8", "replace").split()
    if not begins:
        return len(words), 0, b" ".join(words)
    edges = [0, *(x for pair in zip(begins, ends, strict=True) for x in pair), len(words)]
    kept = [w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]]
    return len(words), len(words) - len(kept), b" ".join(kept)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = with_spans(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), window=window, seed=seed)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made = [kept_words(*r) for r in zip(*(part.column(k).to_pylist() for k in (1, 2, 3)), strict=True)]
            shas = [hashlib.sha256(m[2]).hexdigest() for m in made]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.int64()), pa.array(shas, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    flat = rows.select("row.doc_id", "row.text", "begins", "ends")
    return flat.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """The documents, same columns. Texts that hold repeats become their kept words, joined by one space."""

    @F.pandas_udf("string")
    def kept(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([kept_words(t, list(b), list(e))[2].decode() for t, b, e in zip(texts, begins, ends, strict=True)], dtype="object")

    rows = with_spans(docs, doc_id, text, window, seed)
    own, none = F.col(f"row.`{text}`"), F.array().cast("array<long>")
    rest = F.when(F.col("begins").isNull(), own).otherwise(kept(own, F.coalesce("begins", none), F.coalesce("ends", none)))
    changed = rows.select("row", rest.alias("rest"))
    return changed.select(*[F.col("rest").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
