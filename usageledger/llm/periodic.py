"""Words that repeat periodically, found by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q and at least max(24, 3q) words that no
neighbouring word extends. Every word of a run occurs at least three times in it. So a word that
occurs less often inside a segment lies in no run of that segment and splits it; the pieces are
counted again, until every word of every segment is frequent there. The segments that survive are
scanned for lags: a run of period q repeats at lag q over at least 2q words and so covers two equal
blocks of q words whose places are multiples of q. Blocks are compared by prefix sums, n/q of them
for a lag and n log n in all; what agrees is extended word by word to its exact ends. Words covered
behind the first period of a run are dropped. Everything is a function of one row: no shuffle.

Defined cases: a NULL text has no words. A text without runs keeps its words, joined by one space. A
NULL id plants nothing. Repeated rows give repeated results, an empty table gives no rows, extra
columns are carried in `row` and cannot clash. Very long texts are handled whole, in memory and time
proportional to n log n.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from usageledger.llm.common import small_batches

COPIES = 3
SHORTEST = 24
# Lags that are scanned at once have at most so many blocks together.
BLOCKS = 1 << 18
_PRIME, _BASE = 2_147_483_647, 1_103_515_245
RUNS = ArrayType(StructType([StructField(n, LongType()) for n in ("start", "length", "period")]))


def frequent_segments(codes: np.ndarray, copies: int = COPIES, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """The stretches in which every word occurs at least `copies` times, however often they are split."""
    out, pending = [], [(0, len(codes))]
    while pending:
        lo, hi = pending.pop()
        if hi - lo < shortest:
            continue
        _, words, counts = np.unique(codes[lo:hi], return_inverse=True, return_counts=True)
        cuts = np.flatnonzero(counts[words] < copies)
        a, b = 0, hi - lo
        order = first = None
        # Pieces of at most half the segment are counted anew. A larger one keeps its counts less
        # what was cut off, so that a segment that only crumbles at its ends is not counted again.
        while len(cuts):
            begins, ends = np.append(a, cuts + 1), np.append(cuts, b)
            long = np.flatnonzero(ends - begins >= shortest)
            most = long[np.argmax((ends - begins)[long])] if len(long) else None
            large = most is not None and 2 * (ends[most] - begins[most]) > hi - lo
            pending += [(lo + int(begins[i]), lo + int(ends[i])) for i in long if not (large and i == most)]
            if not large:
                a = b
                break
            x, y = int(begins[most]), int(ends[most])
            if order is None:
                order, first = np.argsort(words, kind="stable"), np.append(0, np.cumsum(counts))
            gone, times = np.unique(np.concatenate([words[a:x], words[y:b]]), return_counts=True)
            counts[gone] -= times
            a, b = x, y
            rare = gone[(counts[gone] > 0) & (counts[gone] < copies)]
            places = [order[first[w] : first[w + 1]] for w in rare.tolist()]
            inside = [p[np.searchsorted(p, a) : np.searchsorted(p, b)] for p in places]
            cuts = np.sort(np.concatenate(inside)) if inside else np.zeros(0, dtype=np.int64)
        if b > a:
            out.append((lo + a, lo + b))
    return sorted(out)


def _powers(n: int) -> np.ndarray:
    """The first n powers of the base modulo the prime."""
    out = np.ones(1, dtype=np.uint64)
    step = np.uint64(_BASE)
    while len(out) < n:
        out = np.concatenate([out, out * step % np.uint64(_PRIME)])
        step = step * step % np.uint64(_PRIME)
    return out[:n]


@lru_cache(maxsize=4096)
def _prime_divisors(n: int) -> tuple[int, ...]:
    found, d = [], 2
    while d * d <= n:
        if n % d == 0:
            found.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return tuple(found + [n] if n > 1 else found)


class _Blocks:
    """Equality of blocks of words, up to rare false alarms; the caller looks at the words."""

    def __init__(self, words: np.ndarray):
        prime = np.uint64(_PRIME)
        mixed = (words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % prime
        self.power = _powers(len(words) + 1)
        self.sums = np.append(np.uint64(0), np.cumsum(mixed * self.power[:-1] % prime)) % prime

    def repeated(self, lags: range) -> tuple[np.ndarray, np.ndarray]:
        """(lag, place) of the blocks of `lag` words, at multiples of the lag, that equal the next block."""
        prime, sums, each = np.uint64(_PRIME), self.sums, np.arange(lags.start, lags.stop)
        per = (len(sums) - 1) // each - 1
        lag = np.repeat(each, per)
        place = (np.arange(len(lag)) - np.repeat(np.cumsum(per) - per, per)) * lag
        one = (sums[place + lag] + prime - sums[place]) % prime * self.power[lag] % prime
        two = (sums[place + 2 * lag] + prime - sums[place + lag]) % prime
        same = one == two
        return lag[same], place[same]


class _Stretches:
    """The stretches found so far, by lag. Within one lag they come in ascending order."""

    def __init__(self):
        self.begins: dict[int, list[int]] = {}
        self.ends: dict[int, list[int]] = {}

    def note(self, lag: int, begin: int, end: int) -> bool:
        """Remember a stretch; whether it is new."""
        begins = self.begins.setdefault(lag, [])
        if begins and begins[-1] >= begin:
            return False
        begins.append(begin)
        self.ends.setdefault(lag, []).append(end)
        return True

    def of_shorter_period(self, lag: int, x: int, y: int) -> tuple[int, int] | None:
        """The stretch that holds x to y and whose period divides the lag, if there is one."""
        for prime in _prime_divisors(lag):
            begins = self.begins.get(lag // prime, [])
            at = bisect_right(begins, x) - 1
            if at >= 0 and self.ends[lag // prime][at] >= y:
                return begins[at], self.ends[lag // prime][at]
        return None


def _lag_batches(n: int, longest: int) -> Iterator[range]:
    first, blocks = 1, 0
    for lag in range(1, longest + 1):
        blocks += n // lag
        if blocks >= BLOCKS or lag == longest:
            yield range(first, lag + 1)
            first, blocks = lag + 1, 0


def _stretch(words: np.ndarray, lag: int, x: int, y: int) -> list[tuple[int, int]]:
    """Maximal stretches of period `lag` that touch the blocks from x to y, as [begin, end)."""
    lo, hi = max(0, x - lag), min(len(words) - lag, y + lag)
    differ = np.flatnonzero(words[lo:hi] != words[lo + lag : hi + lag]) + lo
    begins, ends = np.append(lo, differ + 1), np.append(differ, hi)
    wide = (ends - begins >= lag) & (ends > begins)
    return [(int(b), int(e) + lag) for b, e in zip(begins[wide], ends[wide], strict=True)]


def segment_runs(words: np.ndarray, copies: int = COPIES, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one segment."""
    blocks, stretches, runs = _Blocks(words), _Stretches(), []
    for lags in _lag_batches(len(words), len(words) // copies):
        lag, place = blocks.repeated(lags)
        if not len(lag):
            continue
        begins = np.append(0, np.flatnonzero((np.diff(lag) != 0) | (np.diff(place) != lag[1:])) + 1)
        lasts = np.append(begins[1:], len(lag)) - 1
        for q, x, y in zip(lag[begins].tolist(), place[begins].tolist(), place[lasts].tolist(), strict=True):
            # Blocks x to y and the one behind agree. With a shorter period too they are no run of
            # this lag, and the stretch is kept for the multiples of the lag.
            shorter = stretches.of_shorter_period(q, x, y + 2 * q)
            if shorter:
                stretches.note(q, *shorter)
                continue
            for begin, end in _stretch(words, q, x, y + q):
                if end - begin >= max(shortest, copies * q) and stretches.note(q, begin, end):
                    runs.append((begin, end - begin, q))
    return runs


def runs_of(words: list[bytes], copies: int = COPIES, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of words, by start and then period."""
    if len(words) < shortest:
        return []
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    out = []
    for lo, hi in frequent_segments(codes, copies, shortest):
        out += [(lo + start, length, period) for start, length, period in segment_runs(codes[lo:hi], copies, shortest)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run covers behind its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length over period; ties go to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with, in every tenth document by a hash of its id, a tail that repeats."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def collapse(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    copies: int = COPIES,
    shortest: int = SHORTEST,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Every document as `row` with its `runs`, the `best` of them and its `collapsed` text.

    `prepare` maps the id and the words of a document to the words that are searched. A run of
    period q has at least max(shortest, copies x q) words; `copies` is 3 or more.
    """
    if copies < 3:
        raise ValueError("a run repeats at least three times")
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    at = docs.columns.index(doc_id), docs.columns.index(text)
    one = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    fields = lambda run: dict(zip(("start", "length", "period"), run, strict=True))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            row = part.column(0)
            ids, texts = (row.field(i).to_pylist() for i in at)
            every, best, kept = [], [], []
            for own, value in zip(ids, texts, strict=True):
                words = (value or "").encode("utf-8", "replace").split()
                words = prepare(own, words) if prepare else words
                runs = runs_of(words, copies, shortest)
                every.append([fields(r) for r in runs])
                best.append(fields(top) if (top := best_run(runs)) else None)
                kept.append(b" ".join(kept_words(words, runs)).decode())
            columns = [pa.array(every, pa.list_(one)), pa.array(best, one), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([row, *columns], ["row", "runs", "best", "collapsed"])

    schema = StructType([rows.schema["row"], StructField("runs", RUNS), StructField("best", RUNS.elementType), StructField("collapsed", StringType())])
    return rows.mapInArrow(run, schema)
