"""Fill-in-middle rewriting of documents at line boundaries.

A text is cut into lines, each with its line feed. The offsets at which lines end form a Roaring-style
set: containers of 2^16 offsets, each an array, a bitmap or a list of runs, whichever is smallest,
with the cumulative cardinalities beside them. Two hashed line numbers choose the cuts; each is
looked up by a search over the cumulative cardinalities and a select inside one container. The
middle goes to the end, behind sentinels: psm is prefix, suffix, middle; spm suffix, prefix, middle.
Everything is a function of one row, so nothing is shuffled.

Defined cases: a NULL text is an empty one; empty texts and texts that hold a sentinel stay plain,
and plain output is the text. A NULL id hashes as the empty text, so such rows are cut alike. Repeated
rows give repeated results, an empty table gives no rows, extra columns are carried in `row` and
cannot clash. A very long text is scanned in pieces; only its boundary set is held beside it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from usageledger.llm.common import small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50

# The sizes that make a container an array, a bitmap or runs: two bytes a value, 8 KiB, four bytes a run.
SPAN = 1 << 16
BITMAP_BYTES = SPAN // 8
SCAN = 16 * SPAN


class ArrayContainer:
    """The low halves of up to 4,096 offsets, in order."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.low[rank])


class BitmapContainer:
    """A bit per offset, with the number of bits up to and including each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, dtype=np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.upto, rank, side="right"))
        rest = rank - (int(self.upto[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[rest])


class RunContainer:
    """First offsets of runs of consecutive offsets, with the cardinality up to the end of each."""

    def __init__(self, low: np.ndarray):
        begins = np.flatnonzero(np.diff(low, prepend=low[0] - 2) != 1)
        self.first = low[begins].astype(np.uint16)
        self.upto = np.append(begins[1:], len(low))

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.upto, rank, side="right"))
        return int(self.first[run]) + rank - (int(self.upto[run - 1]) if run else 0)


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form for the ascending low halves of one container."""
    runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
    if 4 * runs < min(2 * len(low), BITMAP_BYTES):
        return RunContainer(low)
    return ArrayContainer(low) if 2 * len(low) <= BITMAP_BYTES else BitmapContainer(low)


class BoundarySet:
    """Ascending offsets, found by rank."""

    def __init__(self, offsets: np.ndarray):
        high = offsets // SPAN
        begins = np.flatnonzero(np.diff(high, prepend=-1))
        self.high = high[begins]
        self.containers = [container(part % SPAN) for part in np.split(offsets, begins[1:])] if len(offsets) else []
        self.upto = np.append(begins[1:], len(offsets)) if len(offsets) else np.zeros(0, dtype=np.int64)

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, rank: int) -> int:
        """The offset with `rank` smaller ones in the set."""
        at = int(np.searchsorted(self.upto, rank, side="right"))
        return int(self.high[at]) * SPAN + self.containers[at].select(rank - (int(self.upto[at - 1]) if at else 0))


def line_ends(text: str) -> BoundarySet:
    """The offsets, in code points, behind each line of a text."""
    found = []
    for at in range(0, len(text), SCAN):
        points = np.frombuffer(text[at : at + SCAN].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        found.append(np.flatnonzero(points == 10) + (at + 1))
    if text and not text.endswith("\n"):
        found.append(np.array([len(text)]))
    return BoundarySet(np.concatenate(found) if found else np.zeros(0, dtype=np.int64))


def draws(seed: int, doc_id: object) -> list[int]:
    """Four numbers below 2^32 that depend on the seed and the id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def check_sentinels(sentinels: Sequence[str]) -> None:
    """Sentinels that cannot be found anywhere but where they were put between texts without them."""
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if (a != b and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"sentinels overlap: {a!r}, {b!r}")


def rewrite(
    text: str, doc_id: object, seed: int, fim_percent: int, spm_percent: int, sentinels: Sequence[str]
) -> tuple[int, str, int | None, int | None, str]:
    """(lines, form, code points of prefix and middle, output) of one text."""
    ends = line_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or any(s in text for s in sentinels) or h3 % 100 >= fim_percent:
        return n, PLAIN, None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y = (ends.select(k - 1) if k else 0 for k in (first, second))
    p, s, m = sentinels
    if h4 % 100 < spm_percent:
        return n, SPM, x, y - x, f"{s}{text[y:]}{p}{text[:x]}{m}{text[x:y]}"
    return n, PSM, x, y - x, f"{p}{text[:x]}{s}{text[y:]}{m}{text[x:y]}"


def transform(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    sentinels: Sequence[str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """Every document as `row` with n, form, prefix_chars, middle_chars and output."""
    check_sentinels(sentinels)
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [LongType(), StringType(), LongType(), LongType(), StringType()]
    arrow = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    at = docs.columns.index(doc_id), docs.columns.index(text)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            row = part.column(0)
            ids, texts = (row.field(i).to_pylist() for i in at)
            made = [rewrite(t or "", i, seed, fim_percent, spm_percent, sentinels) for i, t in zip(ids, texts, strict=True)]
            columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([row, *columns], ["row", *names])

    schema = StructType([rows.schema["row"], *[StructField(n, k) for n, k in zip(names, kinds, strict=True)]])
    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column, sentinels: Sequence[str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that a document's output was made from."""
    p, s, m = sentinels

    def parts(opening: str, between: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(opening) + 1), F.length(output))
        one = F.substring_index(body, between, 1)
        rest = F.substring(body, F.length(one) + len(between) + 1, F.length(body))
        two = F.substring_index(rest, m, 1)
        return one, two, F.substring(rest, F.length(two) + len(m) + 1, F.length(rest))

    prefix, suffix, middle = parts(p, s)
    suffix_first, prefix_second, middle_last = parts(s, p)
    return (
        F.when(form == PSM, F.concat(prefix, middle, suffix))
        .when(form == SPM, F.concat(prefix_second, middle_last, suffix_first))
        .otherwise(output)
    )
