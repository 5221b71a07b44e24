"""Line dedup by a range partition of line hashes.

Lines of at least MIN_CHARS characters become (hash, document, position). They are partitioned by
ranges of hash and document, so a line that a third of all documents hold spreads over many tasks,
and sorted within; one pass streams the runs of equal hashes, largest document first. A run inside
a partition is settled there. The first and last run of a partition may go on in its neighbours:
their rows are settled against a table with at most two keys per partition. What comes back is not
text but, for each document that loses lines, a compressed bitmap of the lines it keeps.

Defined cases: a NULL or empty text is one empty line. A line's key is the line without BLANKS at
its ends, with A-Z in lower case. Rows with one document id are one document, told apart by a
hash of their texts; documents with a NULL id count for nothing and keep all lines. The line stays
in the largest document id that holds it, at all its places there. Other columns are untouched.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.llm.common import BLANKS, small_batches, stored

MIN_CHARS = 40
MIN_DOCS = 5
_LINES = "h1 long, h2 long, doc_id long, body long, pos int"
_SEEN = f"kind byte, {_LINES}"
DROP, OPEN, WITNESS = 0, 1, 2


def _line_rows(docs: DataFrame) -> DataFrame:
    """A row per long line of (doc_id, body, text)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h1", "h2", "doc_id", "body", "pos"]
        for part in parts:
            ids, bodies = part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False)
            hashes, owner, places = bytearray(), [], []
            for i, text in enumerate(part.column(2).to_pylist()):
                for pos, line in enumerate(text.split("\n")):
                    if len(line) >= MIN_CHARS and len(key := line.strip(BLANKS)) >= MIN_CHARS:
                        hashes += xxhash.xxh3_128_digest(key.encode("utf-8", "replace").lower())
                        owner.append(i)
                        places.append(pos)
            both = np.frombuffer(bytes(hashes), dtype=">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids[owner], pa.int64()), pa.array(bodies[owner], pa.int64()), pa.array(places, pa.int32())],
                names,
            )

    return docs.mapInArrow(run, _LINES)


def _settle(parts: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Stream the sorted rows of one partition; see DROP, OPEN and WITNESS."""
    names = ["kind", "h1", "h2", "doc_id", "body", "pos"]
    kinds = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    first_key: tuple[int, int] | None = None
    # The run that may go on: its rows while undecided, else one row of each of its first documents.
    held = [np.zeros(0, dtype=np.int64)] * 5 + [np.zeros(0, dtype=bool)]

    def emit(kind: int, columns: list[np.ndarray], keep: np.ndarray) -> pa.RecordBatch:
        rows = [c[keep] for c in columns[:5]]
        data = [np.full(len(rows[0]), kind, dtype=np.int8), *rows]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(data, kinds, strict=True)], names)

    for part in parts:
        if not part.num_rows:
            continue
        fresh = [part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
        h1, h2, doc, body, pos, done = columns = [
            np.concatenate(pair) for pair in zip(held, [*fresh, np.zeros(part.num_rows, dtype=bool)], strict=True)
        ]
        n = len(h1)
        if first_key is None:
            first_key = (int(h1[0]), int(h2[0]))
        begins = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        starts = np.flatnonzero(begins)
        run = np.cumsum(begins) - 1
        new_doc = begins | np.concatenate([[True], doc[1:] != doc[:-1]])
        order = np.cumsum(new_doc)
        nth = order - order[starts][run]  # of its run's documents, from 0
        docs = np.maximum.reduceat(nth, starts) + 1
        leading = np.zeros(len(starts), dtype=bool)
        leading[0] = (int(h1[0]), int(h2[0])) == first_key
        common = (docs >= min_docs) & ~leading
        yield emit(DROP, columns, common[run] & (nth > 0) & ~done)
        yield emit(OPEN, columns, leading[run] & ~done)
        last = run == len(starts) - 1
        if leading[-1]:
            keep = np.zeros(n, dtype=bool)
        elif common[-1]:
            keep = last & new_doc & (nth < min_docs)
        else:
            keep = last
        held = [c[keep] for c in columns]
        held[5] = np.full(int(keep.sum()), bool(common[-1]))
    if len(held[0]):
        yield emit(OPEN, held, ~held[5])
        yield emit(WITNESS, held, held[5])


def _bitmaps(dropped: DataFrame) -> DataFrame:
    """(doc_id, body, keep): the number of bits and, compressed, a bit per line up to the last dropped."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            maps = []
            for places in part.column(2):
                gone = places.values.to_numpy()
                bits = np.ones(int(gone.max()) + 1, dtype=np.uint8)
                bits[gone] = 0
                maps.append(len(bits).to_bytes(4, "little") + zlib.compress(np.packbits(bits).tobytes()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(maps, pa.binary())], ["doc_id", "body", "keep"])

    gathered = dropped.groupBy("doc_id", "body").agg(F.collect_set("pos").alias("places"))
    return gathered.mapInArrow(run, "doc_id long, body long, keep binary")


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, body, keep) of the documents that lose lines; body is a hash of the text."""
    small_batches(docs.sparkSession)
    whole = F.coalesce(docs[text], F.lit(""))
    narrow = docs.where(docs[doc_id].isNotNull()).select(docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(whole).alias("body"), whole.alias("text"))
    order = ["h1", "h2", F.desc("doc_id"), "body", "pos"]
    rows = _line_rows(narrow).repartitionByRange(*order).sortWithinPartitions(*order)
    seen = stored(rows.mapInArrow(lambda parts: _settle(parts, min_docs), _SEEN), "line-runs")
    undecided = seen.where(F.col("kind") != DROP)
    per_doc = undecided.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    common = per_doc.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("stays")).where(F.col("docs") >= min_docs)
    # At most two keys per partition of `rows`: small whatever the input.
    late = seen.where(F.col("kind") == OPEN).join(F.broadcast(common), ["h1", "h2"]).where(F.col("doc_id") < F.col("stays"))
    columns = ["doc_id", "body", "pos"]
    # Stored, so that no task runs the workers of this step and of the next side by side.
    return stored(_bitmaps(seen.where(F.col("kind") == DROP).select(*columns).unionByName(late.select(*columns))), "line-bitmaps")


def kept_lines(text: str, keep: bytes | None) -> list[str]:
    """The lines of a text that its bitmap keeps; all without one."""
    lines = text.split("\n")
    if keep is None:
        return lines
    size, packed = int.from_bytes(keep[:4], "little"), keep[4:]
    bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8), count=size).tolist()
    return [line for i, line in enumerate(lines) if i >= size or bits[i]]


def with_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """Every document as `row`, its text (never NULL) as `body_text`, its bitmap as `keep`."""
    maps = keep_bitmaps(docs, doc_id, text, min_docs).select(F.col("doc_id").alias("map_id"), F.col("body").alias("map_body"), "keep")
    whole = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), whole.alias("body_text"), docs[doc_id].cast("long").alias("own_id"), F.xxhash64(whole).alias("own_body"))
    # Bitmaps grow with the corpus: one merge join at every size, never a broadcast.
    joined = rows.join(maps.hint("merge"), (F.col("own_id") == F.col("map_id")) & (F.col("own_body") == F.col("map_body")), "left")
    return joined.select("row", "body_text", "keep")


def _texts(frame: DataFrame, schema: str, finish) -> DataFrame:
    """Apply the bitmaps of (id..., body_text, keep) rows; `finish` makes the output columns."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, keeps = part.column("body_text").to_pylist(), part.column("keep").to_pylist()
            yield finish(part, texts, [kept_lines(t, k) for t, k in zip(texts, keeps, strict=True)])

    return frame.mapInArrow(run, schema)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""

    def finish(part: pa.RecordBatch, texts: list[str], kept: list[list[str]]) -> pa.RecordBatch:
        total = [t.count("\n") + 1 for t in texts]
        dropped = [n - len(k) for n, k in zip(total, kept, strict=True)]
        shas = [hashlib.sha256("\n".join(k).encode("utf-8", "replace")).hexdigest() for k in kept]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(shas, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = with_bitmaps(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), min_docs=min_docs)
    narrow = rows.select(F.col("row.doc_id").alias("doc_id"), "body_text", "keep")
    return _texts(narrow, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string", finish)


def without_common_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents, same columns, without the lines their bitmaps drop."""

    @F.pandas_udf("string")
    def kept(texts: pd.Series, keeps: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(kept_lines(t, k)) for t, k in zip(texts, keeps, strict=True)], dtype="object")

    rows = with_bitmaps(docs, doc_id, text, min_docs)
    rest = F.when(F.col("keep").isNull(), F.col(f"row.`{text}`")).otherwise(kept("body_text", "keep"))
    changed = rows.select("row", rest.alias("rest"))
    return changed.select(*[F.col("rest").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
