"""Near-duplicate documents by MinHash with tensored banding.

A document is the set of its distinct word shingles. Documents with equal sets are one class, and
only classes are compared. A class has two small collections of band hashes; every pair of one
band of the first and one of the second is the key of a table, so BANDS^2 tables cost the minhashes
of 2 x BANDS bands. Classes that share a key are candidates, and every link is confirmed on the
full sets. Components, not pairs, are the result, so candidates that are already connected are not
compared:

1. In every table bucket each class is compared with one pivot, the class that meets most others.
2. Confirmed links are contracted to components.
3. Candidates, linked or not, form clusters. In those that still hold several components the
   classes outside the largest one are compared with all others, in blocks, wherever they share
   a key and their signatures allow the wanted similarity.

No bucket is cut short and none is expanded into all its pairs. The number of bands makes a missed
link at the threshold a matter of 1 in 3,000 (similarity 0.8) or 1 in 25,000 (0.85); looking at the
signatures first in step 3 adds less than 1 in a million to that.

Defined cases: a NULL or blank text has no shingles and links with nothing; a text with fewer words
than a shingle is one shingle. Rows with equal sets are in one component, also under one id; rows
that repeat the smallest id are that document and all count as kept. A row with a NULL id stands
alone and is kept. An empty table gives no rows; extra columns are ignored and cannot clash.
Sets and shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.llm.common import small_batches, stored

SHINGLE = 5
BANDS = 12
ROWS = 3
HASHES = 2 * BANDS * ROWS
# Late candidates whose signatures agree in less than the threshold minus this are not confirmed on
# full sets. A link at 0.8 agrees so seldom with a chance below exp(-72 x 0.22), about 1e-7 (Chernoff).
SLACK = 0.3
CELL = 256
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SEEDS = np.random.RandomState(20).randint(1, 2**63 - 1, HASHES, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    digest = xxhash.xxh3_64_intdigest
    words = np.array([digest(w) for w in _WORD.findall(text.encode("utf-8", "replace").lower())], dtype=np.uint64)
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(size, len(words))):
        out = (out ^ (words[k : k + n] * _MIX_B)) * _MIX_A
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minhashes of a set, as signed 32-bit numbers."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2_048):
        low = np.minimum(low, (hashes[at : at + 2_048, None] * _SEEDS[None, :]).min(axis=0))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _fingerprint(hashes: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64)))


def _profiles(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, body, n_shingles, cid, sig) of (doc_id, text, body); cid is the fingerprint of the set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            counts, cids, sigs = [], [], []
            for text in part.column(1).to_pylist():
                found = shingles(text or "", size)
                counts.append(len(found))
                cids.append(_fingerprint(found) if len(found) else None)
                sigs.append(signature(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(counts, pa.int64()), pa.array(cids, pa.int64()), pa.array(sigs, pa.list_(pa.int32()))],
                ["doc_id", "body", "n_shingles", "cid", "sig"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, body long, n_shingles long, cid long, sig array<int>")


def _tables(classes: DataFrame) -> DataFrame:
    """(cid, key): the tables' keys, from the pairs of bands that other classes share."""
    band = F.transform(
        F.sequence(F.lit(0), F.lit(2 * BANDS - 1)), lambda i: F.struct(i.alias("band"), F.xxhash64(i, F.slice("sig", i * ROWS + 1, ROWS)).alias("k"))
    )
    bands = classes.select("cid", F.inline(band))
    shared = bands.groupBy("k").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low < high").select("k")
    live = bands.join(shared, "k", "left_semi").select("cid", "band", "k")
    gathered = live.groupBy("cid").agg(F.collect_list(F.struct("band", "k")).alias("all"))
    side = lambda first: F.filter("all", lambda b: (b["band"] < BANDS) if first else (b["band"] >= BANDS))
    keys = F.flatten(F.transform(F.col("a"), lambda a: F.transform(F.col("b"), lambda b: F.xxhash64(a["k"], b["k"]))))
    return gathered.select("cid", side(True).alias("a"), side(False).alias("b")).select("cid", F.explode(keys).alias("key"))


def _pivot_pairs(tensored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of a class and the pivot of one of its buckets; the classes in such buckets."""
    sizes = tensored.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(tensored.join(sizes, "key").select("cid", "key", "n"), "near-tables")
    # The pivot is the class that meets most others: for copies of one text, the text itself.
    weight = members.groupBy("cid").agg(F.sum("n").alias("weight"))
    weighted = stored(members.join(weight, "cid").select("cid", "key", "weight"), "near-weights")
    pivots = weighted.groupBy("key").agg(F.max(F.struct("weight", "cid"))["cid"].alias("pivot"))
    pairs = weighted.join(pivots, "key").where(F.col("cid") != F.col("pivot"))
    pairs = pairs.select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct()
    return pairs, weight.select("cid")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cid, n, members): the full shingle set of each wanted class, read from one document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            cids, counts, members = [], [], []
            for cid, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                found = shingles(text or "", size)
                # Rows that share an id with the wanted one but not its set drop out here.
                if len(found) and _fingerprint(found) == cid:
                    cids.append(cid)
                    counts.append(len(found))
                    members.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(counts, pa.int64()), pa.array(members, pa.binary())], ["cid", "n", "members"])

    texts = docs.join(wanted.select(F.col("rep").alias("doc_id"), "cid"), "doc_id").select("cid", "text")
    found = texts.mapInArrow(run, "cid long, n long, members binary")
    return found


def _similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * common >= percent * (len(p) + len(q) - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("members").alias("set_b"))
    possible = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    both = pairs.join(left, "a").join(right, "b").where(possible).select("a", "b", "set_a", "set_b")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            good = []
            for x, y in zip(part.column(2), part.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                good.append(_similar(p, q, percent))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of edges (a, b): one label per component.

    Each round every node moves to its smallest neighbour and the edges are contracted; the
    number of rounds grows with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    edges = stored(edges, "near-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "near-parents")
        upper = parents.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        parents = stored(parents.join(upper, "label").select("node", F.col("higher").alias("label")), "near-parents")
        a = parents.select(F.col("node").alias("a"), F.col("label").alias("x"))
        b = parents.select(F.col("node").alias("b"), F.col("label").alias("y"))
        moved = edges.join(a, "a").join(b, "b").where("x <> y")
        edges = stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "near-edges")
        if labels is None:
            labels = parents
        else:
            upper = parents.select(F.col("node").alias("label"), F.col("label").alias("higher"))
            labels = stored(labels.join(upper, "label", "left").select("node", F.coalesce("higher", "label").alias("label")), "near-labels")
    return spark.createDataFrame([], "node long, label long") if labels is None else labels


def _relabelled(labels: DataFrame, late: DataFrame) -> DataFrame:
    """Labels after the late links (a, b): only the components that these join are contracted again."""
    ends = late.select(F.col("a").alias("node")).unionByName(late.select(F.col("b").alias("node"))).distinct()
    new = ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    labels = stored(labels.unionByName(new), "near-labels")
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    joined = late.join(a, "a").join(b, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    upper = components(joined).select(F.col("node").alias("label"), F.col("label").alias("higher"))
    return stored(labels.join(upper, "label", "left").select("node", F.coalesce("higher", "label").alias("label")), "near-labels")


def _open_links(classes: DataFrame, sets: DataFrame, clusters: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between different components of one cluster of candidates.

    In each cluster the classes outside its largest component meet all others, block by block.
    A block compares signatures first and full sets only where they allow the similarity; it
    gives back the links that join components, not the pairs that it has looked at.
    """
    floor = percent / 100 - SLACK
    named = clusters.select(F.col("node").alias("cid"), F.col("label").alias("k")).join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.select("k", "cid", F.coalesce("label", "cid").alias("label"))
    per_label = named.groupBy("k", "label").agg(F.count("*").alias("n"))
    mixed = per_label.groupBy("k").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("labels")).where("labels > 1")
    mixed = stored(mixed.select("k", "n", F.col("most.label").alias("major"), (F.col("n") - F.col("most.n")).alias("minors")), "near-mixed")
    rows = named.join(mixed, "k").join(classes.select("cid", "sig"), "cid").join(sets.select("cid", "members"), "cid")
    blocks = lambda n: F.ceil(F.col(n) / CELL).cast("int")
    own = lambda n: F.pmod(F.xxhash64("cid"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    # Outsiders meet every block of the cluster; all members meet every block of outsiders.
    outside = rows.where("label <> major").select("k", own("minors").alias("p"), every("n").alias("q"), "cid", "label", "sig", "members", F.lit(True).alias("outside"))
    inside = rows.select("k", every("minors").alias("p"), own("n").alias("q"), "cid", "label", "sig", "members", F.lit(False).alias("outside"))

    def search(table: pa.Table) -> pa.Table:
        out = table.column("outside").to_numpy()
        cids, names = table.column("cid").to_numpy(), table.column("label").to_numpy()
        sigs = table.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, HASHES)
        members = [np.frombuffer(m.as_buffer(), dtype=np.uint64) for m in table.column("members")]
        sizes = np.array([len(m) for m in members])
        x, y = np.flatnonzero(out), np.flatnonzero(~out)
        parent: dict[int, int] = {}

        def find(name: int) -> int:
            while (up := parent.get(name, name)) != name:
                name = up
            return name

        links: list[tuple[int, int]] = []
        for i in x:
            same = sigs[y] == sigs[i]
            bands = same.reshape(len(y), 2 * BANDS, ROWS).all(axis=2)
            alike = same.mean(axis=1)
            good = bands[:, :BANDS].any(axis=1) & bands[:, BANDS:].any(axis=1) & (alike >= floor) & (names[y] != names[i])
            good &= 100 * np.minimum(sizes[y], sizes[i]) >= percent * np.maximum(sizes[y], sizes[i])
            at = np.flatnonzero(good)
            for j in y[at[np.argsort(-alike[at], kind="stable")]]:
                a, b = find(int(names[i])), find(int(names[j]))
                if a != b and _similar(members[i], members[j], percent):
                    parent[max(a, b)] = min(a, b)
                    links.append((int(cids[i]), int(cids[j])))
        return pa.table({"a": pa.array([min(l) for l in links], pa.int64()), "b": pa.array([max(l) for l in links], pa.int64())})  # noqa: E741

    return outside.unionByName(inside).groupBy("k", "p", "q").applyInArrow(search, "a long, b long")


def one_of_each(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """The documents, same columns, with one row of every component of near duplicates.

    Rows are told apart by id and text: of a component the smallest id stays, and where that id
    has several such texts or rows, one of them. Texts without words all stay. Rows with a NULL id
    take part only in that equal ones become one.
    """
    found = stored(near_duplicates(docs, percent, doc_id, text, size).where(F.col("cid").isNotNull()), "near-found")
    first = found.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("component_id").agg(F.min("body").alias("body"))
    staying = first.select(F.col("component_id").alias("doc_id"), "body").hint("merge")
    gone = found.where(F.col("doc_id").isNotNull()).join(staying, ["doc_id", "body"], "left_anti").select("doc_id", "body").distinct()
    often = found.groupBy("doc_id", "body").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id", "body")
    listed = gone.select("*", F.lit(True).alias("gone")).unionByName(often.select("*", F.lit(False).alias("gone")))
    marks = stored(listed.groupBy(F.col("doc_id").alias("mark_id"), F.col("body").alias("mark_body")).agg(F.bool_or("gone").alias("gone")), "near-gone")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].alias("own_id"), F.xxhash64(docs[text]).alias("own_body"))
    same = F.col("own_id").eqNullSafe(F.col("mark_id")) & (F.col("own_body") == F.col("mark_body"))
    # Marks grow with the corpus: one merge join at every size, never a broadcast.
    marked = rows.join(marks.hint("merge"), same, "left")
    unmarked = marked.where(F.col("mark_body").isNull()).select("row.*")
    if marks.where(~F.col("gone")).isEmpty():
        return unmarked
    repeated = marked.where(~F.col("gone")).groupBy("own_id", "own_body").agg(F.min("row").alias("row"))
    return unmarked.unionByName(repeated.select("row.*"))


def near_duplicates(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, body, n_shingles, cid, component_id, kept) of every document; body is a hash of its text.

    Documents are linked if 100 x intersection >= percent x union of their sets; component_id
    is the smallest id of the component. cid tells the classes of equal sets apart.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("body"))
    base = stored(_profiles(narrow, size), "near-profiles")
    known = base.where(F.col("cid").isNotNull() & F.col("doc_id").isNotNull())
    classes = stored(known.groupBy("cid").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "near-classes")
    pairs, wanted = _pivot_pairs(_tables(classes))
    pairs = stored(pairs, "near-pairs")
    wanted = classes.select("cid", "rep").join(wanted, "cid", "left_semi")
    # Rows that repeat an id repeat its set: any one of them will do.
    sets = stored(_sets(narrow, wanted, size), "near-sets").dropDuplicates(["cid"])
    edges = stored(_confirmed(pairs, sets, percent), "near-links")
    labels = components(edges)
    late = stored(_open_links(classes, sets, components(pairs), labels, percent), "near-links")
    if not late.isEmpty():
        labels = _relabelled(labels, late)
    named = classes.select("cid", "rep").join(labels.withColumnRenamed("node", "cid"), "cid")
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    found = stored(named.join(smallest, "label").select("cid", "component_id"), "near-components")
    # Classes without a link to another still hold equal documents.
    alone = classes.join(found, "cid", "left_anti").select("cid", F.col("rep").alias("component_id"))
    of_class = stored(found.unionByName(alone), "near-classes-named")
    joined = base.select("doc_id", "body", "n_shingles", "cid").join(of_class, "cid", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id", "body", "n_shingles", "cid", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )
