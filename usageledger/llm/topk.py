"""Exact top-k by inner product with two cover trees.

Candidates and queries are dealt into blocks; each pair of a query block and a candidate block is
searched by one task with two cover trees. A pair of nodes is skipped when even the largest inner
product that the covering radii allow is below the worst k-th score of the node's queries; the
best k of all blocks are merged per query. Scores are whole numbers and exact.

Defined cases: vectors that are NULL, empty or hold NULL or non-finite components, and rows with a
NULL id, take no part. A query id that repeats is asked once (its smallest vector); repeated
candidate rows all count. Ties go to the smaller id. Vectors of different lengths do not meet.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2_048
QUERY_BLOCK = 1_024
LEAF = 24
_KINDS = "query_id long, vec_id long, score long"


@dataclass
class Node:
    centre: np.ndarray
    norm: float
    radius: float
    rows: np.ndarray | None
    children: list[Node] = field(default_factory=list)


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """Each level covers the points of a node by balls of half its radius around some of them."""
    rows = np.arange(len(points)) if rows is None else rows
    mine = points[rows]
    # The point nearest to the mean makes a small covering radius.
    centre = mine[np.argmin(((mine - mine.mean(axis=0)) ** 2).sum(axis=1))]
    far = np.sqrt(((mine - centre) ** 2).sum(axis=1))
    node = Node(centre, float(np.sqrt((centre**2).sum())), float(far.max()), None)
    if len(rows) <= LEAF or node.radius == 0:
        node.rows = rows
        return node
    nearest, owner, k = far, np.zeros(len(rows), dtype=np.int64), 0
    while nearest.max() > node.radius / 2:
        k += 1
        distance = np.sqrt(((mine - mine[np.argmax(nearest)]) ** 2).sum(axis=1))
        closer = distance < nearest
        owner[closer], nearest = k, np.minimum(nearest, distance)
        if k >= len(rows) // LEAF + 1:
            break
    parts = [rows[owner == i] for i in range(k + 1)]
    parts = [p for p in parts if len(p)]
    if len(parts) == 1:
        node.rows = rows
        return node
    node.children = [cover_tree(points, p) for p in parts]
    return node


def _bound(q: Node, c: Node) -> float:
    """No query under q has a larger inner product with a candidate under c."""
    most = float(q.centre @ c.centre) + q.norm * c.radius + c.norm * q.radius + q.radius * c.radius
    return most + 1e-9 * (abs(most) + (q.norm + q.radius) * (c.norm + c.radius)) + 1e-6


def dual_tree(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of each query's best k; missing places have the id -1."""
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * queries.shape[1]
    # Whole numbers below 2^53 multiply exactly as doubles; beyond, as Python's own.
    exact = np.float64 if reach < 2**53 else object
    none = -np.inf if exact is np.float64 else -(10**60)
    q_points, c_points = queries.astype(np.float64), candidates.astype(np.float64)
    q_exact, c_exact = queries.astype(exact), candidates.astype(exact)
    scores = np.full((len(queries), k), none, dtype=exact)
    found = np.full((len(queries), k), -1, dtype=np.int64)
    top, tree = cover_tree(q_points), cover_tree(c_points)

    worst: dict[int, float] = {}

    def worst_of(node: Node) -> float:
        """The worst k-th score among the node's queries; only leaves' values ever change."""
        if node.rows is not None:
            return worst.get(id(node), -np.inf)
        return min(map(worst_of, node.children))

    def compare(q: Node, c: Node) -> None:
        values = q_exact[q.rows] @ c_exact[c.rows].T
        own = query_ids[q.rows][:, None] == ids[c.rows][None, :]
        values = np.where(own, none, values)
        all_values = np.concatenate([scores[q.rows], values], axis=1)
        all_ids = np.concatenate([found[q.rows], np.broadcast_to(ids[c.rows], values.shape)], axis=1)
        all_ids = np.where(all_values == none, np.int64(2**63 - 1), all_ids)
        order = np.lexsort((all_ids, -all_values), axis=1)[:, :k]
        scores[q.rows] = np.take_along_axis(all_values, order, axis=1)
        best = np.take_along_axis(all_ids, order, axis=1)
        found[q.rows] = np.where(best == 2**63 - 1, -1, best)
        last = scores[q.rows][:, -1]
        worst[id(q)] = -np.inf if (last == none).any() else float(last.min())

    heap = [(-_bound(top, tree), 0, top, tree)]
    made = 0
    while heap:
        bound, _, q, c = heapq.heappop(heap)
        # Equal scores still matter: the smaller id wins.
        if -bound < worst_of(q):
            continue
        if q.rows is not None and c.rows is not None:
            compare(q, c)
            continue
        split_query = c.rows is not None or (q.rows is None and q.radius > c.radius)
        for a, b in [(x, c) for x in q.children] if split_query else [(q, x) for x in c.children]:
            if (most := _bound(a, b)) >= worst_of(a):
                made += 1
                heapq.heappush(heap, (-most, made, a, b))
    return scores, found


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) from rows (vec_id, v): whole-number vectors."""
    usable = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), "v", F.size("v").alias("width"))
    asked = usable.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = asked.withColumn("width", F.size("v"))
    sizes = usable.agg(F.count("*").alias("n"), F.coalesce(F.sum(is_query.cast("long")), F.lit(0)).alias("q")).first()
    c_blocks, q_blocks = -(-sizes["n"] // block) or 1, -(-sizes["q"] // QUERY_BLOCK) or 1
    dealt = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    # A stated query set against all rows, in blocks: every pair of blocks meets once.
    left = asked.select(
        "query_id", "v", "width", dealt("query_id", q_blocks).alias("q"), F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("c")
    )
    right = usable.select(
        "vec_id", "v", "width", F.pmod(F.xxhash64("vec_id", "v"), F.lit(c_blocks)).cast("int").alias("c"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q"),
    )

    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(candidates):
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        width = queries.column("width")[0].as_py()
        query_ids = queries.column("query_id").to_numpy()
        scores, found = dual_tree(
            query_ids, _matrix(queries.column("v"), width), candidates.column("vec_id").to_numpy(), _matrix(candidates.column("v"), width), k
        )
        real = found >= 0
        return pa.table(
            [
                pa.array(np.repeat(query_ids, k).reshape(-1, k)[real], pa.int64()),
                pa.array(found[real], pa.int64()),
                pa.array([int(x) for x in scores[real]], pa.int64()),
            ],
            names=names,
        )

    keys = ["width", "q", "c"]
    local = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, _KINDS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors whose components are all finite numbers."""
    v = embeddings[vector]
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = embeddings.where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
    return good.select(embeddings[vec_id].alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
