"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from reviewlens.llm.common import map_batches, written

#: Vectors of one part of a leaf, vectors and queries multiplied at once.
PART, BLOCK = 8192, 512


@dataclass
class Node:
    """Centroids of the children, and for each a leaf number or a further node."""

    centres: np.ndarray
    children: list = field(default_factory=list)


@dataclass
class Tree:
    root: Node
    leaves: int
    #: Squared norm that vectors are lifted to, in one more dimension: then the nearest is the largest product.
    top: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top - (vectors * vectors).sum(axis=1), 0))
        return np.column_stack([vectors, rest])

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child, from the root down."""
        out = np.zeros(len(vectors), np.int32)

        def down(node: Node, rows: np.ndarray, points: np.ndarray) -> None:
            near = nearest(points, node.centres)
            for c, child in enumerate(node.children):
                own = near == c
                if own.any():
                    if isinstance(child, Node):
                        down(child, rows[own], points[own])
                    else:
                        out[rows[own]] = child

        down(self.root, np.arange(len(vectors)), self.lifted(vectors))
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The leaves that a search reaches first: the nearest node on the queue is opened next."""
        point = np.append(query, 0.0)
        queue: list[tuple[float, int, Node | int]] = [(0.0, 0, self.root)]
        found, turn = [], 0
        while queue and len(found) < most:
            _, _, node = heapq.heappop(queue)
            if not isinstance(node, Node):
                found.append(node)
                continue
            apart = ((node.centres - point) ** 2).sum(axis=1)
            for distance, child in zip(apart.tolist(), node.children, strict=True):
                turn += 1
                heapq.heappush(queue, (distance, turn, child))
        return found


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1)[None, :] - 2 * points @ centres.T).argmin(axis=1)


def grow(sample: np.ndarray, top: float, branches: int, depth: int, least: int, rounds: int = 12) -> Tree:
    """A tree over ``sample``: k-means with ``branches`` centres, again within each, ``depth`` levels."""
    rng = np.random.default_rng(5)
    leaves = 0

    def split(points: np.ndarray, level: int) -> Node:
        nonlocal leaves
        k = max(1, min(branches, len(points)))
        centres = points[rng.choice(len(points), k, replace=False)]
        for _ in range(rounds):
            near = nearest(points, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, points)
            size = np.bincount(near, minlength=k)[:, None]
            centres = np.where(size > 0, sums / np.maximum(size, 1), centres)
        near = nearest(points, centres)
        node = Node(centres)
        for c in range(k):
            own = points[near == c]
            if level + 1 < depth and len(own) >= least:
                node.children.append(split(own, level + 1))
            else:
                node.children.append(leaves)
                leaves += 1
        return node

    tree = Tree(Node(np.zeros((1, 1))), 0, top)
    tree.root = split(tree.lifted(sample), 0)
    tree.leaves = leaves
    return tree


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple]:
    """``(query, row, score)`` of each query's ``k`` best rows, its own id excluded, ties to smaller ids.

    A matrix product picks the candidates with a margin for its rounding; their scores are then
    summed one by one in a fixed order, so that equal vectors get equal scores anywhere.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    for at in range(0, len(queries), BLOCK):
        block = slice(at, at + BLOCK)
        near = queries[block] @ vectors.T
        near[ids[None, :] == query_ids[block, None]] = -np.inf
        n = min(k, near.shape[1])
        edge = np.partition(near, near.shape[1] - n, axis=1)[:, near.shape[1] - n]
        scale = np.abs(near[np.isfinite(near)]).max(initial=1.0)
        for q, row, least in zip(range(at, len(queries)), near, edge, strict=False):
            pick = np.flatnonzero((row >= least - 1e-9 * scale) & np.isfinite(row))
            exact = (vectors[pick] * queries[q]).sum(axis=1)
            first = np.lexsort((ids[pick], -exact))[:k]
            yield q, order[pick[first]], exact[first]


def usable(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """``id, vec`` of the rows that take part, each once; all of the length that most vectors have."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = rows.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    own = own.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    sizes = own.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n"))
    size = sizes.orderBy(F.desc("n"), "size").first()
    return own.filter(F.size("vec") == (size["size"] if size else -1)).dropDuplicates(["id", "vec"])


FOUND = "query_id bigint, vec_id bigint, score double"


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def brute(rows: DataFrame, queries: tuple[np.ndarray, np.ndarray], k: int) -> DataFrame:
    """The exact ``k`` best of all ``rows`` for a few given queries: each task keeps its best so far."""
    query_ids, vectors = queries

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = batch.column(0).to_numpy(), matrix(batch.column(1)), batch.column(2).to_numpy()
            held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True))
            if len(held[0]) >= PART:
                use = np.unique(np.concatenate([r for _, r, _ in best(query_ids, vectors, *held[:2], k)]))
                held = tuple(x[use] for x in held)
        if held is not None:
            out = [(int(query_ids[q]), held[0][r], held[2][r], s) for q, r, s in best(query_ids, vectors, *held[:2], k)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out])),
                    *(pa.array(np.concatenate([o[i] for o in out])) for i in (1, 2, 3)),
                ],
                names=["query_id", "vec_id", "leaf", "score"],
            )

    found = map_batches(rows.select("id", "vec", "leaf"), run, "query_id bigint, vec_id bigint, leaf int, score double")
    return top(found, k)


def calibrated(tree: Tree, queries: tuple[np.ndarray, np.ndarray], truth: list, recall: float) -> int:
    """The least number of leaf visits, widened until ``recall`` of the true neighbours is reached."""
    leaf = {}
    for r in truth:
        leaf.setdefault(r["query_id"], []).append(r["leaf"])
    turns = []
    for query, vector in zip(*queries, strict=True):
        turn = {x: i + 1 for i, x in enumerate(tree.visits(vector, tree.leaves))}
        turns += [turn[x] for x in leaf.get(query, [])]
    turns.sort()
    return turns[min(len(turns) - 1, int(np.ceil(recall * len(turns))) - 1)] if turns else tree.leaves


def nearest_neighbours(
    rows: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    recall: float = 0.97,
    sample: int = 20_000,
    probes: int = 256,
    branches: int = 16,
    depth: int = 2,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query.

    ``is_query`` is a condition on ``id_col``; candidates are all rows but the query's own. The tree
    is fitted on ``sample`` vectors and every vector is filed under a leaf of it. A search opens
    nodes in the order of their distance and visits so many leaves that, on ``probes`` queries
    compared with all rows, ``recall`` of the true neighbours was reached. Leaves are searched in
    parts of ``PART`` vectors. Scores are double-precision products of the given vectors.

    Rows without id, and vectors that are null, zero, of another length than most, or have a null or
    non-finite component, take no part; repeated rows count once. Of equal vectors, the ``k + 1``
    smallest ids are kept, as no search can return others. Ties go to the smaller id. No rows give
    no rows; fewer candidates than ``k`` are all returned.
    """
    used = usable(rows, id_col, vector)
    copies = Window.partitionBy("vec").orderBy("id")
    distinct = used.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).drop("copy")
    by_hash = lambda df, n: df.orderBy(F.xxhash64("id"), "id").limit(n).collect()
    picked = by_hash(distinct, sample)
    if not picked:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    tree = grow(
        np.array([r["vec"] for r in picked]), distinct.agg(F.max(norm)).first()[0], branches, depth, 4 * branches
    )

    def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaf_of(matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["id", "vec", "leaf"])

    filed = written(map_batches(distinct, file, "id bigint, vec array<double>, leaf int"), "leaves")
    asked = used.filter(is_query(F.col("id")))
    probed = by_hash(asked, probes)
    few = np.array([r["id"] for r in probed], np.int64), np.array([r["vec"] for r in probed])
    visits = calibrated(tree, few, brute(filed, few, k).collect(), recall) if probed else 1
    parts = {r["leaf"]: -(-r["count"] // PART) for r in filed.groupBy("leaf").count().collect()}

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cell, part = [], [], []
            for i, query in enumerate(matrix(batch.column(1)) if batch.num_rows else ()):
                for leaf in tree.visits(query, visits):
                    for p in range(parts.get(leaf, 0)):
                        at.append(i), cell.append(leaf), part.append(p)
            at = pa.array(at, pa.int64())
            columns = [pa.array(cell, pa.int32()), pa.array(part, pa.int32()), *(c.take(at) for c in batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=["leaf", "part", "id", "vec"])

    part_count = F.create_map(*[F.lit(x) for pair in sorted(parts.items()) for x in pair])
    stored = filed.select(
        "leaf",
        F.pmod(F.xxhash64("id"), F.element_at(part_count, F.col("leaf"))).cast("int").alias("part"),
        F.lit(0).alias("kind"), "id", "vec",
    )
    questions = map_batches(asked, ask, "leaf int, part int, id bigint, vec array<double>").select(
        "leaf", "part", F.lit(1).alias("kind"), "id", "vec"
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, vectors = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(4)]
            every = matrix(batch.column(4))
            edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)) + 1
            for s, e in zip([0, *edge], [*edge, batch.num_rows], strict=True):
                if place != (cols[0][s], cols[1][s]):
                    place, ids, vectors = (cols[0][s], cols[1][s]), [], []
                if cols[2][s] == 0:
                    ids.append(cols[3][s:e])
                    vectors.append(every[s:e])
                    continue
                if not ids:
                    continue
                own = np.concatenate(ids), np.concatenate(vectors)
                ids, vectors = [own[0]], [own[1]]
                asking, rows_found, scores = zip(*best(cols[3][s:e], every[s:e], *own, k), strict=True)
                asked_by = cols[3][s:e][np.repeat(asking, [len(r) for r in rows_found])]
                columns = asked_by, own[0][np.concatenate(rows_found)], np.concatenate(scores)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    cell = ["leaf", "part"]
    dealt = stored.unionByName(questions).repartition(*cell).sortWithinPartitions(*cell, "kind")
    return top(map_batches(dealt, search, FOUND), k).select("query_id", "rank", "vec_id", "score")
