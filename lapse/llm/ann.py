"""Approximate nearest neighbours with a vantage-point tree per shard.

Every shard of the table (a block of rows as they lie) gets a tree: a node
picks a vantage point and splits its rows at the median distance to it. A
query descends into the side it lies on, then into the other side only if that
could hold something nearer by the triangle inequality, relaxed by ``factor``:
a side is visited if its boundary distance * factor <= the k-th best distance
so far. The boundary distance is the largest on the way down. Factor 1 is an
exact search; larger factors prune more. The k-th best is that of all trees
before in the task, and of a first tree, so only that one starts from nothing.

All rows are indexed. Trees are a landed table, one row per shard, that any
number of query chunks can be run against; memory per task is one shard and
one chunk of queries. Queries of a chunk descend together.

Defined cases: vectors that are null, zero or hold null or non-finite
components take no part, nor do rows without an id; every row counts, also one
repeated as a whole, as query and as candidate; rows having the query's id are
its own; only vectors of equal length meet; fewer candidates than k give fewer
rows; ties go to the smaller id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.llm.vectors import BLOCK_ROWS, Best, Queries, arrow_rows, ranked, search, usable, vectors_of
from lapse.operators.materialize import land

LEAF = 64
FACTOR = 5.0
TRIALS = 5  # vantage points tried per node


def distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - point) ** 2).sum(axis=-1))


def build_tree(vectors: np.ndarray, leaf: int = LEAF, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows and nodes (begin, end, radius, inner child, outer
    child); a node's vantage point is its first row, a leaf has children -1."""
    draw = np.random.default_rng(seed)
    order = np.arange(len(vectors))
    nodes: list[list[float]] = []
    work = [(0, len(vectors), -1, 0)]
    while work:
        begin, end, parent, side = work.pop()
        number = len(nodes)
        if parent >= 0:
            nodes[parent][3 + side] = number
        nodes.append([begin, end, 0.0, -1, -1])
        if end - begin <= leaf:
            continue
        own = order[begin:end]
        tried = draw.choice(len(own), size=min(TRIALS, len(own)), replace=False)
        sample = vectors[own[draw.choice(len(own), size=min(100, len(own)), replace=False)]]
        spread = [np.var(distances(sample, vectors[own[t]])) for t in tried]
        chosen = tried[int(np.argmax(spread))]
        own[[0, chosen]] = own[[chosen, 0]]
        away = distances(vectors[own[1:]], vectors[own[0]])
        sort = np.argsort(away, kind="stable")
        own[1:] = own[1:][sort]
        half = len(sort) // 2
        nodes[number][2] = away[sort[half]]
        order[begin:end] = own
        work.append((begin + 1 + half, end, number, 1))
        work.append((begin + 1, begin + 1 + half, number, 0))
    return order, np.array(nodes, dtype=float).reshape(-1, 5)


class Search:
    """Joint descent of many queries in one tree; distances are offered to
    ``best`` as negative scores."""

    def __init__(self, ids, vectors, nodes, query_ids, queries, best: Best, factor: float):
        self.ids, self.vectors, self.nodes, self.factor = ids, vectors, nodes, factor
        self.query_ids, self.queries, self.best = query_ids, queries, best
        self.limit = -best.floor()  # distance that still matters
        self.visited = 0

    def offer(self, which: np.ndarray, begin: int, end: int, away: np.ndarray) -> None:
        """Offer candidates begin..end at distances ``away``."""
        ids = self.ids[begin:end]
        q, j = np.nonzero((away <= self.limit[which, None]) & (ids != self.query_ids[which, None]))
        if len(q):
            self.best.offer(which[q], ids[j], -away[q, j])
            self.limit[which] = -np.maximum(self.best.bound[which], np.where(self.best.n[which] >= self.best.k, self.best.score[which, -1], -np.inf))

    def run(self) -> None:
        # Depth first: what is pushed last is visited first; a side comes with
        # boundary distances and is checked when its turn comes.
        everyone = np.arange(len(self.queries))
        work = [(0, everyone, np.zeros(len(everyone)))] if len(self.nodes) else []
        while work:
            number, which, boundary = work.pop()
            near = boundary * self.factor <= self.limit[which]
            which, boundary = which[near], boundary[near]
            if not len(which):
                continue
            begin, end, radius, inner, outer = self.nodes[number]
            begin, end = int(begin), int(end)
            if inner < 0:
                self.visited += len(which) * (end - begin)
                for at in range(0, len(which), 128):
                    some = which[at : at + 128]
                    self.offer(some, begin, end, distances(self.vectors[None, begin:end], self.queries[some, None]))
                continue
            away = distances(self.queries[which], self.vectors[begin])
            self.visited += len(which)
            self.offer(which, begin, begin + 1, away[:, None])
            far = np.maximum(boundary, np.abs(away - radius))
            inside = away < radius
            work.append((int(outer), which[inside], far[inside]))
            work.append((int(inner), which[~inside], far[~inside]))
            work.append((int(outer), which[~inside], boundary[~inside]))
            work.append((int(inner), which[inside], boundary[inside]))


def index(rows: DataFrame) -> DataFrame:
    """Trees (landed), one row per shard and length, over landed usable rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, ids, vectors in vectors_of(batch):
                by_id = np.lexsort((*vectors.T[::-1], ids))  # one tree whatever the order of rows
                ids, vectors = ids[by_id], vectors[by_id]
                order, nodes = build_tree(vectors)
                lists = [pa.array([x], pa.list_(t)) for x, t in ((ids[order], pa.int64()), (vectors[order].ravel(), pa.float64()), (nodes.ravel(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), *lists], ["dims", "ids", "values", "nodes"])

    with arrow_rows(rows.sparkSession, BLOCK_ROWS):
        return land(rows.mapInArrow(run, "dims int, ids array<long>, `values` array<double>, nodes array<double>"), "ann-trees")


def nearest(embeddings: DataFrame, queries: Column, k: int = 10, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id and Euclidean distance of the k nearest found
    for every row that ``queries`` (a condition on vec_id) admits."""
    rows = land(usable(embeddings, nonzero=True), "ann-rows")
    trees = index(rows)

    def scan(batch: pa.RecordBatch, chunk: Queries, best: dict[int, Best]) -> None:
        for i in range(batch.num_rows):
            dims = batch.column("dims")[i].as_py()
            if dims not in chunk:
                continue
            ids, flat, nodes = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("ids", "values", "nodes"))
            _, query_ids, query_vectors = chunk[dims]
            Search(ids, flat.reshape(len(ids), dims), nodes.reshape(-1, 5), query_ids, query_vectors, best[dims], factor).run()

    with arrow_rows(embeddings.sparkSession, 4):
        found = search(trees, rows.where(queries), k, float, trees.limit(1), scan)
    return ranked(found, k).withColumn("score", -F.col("score"))
