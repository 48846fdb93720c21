"""Exact top-k search by inner product: columnar branch and bound.

Inside a block, candidates lie in vertical layout (one row per dimension,
dimensions of large mass first). Scores are accumulated dimension block by
dimension block; the mass that remains bounds what a candidate can still gain
or lose (Cauchy-Schwarz), candidates that cannot reach a query's k-th best
lower bound are dropped, and the survivors are compacted. A block starts from
the k-th best of the blocks before it in its task, and of a first one.

Components are quantised to floor(256 * x), scores are integers.

Defined cases: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; every row counts, also one repeated
as a whole, as query and as candidate; rows having the query's id are its own;
only vectors of equal length meet; fewer candidates than k give fewer rows;
ties go to the smaller id; scores beyond 64 bits are clamped; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from lapse.llm.vectors import BLOCK_ROWS, Best, Queries, arrow_rows, ranked, search, usable, vectors_of
from lapse.operators.materialize import land

SCALE = 256.0
DIM_BLOCK = 16
CHUNK = 64  # queries handled at once


def quantise(vectors: np.ndarray) -> np.ndarray:
    return np.floor(vectors * SCALE)


Found = tuple[np.ndarray, np.ndarray, np.ndarray]  # query number in the block, vec_id, score


def block_top(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None) -> Found:
    """Each query's k best in the block, less what cannot reach its ``floor``."""
    dims = rows.shape[1]
    limit = float(np.abs(rows).max(initial=0.0)) * float(np.abs(queries).max(initial=0.0)) * max(1, dims)
    if not limit < 2.0**53:
        return _exact_top(ids, rows, query_ids, queries, k)
    floor = np.full(len(queries), -np.inf) if floor is None else floor
    order = np.argsort(-(np.abs(rows).sum(axis=0) * np.abs(queries).sum(axis=0)), kind="stable")
    vertical, queries = np.ascontiguousarray(rows[:, order].T), queries[:, order]
    cuts = list(range(0, dims, DIM_BLOCK)) or [0]
    # Mass that remains from each cut on.
    rest = [np.sqrt((vertical[c:] ** 2).sum(axis=0)) for c in cuts[1:]] + [np.zeros(len(ids))]
    query_rest = [np.sqrt((queries[:, c:] ** 2).sum(axis=1)) for c in cuts[1:]] + [np.zeros(len(queries))]
    out: list[Found] = []
    for at in range(0, len(queries), CHUNK):
        chunk = queries[at : at + CHUNK]
        first = chunk[:, : DIM_BLOCK] @ vertical[:DIM_BLOCK]
        for i in range(len(chunk)):
            alive = np.flatnonzero(ids != query_ids[at + i])
            score = first[i, alive]
            for b, cut in enumerate(cuts):
                if b:
                    score = score + chunk[i, cut : cut + DIM_BLOCK] @ vertical[cut : cut + DIM_BLOCK, alive]
                slack = rest[b][alive] * query_rest[b][at + i] * (1 + 1e-9) + 1e-3 * (b + 1 < len(cuts))
                least = floor[at + i]
                if len(alive) > k:
                    least = max(least, np.partition(score - slack, len(alive) - k)[len(alive) - k])
                keep = score + slack >= least
                alive, score = alive[keep], score[keep]
            top = np.lexsort((ids[alive], -score))[:k]
            out.append((np.full(len(top), at + i), ids[alive[top]], score[top].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 3


def _exact_top(ids, rows, query_ids, queries, k) -> Found:
    """The same with unbounded integers, for very large components."""
    whole = [[int(x) for x in r] for r in rows]
    out = []
    for i, q in enumerate(queries):
        q = [int(x) for x in q]
        scored = [(-sum(a * b for a, b in zip(q, r)), int(v)) for v, r in zip(ids, whole) if v != query_ids[i]]
        out += [(i, v, max(-(1 << 63), min((1 << 63) - 1, -s))) for s, v in sorted(scored)[:k]]
    return tuple(np.array([r[j] for r in out], dtype=np.int64) for j in range(3))


def scan(batch: pa.RecordBatch, queries: Queries, best: dict[int, Best]) -> None:
    """Offer the rows of a batch to the queries of their length."""
    for dims, ids, vectors in vectors_of(batch):
        if dims in queries:
            _, query_ids, query_vectors = queries[dims]
            best[dims].offer(*block_top(ids, quantise(vectors), query_ids, quantise(query_vectors), best[dims].k, best[dims].floor()))


def top_k(embeddings: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every row
    that ``queries`` (a condition on vec_id) admits."""
    rows = land(usable(embeddings), "topk-rows")
    with arrow_rows(embeddings.sparkSession, BLOCK_ROWS):
        found = search(rows, rows.where(queries), k, int, rows.limit(BLOCK_ROWS), scan)
    return ranked(found, k)
