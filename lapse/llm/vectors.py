"""Searches of a query set against all rows of a vector table.

Rows are landed once and scanned in Arrow batches, which are the blocks of a
search. Queries are dealt into chunks of bounded size; a chunk is broadcast and
the rows are scanned for it, every task keeping the best of each query over all
its blocks. So nothing but the best rows of each task is shuffled, however many
rows and queries there are; the scans, like the comparisons, grow with rows
times chunks. A first scan of one block gives every query a bound to start from.

One reading of repeated rows: every row counts, as query and as candidate; a
query's own rows are those with its id.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapse.operators.materialize import land

BLOCK_ROWS = 4096
CHUNK_BYTES = 32 << 20  # of query vectors, broadcast at once
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
Queries = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # dims -> numbers, ids, vectors


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """Plans run inside move at most ``n`` rows per Arrow batch (a row may
    hold a whole block)."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(n))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def usable(embeddings: DataFrame, nonzero: bool = False) -> DataFrame:
    """(vec_id, v, dims) of rows whose vector has finite components only. Null
    ids take no part."""
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~F.coalesce(bad, F.lit(True)))
    if nonzero:
        rows = rows.where(F.exists("v", lambda x: x != 0.0))
    return rows.withColumn("dims", F.size("v"))


def vectors_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dims, ids, vectors) of a batch of rows (vec_id, v, dims), by length."""
    dims, ids, lists = (batch.column(c) for c in ("dims", "vec_id", "v"))
    dims, ids = dims.to_numpy(zero_copy_only=False), ids.to_numpy(zero_copy_only=False)
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield d, ids[at], flat.reshape(len(at), d) if d else np.zeros((len(at), 0))


def query_chunks(queries: DataFrame) -> Iterator[Queries]:
    """The queries in chunks of about ``CHUNK_BYTES``; numbers are unique."""
    size = queries.agg(F.sum(F.col("dims").cast("long") * 8 + 64)).first()[0] or 0
    n = max(1, math.ceil(size / CHUNK_BYTES))
    numbered = land(queries.withColumn("number", F.monotonically_increasing_id()), "search-queries")
    for c in range(n if size else 0):
        chunk = numbered.where(F.pmod(F.xxhash64("number"), F.lit(n)) == c).toArrow()
        found: Queries = {}
        for batch in chunk.combine_chunks().to_batches():
            numbers = batch.column("number").to_numpy(zero_copy_only=False)
            dims = batch.column("dims").to_numpy(zero_copy_only=False)
            for d, ids, vectors in vectors_of(batch):
                found[d] = (numbers[dims == d], ids, vectors)
        yield found


FOUND = "query_id long, number long, vec_id long, score"


class Best:
    """The k best rows of each query so far, larger scores first; equal ones by
    id. ``bound`` is a score that each query's k-th best reaches for sure."""

    def __init__(self, n_queries: int, k: int, kind, bound: np.ndarray | None = None):
        self.k = k
        self.worst = -np.inf if kind is float else np.iinfo(np.int64).min
        self.score = np.full((n_queries, k), self.worst, dtype=kind)
        self.ids = np.full((n_queries, k), np.iinfo(np.int64).max)
        self.n = np.zeros(n_queries, dtype=np.int64)
        self.bound = np.full(n_queries, -np.inf) if bound is None else bound

    def floor(self) -> np.ndarray:
        """What a row must score to matter."""
        return np.maximum(self.bound, np.where(self.n >= self.k, self.score[:, -1], -np.inf))

    def offer(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Merge rows given as (query, id, score), in any order."""
        if not len(query):
            return
        known = np.arange(self.k) < self.n[:, None]
        old = known.any(axis=1) & np.isin(np.arange(len(self.n)), query)
        q, j = np.nonzero(known & old[:, None])
        query = np.concatenate([query, q])
        ids, score = np.concatenate([ids, self.ids[q, j]]), np.concatenate([score, self.score[q, j]])
        # -score would overflow for the smallest integer.
        order = np.lexsort((ids, ~score if score.dtype.kind == "i" else -score, query))
        query, ids, score = query[order], ids[order], score[order]
        first = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
        sizes = np.diff(np.append(first, len(query)))
        place = np.arange(len(query)) - np.repeat(first, sizes)
        kept = place < self.k
        self.ids[query[kept], place[kept]], self.score[query[kept], place[kept]] = ids[kept], score[kept]
        self.n[query[first]] = np.minimum(sizes, self.k)

    def rows(self, numbers: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        q, j = np.nonzero(np.arange(self.k) < self.n[:, None])
        return [ids[q], numbers[q], self.ids[q, j], self.score[q, j]]


def search(
    blocks: DataFrame, queries: DataFrame, k: int, kind, pilot: DataFrame,
    scan: Callable[[pa.RecordBatch, Queries, dict[int, Best]], None],
) -> DataFrame:
    """Landed (query_id, number, vec_id, score), the k best rows of each query
    in each task. ``scan`` offers the rows of a batch of ``blocks`` to the best
    of their length; ``pilot`` is a block to take the first bounds from."""
    spark = blocks.sparkSession
    schema = f"{FOUND} {'double' if kind is float else 'long'}"

    def run_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunk, bounds = shared.value
            best = {d: Best(len(ids), k, kind, bounds.get(d)) for d, (_, ids, _) in chunk.items()}
            for batch in batches:
                scan(batch, chunk, best)
            for d, (numbers, ids, _) in chunk.items():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in best[d].rows(numbers, ids)], ["query_id", "number", "vec_id", "score"])

        return run

    out = None
    for chunk in query_chunks(queries):
        shared = spark.sparkContext.broadcast((chunk, {}))
        first = pilot.mapInArrow(run_with(shared), schema).groupBy("number").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        found = {r["number"]: r["kth"] for r in first.where(F.col("n") >= k).collect()}
        bounds = {d: np.array([found.get(x, -np.inf) for x in numbers.tolist()], dtype=float) for d, (numbers, _, _) in chunk.items()}
        shared = spark.sparkContext.broadcast((chunk, bounds))
        part = land(blocks.mapInArrow(run_with(shared), schema), "search-found")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows per query: query_id, rank, vec_id, score."""
    rank = F.row_number().over(Window.partitionBy("query_id", "number").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
