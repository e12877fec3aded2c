"""Exact nearest neighbours by a block matrix join with int8 product tiles.

Queries and candidates are dealt by a hash of their ids to blocks of about
``QUERY_BLOCK`` and ``CANDIDATE_BLOCK`` components.  Every query block meets every
candidate block in one tile: a row of the candidates is sent once per query
block, a row of the queries once per candidate block.

Inside a tile vectors are scaled to length 1 and rounded to int8 with a step
of their own.  The product of the int8 blocks gives all cosines with an error
bound from the norms of the rounding errors: |q.x - q'.x'| <= |q'| |x - x'| +
|q - q'|.  A query's k-th largest lower bound is its threshold; pairs whose
upper bound reaches it survive, are recomputed in double precision from the
original vectors, and the best k of a tile are kept in a heap.  Tiles' heaps
are merged into the final k, nearest first, ties to the smaller id.  So the
result is exact: recall is 1.

The products run on whole numbers below 2^24 held in float32 (longer vectors
are cut into slices), so they are exact int8 products.

Vectors that are null or empty, or hold a null or non-finite component, or only
zeros take no part, and neither do rows with a null id.  An id on several rows counts
once, with the first vector in the order of their components.  Vectors are
compared with those of their own length only.  A query with fewer candidates
than k gets them all; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barrio.llm.tables import kept, picked

QUERY_BLOCK, CANDIDATE_BLOCK = 1 << 17, 1 << 20      # components in a block
PART = 4096                       # candidates of a tile multiplied at a time
_SLICE = 1024                     # components whose int8 products stay below 2^24

BEST = "query_id long, vec_id long, score double"


def _rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as float32), their step, length of the rounded rows and of the errors."""
    unit = x / np.sqrt(np.sum(x * x, axis=1, keepdims=True))
    step = np.abs(unit).max(axis=1, keepdims=True) / 127
    whole = np.rint(unit / step)
    near = whole * step
    error = np.sqrt(np.sum((unit - near) ** 2, axis=1))
    return (whole.astype(np.float32), step[:, 0], np.sqrt(np.sum(near * near, axis=1)),
            # room for the rounding of these doubles themselves
            error * (1 + 1e-9) + 1e-12)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], _SLICE):
        out += a[:, i:i + _SLICE] @ b[:, i:i + _SLICE].T
    return out


def _dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row products, added component by component: equal rows give equal sums."""
    out = np.zeros(len(x))
    for i in range(x.shape[1]):
        out += x[:, i] * y[..., i]
    return out


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of a vector with rows, in double precision."""
    return _dot(x, q) / (np.sqrt(_dot(x, x)) * np.sqrt(_dot(q[None], q[None])))


def _fits(x: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two, so that squares neither over- nor underflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _tile_best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int
               ) -> Iterator[tuple[int, int, float]]:
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    q8, q_step, q_length, q_error = _rounded(q)
    for i in range(0, len(ids), PART):
        part, part_ids = x[i:i + PART], ids[i:i + PART]
        x8, x_step, _, x_error = _rounded(part)
        near = _products(q8, x8) * q_step[:, None] * x_step[None, :]
        error = q_length[:, None] * x_error[None, :] + q_error[:, None] + 1e-12
        own = query_ids[:, None] == part_ids[None, :]
        near[own] = -np.inf
        low = near - error
        have = min(k, len(part_ids))
        least = np.partition(low, len(part_ids) - have, axis=1)[:, len(part_ids) - have]
        for r, heap in enumerate(heaps):
            bound = least[r] if have == k else -np.inf
            if len(heap) == k:
                bound = max(bound, heap[0][0])
            survive = np.flatnonzero((near[r] + error[r] >= bound) & ~own[r])
            if not len(survive):
                continue
            score = cosine(q[r], part[survive])
            # of many equal scores only the smallest ids can enter the heap
            for j in np.lexsort((part_ids[survive], -score))[:k]:
                entry = (float(score[j]), -int(part_ids[survive[j]]))
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
    for query, heap in zip(query_ids.tolist(), heaps):
        for score, minus in heap:
            yield query, -minus, score


def _tile(k: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("vec_id").to_numpy()
        flat = table.column("vector").chunk(0).flatten().to_numpy() if len(ids) else np.empty(0)
        x = flat.reshape(len(ids), -1)
        is_query = table.column("is_query").to_numpy(zero_copy_only=False).astype(bool)

        def once(rows: np.ndarray) -> np.ndarray:
            """The first vector of each id."""
            order = np.lexsort([*x[rows].T[::-1], ids[rows]]) if len(set(ids[rows])) < len(rows) else \
                np.argsort(ids[rows])
            rows = rows[order]
            return rows[np.r_[True, ids[rows][1:] != ids[rows][:-1]]] if len(rows) else rows

        queries, candidates = once(np.flatnonzero(is_query)), once(np.flatnonzero(~is_query))
        fit = _fits(x) if len(x) else x
        rows = list(_tile_best(ids[candidates], fit[candidates], ids[queries], fit[queries], k)) \
            if len(queries) and len(candidates) else []
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})
    return run


def _merge(k: int):
    """Merges sorted lists of one query's tiles, given as rows sorted by query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, []

        def out() -> pa.RecordBatch:
            best = sorted(heap, reverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([query] * len(best), pa.int64()), pa.array(range(1, len(best) + 1), pa.int32()),
                 pa.array([-m for _, m in best], pa.int64()), pa.array([s for s, _ in best], pa.float64())],
                names=["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for q, v, s in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score"))):
                if q != query:
                    if heap:
                        yield out()
                    query, heap = q, []
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                elif (s, -v) > heap[0]:
                    heapq.heapreplace(heap, (s, -v))
        if heap:
            yield out()
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows by cosine of each row
    that ``is_query`` (a condition on the id, as column ``vec_id``) names."""
    rows = picked(vectors, vec_id=id_col, vector=vector_col)
    rows = (rows.withColumn("vector", F.col("vector").cast("array<double>"))
            .where("vec_id IS NOT NULL AND size(vector) > 0 AND exists(vector, v -> v <> 0) "
                   "AND forall(vector, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('infinity'))")
            .withColumn("vec_id", F.col("vec_id").cast("long")).withColumn("query", F.coalesce(is_query, F.lit(False))))
    # an id on several rows has its first vector, found before rows are dealt
    again = kept(rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id"), "nn-repeated")
    if not again.isEmpty():
        one = rows.join(again, "vec_id", "left_semi").groupBy("vec_id", "query").agg(F.min("vector").alias("vector"))
        rows = rows.join(again, "vec_id", "left_anti").unionByName(one)
    n, q = rows.agg(F.sum(F.size("vector")), F.sum(F.when(F.col("query"), F.size("vector")))).first()
    across, down = max(1, math.ceil((n or 0) / CANDIDATE_BLOCK)), max(1, math.ceil((q or 0) / QUERY_BLOCK))
    block = lambda n, salt: F.expr(f"cast(pmod(xxhash64(vec_id, {salt}), {n}) as int)")
    span = lambda n: F.explode(F.expr(f"sequence(0, {n - 1})"))
    cols = ["long", "x", "y", "is_query", "vec_id", "vector"]
    rows = rows.withColumn("long", F.size("vector"))
    wide = (rows.withColumn("is_query", F.lit(False)).withColumn("x", block(across, 1)).withColumn("y", span(down))
            .select(cols)
            .unionByName(rows.where("query").withColumn("is_query", F.lit(True))
                         .withColumn("y", block(down, 2)).withColumn("x", span(across)).select(cols)))
    best = wide.groupBy("long", "x", "y").applyInArrow(_tile(k), BEST)
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (kept(best, "nn-tiles").repartition(parts, "query_id").sortWithinPartitions("query_id")
            .mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double"))
