"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors of integers are cut into 1, 2, 4, ... segments; a segment is known by its mean and deviation. For two vectors
the squared distance is at least the sum over segments of length * ((difference of means)^2 + (difference of
deviations)^2), and so, the norms being known, the inner product is at most the sum of length * (product of means +
product of deviations). Bounds are taken coarse to fine against the k-th best exact score so far; only the survivors'
exact integer products are computed.

Queries and candidates are packed into blocks, and each block of queries meets each block of candidates in a task of
its own, so the work is spread evenly however rows are distributed. A task holds one pair of blocks.

Vectors that are null, empty, or hold a null or non-finite component take no part, nor do rows with a null id.
Vectors of different lengths do not meet. Rows with the query's id are no candidates for it; a repeated candidate row
counts each time, a repeated query row is asked once more. Ties go to the smaller id. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept

HIT = "query_row long, query_id long, vec_id long, score long"
BLOCK = "dim int, ids binary, vectors binary"


def quantized(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component as a double; null where a component is null or not finite."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(whole & (F.size(v) > 0), F.transform(v, lambda x: F.floor(scale * x)))


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """(id, vector of longs) -> blocks of at most `most` rows of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, vectors = (np.concatenate(x) for x in zip(*held.pop(dim)))
            return pa.record_batch([pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary())], ["dim", "ids", "vectors"])

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            column = b.column(1)
            dims, flat = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(dims)])
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                for k in range(0, len(at), most):
                    part = at[k : k + most]
                    have = held.setdefault(dim, [])
                    if sum(len(x) for x, _ in have) + len(part) > most:
                        yield block(dim)
                        have = held.setdefault(dim, [])
                    have.append((ids[part], flat[starts[part][:, None] + np.arange(dim)]))
        for dim in list(held):
            yield block(dim)

    return rows.mapInArrow(pack, BLOCK)


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(length) * mean and sqrt(length) * deviation of each segment: products of these bound inner products."""
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)
    n = np.diff(edges).astype(float)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / n
    square = np.add.reduceat(x * x, edges[:-1], axis=1) / n
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([n, n]))


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; arbitrary precision where 64 bits might not do."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * len(q)
    if most < 2.0**62:
        return x @ q
    wide = x.astype(object) @ q.astype(object)
    return np.clip(wide, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def search_pair(qi: np.ndarray, q: np.ndarray, ci: np.ndarray, c: np.ndarray, k: int, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the query, ids, scores) of the k best of one block; `floor`: lower bounds of the k-th score, raised."""
    dim = q.shape[1]
    levels = [s for s in (1, 4, 16, 64) if s < dim] or [1]
    stats = [(segment_statistics(q.astype(float), s), segment_statistics(c.astype(float), s)) for s in levels]
    slack = 1e-9 * np.sqrt((c.astype(float) ** 2).sum(1).max(initial=0))
    norms = np.sqrt((q.astype(float) ** 2).sum(1))
    for i in range(len(q)):
        own = np.flatnonzero(ci != qi[i])
        if not len(own):
            continue
        bound = stats[0][1] @ stats[0][0][i]
        probe = own if len(own) <= 4 * k else own[np.argpartition(-bound[own], 4 * k)[: 4 * k]]
        if len(probe) >= k:
            floor[i] = max(floor[i], float(np.partition(exact_products(q[i], c[probe]), len(probe) - k)[len(probe) - k]))
        for level, (sq, sc) in enumerate(stats):
            bound = bound if level == 0 else None
            upper = (bound[own] if bound is not None else sc[own] @ sq[i]) + slack * norms[i] + 1e-6
            own = own[upper >= floor[i]]
        score = exact_products(q[i], c[own])
        best = np.lexsort((ci[own], -score))[:k]
        if len(best) == k:
            floor[i] = max(floor[i], float(score[best[-1]]))
        yield i, ci[own][best], score[best]


def top_k(
    vectors: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256,
    query_block: int = 512, block: int = 8192,
) -> DataFrame:
    """One row a query and rank: query_id, rank from 1, vec_id, score."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), quantized(vector, scale).alias("v"), is_query.alias("asks"))
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL")
    asked = _blocks(rows.where("asks").select("id", "v"), query_block)
    asked = kept(asked.withColumn("at", F.monotonically_increasing_id()))
    numbered = asked.select("at", "dim").groupBy("dim").agg(F.collect_list("at").alias("ats"))  # one number a block
    there = _blocks(rows.select("id", "v"), block).select("*", F.monotonically_increasing_id().alias("block"))
    pairs = there.join(numbered, "dim").select("ids", "vectors", F.explode("ats").alias("at"))
    pairs = pairs.join(asked.select("at", "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), "at")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, np.ndarray] = {}
        for b in batches:
            for row in b.to_pylist():
                qi, ci = (np.frombuffer(row[n], np.int64) for n in ("q_ids", "ids"))
                q, c = (np.frombuffer(row[n], np.int64).reshape(-1, row["dim"]) for n in ("q_vectors", "vectors"))
                floor = floors.setdefault(row["at"], np.full(len(qi), -np.inf))
                hits = list(search_pair(qi, q, ci, c, k, floor))
                n = [len(x) for _, x, _ in hits]
                places = np.repeat(np.array([i for i, _, _ in hits], np.int64), n)
                cols = [row["at"] * query_block + places, qi[places], *(np.concatenate([h[j] for h in hits] or [np.zeros(0, np.int64)]) for j in (1, 2))]
                yield pa.record_batch([pa.array(x, pa.int64()) for x in cols], ["query_row", "query_id", "vec_id", "score"])

    found = pairs.select("at", "dim", "q_ids", "q_vectors", "ids", "vectors").mapInArrow(search, HIT)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
