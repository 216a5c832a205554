"""Exact nearest neighbours by a blocked matrix join.

Queries and candidates are dealt into tiles of bounded size, and every pair of tiles is one block.
Inside a block, vectors are of unit length and quantised to int8; the integer product of two tiles
gives all cosines up to an error that is bounded for each pair by the rounding errors of its two
vectors. A query keeps the candidates whose upper bound reaches its k-th largest lower bound; those
are computed again in double precision on the original vectors. Each block returns k rows for a
query, and the blocks are merged by a heap.

The query set is stated, so the number of blocks is queries times candidates over the tile sizes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_TILE, CANDIDATE_TILE = 2048, 8192
_EXACT = 1040  # so many products of two int8 are exact in a float32


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 rows, their scales, and the length of what rounding took from each (rows of length 1)."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - q * scale[:, None], axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows, in pieces short enough for float32."""
    out = np.zeros((len(a), len(b)), np.float64)
    for i in range(0, a.shape[1], _EXACT):
        out += a[:, i : i + _EXACT].astype(np.float32) @ b[:, i : i + _EXACT].astype(np.float32).T
    return out


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Of one vector with rows, each sum taken from left to right in double precision."""
    dot = np.cumsum(x * q, axis=1)[:, -1]
    return dot / (np.sqrt(np.cumsum(q * q)[-1]) * np.sqrt(np.cumsum(x * x, axis=1)[:, -1]))


def nearest_in_block(
    q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int
) -> Iterator[tuple[int, float, int]]:
    """(query, cosine, candidate) of the ``k`` nearest of each query in this block."""
    qu = q / np.linalg.norm(q, axis=1, keepdims=True)
    cu = c / np.linalg.norm(c, axis=1, keepdims=True)
    qi, qs, qe = quantised(qu)
    ci, cs, ce = quantised(cu)
    near = products(qi, ci) * qs[:, None] * cs[None, :]
    # |q.c - q'.c'| <= |q - q'| |c| + |q'| |c - c'|, with a little room for rounding in doubles.
    error = qe[:, None] + (1 + qe)[:, None] * ce[None, :] + 1e-9
    low, high = near - error, near + error
    own = q_ids[:, None] == c_ids[None, :]
    low[own] = high[own] = -np.inf
    at = max(0, len(c_ids) - k)
    bar = np.partition(low, at, axis=1)[:, at]
    for i in range(len(q_ids)):
        left = np.flatnonzero((high[i] >= bar[i]) & ~own[i])
        scores = cosine(q[i], c[left])
        best = heapq.nsmallest(k, zip(-scores, c_ids[left].tolist(), strict=True))
        for score, other in best:
            yield int(q_ids[i]), -float(score), other


def _blocks(k: int):
    schema = pa.schema({"query_id": pa.int64(), "score": pa.float64(), "vec_id": pa.int64()})

    def matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(len(rows), -1)
        # Scaling by a power of two is exact and keeps squares of extreme values in range.
        _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True))
        return rows.column("vec_id").to_numpy(), np.ldexp(x, -exponent)

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        if len(queries) and len(candidates):
            q_ids, q = matrix(queries)
            c_ids, c = matrix(candidates)
            for i in range(0, len(q), 256):
                part = slice(i, i + 256)
                for j in range(0, len(c), CANDIDATE_TILE):
                    block = slice(j, j + CANDIDATE_TILE)
                    found += nearest_in_block(q_ids[part], q[part], c_ids[block], c[block], k)
        columns = zip(*found, strict=True) if found else ([], [], [])
        return pa.Table.from_arrays(
            [pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema
        )

    return run


def _merge(k: int):
    schema = pa.schema(
        {"query_id": pa.int64(), "rank": pa.int32(), "vec_id": pa.int64(), "score": pa.float64()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heap, out = None, [], []

        def close() -> None:
            best = sorted((-s, -v) for s, v in heap)
            out.extend((now, i + 1, v, -s) for i, (s, v) in enumerate(best))

        def batch_of() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else ([], [], [], [])
            return pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema
            )

        for batch in batches:
            out = []
            for query, score, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if query != now:
                    close()
                    now, heap = query, []
                if (score, -other) not in heap:
                    (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (score, -other))
            yield batch_of()
        out = []
        close()
        yield batch_of()

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v, dim`` of the vectors that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    return rows.filter(
        F.col("vec_id").isNotNull() & finite & F.exists(v, lambda x: x != 0)
    ).withColumn("dim", F.size("v"))


def _tiled(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a tile number, and the number of tiles for each length of vector."""
    tiles = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("long").alias("tiles"))
    dealt = rows.join(tiles, "dim")
    return dealt.withColumn("tile", F.pmod(F.xxhash64("vec_id", "v"), "tiles")).drop("tiles"), tiles


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 5,
    query_tile: int = QUERY_TILE,
    candidate_tile: int = CANDIDATE_TILE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``vectors`` nearest to each query.

    Both have ``vec_id, embedding``. Nearness is the cosine in double precision; ties go to the
    smaller ``vec_id``; a row is never its own neighbour. Vectors that are null, empty, zero, or hold
    null or non-finite components, and rows without an id, take no part. Vectors are compared with
    those of their own length. Rows that repeat an id and a vector count once.
    """
    q, q_tiles = _tiled(usable(queries).distinct(), query_tile)
    c, c_tiles = _tiled(usable(vectors).distinct(), candidate_tile)
    number = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = q.join(c_tiles, "dim").select("dim", F.col("tile").alias("i"), number("tiles").alias("j"), "vec_id", "v")
    right = c.join(q_tiles, "dim").select("dim", number("tiles").alias("i"), F.col("tile").alias("j"), "vec_id", "v")
    found = (
        left.groupBy("dim", "i", "j")
        .cogroup(right.groupBy("dim", "i", "j"))
        .applyInArrow(_blocks(k), "query_id long, score double, vec_id long")
    )
    ordered = found.repartition("query_id").sortWithinPartitions("query_id")
    return ordered.mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")
