"""Whitening of embeddings by the principal components of their whole covariance.

Entries are put on a grid of integers, so sums and products are exact: each task multiplies its rows,
centred by the rounded mean, in pieces short enough for doubles to hold every sum, and Spark adds the
pieces up. The covariance is then the quotient of two integers and does not depend on how rows are
dealt out. Its eigenvectors start in float32 and are corrected by matrix products in extended
precision (the refinement of Ogita and Aishima). Eigenvalues too close for that are a cluster, whose
eigenvectors are turned by the solution of the small eigenproblem in their own subspace.

The driver holds the covariance, whose size depends on the length of a vector only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerlens.session import cut_lineage

SCALE, OFFSET = 1024, 100_000
LIMIT = float(1 << 30)
COMPONENTS = 8
_CHUNK = 4096
_LOW = 20  # bits of the lower part of a centred entry


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    fits = F.forall("v", lambda x: F.coalesce(F.abs(x) < LIMIT, F.lit(False)))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fits)
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("v") == (usual["d"] if usual else 0))


def grid(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """One row of whole numbers for each vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(len(column), -1) + OFFSET


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of whole numbers below 2**41 in size, as Python integers."""
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for i in range(0, len(y), _CHUNK):
        part = y[i : i + _CHUNK]
        if len(part) * float(np.abs(part).max()) ** 2 < 2.0**53:
            x = part.astype(np.float64)
            out += (x.T @ x).astype(np.int64).astype(object)
            continue
        high = (part >> _LOW).astype(np.float64)
        low = (part & ((1 << _LOW) - 1)).astype(np.float64)
        cross = (high.T @ low).astype(np.int64).astype(object)
        out += (high.T @ high).astype(np.int64).astype(object) << (2 * _LOW)
        out += (cross + cross.T) << _LOW
        out += (low.T @ low).astype(np.int64).astype(object)
    return out


def _totals(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> dict[tuple[int, int], int]:
    """The sum over all rows of the matrices that ``of`` gives for blocks of them (not zeros)."""
    schema = pa.schema({"i": pa.int32(), "j": pa.int32(), "x": pa.decimal128(38, 0)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                found = of(grid(batch.column("v")))
                total = found if total is None else total + found
        if total is not None:
            i, j = np.nonzero(total)
            values = pa.array([int(x) for x in total[i, j]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], schema=schema)

    parts = rows.select("v").mapInArrow(run, "i int, j int, x decimal(38,0)")
    return {(r[0], r[1]): int(r[2]) for r in parts.groupBy("i", "j").agg(F.sum("x").cast("decimal(38,0)")).collect()}


def _counted(x: np.ndarray) -> np.ndarray:
    """One row: how many, then the sums."""
    parts = x >> _LOW, x & ((1 << _LOW) - 1)
    high, low = (p.sum(axis=0).astype(object) for p in parts)
    return np.concatenate([[len(x)], (high << _LOW) + low]).astype(object)[None, :]


def quotient(numerator: int, denominator: int) -> np.longdouble:
    """Correct to more than a double's bits."""
    near = numerator / denominator
    a, b = near.as_integer_ratio()
    return np.longdouble(near) + np.longdouble((numerator * b - a * denominator) / (denominator * b))


def _clusters(values: np.ndarray, width: np.longdouble) -> list[np.ndarray]:
    """Runs of at least two places whose ``values`` are not further apart than ``width``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def refined_eigenvectors(a: np.ndarray, *, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors (columns) of a symmetric matrix in extended precision.

    Starts from those of the matrix in float32. Each round corrects all of them by four matrix
    products and about doubles the number of right digits.
    """
    wide = np.longdouble
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(len(a), wide), np.eye(len(a), dtype=wide)
    a = a.astype(wide) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(wide)
    one, size = np.eye(len(a), dtype=wide), np.sqrt((a * a).sum())
    tiny, noise = 8 * len(a) * np.finfo(wide).eps, 8 * size * np.finfo(wide).eps
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        rest = s - np.diag(values)
        width = 2 * (np.sqrt((rest * rest).sum()) + size * np.sqrt((r * r).sum()))
        apart = values[None, :] - values[:, None]
        clear = np.abs(apart) > width
        e = np.where(clear, (s + values[None, :] * r) / np.where(clear, apart, 1), r / 2)
        x = x + x @ e
        turned = False
        for c in _clusters(values, width):
            y = x[:, c]
            own = y.T @ (a @ y - values[c].mean() * y)
            spread = np.abs(own).max()
            off = np.abs(own - np.diag(np.diag(own))).max()
            if off > max(noise, spread * np.finfo(np.float64).eps):
                x[:, c] = y @ np.linalg.eigh((own / spread).astype(np.float64))[1]
                turned = True
        if not turned and np.abs(e).max() <= tiny:
            break
    return values * scale, x @ (1.5 * one - 0.5 * (x.T @ x))


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with ``sums``; ``components`` (columns) by falling ``eigenvalues``."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: np.longdouble

    def centre(self) -> list[int]:
        return [round(s / self.n) for s in self.sums]

    def explained(self) -> list[float | None]:
        """Each component's share of the variance; null when there is none at all."""
        return [float(max(e, 0) / self.trace) if self.trace else None for e in self.eigenvalues]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From all ``rows`` (see ``usable``); None when there are none."""
    totals = _totals(rows, _counted)
    if not totals:
        return None
    n = totals[0, 0]
    d = len(rows.select("v").first()[0])
    sums = [totals.get((0, i + 1), 0) for i in range(d)]
    centre = np.array([round(s / n) for s in sums])
    left = [s - n * int(m) for s, m in zip(sums, centre, strict=True)]
    products = _totals(rows, lambda x: np.triu(exact_products(x - centre)))
    v = np.zeros((d, d), np.longdouble)
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = quotient(n * products.get((i, j), 0) - left[i] * left[j], n * n)
    values, x = refined_eigenvectors(v)
    top = np.argsort(-values, kind="stable")[:components]
    x = x[:, top]
    # Either sign is right; this one is the same in every run.
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(top))] < 0, -1, 1)
    floor = 64 * d * np.finfo(np.longdouble).eps * np.abs(v).max()
    return Whitening(n, sums, x, np.where(values[top] > floor, values[top], 0), np.trace(v))


def _project(model: Whitening):
    schema = pa.schema({"deviation": pa.int64(), "w": pa.list_(pa.float64())})
    n, centre = model.n, np.array(model.centre())
    left = np.array([s - n * int(m) for s, m in zip(model.sums, centre, strict=True)], object)
    off = np.array([float(quotient(int(x), n)) for x in left])
    positive = model.eigenvalues > 0
    root = np.sqrt(np.where(positive, model.eigenvalues, 1))
    onto = (model.components / root).astype(np.float64)
    k, most = len(positive), int(np.iinfo(np.int64).max)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            y = grid(batch.column("v")) - centre
            bound = n * int(np.abs(y).max()) + max(abs(int(x)) for x in left)
            if bound * bound * len(left) <= most:
                deviation = ((n * y - left.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviation = [sum(int(v) ** 2 for v in n * row.astype(object) - left) for row in y]
                deviation = [x if x <= most else None for x in deviation]
            w = (y - off) @ onto
            mask = np.broadcast_to(~positive, w.shape).ravel()
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, w.size + 1, k, dtype=np.int32)), pa.array(w.ravel(), mask=mask)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviation, pa.int64()), lists],
                names=["vec_id", *schema.names],
            )

    return run


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation, w`` for each of ``rows``: ``w`` holds its whitened components."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(_project(model), f"vec_id {kind}, deviation bigint, w array<double>")


def identity_error(projected: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the covariance of the whitened rows minus the identity."""
    places = np.flatnonzero(model.eigenvalues > 0).tolist()
    w = [F.col("w")[i] for i in places]
    pairs = [(a, b) for a in range(len(w)) for b in range(a, len(w))]
    if not w:
        return 0.0
    row = projected.agg(*[F.sum(x) for x in w], *[F.sum(w[a] * w[b]) for a, b in pairs]).first()
    mean = [x / model.n for x in row[: len(w)]]
    covariance = [s / model.n - mean[a] * mean[b] for s, (a, b) in zip(row[len(w) :], pairs, strict=True)]
    return max(abs(c - (a == b)) for c, (a, b) in zip(covariance, pairs, strict=True))


def whitened(vectors: DataFrame, *, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Takes ``vec_id, embedding``. Vectors that are null or empty, or hold a null, an entry that is not
    finite, or one of 2**30 and more in size, are left out, and so are vectors of another length than
    most (the longer length, if two are as common). Rows that repeat count each, also without an id.
    A component without variance has a null ``whitened``; ``explained`` is null when there is none at
    all. ``deviation`` is null where it does not fit a long. An empty table gives no rows.
    """
    rows = usable(vectors)
    model = fit(rows, components)
    if model is None:
        found, error, shares = rows.selectExpr("vec_id", "0L AS deviation", "array(0D) AS w"), 0.0, [0.0]
    else:
        found = cut_lineage(project(rows, model))
        error, shares = identity_error(found, model), model.explained()
    by_place = F.array(*[F.lit(x).cast("double") for x in shares])
    out = found.select("vec_id", "deviation", F.posexplode("w").alias("_at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        by_place[F.col("_at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
