"""Whitening of embeddings: leading eigenvectors of the covariance by contour integration (FEAST).

Exact sums and the covariance come from Spark. The range of the eigenvalues is cut where inertia counts show gaps;
each interval is one Spark task that projects a block of vectors by complex shifted solves and extracts its
components. Counts prove that none is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, stored, table

SCALE, OFFSET = 64, 1_000_000
_LARGEST = 2.0**52  # beyond it a double has no place for the offset


def quantise(rows: DataFrame, vector: str, name: str) -> DataFrame:
    """``rows`` with ``name``: floor(64 * c) + 1000000 of each entry as packed longs, null where a row drops out.

    A row drops out whose vector is null, empty, or has an entry that is null, not finite or not below 2**52 / 64.
    """
    entries = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    good = (F.size(entries) > 0) & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < _LARGEST))
    longs = F.transform(entries, lambda c: F.floor(c * SCALE) + F.lit(OFFSET))
    return rows.withColumn(name, F.when(F.coalesce(good, F.lit(False)), longs))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums by dimension; a task sends one row for each dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n, total = n + len(x), total + (x - OFFSET).sum(0).astype(object)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(width), pa.int32()), "n": pa.array([n] * width, pa.int64()), "s": [str(int(t)) for t in total]})

    made = fit.mapInArrow(work, "i int, n bigint, s string").groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r["i"]: int(r["s"]) for r in made}
    n = made[0]["n"] if made else 0
    return n, [sums.get(i, 0) + OFFSET * n for i in range(width)]


def _products(vectors: DataFrame, width: int, out: int, centre: np.ndarray, basis: np.ndarray | None = None) -> np.ndarray:
    """Sum over the vectors of c c', with c the centred vector, or its projection on ``basis``; ``out`` entries a side."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast((centre, basis))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, onto = shared.value
        total = np.zeros((out, out))
        for batch in batches:
            c = (_matrix(batch.column(0), width) - OFFSET) - middle
            c = c if onto is None else c @ onto
            total += c.T @ c
        i, j = np.triu_indices(out)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])

    whole = np.zeros((out, out))
    for r in vectors.mapInArrow(work, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        whole[r["i"], r["j"]] = whole[r["j"], r["i"]] = r["v"]
    return whole


def row_norm(a: np.ndarray) -> float:
    """The greatest sum of a row's absolute entries, at least as great as every eigenvalue."""
    return float(np.abs(a).sum(1).max(initial=0))


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the tridiagonal matrix with the inertia of ``a - s I`` for every s (reflections)."""
    a = a.copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += math.copysign(size, v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Number of eigenvalues greater than ``shift``: the positive pivots of the shifted matrix, by Sylvester's law."""
    tiny = np.finfo(float).tiny
    count, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        pivot = d - shift - (off[i - 1] ** 2 / pivot if i else 0.0)
        if pivot == 0:
            pivot = -tiny
        count += bool(pivot > 0)
    return count


def cut_intervals(a: np.ndarray, wanted: int, most: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) that hold the ``wanted`` greatest eigenvalues, greatest first.

    Intervals are halved until they hold at most ``most``. Cuts stay off the eigenvalues: none lies within a millionth
    of the norm of a cut. A cluster that no such cut parts is one interval with all its eigenvalues.
    """
    diagonal, off = tridiagonal(a)
    norm = row_norm(a) or 1.0
    gap, floor = 1e-6 * norm, len(a) * np.finfo(float).eps * norm
    count = lambda s: above(diagonal, off, s)
    positive = min(wanted, count(2 * floor))
    out: list[tuple[float, float, int]] = []
    todo = [(-norm * 1e-2, norm * 1.01, count(-norm * 1e-2))]
    while todo and sum(n for _, _, n in out) < positive:
        low, high, n = todo.pop()
        if n == 0:
            continue
        if n > most and high - low > 8 * gap:
            # The middle first, then places beside it, until one is clear of eigenvalues.
            for share in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7, 0.2, 0.8, 0.1, 0.9):
                cut = low + share * (high - low)
                if count(cut - gap) == count(cut + gap):
                    top = count(cut) - count(high)
                    todo += [(low, cut, n - top), (cut, high, top)]
                    break
            else:
                out.append((low, high, n))
        else:
            out.append((low, high, n))
    return out


def feast(a: np.ndarray, low: float, high: float, inside: int, nodes: int = 8, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The ``inside`` eigenvalues of ``a`` in (low, high) and their vectors as columns.

    Each round applies the contour's filter to a block: Gauss-Legendre points on the upper half of the circle over the interval,
    a complex shifted solve for each, then Rayleigh-Ritz in the span. The block grows while fewer values than the
    inertia count gives lie inside, so that no component is missed; a block of full size holds all of them.
    """
    size = len(a)
    points, weights = np.polynomial.legendre.leggauss(nodes)
    angles = np.pi / 2 * (points + 1)
    centre, radius = (low + high) / 2, (high - low) / 2
    norm = row_norm(a)
    block = min(size, max(inside + 4, math.ceil(1.5 * inside)))
    while True:
        y = np.random.default_rng(size).standard_normal((size, block))
        worst = np.inf
        for _ in range(rounds):
            q = np.zeros_like(y)
            for angle, weight in zip(angles, weights):
                step = np.exp(1j * angle)
                q += weight / 2 * (radius * step * np.linalg.solve((centre + radius * step) * np.eye(size) - a, y)).real
            q, _ = np.linalg.qr(q)
            q, _ = np.linalg.qr(q)
            values, turned = np.linalg.eigh(q.T @ a @ q)
            y = q @ turned
            hit = (values > low) & (values < high)
            if hit.sum() == inside:
                left = np.linalg.norm(a @ y[:, hit] - y[:, hit] * values[hit], axis=0).max(initial=0)
                if left <= 64 * np.finfo(float).eps * norm or (left <= 1e-11 * norm and left >= worst / 2):
                    return values[hit], y[:, hit]
                worst = min(worst, left)
        if block == size:
            raise ArithmeticError(f"{inside} eigenvalues counted in ({low}, {high}), {int(hit.sum())} extracted")
        block = min(size, 2 * block)


def leading_components(spark: SparkSession, a: np.ndarray, wanted: int, most: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues of a covariance, falling, and their unit vectors as columns.

    One Spark task for each interval. Components whose eigenvalue is not above the rounding of the matrix are left out.
    """
    norm = row_norm(a)
    if norm == 0:
        return np.zeros(0), np.zeros((len(a), 0))
    intervals = cut_intervals(a, wanted, most)
    shared = spark.sparkContext.broadcast(a)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, inside in zip(*(c.to_pylist() for c in batch.columns)):
                values, vectors = feast(shared.value, low, high, inside)
                yield pa.RecordBatch.from_pydict({"value": values, "vector": pa.array(vectors.T.tolist(), pa.list_(pa.float64()))})

    # At most ``wanted`` intervals and vectors of one dimension's length reach the driver.
    found = spark.createDataFrame(intervals, "low double, high double, inside int").repartition(len(intervals)).mapInArrow(work, "value double, vector array<double>").collect()
    assert len(found) == sum(n for _, _, n in intervals)
    # Vectors of different intervals are orthogonal but for rounding; one more extraction over all of them removes that.
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in sorted(found, key=lambda r: -r["value"])]).T)
    values, turned = np.linalg.eigh(basis.T @ a @ basis)
    order = np.argsort(-values)[:wanted]
    order = order[values[order] > len(a) * np.finfo(float).eps * norm]
    return values[order], (basis @ turned)[:, order]


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 16) -> DataFrame:
    """``key``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error`` of every row that remains.

    Entries c become longs x = floor(64 * c) + 1000000. The covariance is that of the distinct x-vectors, centred before
    multiplying, divisor n. ``whitened`` projects x - S / n on a component, over the root of its eigenvalue;
    ``deviation`` is the exact sum of (n * x - S)**2 (null where a long does not hold it); ``explained`` the share of
    the trace; ``identity_error`` the largest entry of the fitted vectors' whitened covariance less the identity.

    A row drops out whose vector is null or empty or has a null, non-finite or too great entry (``quantise``). Vectors of another
    length than the most frequent (of ties: the greater) drop out too. Repeated rows come out as often as they
    come in, each vector counts once in the fit; null keys stay. Components of equal eigenvalue span their
    space in some turn, the same for all rows. There are as many components as the covariance has rank, ``components``
    at most, so an empty table, or one distinct vector, gives no row. Other columns are not read.
    """
    spark = rows.sparkSession
    x = fresh(rows.select(key), "x")
    read = quantise(rows.select(F.col(f"`{key}`"), F.col(f"`{vector}`").alias(x)), x, x).where(F.col(f"`{x}`").isNotNull())
    lengths = read.groupBy(F.size(x).alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    width = lengths[0]["size"] if lengths else 1
    read = read.where(F.size(x) == width)
    # Copies shrink to one row in each task before the shuffle.
    fit = stored(read.select(F.col(x).alias("x")).distinct(), "vectors")
    n, sums = _sums(fit, width)
    base = [s // max(n, 1) for s in sums]
    rest = [s - n * b for s, b in zip(sums, base)]
    # x - S / n is taken from whole numbers: first the whole part of the mean, then its fraction.
    centre = np.array([b - OFFSET for b in base]) + np.array([r / max(n, 1) for r in rest])
    covariance = _products(fit, width, width, centre) / max(n, 1)
    values, basis = leading_components(spark, covariance, components)
    scaled = basis / np.sqrt(values)
    k = len(values)
    error = float(np.abs(_products(fit, width, k, centre, scaled) / max(n, 1) - np.eye(k)).max(initial=0)) if k else 0.0
    explained = values / np.trace(covariance) if k else values
    shared = spark.sparkContext.broadcast((np.array(base, object), np.array(rest, object), centre, scaled, explained))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_, rest_, centre_, scaled_, explained_ = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                whole = _matrix(part.column(1), width)
                rows_ = len(whole)
                apart = whole - base_.astype(np.int64)
                if width * ((float(np.abs(apart).max(initial=0)) + 1) * n) ** 2 < 2.0**62:
                    deviation = ((apart * n - rest_.astype(np.int64)) ** 2).sum(1).tolist()
                else:
                    deviation = [d if d < 2**63 else None for d in ((apart.astype(object) * n - rest_) ** 2).sum(1)]
                white = ((whole - OFFSET) - centre_) @ scaled_
                copies = np.repeat(np.arange(rows_), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(copies)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_)), pa.array(np.full(len(copies), n)),
                     pa.array(deviation, pa.int64()).take(pa.array(copies)), pa.array(white.ravel()), pa.array(np.tile(explained_, rows_)), pa.array(np.full(len(copies), error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = read.schema[key].dataType.simpleString()
    return read.select(F.col(f"`{key}`"), F.col(x)).mapInArrow(
        work, f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def op13_whitening(spark, sf_dir):
    """The leading whitened components of every embedding."""
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op13_whitening": op13_whitening}
SQL: dict[str, str] = {}
