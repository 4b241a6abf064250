"""Whitening of embeddings: leading components by Chebyshev-filtered subspace iteration.

Method: a block of directions is multiplied by a polynomial of the covariance V that is small on the unwanted part of the spectrum and grows fast above it
(scaled Chebyshev recurrence). Each step of the recurrence is one pass over the vectors, V Q = X'(X Q) / n with centred X; the
product is summed by Spark, dimension by dimension, and V itself is never built. Then QR makes the block orthonormal and Rayleigh-Ritz
turns it into estimates of eigenvectors; a pass of its own measures their residuals |V q - e q|. This repeats until the residuals of all wanted
components are certified to be at rounding level, or stop falling there. A few Lanczos steps with full reorthogonalisation first give a lower
bound of the spectrum; the upper end of the unwanted part is the least estimate of the block, which holds more directions than are wanted.

Vectors become whole numbers, x = floor(64 c) + 1000000, written once. Their sums are exact, and so are the centred numbers n x - S that all passes
start from. What goes to the driver are sums by dimension and a block of (dimension x directions); what is broadcast is such a
block. Both depend on the width of the vectors alone, which is checked; no pass gathers rows.

Results for odd input: vectors that are NULL, empty, or hold NULL, non-finite or (as whole numbers) more than 62-bit entries take no part; nor
do vectors of another length than the commonest one (the shorter one of a tie). Repeated rows count as often as they occur; a NULL id is
kept. Components without variance, up to rounding, are left out: equal vectors have none, n different vectors at most n - 1. An empty table gives no rows. A
deviation beyond 64 bits is NULL. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from signal_lake.llm.common import as_column, prepare
from signal_lake.session import stage

COMPONENTS, EXTRA = 32, 16
SCALE, SHIFT = 64, 1_000_000
DEGREE, LANCZOS, ROUNDS = 10, 10, 60
#: A residual counts as rounding below this part of the greatest eigenvalue; components below the second part have no variance.
CERTIFIED, NOTHING = 1e-13, 1e-12
MOST_DIMENSIONS = 1 << 16
SEED = 20240701


def whole_vectors(table: DataFrame, id_column: Column, vector_column: Column) -> tuple[DataFrame, int]:
    """(staged rows (id, x) of the vectors that take part, their length)."""
    entry = vector_column.cast("array<double>")
    limit = float(1 << 62)
    fine = F.forall(entry, lambda c: F.coalesce(F.abs(c) * SCALE < limit, F.lit(False)) & ~F.isnan(c)) & (F.size(entry) > 0)
    rows = table.select(id_column.alias("id"), entry.alias("c")).where(F.coalesce(fine, F.lit(False)))
    number = F.transform("c", lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT)
    rows = stage(rows.select("id", number.alias("x")), "whole_vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    width = lengths[0]["d"] if lengths else 0
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors of more than {MOST_DIMENSIONS} entries")
    return rows.where(F.size("x") == width), width


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _exact_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), width)
                # Halves of 32 bits keep the sums of a batch inside 64 bits.
                low, high = (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)
                yield pa.record_batch(
                    [pa.array(np.arange(width), pa.int32()), pa.array(np.full(width, batch.num_rows), pa.int64()), pa.array(low), pa.array(high)],
                    ["j", "n", "low", "high"],
                )

    sums = rows.select("x").mapInArrow(add, "j int, n bigint, low bigint, high bigint").groupBy("j").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")]
    )
    found = sorted((r["j"], r["n"], int(r["high"]) * (1 << 32) + int(r["low"])) for r in sums.collect())
    return (found[0][1], [s for _, _, s in found]) if found else (0, [])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S as whole numbers, of Python's own kind where 64 bits might not do."""
    mean = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, mean, strict=True)]
    away = x - np.array(mean, dtype=np.int64)  # entries have at most 62 bits, so this fits
    if int(np.abs(away).max(initial=0)) * n + n < 1 << 62:
        return away * n - np.array(rest, dtype=np.int64)
    return away.astype(object) * n - np.array(rest, dtype=object)


def _passes(rows: DataFrame, width: int, n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """The product V Q as a function of Q: one pass over the vectors."""
    spark = rows.sparkSession

    def times(block: np.ndarray) -> np.ndarray:
        many = block.shape[1]
        shared = spark.sparkContext.broadcast(block)

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width, many))
            for batch in batches:
                if batch.num_rows:
                    away = centred(_matrix(batch.column(0), width), n, sums).astype(np.float64) / n
                    total += away.T @ (away @ shared.value)
            yield pa.record_batch([pa.array(np.arange(width), pa.int32()), *(pa.array(total[:, k].copy()) for k in range(many))], ["j", *(f"q{k}" for k in range(many))])

        fields = "j int, " + ", ".join(f"q{k} double" for k in range(many))
        parts = rows.select("x").mapInArrow(multiply, fields).groupBy("j").agg(*[F.sum(f"q{k}").alias(f"q{k}") for k in range(many)])
        result = np.zeros((width, many))
        for row in parts.collect():
            result[row["j"]] = row[1:]
        shared.unpersist()
        return result / n

    return times


def _lower_bound(times: Callable[[np.ndarray], np.ndarray], width: int, rng: np.random.Generator) -> float:
    """No eigenvalue lies below this, as far as Lanczos steps can tell: their least estimate less its residual."""
    basis = [rng.standard_normal(width)]
    basis[0] /= np.linalg.norm(basis[0])
    diagonal, beside = [], []
    for _ in range(min(LANCZOS, width)):
        w = times(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        for _ in range(2):
            for q in basis:
                w -= (q @ w) * q
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * max(abs(d) for d in diagonal):
            beside[-1] = 0.0
            break
        basis.append(w / beside[-1])
    inner = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    values, vectors = np.linalg.eigh(inner)
    return max(0.0, float(values[0] - beside[-1] * abs(vectors[-1, 0]) - beside[-1]))


def leading_components(times: Callable[[np.ndarray], np.ndarray], width: int, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(eigenvalues falling, unit eigenvectors in columns, greatest relative residual of each round) of the covariance that ``times`` applies."""
    rng = np.random.default_rng(SEED)
    wanted, many = min(components, width), min(components + EXTRA, width)
    block, _ = np.linalg.qr(rng.standard_normal((width, many)))
    low = _lower_bound(times, width, rng) if many < width else 0.0
    residuals: list[float] = []
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    image = times(block)
    for _ in range(ROUNDS):
        # Rayleigh-Ritz, then a pass with the turned block for residuals without the rounding of the turn.
        inner = block.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, _ = np.linalg.qr(block @ turn)
        image = times(block)
        values = np.einsum("ij,ij->j", block, image)
        top = max(float(values[0]), 0.0)
        if top == 0.0:
            return np.zeros(0), np.zeros((width, 0)), [0.0]
        gaps = np.linalg.norm(image - block * values, axis=0)[:wanted]
        residuals.append(float(gaps.max()) / top)
        if best is None or residuals[-1] < best[0]:
            best = (residuals[-1], values.copy(), block.copy())
        if residuals[-1] <= CERTIFIED or (len(residuals) > 2 and residuals[-1] <= 1e-11 and residuals[-1] > residuals[-2] / 2):
            break
        if many == width:
            continue  # the block spans all: only rounding is left
        cut = max(float(values[-1]), low + 1e-12 * top)
        # Scaled recurrence on [low, cut]; the scale keeps the greatest direction near its size.
        half, middle = (cut - low) / 2, (cut + low) / 2
        sigma = half / (top - middle) if top > middle else 1.0
        first = sigma
        earlier, now = block, (image - middle * block) * (sigma / half)
        for _ in range(2, DEGREE + 1):
            following = 1.0 / (2.0 / first - sigma)
            earlier, now = now, 2 * following / half * (times(now) - middle * now) - sigma * following * earlier
            sigma = following
        block, _ = np.linalg.qr(now)
        image = times(block)
    assert best is not None
    if best[0] > 1e-9:
        raise RuntimeError(f"components are not certified after {ROUNDS} rounds: residual {best[0]:.1e} of the greatest eigenvalue")
    order = np.argsort(-best[1][:wanted], kind="stable")
    values, vectors = best[1][:wanted][order], best[2][:, :wanted][:, order]
    real = values > NOTHING * values[0]
    return values[real], vectors[:, real], residuals


def _measure(rows: DataFrame, width: int, n: int, sums: list[int], axes: np.ndarray) -> tuple[float, np.ndarray]:
    """(trace of V, covariance of the whitened vectors), one pass each way."""
    many = axes.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(axes)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trace, products, total = 0.0, np.zeros((many, many)), np.zeros(many)
        for batch in batches:
            if batch.num_rows:
                away = centred(_matrix(batch.column(0), width), n, sums).astype(np.float64) / n
                white = away @ shared.value
                trace += float((away * away).sum())
                products += white.T @ white
                total += white.sum(axis=0)
        columns = [products[:, k].copy() for k in range(many)]
        yield pa.record_batch(
            [pa.array(np.arange(-1, many), pa.int32()), pa.array([trace, *total.tolist()]), *(pa.array([0.0, *c.tolist()]) for c in columns)],
            ["j", "s", *(f"p{k}" for k in range(many))],
        )

    names = ["s", *(f"p{k}" for k in range(many))]
    parts = rows.select("x").mapInArrow(measure, "j int, " + ", ".join(f"{c} double" for c in names)).groupBy("j").agg(*[F.sum(c).alias(c) for c in names])
    by_row = {r["j"]: r for r in parts.collect()}
    products = np.array([by_row[j][2:] for j in range(many)])
    mean = np.array([by_row[j]["s"] for j in range(many)]) / n
    return by_row[-1]["s"] / n, products / n - np.outer(mean, mean)


def whiten(
    table: DataFrame, id_column: Column | str = "vec_id", vector_column: Column | str = "embedding", name: str = "vec_id", components: int = COMPONENTS
) -> DataFrame:
    """(id as ``name``, component, n, deviation, whitened, explained, identity_error) of every vector and component."""
    spark = table.sparkSession
    prepare(spark)
    rows, width = whole_vectors(table, as_column(id_column), as_column(vector_column))
    fields = StructType([StructField(name, rows.schema["id"].dataType), *StructType.fromDDL("component int, n bigint, deviation bigint, whitened double, explained double, identity_error double").fields])
    n, sums = _exact_sums(rows, width) if width else (0, [])
    values, vectors, _ = leading_components(_passes(rows, width, n, sums), width, components) if n else (np.zeros(0), np.zeros((0, 0)), [])
    many = len(values)
    if not many:
        return spark.createDataFrame([], fields)
    axes = vectors / np.sqrt(values)
    trace, covariance = _measure(rows, width, n, sums, axes)
    error = float(np.abs(covariance - np.eye(many)).max())
    explained = values / trace
    shared = spark.sparkContext.broadcast(axes)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            away = centred(_matrix(batch.column(1), width), n, sums)
            if away.dtype != object and int(np.abs(away).max()) ** 2 * width < 1 << 63:
                deviation = (away * away).sum(axis=1).tolist()
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in away.tolist()]
                deviation = [v if v < 1 << 63 else None for v in exact]
            white = away.astype(np.float64) / n @ shared.value
            yield pa.record_batch(
                [batch.column(0).take(pa.array(np.repeat(np.arange(size), many))), pa.array(np.tile(np.arange(1, many + 1), size), pa.int32()),
                 pa.array(np.full(size * many, n), pa.int64()), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(size), many))),
                 pa.array(white.reshape(-1)), pa.array(np.tile(explained, size)), pa.array(np.full(size * many, error))],
                fields.names,
            )

    return rows.select("id", "x").mapInArrow(project, fields)
