"""Embedding whitening: leading components by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlens.llm.common import map_batches, written

#: An entry c becomes the integer floor(SCALE * c) + SHIFT; entries of LARGEST or more have no exact one.
SCALE, SHIFT, LARGEST = 1024, 100_000, float(1 << 40)
#: Vectors beside the wanted ones, highest degree of the filter, largest ratio it may open between wanted ones.
GUARD, DEGREE, SPREAD = 32, 10, 1e8
#: Rounds after which a block that is not certified grows to twice its width.
PATIENCE = 12
LONG = 1 << 63


def integer_vectors(rows: DataFrame, id_col: str, vector: str) -> tuple[DataFrame, int]:
    """``id, x`` for the vectors that count, and their number of dimensions (0 if there are none)."""
    fine = lambda c: c.isNotNull() & (F.abs(c) < LARGEST)  # noqa: E731  false for NaN and infinities
    given = rows.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("c"))
    given = given.filter(F.col("c").isNotNull() & (F.size("c") > 0) & F.forall("c", lambda c: F.coalesce(fine(c), F.lit(False))))
    x = F.transform("c", lambda c: F.floor(c * SCALE) + SHIFT)
    found = written(given.select("id", x.alias("x")), "x-vectors")
    sizes = found.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0
    return found.filter(F.size("x") == d), d


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def summed(x: DataFrame, d: int, make: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind: str) -> np.ndarray:
    """The sum of ``make`` over blocks of vectors. Each task adds up its own blocks first; the driver
    receives one number per entry of ``shape``, whatever the number of vectors."""
    size = int(np.prod(shape))
    dtype = np.int64 if kind == "bigint" else np.float64

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype)
        for batch in batches:
            if batch.num_rows:
                total += make(matrix(batch.column(0), d))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total.reshape(-1))], names=["cell", "value"])

    parts = map_batches(x.select("x"), run, f"cell bigint, value {kind}")
    out = np.zeros(size, dtype)
    for cell, value in parts.groupBy("cell").agg(F.sum("value")).collect():
        out[cell] = value
    return out.reshape(shape)


def centred(block: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S/n``, rounded once: the numerator is an exact integer as long as it fits."""
    whole, rest = np.divmod(sums, n)
    return (block - whole).astype(np.float64) - rest / n


def degree_for(ritz: np.ndarray, k: int, cut: float) -> int:
    """The highest degree that keeps the wanted directions within ``SPREAD`` of each other."""
    reach = np.arccosh(np.maximum(2 * ritz[[0, k - 1]] / max(cut, 1e-300) - 1, 1.0))
    growth = float(reach[0] - reach[1])
    return int(np.clip(np.log(SPREAD) / max(growth, 1e-9), 2, DEGREE))


def leading(apply: Callable[[np.ndarray], np.ndarray], d: int, k: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues and unit eigenvectors of the operator ``apply`` (d x d, no eigenvalue below 0).

    A block of ``k + GUARD`` vectors is filtered by a Chebyshev polynomial that stays within 1 on
    [0, smallest Ritz value of the block] and grows fast above; QR and Rayleigh-Ritz then give the
    next block. It ends when the residual norm of each wanted pair is at most ``tolerance`` times
    the largest eigenvalue. A block that takes too long doubles, at last to all d dimensions, where
    Rayleigh-Ritz itself is exact.
    """
    rng = np.random.default_rng(5)
    width = min(d, k + GUARD)
    block, _ = np.linalg.qr(rng.standard_normal((d, width)))
    rounds = 0
    while True:
        image = apply(block)
        inner = block.T @ image
        ritz, turn = np.linalg.eigh((inner + inner.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residual = np.linalg.norm(image[:, :k] - block[:, :k] * ritz[:k], axis=0)
        rounds += 1
        if width == d or residual.max() <= tolerance * max(ritz[0], 0.0):
            return ritz[:k], block[:, :k]
        cut = max(float(ritz[-1]), 1e-12 * float(ritz[0]))
        half = cut / 2
        before, now = block, (image - half * block) / half
        for _ in range(degree_for(ritz, k, cut) - 1):
            before, now = now, 2 * (apply(now) - half * now) / half - before
        now = now / np.linalg.norm(now, axis=0)
        if rounds % PATIENCE == 0:
            width = min(d, 2 * width)
            now = np.hstack([now, rng.standard_normal((d, width - now.shape[1]))])
        block, _ = np.linalg.qr(now)


def deviations(block: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n*x - S)^2, exactly; None where no long holds it."""
    rough = np.abs(block.astype(np.float64) * n - sums).max(initial=0.0)
    if rough * rough * block.shape[1] < LONG / 4:
        return ((block * n - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums.tolist(), strict=True)) for row in block.tolist()]
    return [e if e < LONG else None for e in exact]


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 8, tolerance: float = 1e-12
) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error`` per vector and component.

    An entry c counts as the integer x = floor(1024*c) + 100000. The covariance of the n x-vectors
    (divisor n, centred first) is never formed: each step multiplies it with a block of vectors in
    one distributed pass. Components are numbered from 1 by falling eigenvalue, at most ``k``; the
    largest entry of each is positive, the first such one of equal ones. ``deviation`` is the sum
    over dimensions of (n*x - S)^2 for the dimension sums S; ``whitened`` the centred vector on the component, over the
    root of the eigenvalue; ``explained`` the eigenvalue over the trace; ``identity_error`` one
    value, the largest entry of the whitened vectors' covariance minus the identity.

    A vector is left out if it is null, empty, holds an entry that is null, not finite or beyond
    2^40, or has another length than the most frequent one (the longer of equally frequent ones).
    Repeated rows count as often as they occur, and a null id stays null. Components without
    variance (below 1e-12 of the largest eigenvalue) are left out, so equal vectors give no rows,
    like an empty table. A deviation that no long holds is null. Other columns are ignored.
    """
    schema = (
        "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    named = [F.col("id").alias(id_col), *[F.col(c) for c in ("component", "n", "deviation", "whitened", "explained", "identity_error")]]
    x, d = integer_vectors(rows, id_col, vector)
    id_type = x.schema["id"].dataType.simpleString()
    schema = schema.replace("id bigint", f"id {id_type}", 1)
    n = x.count()
    if not n:
        return rows.sparkSession.createDataFrame([], schema).select(*named)
    sums = summed(x, d, lambda b: b.sum(axis=0), (d,), "bigint")

    def apply(block: np.ndarray) -> np.ndarray:
        def part(b: np.ndarray) -> np.ndarray:
            c = centred(b, n, sums)
            return c.T @ (c @ block)

        return summed(x, d, part, block.shape, "double") / n

    k = min(k, d)
    value, vectors = leading(apply, d, k, tolerance)
    trace = float(summed(x, d, lambda b: (centred(b, n, sums) ** 2).sum(axis=0), (d,), "double").sum()) / n
    kept = int((value > 1e-12 * max(value[0], 0.0)).sum()) if trace > 0 else 0
    if not kept:
        return rows.sparkSession.createDataFrame([], schema).select(*named)
    value, vectors = value[:kept], vectors[:, :kept]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    scaled = vectors / np.sqrt(value)

    def moments(b: np.ndarray) -> np.ndarray:
        w = centred(b, n, sums) @ scaled
        return np.vstack([w.T @ w, w.sum(axis=0)])

    total = summed(x, d, moments, (kept + 1, kept), "double") / n
    covariance = total[:kept] - np.outer(total[kept], total[kept])
    error = float(np.abs(covariance - np.eye(kept)).max())
    explained = value / trace

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            block = matrix(batch.column(1), d)
            rows_ = len(block)
            of = np.repeat(np.arange(rows_), kept)
            far = pa.array(deviations(block, n, sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of)),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows_)),
                    pa.array(np.full(rows_ * kept, n)),
                    far.take(pa.array(of)),
                    pa.array((centred(block, n, sums) @ scaled).reshape(-1)),
                    pa.array(np.tile(explained, rows_)),
                    pa.array(np.full(rows_ * kept, error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return map_batches(x.select("id", "x"), run, schema).select(*named)
