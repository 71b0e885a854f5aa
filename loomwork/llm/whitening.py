"""Whitening of embeddings by shifted CholeskyQR.

The fitted matrix A has a row for each distinct vector, less the mean. A pass over it
sums the Gram matrix of Q = A R^-1, with R the triangular factor so far; the Cholesky
factor of that sum is multiplied onto R. The first sum is shifted, so that its
factorisation cannot fail, the next passes make the columns of Q orthonormal to double
precision. Singular values and right singular vectors of the small R are then those of A:
no Gram matrix of A itself is decomposed, whose condition is the square of that of A.

A pass is one map over the written table of distinct vectors; it sends one matrix per
task, which Spark sums by entry. The driver holds matrices of dimensions by dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.shared import cut_lineage

#: Entries are whole multiples of 1 / SCALE.
SCALE = 256
#: Larger entries cannot be held as whole multiples.
LARGEST = 2.0**50
#: Passes after the shifted one, at most; two are enough unless directions are missing.
PASSES = 6
#: How far from orthonormal Q may be.
ORTHONORMAL = 1e-12
#: Eigenvalues below this share of the largest are directions without variance.
NO_VARIANCE = 1e-13
#: Rows that NumPy works on at once.
ROWS = 4096

VECTOR = "_x"


@dataclass
class Whitener:
    n: int
    sums: list[int]  # exact, per dimension
    components: np.ndarray  # one unit vector per row, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def quantised(rows: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The usable rows, with floor(scale * entry) of each entry as the array ``_x`` of longs.

    Left out are null and empty vectors, and those with an entry that is null, not
    finite or beyond 2^50.
    """
    usable = F.forall(
        column, lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False)) & ~F.isnan(c.cast("double"))
    )
    whole = F.transform(column, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    return rows.where(F.coalesce(usable & (F.size(column) > 0), F.lit(False))).withColumn(VECTOR, whole)


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers."""
    if len(column) == 0:
        return np.zeros((0, 0), dtype=np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def triangular_solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows R^-1 for an upper triangular R, column by column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def summed(fit: DataFrame, made: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum over all rows of a square matrix that ``made`` computes for a block of them.

    Tasks sum their own rows; entries of tasks are then summed by place.
    """
    schema = pa.schema([("i", pa.int32()), ("row", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = matrix(batch.column(0))
            for start in range(0, len(rows), ROWS):
                total += made(rows[start : start + ROWS].astype(np.float64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], schema=schema
        )

    parts = fit.select(VECTOR).mapInArrow(run, "i int, row array<double>")
    entries = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for i, j, v in entries.collect():
        out[i, j] = v
    return out


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and the sum of each dimension as a whole number."""
    places = fit.select(F.posexplode(VECTOR).alias("j", "v")).groupBy("j")
    # sums of any size: 38 digits hold 10^22 entries of the largest kind
    found = places.agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(18,0)")).alias("s")).collect()
    return (found[0].n if found else 0), [int(r.s) for r in sorted(found, key=lambda r: r.j)]


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """An upper triangular factor of a Gram matrix, shifted only as far as it has to be."""
    try:
        return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
    except np.linalg.LinAlgError:
        unit = len(gram) * np.finfo(float).eps * max(float(np.trace(gram)), np.finfo(float).tiny)
        return _factor(gram, max(shift * 100, 11 * unit))


def fit_whitener(fit: DataFrame, most: int) -> Whitener | None:
    """Fit on a table of distinct vectors in ``_x``; at most ``most`` components.

    None for an empty table. Directions without variance give no component.
    """
    n, sums = exact_sums(fit)
    if n == 0:
        return None
    width = len(sums)
    mean = np.array([s / n for s in sums])
    solve = triangular_solve

    def gram_of(factor: np.ndarray | None) -> np.ndarray:
        def made(rows: np.ndarray) -> np.ndarray:
            q = rows - mean
            if factor is not None:
                q = solve(q, factor)
            return q.T @ q

        return summed(fit, made, width)

    gram = gram_of(None)
    if not gram.any():
        return Whitener(n, sums, np.zeros((0, width)), np.zeros(0), 0.0)
    # the shift of Fukaya and others (2020), of the order of the rounding of the sum
    shift = 11 * (n * width + width * (width + 1)) * (np.finfo(float).eps / 2) * np.linalg.norm(gram, 2)
    shift = min(shift, 1e-6 * np.linalg.norm(gram, 2))
    factor = _factor(gram, shift)
    before = np.inf
    for _ in range(PASSES):
        gram = gram_of(factor)
        # directions without variance stay without length in Q
        values = np.linalg.eigvalsh(gram)
        error = float(np.min(np.abs(np.stack([values, values - 1])), axis=0).max())
        if error < ORTHONORMAL or (error >= before / 2 and error < 1e-9):
            break
        before = error
        factor = _factor(gram, 0.0) @ factor
    _, singular, vectors = np.linalg.svd(factor)
    eigenvalues = singular**2 / n
    trace = float(eigenvalues.sum())
    kept = min(most, int((eigenvalues > NO_VARIANCE * eigenvalues[0]).sum()))
    components = vectors[:kept]
    signs = np.sign(components[np.arange(kept), np.abs(components).argmax(axis=1)])
    found = Whitener(n, sums, components * signs[:, None], eigenvalues[:kept], trace)
    project = found.components.T / np.sqrt(found.eigenvalues)

    def whitened(rows: np.ndarray) -> np.ndarray:
        w = (rows - mean) @ project
        return w.T @ w

    spread = summed(fit, whitened, kept) / n
    found.identity_error = float(np.abs(spread - np.eye(kept)).max(initial=0.0))
    return found


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n x - S)^2, exact; None where it does not fit into 64 bits."""
    if len(rows) == 0:
        return []
    reach = n * int(np.abs(rows).max()) + max(abs(s) for s in sums)
    if len(sums) * reach**2 < 1 << 63:
        apart = rows * n - np.array(sums, dtype=np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in rows.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error.

    One row for each usable vector and component. Vectors that ``quantised`` leaves out
    have none, nor have those of another length than the most frequent one (of two, the
    longer). A repeated vector counts once in the fit and keeps all its rows; a null or
    repeated id stays. If no dimension varies there is no component and no row; an empty
    table gives an empty one. ``deviation`` is null where it exceeds 64 bits. Other
    columns are not read.
    """
    spark = rows.sparkSession
    schema = (
        f"{key} bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double"
    )
    usable = quantised(rows.select(F.col(key).cast("bigint").alias(key), F.col(vector).alias("_vector")), "_vector")
    usable = usable.select(key, VECTOR)
    # a frequent vector is one row a task before it is shuffled
    fit = cut_lineage(usable.select(VECTOR).distinct())
    lengths = usable.groupBy(F.size(VECTOR).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).head(1)
    width = lengths[0].width if lengths else 0
    fit = fit.where(F.size(VECTOR) == width)
    usable = usable.where(F.size(VECTOR) == width)
    found = fit_whitener(fit, most)
    if found is None or len(found.components) == 0:
        return spark.createDataFrame([], schema)
    mean, project = found.mean, found.components.T / np.sqrt(found.eigenvalues)
    n, sums, kept = found.n, found.sums, len(found.eigenvalues)
    explained, error = found.eigenvalues / found.trace, found.identity_error
    out = pa.schema(
        [(key, pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
        + [(c, pa.float64()) for c in ("whitened", "explained", "identity_error")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                own = matrix(part.column(1))
                white = (own - mean) @ project
                each = np.repeat(np.arange(len(own)), kept)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(own))),
                        pa.array(np.full(len(each), n)),
                        pa.array(deviations(own, n, sums), pa.int64()).take(pa.array(each)),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, len(own))),
                        pa.array(np.full(len(each), error)),
                    ],
                    schema=out,
                )

    return usable.mapInArrow(run, schema)
