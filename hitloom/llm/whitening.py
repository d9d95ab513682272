"""Whitening of vectors on the exact spectrum of their integer scatter matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, stage
from hitloom.llm.exact_spectrum import characteristic_mod, combine, isolate, null_vectors, primes_for

# Integer coordinates are floor(SCALE * entry) + SHIFT; entries beyond LARGEST count as not finite.
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 52) / SCALE
# Digits of the lower part in which sums travel.
PART_BITS = 40
# Residues, as 64-bit words, that a task works on at once.
RESIDUE_WORDS = 4_000_000


def coordinates(vector: Column) -> Column:
    """The integer coordinates of a vector as array<long>; null for a null or empty vector and for one with an
    entry that is null, not finite or larger than `LARGEST`."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    # null compares as neither, NaN as larger
    usable = F.forall(entries, lambda c: F.coalesce(F.abs(c) <= F.lit(LARGEST), F.lit(False)))
    whole = F.transform(entries, lambda c: F.floor(c * SCALE) + SHIFT)
    return F.when(usable & (F.size(entries) > 0), whole)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, size)


def _gram(y: np.ndarray) -> np.ndarray:
    """Y^T Y as Python integers; doubles are exact as long as no sum reaches 2^53."""
    largest = int(np.abs(y).max(initial=0))
    out = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    step = min((1 << 53) // max(largest * largest, 1), 1 << 16)
    if not step:
        whole = y.astype(object)
        return whole.T @ whole
    for a in range(0, len(y), step):
        part = y[a : a + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def scatter(fit: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, M) of the rows of `fit` (x): their number, the sums of x - SHIFT, and the integer scatter matrix
    n sum(y y^T) - S S^T, exact.

    A task sends its sums in two parts each; the driver gets one row for each pair of dimensions.
    """
    pairs = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(size, dtype=object), np.zeros((size, size), dtype=object)
        for batch in batches:
            y = _matrix(batch.column(0), size) - SHIFT
            n += len(y)
            total += y.astype(object).sum(0) if len(y) else 0
            products += _gram(y)
        values = [n, *total.tolist(), *products[pairs].tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(values)), pa.int64()),
                pa.array([str(v >> PART_BITS) for v in values]),
                pa.array([v & ((1 << PART_BITS) - 1) for v in values], pa.int64()),
            ],
            names=["i", "high", "low"],
        )

    sums = fit.select("x").mapInArrow(run, "i long, high string, low long").groupBy("i")
    sums = sums.agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    found = {r["i"]: (int(r["high"]) << PART_BITS) + int(r["low"]) for r in sums.collect()}
    n = found.get(0, 0)
    s = [found.get(1 + i, 0) for i in range(size)]
    m = [[0] * size for _ in range(size)]
    for at, (i, j) in enumerate(zip(*(p.tolist() for p in pairs), strict=True)):
        m[i][j] = m[j][i] = n * found.get(1 + size + at, 0) - s[i] * s[j]
    return n, s, m


def _spread(fit: DataFrame, rows: int) -> DataFrame:
    """Numbers below `rows`, one to a partition."""
    return fit.sparkSession.range(0, rows, 1, max(rows, 1))


def polynomial(fit: DataFrame, m: list[list[int]]) -> list[int]:
    """Characteristic polynomial of the matrix `m`, highest coefficient first; primes are dealt to tasks."""
    size = len(m)
    primes = primes_for(size, sum(m[i][i] for i in range(size)))
    step = max(1, min(8, RESIDUE_WORDS // (size * size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                found = characteristic_mod(m, primes[k * step : (k + 1) * step])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(k * step, k * step + len(found)), pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))],
                    names=["k", "residues"],
                )

    # as many rows as primes, as many residues in each as there are dimensions
    found = _spread(fit, -(-len(primes) // step)).mapInArrow(run, "k long, residues array<long>").orderBy("k").collect()
    return combine(np.array([r["residues"] for r in found], dtype=np.int64), primes)


def components(fit: DataFrame, m: list[list[int]], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (largest first, zeros left out) and unit eigenvectors of `m`, `most` at most; a root to a task."""
    size, trace = len(m), sum(m[i][i] for i in range(len(m)))
    if trace == 0:
        return np.zeros(0), np.zeros((0, size))
    poly = polynomial(fit, m)
    rank = size
    while poly[rank] == 0:
        rank -= 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                root, shift, number, multiple = isolate(poly, trace, k + 1)
                vector = null_vectors(m, trace, root, shift, multiple)[number]
                # the share of the trace, as integers of any size do not fit a double
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k]), pa.array([root / (trace << shift)]), pa.array([vector.tolist()])], names=["k", "share", "vector"]
                )

    found = _spread(fit, min(most, rank)).mapInArrow(run, "k long, share double, vector array<double>").orderBy("k").collect()
    return np.array([r["share"] for r in found]) * trace, np.array([r["vector"] for r in found])


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 16
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): each usable row of `vectors` projected
    on its leading components, one row for each of them.

    An entry c becomes x = floor(64 c) + 1000000. The fit list is each distinct x vector once: n of them with sums
    S. Components are unit eigenvectors of their covariance V, by falling eigenvalue e from 1 to `most` at most,
    the largest entry positive; directions without variance have no component. ``deviation`` is the sum
    over the dimensions of (n x - S)^2, null where that exceeds a long; ``whitened`` is (x - S / n) on the
    component over sqrt(e), ``explained`` e / trace(V), and ``identity_error`` the largest entry of the
    whitened fit list's covariance minus the identity.

    1. Distinct vectors are one grouping, copies are merged before they are shuffled.
    2. The integer scatter n sum(y y^T) - S S^T is summed exactly by tasks.
    3. Its characteristic polynomial is found modulo primes, some to a task, and put together by Chinese remainders.
    4. A task for each component isolates the root to `ROOT_BITS` binary digits by counting sign changes,
       and takes the null space of the matrix less the root in fixed-point arithmetic of as many digits.
    5. Rows are projected where they lie.

    The driver holds the matrix, its polynomial and the components: bounded by the dimensions, whatever the rows.
    Rows whose vector is null, empty, or has a null, non-finite or enormous entry (2^52 / 64) are dropped, and rows
    of another number of entries than most usable rows (of equal counts the longest) too. Repeated rows and null ids are
    kept; other columns are left out; where no component has variance, in an empty table say, there are no rows.
    """
    x, key = fresh(vectors, "x", "id")
    rows = vectors.select(F.col(id_col).alias(key), coordinates(F.col(vector_col)).alias(x)).filter(F.col(x).isNotNull())
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sizes = rows.groupBy(F.size(x).alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size = sizes["size"]
    rows = rows.filter(F.size(x) == size)
    fit = stage(rows.select(F.col(x).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "fit_list")
    n, s, m = scatter(fit, size)
    trace = sum(m[i][i] for i in range(size))
    values, axes = components(fit, m, most)
    count = len(values)
    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    # whitened = (x - S / n) . u / sqrt(e) with e = value / n^2
    project = axes.T / np.sqrt(values)
    explained = values / trace
    total = np.array(s, dtype=object)

    def distances(x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """n x - S in doubles, and the exact sums of its squares."""
        y = x - SHIFT
        if n * (int(np.abs(y).max(initial=0)) + 1) * 2 < 1 << 31 and size < 1 << 20:
            z = n * y - np.array(s, dtype=np.int64)
            if size * int(np.abs(z).max(initial=0)) ** 2 < 1 << 63:
                return z.astype(np.float64), (z * z).sum(1).tolist()
        whole = n * y.astype(object) - total
        return whole.astype(np.float64), (whole * whole).sum(1).tolist()

    def covariance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((count, count))
        for batch in batches:
            w = distances(_matrix(batch.column(0), size))[0] @ project
            products += w.T @ w
        i, j = np.indices(products.shape)
        yield pa.RecordBatch.from_arrays([pa.array(v.ravel()) for v in (i, j, products)], names=["i", "j", "sum"])

    cells = fit.select("x").mapInArrow(covariance, "i long, j long, sum double").groupBy("i", "j").agg(F.sum("sum").alias("sum"))
    error = cells.agg(F.max(F.abs(F.col("sum") / n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))).alias("error")).first()["error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, squares = distances(_matrix(batch.column(1), size))
            length = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(length), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), length)),
                    pa.array(np.full(length * count, n, dtype=np.int64)),
                    pa.array([v if v < 1 << 63 else None for v in squares for _ in range(count)], pa.int64()),
                    pa.array((z @ project).ravel()),
                    pa.array(np.tile(explained, length)),
                    pa.array(np.full(length * count, error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
