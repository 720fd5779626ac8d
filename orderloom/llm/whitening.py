"""Embedding whitening with exact integer moments from bit planes.

An entry c becomes x = floor(1024 * c) + 100000. Each batch of rows subtracts
its smallest x, cuts what is left into bit planes, one bit a row, packs a plane's
bits of 64 rows into a word, and counts the ones of `plane & plane` for all pairs
of dimensions: the cross-product of two dimensions is the sum of those counts,
weighted by 2 to the bits' places. The subtracted shift is added back as
integers. Sums travel as decimals, so n * sum(xy) - sum(x) * sum(y), the
covariance times n squared, is exact before anything becomes a double.

Only the moments, at most width * (width + 3) / 2 numbers, reach the driver.

Rows whose vector is null, empty, or holds null or non-finite entries are
dropped, as are vectors shorter than the longest. Repeated rows and null ids
count as rows and are returned. x saturates at plus and minus 2^62. A
`deviation` that no long holds is null. A component without variance has null
`whitened` and no part in `identity_error`; components of equal eigenvalue
are those the decomposition gives. An empty table gives an empty result.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import written
from orderloom.llm.vectors import matrix, usable, values

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8

# Rows whose bit planes are held at a time, a multiple of the 64 rows of a word.
ROWS = 4096
_MOST = 1 << 62


def fixed_point(entries: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * entries) + SHIFT, -_MOST, _MOST).astype(np.int64)


def bit_planes(x: np.ndarray, bits: int) -> np.ndarray:
    """Words of 64 rows for every bit and dimension of the non-negative `x` (rows, dimensions)."""
    columns = np.zeros((x.shape[1], -len(x) % 64 + len(x)), np.uint64)
    columns[:, : len(x)] = x.T
    planes = [np.packbits((columns >> np.uint64(bit) & np.uint64(1)).astype(bool), axis=1).view(np.uint64) for bit in range(bits)]
    return np.stack(planes) if planes else np.zeros((0, x.shape[1], 0), np.uint64)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact (sums, cross-products) of the integer rows `x`, as Python integers where a long might not do."""
    base = int(x.min())
    span = int(x.max()) - base
    planes = bit_planes((x - base).astype(np.uint64) if span <= _MOST else (x.astype(object) - base).astype(np.uint64), span.bit_length())
    kind = np.int64 if 2 * span.bit_length() + len(x).bit_length() < 60 else object
    width = x.shape[1]
    cross, sums = np.zeros((width, width), kind), np.zeros(width, kind)
    for p, low in enumerate(planes):
        sums += np.bitwise_count(low).sum(axis=1, dtype=np.int64).astype(kind) * (1 << p)
        for q in range(p, len(planes)):
            both = np.stack([np.bitwise_count(row & planes[q]).sum(axis=1, dtype=np.int64) for row in low]).astype(kind)
            cross += (both if p == q else both + both.T) * (1 << p + q)
    cross, sums = cross.astype(object), sums.astype(object)
    whole = cross + base * (sums[:, None] + sums) + len(x) * base * base
    return sums + len(x) * base, whole


def _moments(column: str):
    """Of each batch: (width, i, j, text of the sum of products), j = -1 for sums and i = -1 for the count."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, starts, lengths = usable(batch, column)
            entries = values(batch, column)
            for width in np.unique(lengths):
                own = starts[lengths == width]
                for at in range(0, len(own), ROWS):
                    block = own[at : at + ROWS]
                    sums, cross = scatter(fixed_point(entries[block[:, None] + np.arange(width)]))
                    i, j = np.triu_indices(width)
                    found = [str(len(block)), *map(str, sums), *map(str, cross[i, j])]
                    places = np.concatenate([[-1], np.arange(width), i]), np.concatenate([np.full(width + 1, -1), j])
                    ints = [pa.array(c, pa.int32()) for c in (np.full(len(found), width), *places)]
                    yield pa.record_batch([*ints, pa.array(found)], names=["width", "i", "j", "total"])

    return of


@dataclass(frozen=True)
class Whitening:
    """Fitted integers and components of `width` dimensions; `center` holds S, `covariance` n squared times V, exactly."""

    width: int
    n: int
    center: list[int]
    covariance: list[list[int]]

    def axes(self) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues, falling, and unit eigenvectors as columns."""
        v = np.array([[m / (self.n * self.n) for m in row] for row in self.covariance])
        e, vectors = np.linalg.eigh(v)
        return e[::-1], vectors[:, ::-1]


def fitted(vectors: DataFrame, column: str = "embedding") -> Whitening | None:
    """Moments of all usable vectors of the greatest length; None if there is none."""
    parts = vectors.select(column).mapInArrow(_moments(column), "width int, i int, j int, total string")
    totals = parts.groupBy("width", "i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total"))
    last = written(totals, "moments")
    width = last.agg(F.max("width")).first()[0]
    if width is None:
        return None
    rows = {(r.i, r.j): int(r.total) for r in last.filter(F.col("width") == width).collect()}
    n, center = rows[-1, -1], [rows[i, -1] for i in range(width)]
    covariance = [[n * rows[min(i, j), max(i, j)] - center[i] * center[j] for j in range(width)] for i in range(width)]
    return Whitening(width, n, center, covariance)


def _deviations(x: np.ndarray, fit: Whitening) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; None beyond a long."""
    far = max(abs(fit.n * int(e) - s) for e, s in ((m, s) for m in (x.min(), x.max()) for s in (min(fit.center), max(fit.center))))
    if far * far * fit.width < 1 << 62 and fit.n * int(np.abs(x).max()) < 1 << 62:
        apart = fit.n * x - np.array(fit.center, np.int64)
        return np.einsum("ij,ij->i", apart, apart).tolist()
    exact = [sum((fit.n * int(e) - s) ** 2 for e, s in zip(row, fit.center)) for row in x]
    return [d if d < 1 << 63 else None for d in exact]


def whitened(vectors: DataFrame, fit: Whitening, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, deviation, whitened) of the usable vectors, `whitened` the first components in order."""
    e, axes = fit.axes()
    kept = min(components, fit.width)
    some = e[:kept] > fit.width * np.finfo(float).eps * max(e[0], 0)
    project = np.divide(axes[:, :kept], np.sqrt(np.where(some, e[:kept], 1)))
    # (n * x - S) / n keeps the whole precision of x - S / n.
    mean = [divmod(s, fit.n) for s in fit.center]
    whole, rest = np.array([q for q, _ in mean], np.int64), np.array([r / fit.n for _, r in mean])

    def project_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, entries = matrix(batch, column, fit.width)
            if not len(rows):
                continue
            x = fixed_point(entries)
            white = ((x - whole) - rest) @ project
            filled = pa.array(white.ravel(), mask=np.tile(~some, len(rows)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * kept), filled)
            yield pa.record_batch([batch.column("vec_id").take(pa.array(rows)), pa.array(_deviations(x, fit), pa.int64()), lists], names=["vec_id", "deviation", "whitened"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", column).mapInArrow(project_rows, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(white: DataFrame, kept: int) -> float:
    """Largest absolute entry of the covariance of the whitened components minus the identity."""
    pairs = [(i, j) for i in range(kept) for j in range(i, kept)]
    found = white.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs]).first()
    return max((abs(v - (i == j)) for v, (i, j) in zip(found, pairs) if v is not None), default=0.0)


def whitening(vectors: DataFrame) -> DataFrame:
    """One row per usable vector and component, numbered from 1 by falling eigenvalue."""
    fit = fitted(vectors)
    if fit is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    white = written(whitened(vectors, fit), "whitened")
    kept = min(COMPONENTS, fit.width)
    e, _ = fit.axes()
    trace = sum(fit.covariance[i][i] for i in range(fit.width)) / (fit.n * fit.n)
    shares = F.array(*[F.lit(float(v / trace) if trace else 0.0) for v in e[:kept]])
    rows = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        shares[F.col("at")].alias("explained"),
        F.lit(float(identity_error(white, kept))).alias("identity_error"),
    )
