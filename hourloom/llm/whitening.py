"""PCA whitening of embeddings, fitted on distinct vectors weighted by their multiplicity.

1. Equal integer vectors are grouped; a group's weight is its count, or one.
2. Weighted sums give the mean exactly; weighted products of centred vectors the covariance.
   Tasks send one partial matrix, row by row, so no task or driver sees more than one row of
   each.
3. The covariance (d x d, whatever the number of vectors) is decomposed on the driver.
4. Each distinct vector is whitened once; the rows are joined back to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import in_slices, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Larger components count as this much; integers up to it are exact as doubles.
MOST = 2.0**52
#: Largest dimension: bounds the matrix that the driver decomposes to 32 MB.
MOST_DIMENSIONS = 2048
#: A component of a smaller share of the largest variance has none, but for rounding.
FLAT = 1e-13


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows whose vector has only finite entries: floor(64 c) + 1000000."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.greatest(F.least(F.lit(SCALE) * c, F.lit(MOST)), F.lit(-MOST))
    found = vectors.where("embedding IS NOT NULL").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(finite)
    return found.select("vec_id", F.transform("embedding", lambda c: F.floor(whole(c)) + F.lit(SHIFT).cast("long")).alias("x"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The rows of a list column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def by_dimension(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batches' vectors, those of one length at a time."""
    for batch in in_slices(batches):
        dims = pa.compute.list_value_length(batch.column("x")).to_numpy()
        for dim in np.unique(dims).tolist():
            yield dim, batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))


def exact_sums(x: np.ndarray, weight: np.ndarray) -> list[int]:
    """Weighted sums of the columns, as integers of any size."""
    if float(np.abs(x).max(initial=0)) * float(weight.sum(dtype=np.float64)) < 2.0**62:
        return (weight @ x).tolist()
    return [sum(w * v for w, v in zip(weight.tolist(), column)) for column in x.T.tolist()]


def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vectors their weight (at position -1) and sums, of one task."""
    total: dict[tuple[int, int], int] = {}
    for dim, batch in by_dimension(batches):
        x, weight = matrix(batch.column("x"), dim), batch.column("weight").to_numpy()
        for at, value in enumerate([int(weight.sum()), *exact_sums(x, weight)], -1):
            total[dim, at] = total.get((dim, at), 0) + value
    keys = list(total)
    arrays = [pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)]
    arrays.append(pa.array([Decimal(total[k]) for k in keys], pa.decimal128(38, 0)))
    yield pa.RecordBatch.from_arrays(arrays, ["dim", "at", "value"])


class Centre:
    """Count and exact sums of vectors; subtracts their mean without cancellation."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        whole = [(2 * s + n) // (2 * n) for s in sums]
        self.whole = np.array(whole, np.int64)
        self.rest = np.array([(s - n * w) / n for s, w in zip(sums, whole)])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exactly; None beyond 64 bits."""
        most = float(np.abs(x - self.whole).max(initial=0)) + 1
        if most * most * self.n * self.n * max(1, x.shape[1]) < 2.0**62 and self.n < 2**31:
            # n x - S is n (x - whole) - (S - n whole), and both stay small.
            left = np.array([s - self.n * w for s, w in zip(self.sums, self.whole.tolist())], np.int64)
            return np.square(self.n * (x - self.whole) - left).sum(1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [e if e < 2**63 else None for e in exact]


def partial_products(found: dict[int, tuple], project: bool):
    """Per length of vectors the weighted products of their centred (``project``: whitened)
    coordinates, of one task; one row of the matrix in each row. The last row has the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for dim, batch in by_dimension(batches):
            if dim not in found:
                continue
            weight = batch.column("weight").to_numpy().astype(np.float64)
            y = found[dim][0].centred(matrix(batch.column("x"), dim))
            if project:
                y = y @ found[dim][1]
            # Centred already; the sums of what rounding leaves go along as one more row.
            here = np.vstack([y.T @ (weight[:, None] * y), weight @ y])
            total[dim] = total[dim] + here if dim in total else here
        rows = [(dim, at, row) for dim, m in total.items() for at, row in enumerate(m)]
        arrays = [pa.array([r[i] for r in rows], pa.int32()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array([r[2] for r in rows], pa.list_(pa.float64()))], ["dim", "at", "row"])

    return run


def summed_rows(table: pa.Table) -> pa.Table:
    """One row of a matrix from the tasks' partial rows, in an order that reruns keep."""
    rows = np.stack(table.column("row").to_pylist())
    rows = rows[np.lexsort(rows.T[::-1])]
    first = table.slice(0, 1).select(["dim", "at"])
    return first.append_column("row", pa.array([rows.sum(0)], pa.list_(pa.float64())))


def covariances(distinct: DataFrame, found: dict[int, tuple], project: bool = False) -> dict[int, np.ndarray]:
    """The covariance of each length's centred or whitened vectors, divisor n."""
    schema = "dim int, at int, row array<double>"
    parts = distinct.mapInArrow(partial_products(found, project), schema)
    rows: dict[int, dict[int, list]] = {}
    for r in parts.groupBy("dim", "at").applyInArrow(summed_rows, schema).collect():
        rows.setdefault(r.dim, {})[r.at] = r.row
    out = {}
    for dim, by_place in rows.items():
        n = found[dim][0].n
        whole = np.array([by_place[at] for at in sorted(by_place)])
        mean = whole[-1] / n
        out[dim] = whole[:-1] / n - np.outer(mean, mean)
    return out


def decomposed(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Projection onto each component over its deviation, and each one's share of the trace.

    A component without variance has a column of NaN.
    """
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    flat = values <= FLAT * values[:1].sum()
    scaled = vectors / np.sqrt(np.where(flat, np.nan, values))
    trace = float(np.trace(covariance))
    return scaled[:, :components], values[:components] / trace if trace > 0 else np.full(min(components, len(values)), np.nan)


def whitened_batches(found: dict[int, tuple]):
    """Coordinates and deviation of each distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, batch in by_dimension(batches):
            if dim not in found:
                continue
            centre, projection = found[dim]
            x = matrix(batch.column("x"), dim)
            z = centre.centred(x) @ projection
            arrays = [batch.column("x"), pa.array(centre.deviations(x), pa.int64()), pa.array(list(z), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["x", "deviation", "z"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, weights: str = "counts") -> DataFrame:
    """Rows ``vec_id, component, n, deviation, whitened, explained, identity_error`` for every
    row with a finite vector and every component up to ``components``.

    ``weights`` says what a distinct vector counts in the fit: ``counts``, as many as its rows,
    or ``one``. n is the sum of the weights. Components are those of the covariance (divisor n)
    of floor(64 c) + 1000000, by falling variance; ``explained`` is a component's share of the
    trace. ``identity_error`` is the largest absolute entry of the whitened fit list's
    covariance minus the identity.

    Vectors that are null, or hold a null or an entry that isn't finite, are dropped; entries
    beyond 2**46 count as that. Rows without an id and rows that repeat stay. Vectors of each
    length have a fit of their own, so a column of one length has one fit; empty vectors have
    no component. A component without variance has a null ``whitened`` and takes no part in the
    ``identity_error``; a fit without variance has nulls there and in ``explained``. A deviation
    beyond 64 bits is null. Other columns are ignored; an empty table gives an empty one.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights: counts or one, not {weights!r}")
    spark = vectors.sparkSession
    rows = integer_vectors(vectors).where(F.size("x") > 0)
    weight = F.count("*") if weights == "counts" else F.lit(1).cast("long")
    distinct = stored(rows.groupBy("x").agg(F.count("*").alias("count")) if weights == "counts" else rows.select("x").distinct(), "distinct")
    distinct = distinct.select("x", (F.col("count") if weights == "counts" else weight).alias("weight"))

    sums: dict[int, dict[int, int]] = {}
    totals = distinct.mapInArrow(partial_sums, "dim int, at int, value decimal(38,0)").groupBy("dim", "at").agg(F.sum("value").alias("value"))
    for r in totals.collect():
        if r.dim > MOST_DIMENSIONS:
            raise ValueError(f"vectors of {r.dim} entries; the fit takes up to {MOST_DIMENSIONS}")
        sums.setdefault(r.dim, {})[r.at] = int(r.value)
    centres = {dim: (Centre(at[-1], [at[k] for k in range(dim)]),) for dim, at in sums.items()}
    fits = {dim: decomposed(v, components) for dim, v in covariances(distinct, centres).items()}
    found = {dim: (centres[dim][0], fits[dim][0]) for dim in fits}
    white = stored(distinct.mapInArrow(whitened_batches(found), "x array<bigint>, deviation long, z array<double>"), "whitened")

    facts = []
    for dim, cov in covariances(distinct, found, project=True).items():
        known = ~np.isnan(np.diag(cov))
        error = float(np.abs(cov[np.ix_(known, known)] - np.eye(int(known.sum()))).max()) if known.any() else None
        explained = [None if np.isnan(e) else float(e) for e in fits[dim][1]]
        facts.append((dim, found[dim][0].n, explained, error))
    facts = F.broadcast(spark.createDataFrame(facts, "dim int, n long, explained array<double>, identity_error double"))

    joined = rows.join(white, "x").withColumn("dim", F.size("x")).join(facts, "dim")
    pairs = F.posexplode(F.arrays_zip("z", "explained")).alias("at", "of")
    out = joined.select("vec_id", "n", "deviation", "identity_error", pairs)
    value = F.when(F.isnan("of.z"), None).otherwise(F.col("of.z"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        value.alias("whitened"), F.col("of.explained").alias("explained"), "identity_error",
    )
