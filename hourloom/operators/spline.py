"""Natural cubic splines over series of any length and any number.

A natural spline couples all knots of a series, but the coupling fades: in its
diagonally dominant system each knot passes on at most half of a change, whatever
the spacing. A piece of a series solved together with the ``HALO`` knots on each
side is therefore within 2**-64 of the solution over the whole series, less than a
double can hold. Pieces are time slices of bounded rows; the halo is found by knot number, so it
holds 64 knots also where a column is nearly empty.

Pieces are not handed to Python one by one: a task streams its sorted rows in Arrow
batches, and all pieces of a batch are solved as one system. Many short series cost
no more than a few long ones.

The input is read several times (counts, edge knots, rows): pass a stored table
rather than a long unstored plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hourloom.operators.frames import Keys, join_on_keys, key_list
from hourloom.operators.segments import DENSE_ROWS, HOUR, PIECE_ROWS, SEGMENT, with_segment

HALO = 64
IS_HALO = "_halo"


def natural_slopes(x: np.ndarray, y: np.ndarray, piece: np.ndarray | None = None) -> np.ndarray:
    """The quadratic coefficient at each knot; zero at both ends of each piece.

    ``piece`` numbers the pieces that lie one after the other in ``x``. The tridiagonal
    system is solved by cyclic reduction on whole arrays: each round links every knot
    to knots twice as far away, until the links are gone.
    """
    n = len(x)
    if n < 3:
        return np.zeros(n)
    joined = np.ones(n - 1, bool) if piece is None else piece[1:] == piece[:-1]
    h = np.where(joined, np.diff(x), 1.0)
    slope = np.diff(y) / h
    inner = np.zeros(n, bool)
    inner[1:-1] = joined[:-1] & joined[1:]
    lower, upper, diag, rhs = np.zeros(n), np.zeros(n), np.ones(n), np.zeros(n)
    i = np.flatnonzero(inner)
    diag[i] = 2.0 * (h[i - 1] + h[i])
    rhs[i] = 3.0 * (slope[i] - slope[i - 1])
    lower[i] = np.where(inner[i - 1], h[i - 1], 0.0)
    upper[i] = np.where(inner[i + 1], h[i], 0.0)
    stride = 1
    while stride < n and (np.any(lower) or np.any(upper)):
        down = -lower[stride:] / diag[:-stride]
        up = -upper[:-stride] / diag[stride:]
        next_lower, next_upper = np.zeros(n), np.zeros(n)
        next_lower[stride:] = down * lower[:-stride]
        next_upper[:-stride] = up * upper[stride:]
        next_diag, next_rhs = diag.copy(), rhs.copy()
        next_diag[stride:] += down * upper[:-stride]
        next_rhs[stride:] += down * rhs[:-stride]
        next_diag[:-stride] += up * lower[stride:]
        next_rhs[:-stride] += up * rhs[stride:]
        lower, upper, diag, rhs = next_lower, next_upper, next_diag, next_rhs
        stride *= 2
    return rhs / diag


def polynomials(x: np.ndarray, y: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients (b, c, d) of the cubic from each knot to the next one.

    They have no meaning at the last knot of a piece.
    """
    c = natural_slopes(x, y, piece)
    h = np.where(piece[1:] == piece[:-1], np.diff(x), 1.0)
    b, d = np.zeros(len(x)), np.zeros(len(x))
    b[:-1] = np.diff(y) / h - h * (c[1:] + 2.0 * c[:-1]) / 3.0
    d[:-1] = np.diff(c) / (3.0 * h)
    return b, c, d


def fill_gaps(piece: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``y`` with its NaNs replaced; NaN stays outside the knots of a piece.

    Rows are sorted by piece and x. Two knots make a line.
    """
    known = ~np.isnan(y)
    if known.all() or not known.any():
        return y
    kp, kx, ky = piece[known], x[known], y[known]
    b, c, d = polynomials(kx, ky, kp)
    gaps = np.flatnonzero(~known)
    at = np.cumsum(known)[gaps] - 1
    following = np.minimum(at + 1, len(kx) - 1)
    inside = (at >= 0) & (at + 1 < len(kx)) & (kp[at] == piece[gaps]) & (kp[following] == piece[gaps])
    gaps, at = gaps[inside], at[inside]
    t = x[gaps] - kx[at]
    out = y.copy()
    out[gaps] = ky[at] + t * (b[at] + t * (c[at] + t * d[at]))
    return out


def _seconds(ts: pa.ChunkedArray) -> np.ndarray:
    """Seconds since the first instant of 2000, exact for microseconds over centuries."""
    micros = ts.cast(pa.timestamp("us")).cast(pa.int64()).to_numpy()
    return (micros - 946684800000000) / 1e6


def _starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Whether each row but the first has another key or segment than the one before."""
    new = np.zeros(rows.num_rows, bool)
    for k in (*keys, SEGMENT):
        codes = pc.dictionary_encode(rows[k].combine_chunks(), null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _by_whole_pieces(keys: Sequence[str], solve: Callable[[pa.Table, np.ndarray], pa.Table]):
    """Run ``solve`` on runs of complete pieces; the last piece of a batch waits for its rest.

    Each batch is looked at once; what waits is only known by its last row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[pa.Table, np.ndarray]] = []

        def solved(parts: list[tuple[pa.Table, np.ndarray]]) -> list[pa.RecordBatch]:
            rows = pa.concat_tables([p[0] for p in parts])
            return solve(rows, np.cumsum(np.concatenate([p[1] for p in parts]))).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            new = _starts(rows, keys)
            if waiting:
                edge = pa.concat_tables([waiting[-1][0].slice(waiting[-1][0].num_rows - 1), rows.slice(0, 1)])
                new[0] = _starts(edge, keys)[1]
            cut = int(np.flatnonzero(new)[-1]) if new.any() else 0
            if new.any():
                yield from solved([*waiting, (rows.slice(0, cut), new[:cut])])
                waiting = []
            waiting.append((rows.slice(cut), new[cut:]))
        if waiting:
            yield from solved(waiting)

    return run


def _halo_knots(rows: DataFrame, keys: list[str], ts: str, cols: Sequence[str]) -> DataFrame:
    """For each segment and column the ``HALO`` knots before and after it.

    Every segment offers its first and last knots and asks for those around it, both
    by knot number; offers and requests meet in one grouping per number. Series that
    fit in one segment take no part. The result has the shape of ``rows``: one value
    per row, other columns null.
    """
    ranks = range(len(cols))
    counts = rows.groupBy(*keys, SEGMENT).agg(*[F.count(c).alias(f"_n{i}") for i, c in enumerate(cols)])
    series = Window.partitionBy(*keys)
    earlier = series.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumns(
        {f"_before{i}": F.coalesce(F.sum(f"_n{i}").over(earlier), F.lit(0)) for i in ranks}
        | {f"_total{i}": F.sum(f"_n{i}").over(series) for i in ranks}
    ).where(reduce(or_, [F.col(f"_total{i}") > F.col(f"_n{i}") for i in ranks]))

    def numbers(first, last):
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    def wanted(i):
        before, end = F.col(f"_before{i}"), F.col(f"_before{i}") + F.col(f"_n{i}")
        around = F.concat(
            numbers(F.greatest(before - HALO, F.lit(0)), before - 1),
            numbers(end, F.least(end + HALO, F.col(f"_total{i}")) - 1),
        )
        return F.transform(around, lambda k: F.struct(F.lit(i).alias("_col"), k.alias("_knot")))

    requests = placed.select(*keys, F.col(SEGMENT).alias("_for"), F.inline(F.concat(*[wanted(i) for i in ranks])))

    inside = Window.partitionBy(*keys, SEGMENT).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_on_keys(rows.select(*keys, SEGMENT, ts, *cols), placed, [*keys, SEGMENT]).withColumns(
        {f"_rank{i}": F.count(c).over(inside) for i, c in enumerate(cols)}
    )

    def offer(i, c):
        rank, n = F.col(f"_rank{i}"), F.col(f"_n{i}")
        at_edge = F.col(c).isNotNull() & ((rank <= HALO) | (rank > n - HALO)) & (F.col(f"_total{i}") > n)
        knot = F.col(f"_before{i}") + rank - 1
        return F.when(at_edge, F.struct(F.lit(i).alias("_col"), knot.alias("_knot"), F.col(c).alias("_y")))

    offers = ranked.select(
        *keys, F.col(ts).alias("_x"), F.inline(F.array_compact(F.array(*[offer(i, c) for i, c in enumerate(cols)])))
    )
    point = F.struct("_x", "_y").alias("_point")
    messages = offers.select(*keys, "_col", "_knot", point).unionByName(requests, allowMissingColumns=True)
    met = (
        messages.groupBy(*keys, "_col", "_knot")
        .agg(F.collect_list("_point").alias("_points"), F.collect_list("_for").alias("_for"))
        .select(*keys, "_col", F.explode("_for").alias(SEGMENT), F.col("_points")[0].alias("_point"))
    )
    values = [F.when(F.col("_col") == i, F.col("_point._y")).alias(c) for i, c in enumerate(cols)]
    return met.select(*keys, SEGMENT, F.col("_point._x").alias(ts), *values)


def _prepared(
    df: DataFrame, keys: list[str], ts: str, cols: Sequence[str], segment_seconds: int, most_rows: int
) -> DataFrame:
    """Rows and halo knots in one frame, each segment whole and in time order.

    Values are doubles without NaN (a NaN is no measurement).
    """
    numbers = {c: F.col(c).cast("double") for c in cols}
    clean = df.withColumns({c: F.when(~F.isnan(v), v) for c, v in numbers.items()})
    rows, _ = with_segment(clean, keys, ts, segment_seconds, most_rows)
    halo = _halo_knots(rows, keys, ts, cols).withColumn(IS_HALO, F.lit(True))
    both = rows.withColumn(IS_HALO, F.lit(False)).unionByName(halo, allowMissingColumns=True)
    return both.repartition(*keys, SEGMENT).sortWithinPartitions(*keys, SEGMENT, ts)


def spline_fill(
    df: DataFrame,
    key: Keys,
    ts: str,
    cols: Sequence[str],
    on_few_knots: str = "linear",
    segment_seconds: int = PIECE_ROWS * HOUR,
    most_rows: int = DENSE_ROWS,
) -> DataFrame:
    """Fill the nulls of each column from the spline through its non-null points.

    Non-null values stay as they are. A null outside the known points raises, and a
    column without any known point stays null. A spline takes three knots: with
    fewer, ``on_few_knots`` is ``linear`` (two knots make a line) or ``error``.
    ``df`` must be unique on (key, ts); ``segment_seconds`` sets the piece length, and pieces
    of more than ``most_rows`` rows are cut finer.
    """
    if on_few_knots not in ("linear", "error"):
        raise ValueError("on_few_knots is 'linear' or 'error'")
    keys, cols = key_list(key), list(cols)
    names = df.columns

    def fill(rows: pa.Table, piece: np.ndarray) -> pa.Table:
        x = _seconds(rows[ts])
        core = ~rows[IS_HALO].to_numpy()
        out = rows.select(names).filter(pa.array(core))
        for col in cols:
            y = rows[col].to_numpy()
            knots = np.bincount(piece, ~np.isnan(y))[piece]
            gaps = np.isnan(y) & core & (knots > 0)
            if not gaps.any():
                continue
            if on_few_knots == "error" and (knots[gaps] < 3).any():
                raise ValueError(f"{col}: a spline needs three knots, found {int(knots[gaps].min())}")
            y = fill_gaps(piece, x, y)
            if np.isnan(y[gaps]).any():
                raise ValueError(f"{col}: a gap lies outside the known points")
            out = out.set_column(names.index(col), col, pa.array(y[core], from_pandas=True))
        return out

    filled = T.StructType(
        [T.StructField(f.name, T.DoubleType()) if f.name in cols else f for f in df.schema.fields]
    )
    prepared = _prepared(df, keys, ts, cols, segment_seconds, most_rows)
    return prepared.mapInArrow(_by_whole_pieces(keys, fill), filled)


def spline_coefficients(
    df: DataFrame,
    key: Keys,
    ts: str,
    col: str,
    unit_seconds: int = HOUR,
    segment_seconds: int = PIECE_ROWS * HOUR,
    most_rows: int = DENSE_ROWS,
) -> DataFrame:
    """The cubics of the spline: one row per knot but the last of each series.

    ``a + b t + c t**2 + d t**3`` holds from the knot ``ts`` to the next knot, with
    t in units of ``unit_seconds`` since that knot.
    """
    keys = key_list(key)
    types = {f.name: f for f in df.schema.fields}
    parts = [T.StructField(p, T.DoubleType()) for p in "abcd"]
    out = T.StructType([*[types[k] for k in keys], types[ts], *parts])

    def coefficients(rows: pa.Table, piece: np.ndarray) -> pa.Table:
        y = rows[col].to_numpy()
        b, c, d = polynomials(_seconds(rows[ts]) / unit_seconds, y, piece)
        followed = np.append(piece[1:] == piece[:-1], False)
        keep = followed & ~rows[IS_HALO].to_numpy()
        result = rows.select([*keys, ts]).filter(pa.array(keep))
        for name, values in zip("abcd", (y, b, c, d)):
            result = result.append_column(name, pa.array(values[keep]))
        return result

    knots = df.select(*keys, ts, col).where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    prepared = _prepared(knots, keys, ts, [col], segment_seconds, most_rows)
    return prepared.mapInArrow(_by_whole_pieces(keys, coefficients), out)
