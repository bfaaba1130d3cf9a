"""Cutting long ordered series into bounded pieces.

A window over a whole series puts that series into one task. The helpers here cut
series into pieces of time, finer where rows are dense, and number the rows piece by
piece, so a series that holds a large share of the data is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourloom.operators.frames import join_on_keys
from hourloom.session import stored

HOUR = 3600
# Rows of an hourly series in one piece (a little under a year).
PIECE_ROWS = 8192
# Rows beyond which a piece of time is cut finer.
DENSE_ROWS = 4 * PIECE_ROWS
SEGMENT = "_segment"
# Pieces of a join that are sent to every task, at most.
BROADCAST_PIECES = 100_000


def slice_start(ts: str, micros: int) -> Column:
    """Start of the time slice of ``micros`` microseconds that a row falls into, in microseconds."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    return at - F.pmod(at, F.lit(micros))


def with_segment(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, most_rows: int = DENSE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Add the piece of time each row falls into, and give the rows ``_count`` of each piece.

    A piece is a time slice of ``seconds``, named by its start in microseconds. The rows of
    each series and slice are counted (an action; the counts are stored); slices with more
    than ``most_rows`` are cut finer and only their rows counted again, until no piece of
    distinct instants has more. So pieces follow the rows, not the clock; where no slice is
    dense, nothing but the count is added. Rows without a time have no piece and no count.
    """
    on = [*keys, SEGMENT]
    width = int(seconds * 1_000_000)
    cut = df.withColumn(SEGMENT, slice_start(ts, width))

    def counted(rows: DataFrame) -> DataFrame:
        return rows.where(F.col(SEGMENT).isNotNull()).groupBy(*on).agg(F.count(F.lit(1)).alias("_count"))

    counts = stored(counted(cut), "pieces")
    while width > 1:
        dense = counts.where(F.col("_count") > most_rows).select(*on, F.lit(True).alias("_dense"))
        most, n = counts.where(F.col("_count") > most_rows).agg(F.max("_count"), F.count("*")).first()
        if not n:
            break
        width = max(1, width >> (int(most) // most_rows).bit_length())
        found = join_on_keys(cut, F.broadcast(dense) if n <= BROADCAST_PIECES else dense, on, "left")
        finer = found.withColumn(SEGMENT, F.when(F.col("_dense"), slice_start(ts, width)).otherwise(F.col(SEGMENT)))
        again = counted(finer.where("_dense"))
        counts = stored(counts.where(F.col("_count") <= most_rows).unionByName(again), "pieces")
        cut = finer.drop("_dense")
    return cut, counts


def running_offsets(counts: DataFrame, keys: Sequence[str], n: str, offset: str) -> DataFrame:
    """Rows of the same series that come before each segment.

    ``counts`` has one row per series and segment, so this window is smaller than
    the series by the segment length.
    """
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(offset, F.coalesce(F.sum(n).over(before), F.lit(0)))


def with_series_index(
    df: DataFrame, keys: Sequence[str], ts: str, out: str, segment_seconds: int, most_rows: int = DENSE_ROWS
) -> DataFrame:
    """Number the rows of each series from 0 in time order ((keys, ts) must be unique).

    Rows whose key is null are a series too, as in a window; rows without a time belong to
    no series and are dropped. Join and window share one exchange: both go by one struct of
    the keys, in which nulls are equal.
    """
    pieces, counts = with_segment(df, keys, ts, segment_seconds, most_rows)
    place = F.struct(*keys, SEGMENT).alias("_place")
    offsets = running_offsets(counts, keys, "_count", "_offset").select(place, "_offset")
    inside = Window.partitionBy("_place").orderBy(ts)
    return (
        pieces.where(F.col(SEGMENT).isNotNull())
        .withColumn("_place", place)
        .join(offsets, "_place")
        .withColumn(out + "_", F.row_number().over(inside) - 1 + F.col("_offset"))
        .drop("_offset", SEGMENT, "_place")
        .withColumnRenamed(out + "_", out)
    )
