"""Regular grids for irregular series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.functions.predicates import complete_at
from hourloom.functions.times import epoch_seconds
from hourloom.operators.frames import Keys, expand_rows, key_list
from hourloom.operators.segments import HOUR, PIECE_ROWS

#: Types that a hash aggregate can't keep as a result.
VARIABLE = (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType, T.VarcharType, T.CharType)


def complete_span(
    df: DataFrame, key: Keys, ts: str, required: Sequence[str], attrs: Sequence[str] = ()
) -> DataFrame:
    """First and last complete row of each series, with the attributes of the first.

    A series without a row in which every required column is present vanishes. (key, ts) must
    be unique, or the pick among rows of the same time is open. All goes by hash aggregates;
    attributes that are text are looked up at each series' first time.
    """
    keys = key_list(key)
    complete = df.withColumn("_at", complete_at(ts, required)).where(F.col("_at").isNotNull())
    span = [F.min("_at").alias("lo"), F.max("_at").alias("hi")]
    text = [a for a in attrs if isinstance(df.schema[a].dataType, VARIABLE)]
    spans = complete.groupBy(*keys).agg(*span, *[F.min_by(a, "_at").alias(a) for a in attrs if a not in text])
    if text:
        # One struct of the keys and the time, in which null keys are equal.
        first = complete.select(F.struct(*keys, F.col("_at").alias("lo")).alias("_place"), *text)
        spans = spans.withColumn("_place", F.struct(*keys, "lo")).join(first.dropDuplicates(["_place"]), "_place")
    return spans.select(*keys, "lo", "hi", *attrs)


def grid_size(step_seconds: int = HOUR):
    """Number of grid points from ``lo`` to ``hi``, both included."""
    return F.floor((epoch_seconds("hi") - epoch_seconds("lo")) / step_seconds) + 1


def hour_grid(span: DataFrame, key: Keys, ts: str, step_seconds: int = HOUR) -> DataFrame:
    """One row per series and grid point; other columns of ``span`` are repeated."""
    keys = key_list(key)
    grid = expand_rows(span, grid_size(step_seconds), keys, "_step", PIECE_ROWS)
    return grid.withColumn(
        ts, F.timestamp_seconds(epoch_seconds("lo") + F.col("_step") * step_seconds)
    ).drop("_step", "lo", "hi")


def resample(
    df: DataFrame,
    key: Keys,
    ts: str,
    required: Sequence[str],
    values: Sequence[str],
    attrs: Sequence[str] = (),
    step_seconds: int = HOUR,
    min_rows: int = 4,
) -> DataFrame:
    """Put each series on the full grid between its first and last complete row.

    Grid points without a reading have null values; readings outside the span are
    dropped; series with fewer than ``min_rows`` grid points are dropped before the
    grid is made. ``df`` must be unique on (key, ts).
    """
    keys = key_list(key)
    span = complete_span(df, keys, ts, required, attrs).where(grid_size(step_seconds) >= min_rows)
    grid = hour_grid(span, keys, ts, step_seconds)
    joined = grid.join(df.select(*keys, ts, *values), [*keys, ts], "left")
    return joined.select(*keys, ts, *attrs, *values)
