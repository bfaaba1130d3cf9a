"""Lagged values and lagged feature stacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourloom.functions.arrays import concat_features
from hourloom.functions.times import epoch_seconds
from hourloom.operators.frames import Keys, drop_any_null, key_list
from hourloom.operators.segments import HOUR, PIECE_ROWS, with_series_index


def _in_pieces(
    df: DataFrame, keys: list[str], ts: str, n: int, step_seconds: int | None, segment_seconds: int, piece_rows: int
) -> DataFrame:
    """Give each row its place in the series, and copy it to every piece that needs it.

    Series are cut into pieces of ``piece_rows`` places. The last ``n`` places of a
    piece also belong to the next one, so each piece finds all its lags by itself.
    Rows are at home where ``_piece = _home``.
    """
    if step_seconds:
        placed = df.withColumn("_place", F.floor(epoch_seconds(ts) / step_seconds))
    else:
        placed = with_series_index(df, keys, ts, "_place", segment_seconds)
    size = max(piece_rows, n)
    needed_next = F.pmod("_place", F.lit(size)) >= size - n
    pieces = F.when(needed_next, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
    return placed.withColumn("_home", F.floor(F.col("_place") / size)).withColumn("_piece", F.explode(pieces))


def with_lags(
    df: DataFrame,
    key: Keys,
    ts: str,
    cols: Sequence[str],
    n: int = 12,
    step_seconds: int | None = None,
    segment_seconds: int = PIECE_ROWS * HOUR,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Add ``{col}_lag_1`` .. ``{col}_lag_n``, the values of the n rows before.

    With ``step_seconds`` the series is known to be a regular grid and a row's place
    follows from its time; a lag that reaches over a hole is null. Without it rows are
    numbered first, at the price of one more shuffle, in pieces of time of
    ``segment_seconds`` that are cut finer where rows are dense.
    """
    keys = key_list(key)
    order = Window.partitionBy(*keys, "_piece").orderBy("_place")
    lags = {}
    for i in range(1, n + 1):
        for c in cols:
            lags[f"{c}_lag_{i}"] = F.lag(c, i).over(order)
            if step_seconds:
                near = F.col("_place") - F.lag("_place", i).over(order) == i
                lags[f"{c}_lag_{i}"] = F.when(near, lags[f"{c}_lag_{i}"])
    lagged = _in_pieces(df, keys, ts, n, step_seconds, segment_seconds, piece_rows).withColumns(lags)
    return lagged.where("_piece = _home").drop("_place", "_home", "_piece")


def lag_stack(
    df: DataFrame,
    key: Keys,
    ts: str,
    features: str,
    n: int = 12,
    out: str = "features",
    step_seconds: int | None = None,
    segment_seconds: int = PIECE_ROWS * HOUR,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """The feature array followed by those of the n rows before, newest first.

    Rows without a full history are dropped: the first ``n`` of each series, rows with
    a missing array among the n before, and, with ``step_seconds``, rows with a hole there.
    """
    keys = key_list(key)
    order = Window.partitionBy(*keys, "_piece").orderBy("_place")
    lags = {f"_lag_{i}": F.lag(features, i).over(order) for i in range(1, n + 1)}
    oldest = F.lag("_place", n).over(order)
    pieces = _in_pieces(df.select(*keys, ts, features), keys, ts, n, step_seconds, segment_seconds, piece_rows)
    # Places are unique, so n rows back being n places back leaves no hole between.
    full = pieces.withColumns({**lags, "_oldest": oldest}).where("_piece = _home AND _place - _oldest = " + str(n))
    parts = [features, *lags]
    return drop_any_null(full, parts).select(*keys, ts, concat_features(*parts).alias(out))
