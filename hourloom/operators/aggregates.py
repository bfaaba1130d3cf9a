"""Grouped and per-partition aggregates.

All of them combine on the map side, so a key that holds a large share of the
rows reaches the reducers as a few partial rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourloom.functions.times import utc_hour
from hourloom.operators.firsts import attribute_ids, with_attribute_id
from hourloom.operators.frames import Keys, join_on_keys, key_list
from hourloom.operators.segments import DENSE_ROWS, HOUR, SEGMENT, with_segment
from hourloom.session import stored


def hourly_mean(
    df: DataFrame,
    key: Keys,
    ts: str,
    values: Sequence[str],
    attrs: Sequence[str] = (),
    hour: str = "hour",
    few_attributes: bool = False,
) -> DataFrame:
    """One row per key and hour: the mean of each value, attributes of the earliest reading.

    Nulls do not count towards a mean; an hour with nulls only has a null mean.
    Readings of the same instant are ordered by their attributes.

    ``few_attributes`` says that the readings of a key and hour mostly share their attributes,
    as those of a station do. Raw readings then go through hash aggregates only (see
    ``_few_attributes``), and are counted by an action; otherwise they are sorted by key and
    hour before the shuffle, which is what a minimum over text costs.
    """
    keys = key_list(key)
    hours = df.withColumn(hour, utc_hour(ts))
    if attrs and few_attributes:
        return _few_attributes(hours, keys, ts, values, list(attrs), hour)
    grouped = hours.groupBy(*keys, hour)
    means = [F.avg(v).alias(v) for v in values]
    if not attrs:
        return grouped.agg(*means)
    first = F.min(F.struct(ts, *attrs)).alias("_first")
    return grouped.agg(*means, first).select(
        *keys, hour, *[F.col(f"_first.{a}").alias(a) for a in attrs], *values
    )


def _few_attributes(
    hours: DataFrame, keys: list[str], ts: str, values: Sequence[str], attrs: list[str], hour: str
) -> DataFrame:
    """Means and first attributes without sorting the readings.

    The attributes are grouping keys at first, and grouping keys may be text in a hash
    aggregate; what is left is one row per key, hour and attributes. There the first
    attributes are the least of one number: the time in the hour, then the attributes' id.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    inside = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(hour), F.lit(0))
    sums = [F.sum(F.col(v).cast("double")).alias(f"_s{i}") for i, v in enumerate(values)]
    counts = [F.count(v).alias(f"_n{i}") for i, v in enumerate(values)]
    named = [F.col(k).alias(n) for k, n in zip(keys, names)]
    plain = hours.select(*named, F.col(hour).alias("_hour"), inside.alias("_t"), *dict.fromkeys([*attrs, *values]))
    parts = plain.groupBy(*names, "_hour", *attrs).agg(*sums, *counts, F.min("_t").alias("_t"))
    parts = stored(parts, "parts")
    ids = attribute_ids(parts, attrs)
    ranges = range(len(values))
    means = [(F.sum(f"_s{i}") / F.nullif(F.sum(f"_n{i}"), F.lit(0))).alias(v) for i, v in zip(ranges, values)]
    grouped = parts if ids is None else with_attribute_id(parts, ids, attrs, F.col("_t"))
    grouped = grouped.groupBy(*names, "_hour")
    if ids is None:
        least = grouped.agg(*means, F.min(F.struct("_t", *attrs)).alias("_first"))
        first = [F.col(f"_first.{a}").alias(a) for a in attrs]
    else:
        least = grouped.agg(*means, F.min("_first").alias("_first"))
        least = least.join(F.broadcast(ids), F.col("_first").bitwiseAND(F.lit((1 << 31) - 1)) == F.col("_id"))
        first = list(attrs)
    return least.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], F.col("_hour").alias(hour), *first, *values)


def partition_mean(df: DataFrame, keys: Keys, cols: Sequence[str], suffix: str = "_mean") -> DataFrame:
    """Every row with the mean of its group.

    Aggregated and joined back rather than windowed: a window would bring each
    whole group into one task.
    """
    names = key_list(keys)
    means = df.groupBy(*names).agg(*[F.avg(c).alias(c + suffix) for c in cols])
    return join_on_keys(df, means, names)


def first_last_non_null(df: DataFrame, keys: Keys, ts: str, col: str) -> DataFrame:
    """First and last non-null value of each group in time order ((keys, ts) must be unique)."""
    seen = F.when(F.col(col).isNotNull(), F.col(ts))
    return df.groupBy(*key_list(keys)).agg(
        F.min(seen).alias("first_ts"),
        F.min_by(col, seen).alias(f"first_{col}"),
        F.max(seen).alias("last_ts"),
        F.max_by(col, seen).alias(f"last_{col}"),
    )


def min_group_size(df: DataFrame, keys: Keys, min_rows: int) -> DataFrame:
    """Rows of the groups that have at least ``min_rows`` rows."""
    names = key_list(keys)
    big = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_count")).where(F.col("_count") >= min_rows)
    return join_on_keys(df, big.drop("_count"), names, "left_semi")


def top1_per_group(df: DataFrame, keys: Keys, order: Sequence[Column]) -> DataFrame:
    """First row of each group; give a total order, or the pick among ties is open.

    Spark keeps one row per group and task before the shuffle (window group limit).
    """
    ranked = Window.partitionBy(*key_list(keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def collect_sorted(
    df: DataFrame, keys: Keys, ts: str, value: str, segment_seconds: int = 24 * HOUR, most_rows: int = DENSE_ROWS
) -> DataFrame:
    """Values in time order as arrays, one array per key and time slice.

    The slice bounds the array: a whole series never becomes one row. A slice of more than
    ``most_rows`` values is cut finer, so its arrays start within the slice. Rows without a
    time are one slice of their own.
    """
    points = F.array_sort(F.collect_list(F.struct(F.col(ts).alias("x"), F.col(value).alias("y"))))
    pieces, _ = with_segment(df, key_list(keys), ts, segment_seconds, most_rows)
    grouped = pieces.groupBy(*key_list(keys), SEGMENT).agg(points.alias("_p"))
    return grouped.select(
        *key_list(keys),
        F.timestamp_micros(SEGMENT).alias("segment_start"),
        F.col("_p.x").alias("xs"),
        F.col("_p.y").alias("ys"),
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
