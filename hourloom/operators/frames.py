"""Small frame helpers shared by the other operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.functions.predicates import all_present

Keys = str | Sequence[str]


def key_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def required_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.where(all_present(cols))


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null column (an array counts as one value)."""
    return df.na.drop(subset=list(subset) if subset else None)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; columns pair up by position.

    One grouping of both sides: copies collapse before the shuffle, on either side.
    """
    tagged = left.withColumn("_side", F.lit(0)).union(right.withColumn("_side", F.lit(1)))
    return tagged.groupBy(*left.columns).agg(F.max("_side").alias("_side")).where("_side = 0").drop("_side")


def schema_merge_union(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks come out null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other, as they do in a window partition."""
    tagged = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(tagged, on, how).drop(*[f"_r_{k}" for k in keys])


def expand_rows(
    df: DataFrame, count: Column, keys: Sequence[str], index: str, block: int = 8192
) -> DataFrame:
    """Repeat each row ``count`` times, numbered from 0 in ``index``.

    One row may stand for very many: it is cut into blocks first, the blocks are
    spread over the cluster, and only then are they unrolled. The partition count
    is explicit because AQE would merge the tiny block rows into one task.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (
        df.withColumn("_n", count.cast("long"))
        .where(F.col("_n") > 0)
        .withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {block}"))))
        .repartition(parts, *keys, "_b")
    )
    first = F.col("_b") * block
    last = F.least(first + (block - 1), F.col("_n") - 1)
    return blocks.withColumn(index, F.explode(F.sequence(first, last))).drop("_n", "_b")
