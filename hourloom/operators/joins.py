"""Joins. All are equi-joins; the planner broadcasts a side only below its own size limit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.functions.text import suffix_key
from hourloom.operators.frames import drop_any_null, prefix_columns


def right_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """All rows of ``right``, with the rows of ``left`` that match or nulls.

    Spark's outer join, each input read once. Null keys match nothing, so a null ``right``
    key comes out with nulls.
    """
    return left.join(right, left[left_key] == right[right_key], "right")


def two_role_dim_join(df: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str]) -> DataFrame:
    """Join one dimension once per role: ``roles`` maps a column prefix to the fact column.

    Facts without a match in every role, and dimension rows without facts, do not appear.
    """
    for prefix, fact_key in roles.items():
        side = prefix_columns(dim, prefix)
        df = df.join(side, F.col(fact_key) == F.col(prefix + dim_key), "inner").drop(prefix + dim_key)
    return df


def suffix_key_join(
    df: DataFrame, id_col: str, dim: DataFrame, dim_key: str, width: int = 5, pad_key_to: int | None = None
) -> DataFrame:
    """Inner join on the last ``width`` characters of ``id_col``.

    Keys shorter than ``width`` never match unless ``pad_key_to`` fills them up with zeros.
    """
    side = dim.withColumn(dim_key, F.lpad(F.col(dim_key), pad_key_to, "0")) if pad_key_to else dim
    return df.withColumn("_suffix", suffix_key(id_col, width)).join(
        side, F.col("_suffix") == F.col(dim_key), "inner"
    ).drop("_suffix")


def bucket_join(events: DataFrame, features: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Attach the features of the same place and hour; the key columns are dropped.

    ``on`` maps event columns to feature columns. Features are unique on their
    key, so events do not multiply; a busy hour is split by AQE's skew join.
    """
    left, right = events.alias("e"), features.alias("f")
    condition = [F.col(f"e.`{a}`") == F.col(f"f.`{b}`") for a, b in on.items()]
    kept = [F.col(f"e.`{c}`") for c in events.columns if c not in on]
    kept += [F.col(f"f.`{c}`") for c in features.columns if c not in on.values()]
    return drop_any_null(left.join(right, condition, "inner").select(*kept))


def two_sided_bucket_join(
    events: DataFrame,
    left_features: DataFrame,
    right_features: DataFrame,
    left_on: Mapping[str, str],
    right_on: Mapping[str, str],
) -> DataFrame:
    """Attach the features of two places, each at its own hour."""
    return bucket_join(bucket_join(events, left_features, left_on), right_features, right_on)
