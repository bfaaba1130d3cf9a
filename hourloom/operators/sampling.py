"""Class balancing and a repeatable split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourloom.operators.frames import expand_rows

# Leading hex digits of the shuffle key that name a bucket: 16**4 buckets.
BUCKET_DIGITS = 4


def shuffle_key(cols: Sequence[str], seed: int = 42) -> Column:
    """Text that puts rows in a random but repeatable order.

    A digest of the row's id and the seed: unlike ``rand`` it does not depend on how
    the rows are partitioned, so a recomputed task draws the same order. Several
    columns are hashed first; rows that differ may then, rarely, share a key.
    """
    text = F.col(cols[0]).cast("string") if len(cols) == 1 else F.hex(F.xxhash64(*cols))
    return F.md5(F.concat(text, F.lit(f":{seed}")))


def random_order(df: DataFrame, id_cols: Sequence[str], seed: int = 42) -> DataFrame:
    return df.orderBy(shuffle_key(id_cols, seed), *id_cols)


def undersample(
    df: DataFrame,
    label: str,
    seed: int = 42,
    id_cols: Sequence[str] | None = None,
    classes: Sequence = (0, 1),
    fraction: float = 0.8,
) -> DataFrame:
    """Keep the same number of rows of each class, as many as the rarest has.

    Adds ``in_train``: true for the first ``fraction`` of each class in shuffle
    order. ``id_cols`` name a unique id; without one all columns are used, and equal
    rows, which are interchangeable, are drawn by number.

    Ranking a class by a window would put it into one task. Instead rows are counted
    per bucket of their shuffle key. A bucket that lies wholly before or after a cut
    needs no rank and its rows are not shuffled; only buckets that hold a cut are ranked.
    """
    ids = list(id_cols or [c for c in df.columns])
    keyed = (
        df.where(F.col(label).isin(*classes))
        .withColumn("_order", shuffle_key(ids, seed))
        .withColumn("_bucket", F.left("_order", F.lit(BUCKET_DIGITS)))
    )
    # At most 16**4 rows per class, so small enough for one task and for a broadcast.
    counts = keyed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy()
    cuts = (
        counts.withColumn("_start", F.sum("_n").over(Window.partitionBy(label).orderBy("_bucket")) - F.col("_n"))
        .withColumn("_size", F.sum("_n").over(Window.partitionBy(label)))
        .withColumn("_smallest", F.min("_size").over(everything))
        .withColumn("_classes", F.size(F.collect_set(label).over(everything)))
        .withColumn("_keep", F.when(F.col("_classes") == len(classes), F.col("_smallest")).otherwise(0))
        .withColumn("_train", F.floor(F.col("_keep") * fraction))
        .select(label, "_bucket", "_n", "_start", "_keep", "_train")
    )
    placed = keyed.join(F.broadcast(cuts), [label, "_bucket"]).where("_start < _keep")
    end = F.col("_start") + F.col("_n")
    whole = (end <= F.col("_train")) | ((F.col("_start") >= F.col("_train")) & (end <= F.col("_keep")))
    settled = placed.where(whole).withColumn("in_train", end <= F.col("_train")).select(*df.columns, "in_train")

    cut = placed.where(~whole)
    if id_cols:
        rank = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_order", *ids))
        drawn = (
            cut.withColumn("_place", rank + F.col("_start"))
            .where("_place <= _keep")
            .withColumn("in_train", F.col("_place") <= F.col("_train"))
        )
    else:
        drawn = _draw_copies(cut, df.columns, label)
    return settled.unionByName(drawn.select(*df.columns, "in_train"))


def _draw_copies(cut: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Draw from buckets of rows without an id: equal rows are one row with a count."""
    order = Window.partitionBy(label, "_bucket").orderBy("_order", *[c for c in columns if c != label])
    groups = (
        cut.groupBy(*columns, "_bucket", "_order", "_start", "_keep", "_train")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_end", F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_start"))
        .withColumn("_first", F.col("_end") - F.col("_copies"))
    )
    kept = F.least(F.col("_end"), F.col("_keep")) - F.col("_first")
    numbered = expand_rows(groups, F.greatest(kept, F.lit(0)), ["_order"], "_copy")
    return numbered.withColumn("in_train", F.col("_first") + F.col("_copy") < F.col("_train"))


def stratified_split(balanced: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test part of a balanced frame; together they are all of it."""
    train = balanced.where("in_train").drop("in_train")
    test = balanced.where("not in_train").drop("in_train")
    return train, test
