"""Random forest training and ROC evaluation."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourloom.session import stored

#: Distinct scores of one range, about: what one task accumulates.
RANGE_SCORES = 65_536


def rf_train_score(
    train: DataFrame,
    test: DataFrame,
    label: str = "label",
    features: str = "features",
    trees: int = 25,
    depth: int = 13,
    seed: int = 42,
) -> tuple[RandomForestClassificationModel, DataFrame]:
    """Fit a forest on ``train`` (an action) and score ``test``.

    Features are float arrays; they become vectors only here. The scored frame has
    the columns of ``test`` with ``prediction`` and ``probability`` (of class 1).
    """
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="_vector", numTrees=trees, maxDepth=depth, seed=seed
    )
    model = forest.fit(train.select(label, array_to_vector(F.col(features)).alias("_vector")))
    return model, score(model, test, features)


def train_curve(model: RandomForestClassificationModel) -> DataFrame:
    """The ROC curve of a fitted forest on the rows it was fitted on: ``FPR``, ``TPR``, ``areaUnderROC``.

    Two classes only. A loaded model has no curve, as its training rows are not saved with it:
    an error.
    """
    summary = model.summary
    return summary.roc.withColumn("areaUnderROC", F.lit(summary.areaUnderROC).cast("double"))


def load_model(path: str) -> RandomForestClassificationModel:
    """A forest that ``model.write().save(path)`` has saved."""
    return RandomForestClassificationModel.load(path)


def score(model: RandomForestClassificationModel, df: DataFrame, features: str = "features") -> DataFrame:
    scored = model.transform(df.withColumn("_vector", array_to_vector(F.col(features))))
    return scored.withColumn("probability", vector_to_array("probability")[1]).drop("_vector", "rawPrediction")


def _cumulative(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: positives and negatives at it, above it, and in total.

    Rows are counted per score first and the counts stored (an action), so the input is
    read once. A distributed prefix sum follows: the distinct scores are sorted into ranges,
    as many as they fill, each range is summed, the sums of the ranges above are added up,
    and each range accumulates its own scores from there.
    """
    counted = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("_score"))
        .agg(
            F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
            F.count(F.when(F.col(label) != 1, 1)).alias("neg"),
        )
    )
    points = stored(counted, "scores")
    ranges = -(-points.count() // RANGE_SCORES) or 1
    # Stored, so that a row's range is what it was when it was dealt.
    dealt = points.repartitionByRange(ranges, F.desc("_score")) if ranges > 1 else points.coalesce(1)
    ranged = stored(dealt.withColumn("_range", F.spark_partition_id()), "ranges") if ranges > 1 else dealt.withColumn("_range", F.lit(0))
    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # One row per range: RANGE_SCORES times fewer than scores.
    totals = (
        ranged.groupBy("_range")
        .agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
        .select(
            "_range",
            F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_p_above"),
            F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n_above"),
            F.sum("_p").over(every).alias("all_pos"),
            F.sum("_n").over(every).alias("all_neg"),
        )
    )
    higher = Window.partitionBy("_range").orderBy(F.desc("_score")).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(totals, "_range").select(
        "_score",
        "pos",
        "neg",
        (F.coalesce(F.sum("pos").over(higher), F.lit(0)) + F.col("_p_above")).alias("pos_above"),
        (F.coalesce(F.sum("neg").over(higher), F.lit(0)) + F.col("_n_above")).alias("neg_above"),
        "all_pos",
        "all_neg",
    )


def _rate(hits: Column, total: str) -> Column:
    return F.when(F.col(total) > 0, hits / F.col(total)).otherwise(0.0)


def roc_and_auc(df: DataFrame, score: str, label: str) -> tuple[DataFrame, DataFrame]:
    """The curve and the area below it, from one pass over ``df``."""
    points = _cumulative(df, score, label)
    curve = points.select(
        _rate(F.col("neg_above") + F.col("neg"), "all_neg").alias("FPR"),
        _rate(F.col("pos_above") + F.col("pos"), "all_pos").alias("TPR"),
    )
    ends = df.sparkSession.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "FPR double, TPR double")
    area = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2))
    pairs = F.max(F.col("all_pos") * F.col("all_neg"))
    return curve.unionByName(ends), points.agg(F.when(pairs > 0, area / pairs).alias("areaUnderROC"))


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """ROC points (FPR, TPR), one per distinct score, between (0, 0) and (1, 1).

    Label 1 is positive, any other label negative. The score may be a hard
    prediction (one inner point) or a probability.
    """
    return roc_and_auc(df, score, label)[0]


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve by trapezoids; null if a class is missing, or all rows.

    Each score adds its negatives times the positives above it plus half of those at
    it: the area of its trapezoid, so the points need not be sorted again.
    """
    return roc_and_auc(df, score, label)[1]
