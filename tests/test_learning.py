"""Balancing, splitting and ROC."""

from collections import Counter

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from hourloom.operators import sampling
from hourloom.operators.model import auc, load_model, rf_train_score, roc_curve, train_curve
from hourloom.operators.sampling import stratified_split, undersample


def labelled(spark, positives, negatives):
    rows = [(i, 1) for i in range(positives)] + [(1000 + i, 0) for i in range(negatives)]
    return spark.createDataFrame(rows, "id int, label int").repartition(5)


def counts(df):
    return dict(Counter(r.label for r in df.collect()))


@pytest.fixture(params=[0, 1, 4])
def digits(request, monkeypatch):
    """With no digit there is one bucket, so every cut falls inside a bucket."""
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", request.param)


@pytest.mark.parametrize("ids", [["id"], None])
def test_classes_are_balanced_and_split(spark, digits, ids):
    data = labelled(spark, 10, 25)
    train, test = stratified_split(undersample(data, "label", id_cols=ids))
    assert counts(train) == {0: 8, 1: 8} and counts(test) == {0: 2, 1: 2}
    rows = [r.id for r in train.collect()] + [r.id for r in test.collect()]
    assert len(set(rows)) == 20 and set(range(10)) <= set(rows)


def test_choice_does_not_depend_on_partitions_or_buckets(spark, monkeypatch):
    data = labelled(spark, 40, 300)
    pick = lambda d: sorted((r.id, r.in_train) for r in undersample(d, "label", id_cols=["id"]).collect())
    first = pick(data)
    assert pick(data.coalesce(1)) == first
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 1)
    assert pick(data.repartition(13)) == first
    drawn = {i for i, _ in first}
    assert {r.id for r in undersample(data, "label", seed=7, id_cols=["id"]).collect()} != drawn


def test_missing_class_gives_nothing(spark):
    assert undersample(labelled(spark, 5, 0), "label", id_cols=["id"]).count() == 0


def test_equal_rows_are_drawn_by_number(spark, digits):
    """Most rows are copies of one row, with an array and no id; none is lost or made up."""
    rows = [(1, [1.0, 2.0])] * 30 + [(1, [3.0, 4.0])] * 3 + [(0, [0.0, 0.0])] * 50 + [(0, [9.0, 9.0])] * 5
    data = spark.createDataFrame(rows, "label int, features array<float>").repartition(4)
    train, test = stratified_split(undersample(data, "label"))
    assert counts(train) == {0: 26, 1: 26} and counts(test) == {0: 7, 1: 7}
    kept = Counter((r.label, tuple(r.features)) for r in train.unionByName(test).collect())
    have = Counter((a, tuple(b)) for a, b in rows)
    assert all(kept[k] <= have[k] for k in kept)
    assert kept[1, (1.0, 2.0)] == 30 and kept[1, (3.0, 4.0)] == 3


def test_rows_in_whole_buckets_are_not_shuffled(spark):
    plan = undersample(labelled(spark, 10, 25), "label", id_cols=["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number()") == 1 and "BroadcastHashJoin" in plan


def confusion(spark):
    """TP 3, FN 1, FP 1, TN 3."""
    rows = [(1.0, 1)] * 3 + [(0.0, 1)] + [(1.0, 0)] + [(0.0, 0)] * 3
    return spark.createDataFrame(rows, "s double, label int")


def test_hard_scores(spark):
    points = sorted((r.FPR, r.TPR) for r in roc_curve(confusion(spark), "s", "label").collect())
    assert points == [(0.0, 0.0), (0.25, 0.75), (1.0, 1.0), (1.0, 1.0)]
    assert auc(confusion(spark), "s", "label").first()[0] == pytest.approx(0.75)


def scores(spark):
    rng = np.random.default_rng(3)
    label = (rng.random(3000) < 0.3).astype(int)
    score = np.round(rng.normal(size=3000) + label * 0.8, 2)
    return label, score, spark.createDataFrame(list(zip(score.tolist(), label.tolist())), "s double, label int")


def test_area_is_the_rank_statistic(spark):
    label, score, frame = scores(spark)
    pos, neg = score[label == 1], score[label == 0]
    wins = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    area = auc(frame, "s", "label").first()[0]
    assert area == pytest.approx(wins, abs=1e-12)
    vectors = frame.withColumn("s", F.col("s") + 0.0)
    exact = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="label", numBins=0).evaluate(vectors)
    assert area == pytest.approx(exact, abs=1e-9)


def test_curve_rises_and_has_every_score(spark):
    label, score, frame = scores(spark)
    points = sorted((r.FPR, r.TPR) for r in roc_curve(frame, "s", "label").collect())
    assert len(points) == len(set(score)) + 2
    assert all(a[1] <= b[1] for a, b in zip(points, points[1:]))
    fpr, tpr = np.array(points).T
    assert np.trapezoid(tpr, fpr) == pytest.approx(auc(frame, "s", "label").first()[0], abs=1e-12)


def test_one_class_only(spark):
    frame = spark.createDataFrame([(0.5, 1), (0.7, 1)], "s double, label int")
    assert auc(frame, "s", "label").first()[0] is None
    assert {r.FPR for r in roc_curve(frame, "s", "label").collect()} == {0.0, 1.0}


def test_forest_learns(spark):
    frame = spark.range(200).select(
        "id", (F.col("id") % 2).cast("int").alias("label"),
        F.array((F.col("id") % 2).cast("float"), (F.col("id") % 7).cast("float")).alias("features"),
    )
    model, scored = rf_train_score(frame, frame, trees=3, depth=2)
    assert auc(scored, "prediction", "label").first()[0] == pytest.approx(1.0)
    assert model.getNumTrees == 3 and scored.columns == ["id", "label", "features", "probability", "prediction"]


def test_no_scores_no_area(spark):
    none = spark.createDataFrame([], "score double, label int")
    assert auc(none, "score", "label").first()[0] is None
    assert sorted(map(tuple, roc_curve(none, "score", "label").collect())) == [(0.0, 0.0), (1.0, 1.0)]


def test_train_curve(spark, tmp_path):
    """It is the curve of the forest's scores of its own training rows."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (600, 4))
    y = (x.sum(axis=1) + rng.normal(0, 2, 600) > 10).astype(int)
    rows = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(x.astype(float), y)], "label int, features array<float>")
    model, scored = rf_train_score(rows, rows, trees=7, depth=4)
    curve = train_curve(model).collect()
    points = lambda found: {(round(r.FPR, 9), round(r.TPR, 9)) for r in found}
    assert points(curve) == points(roc_curve(scored, "probability", "label").collect()) and len(points(curve)) > 3
    area = auc(scored, "probability", "label").first().areaUnderROC
    assert {round(r.areaUnderROC, 9) for r in curve} == {round(area, 9)}
    model.write().save(str(tmp_path / "m"))
    with pytest.raises(Exception, match="[Nn]o training summary"):
        train_curve(load_model(str(tmp_path / "m")))
