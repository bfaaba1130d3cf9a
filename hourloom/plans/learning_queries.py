"""Balancing, splitting, training, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.operators.aggregates import class_counts
from hourloom.operators.model import auc, load_model, rf_train_score, roc_curve, score, train_curve
from hourloom.operators.sampling import random_order, shuffle_key, stratified_split, undersample
from hourloom.plans.registry import events, query, table
from hourloom.session import scratch_path, stored


def _labelled(spark, sf):
    return events(spark, sf).select("event_id", F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"))


_LABELLED = "SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label FROM events"
_RANKED = f"""
    e AS ({_LABELLED}),
    r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(event_id || ':42'), event_id) AS place FROM e),
    m AS (SELECT min(n) AS keep FROM (SELECT count(*) AS n FROM e GROUP BY label))"""


@query("class_counts", f"SELECT label, count(*) AS n FROM ({_LABELLED}) GROUP BY label")
def label_counts(spark, sf):
    return class_counts(_labelled(spark, sf), "label")


@query("undersample", f"WITH {_RANKED} SELECT event_id, label FROM r, m WHERE place <= keep")
def balanced(spark, sf):
    return undersample(_labelled(spark, sf), "label", id_cols=["event_id"]).drop("in_train")


_KINDS = "SELECT event_type, user_id % 3 AS part, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label FROM events"


@query(
    "undersample_copies",
    f"""WITH e AS ({_KINDS}),
        g AS (SELECT label, count(*) AS n FROM e GROUP BY label),
        m AS (SELECT min(n) AS keep FROM g)
        SELECT label, n AS have, keep::BIGINT AS drawn, floor(keep * 0.8)::BIGINT AS in_train FROM g, m""",
)
def balanced_copies(spark, sf):
    """Rows without an id, nearly all of them copies: what each class has, keeps and trains on."""
    kinds = events(spark, sf).select(
        "event_type", (F.col("user_id") % 3).alias("part"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label")
    )
    drawn = undersample(kinds, "label").groupBy("label").agg(
        F.count(F.lit(1)).alias("drawn"), F.count_if("in_train").alias("in_train")
    )
    return class_counts(kinds, "label").withColumnRenamed("n", "have").join(drawn, "label")


@query(
    "stratified_split",
    f"""WITH {_RANKED} SELECT event_id, label, CASE WHEN place <= floor(keep * 0.8) THEN 'train' ELSE 'test' END AS part
        FROM r, m WHERE place <= keep""",
)
def split(spark, sf):
    drawn = stored(undersample(_labelled(spark, sf), "label", id_cols=["event_id"]), "balanced")
    train, test = stratified_split(drawn)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("random_order", "SELECT event_id, md5(event_id || ':42') AS draw FROM events ORDER BY draw, event_id")
def shuffled(spark, sf):
    drawn = events(spark, sf).select("event_id", shuffle_key(["event_id"]).alias("draw"))
    return random_order(drawn, ["event_id"])


def _scored(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return table(spark, sf, "documents").select("doc_id", "n_chars").join(labels, "doc_id")


_CURVE = """
    g AS (SELECT n_chars AS score, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality <> 1) AS neg
          FROM documents JOIN labels USING (doc_id) GROUP BY n_chars),
    c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
                 sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g)"""


@query(
    "roc_curve",
    f"""WITH {_CURVE} SELECT round(fp / n, 8) AS FPR, round(tp / p, 8) AS TPR FROM c
        UNION ALL VALUES (0.0::DOUBLE, 0.0::DOUBLE), (1.0::DOUBLE, 1.0::DOUBLE)""",
)
def quality_curve(spark, sf):
    curve = roc_curve(_scored(spark, sf), "n_chars", "quality")
    return curve.select(F.round("FPR", 8).alias("FPR"), F.round("TPR", 8).alias("TPR"))


@query(
    "auc",
    f"""WITH {_CURVE}
        SELECT round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), 8)::DOUBLE AS "areaUnderROC" FROM c""",
)
def quality_area(spark, sf):
    area = auc(_scored(spark, sf), "n_chars", "quality")
    return area.select(F.round("areaUnderROC", 8).alias("areaUnderROC"))


@query("rf_train_score")
def embedding_forest(spark, sf):
    """A forest that tells the upper five classes of embeddings from the lower five."""
    vectors = table(spark, sf, "embeddings").select(
        "vec_id", F.when(F.col("label") >= 5, 1).otherwise(0).alias("label"), F.col("embedding").alias("features")
    )
    train, test = stratified_split(stored(undersample(vectors, "label", id_cols=["vec_id"]), "balanced"))
    _, scored = rf_train_score(train, test)
    return scored.select("vec_id", "label", "prediction", F.round("probability", 6).alias("probability"))


_TOLD = f"""WITH {_RANKED}, p AS (SELECT r.event_id, label, CASE WHEN place <= floor(keep * 0.8) THEN 0 ELSE 1 END AS test
                               FROM r, m WHERE place <= keep)
            SELECT event_id, label, label::DOUBLE AS prediction FROM p WHERE test = 1"""


def _told(spark, sf):
    """A forest on features that tell the label without a doubt, and its test rows."""
    kind = F.col("event_type") == "error"
    told = events(spark, sf).select(
        "event_id",
        F.when(kind, 1).otherwise(0).alias("label"),
        F.array(*[F.when(kind, 1.0).otherwise(0.0).cast("float")] * 2).alias("features"),
    )
    train, test = stratified_split(stored(undersample(told, "label", id_cols=["event_id"]), "balanced"))
    model, scored = rf_train_score(train, test, trees=5, depth=3)
    return model, test, scored


@query("rf_exact_score", _TOLD)
def certain_forest(spark, sf):
    return _told(spark, sf)[2].select("event_id", "label", "prediction")


@query("rf_saved_score", _TOLD)
def saved_forest(spark, sf):
    """Scored by the model that was saved and loaded again."""
    model, test, _ = _told(spark, sf)
    path = scratch_path(spark, "model")
    model.write().save(path)
    return score(load_model(path), test).select("event_id", "label", "prediction")


@query(
    "train_curve",
    """WITH c AS (SELECT count_if(l_quantity >= 30) / count_if(l_quantity > 25) AS t FROM lineitem)
       SELECT x AS "FPR", round(y, 8) AS "TPR", round((1 + t) / 2, 8) AS "areaUnderROC"
       FROM (SELECT unnest([0.0::DOUBLE, 0, 1]) AS x, unnest([0.0::DOUBLE, t, 1]) AS y, t FROM c)""",
)
def quantity_curve(spark, sf):
    """Quantities above 25, told by tens. Most of those from 20 to 29 are not, so the forest puts
    them with the smaller ones (leaves that predict the same are one), and the curve has one bend."""
    lines = table(spark, sf, "lineitem").where("l_quantity IS NOT NULL").select(
        (F.col("l_quantity") > 25).cast("int").alias("label"),
        F.array(F.floor(F.col("l_quantity") / 10).cast("float")).alias("features"),
    )
    model, _ = rf_train_score(lines, lines, trees=5, depth=3)
    curve = train_curve(model)
    return curve.select(*[F.round(c, 8).alias(c) for c in curve.columns]).distinct()
