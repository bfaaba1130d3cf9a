"""Groups and joins on hand-made rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourloom.operators import aggregates as A
from hourloom.operators.frames import except_distinct, expand_rows, schema_merge_union
from hourloom.operators.joins import bucket_join, right_join, suffix_key_join, two_role_dim_join


def at(hour, minute=0, day=1):
    return datetime(2024, 1, day, hour, minute)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_hourly_mean(spark):
    frame = spark.createDataFrame(
        [
            ("a", at(0, 50), 3.0, "late"),
            ("a", at(0, 10), 1.0, "early"),
            ("a", at(0, 55), None, "last"),
            ("a", at(1, 5), None, "x"),
        ],
        "k string, ts timestamp, v double, name string",
    )
    got = rows(A.hourly_mean(frame, "k", "ts", ["v"], ["name"]))
    assert got == [("a", at(0), "early", 2.0), ("a", at(1), "x", None)]


def test_partition_mean_keeps_null_keys(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, None)], "k string, v double")
    assert rows(A.partition_mean(frame, "k", ["v"]).select("k", "v_mean")) == [
        ("a", 2.0), ("a", 2.0), (None, 5.0), (None, 5.0)
    ]


def test_top1_puts_nulls_last(spark):
    data = [("g", None, "a"), ("g", 0, "b"), ("g", 20, "c"), ("h", None, "d")]
    frame = spark.createDataFrame(data, "k string, d int, n string")
    got = A.top1_per_group(frame, "k", [F.desc_nulls_last("d"), F.asc("n")])
    assert rows(got.select("k", "n")) == [("g", "c"), ("h", "d")]


def test_top1_is_limited_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = A.top1_per_group(frame, "k", [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:]


def test_min_group_size(spark):
    frame = spark.createDataFrame([("a",)] * 3 + [("b",)] * 4 + [(None,)] * 4, "k string")
    assert rows(A.min_group_size(frame, "k", 4)) == [("b",)] * 4 + [(None,)] * 4


def test_first_last_non_null(spark):
    frame = spark.createDataFrame(
        [("a", at(0), None), ("a", at(1), 5.0), ("a", at(2), 7.0), ("a", at(3), None), ("b", at(0), None)],
        "k string, ts timestamp, v double",
    )
    got = rows(A.first_last_non_null(frame, "k", "ts", "v"))
    assert got == [("a", at(1), 5.0, at(2), 7.0), ("b", None, None, None, None)]


def test_collect_sorted_is_cut_by_day(spark):
    frame = spark.createDataFrame(
        [("a", at(5), 2.0), ("a", at(1), 1.0), ("a", at(0, day=2), 3.0)], "k string, ts timestamp, v double"
    )
    got = rows(A.collect_sorted(frame, "k", "ts", "v").select("k", "ys"))
    assert got == [("a", [1.0, 2.0]), ("a", [3.0])]


def test_two_roles(spark):
    flights = spark.createDataFrame([(1, "A", "B"), (2, "A", "?"), (3, None, "B")], "id int, o string, d string")
    stations = spark.createDataFrame([("A", "s1"), ("B", "s2"), ("C", "s3")], "code string, station string")
    got = two_role_dim_join(flights, stations, "code", {"O_": "o", "D_": "d"})
    assert rows(got.select("id", "O_station", "D_station")) == [(1, "s1", "s2")]


def test_suffix_key(spark):
    files = spark.createDataFrame([("72259003927",), ("72259013927",)], "STATION string")
    short = spark.createDataFrame([("3927",), ("13927",)], "WBAN string")
    assert rows(suffix_key_join(files, "STATION", short, "WBAN")) == [("72259013927", "13927")]
    assert rows(suffix_key_join(files, "STATION", short, "WBAN", pad_key_to=5)) == [
        ("72259003927", "03927"), ("72259013927", "13927")
    ]


def test_bucket_join_drops_what_has_no_features(spark):
    data = [(1, "s", at(1)), (2, "s", at(2)), (3, None, at(1))]
    moves = spark.createDataFrame(data, "id int, place string, hour timestamp")
    features = spark.createDataFrame([("s", at(1), [1.0])], "place string, hour timestamp, f array<float>")
    assert rows(bucket_join(moves, features, {"place": "place", "hour": "hour"})) == [(1, [1.0])]


def test_busy_bucket_is_split(spark):
    """One hour holds most events: the join runs as a skew join and loses nothing."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        moves = spark.range(0, 60000, numPartitions=8).select(
            "id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 500).cast("long").alias("place")
        )
        features = spark.range(500).select(F.col("id").alias("place"), (F.col("id") * 2).alias("f"))
        joined = bucket_join(moves, features, {"place": "place"})
        got = joined.collect()
        assert len(got) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_right_join_keeps_the_right_side(spark):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "z"), (4, None)], "id int, k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "code string, n int")
    got = rows(right_join(left, right, "k", "code"))
    assert got == rows(left.join(right, F.col("k") == F.col("code"), "right")) and len(got) == 6


def test_except_is_distinct_and_pairs_nulls(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("c", 3), (None, None)], "s string, i int")
    right = spark.createDataFrame([("c", 3), ("c", 3), (None, 2)], "x string, y int")
    assert rows(except_distinct(left, right)) == rows(left.subtract(right)) == [("a", 1), (None, None)]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2,)], "i int")
    assert rows(schema_merge_union(a, b)) == [(1, "x"), (2, None)]


@pytest.mark.parametrize("block", [1, 3, 100])
def test_expand_rows(spark, block):
    frame = spark.createDataFrame([("a", 5), ("b", 0), ("c", 1)], "k string, n int")
    got = rows(expand_rows(frame, F.col("n"), ["k"], "i", block).select("k", "i"))
    assert got == [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("a", 4), ("c", 0)]
