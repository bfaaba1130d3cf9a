"""Joins, groups, windows, sets and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.functions.times import arrival_hour, utc_hour
from hourloom.operators import aggregates as A
from hourloom.operators.frames import except_distinct, schema_merge_union
from hourloom.operators.joins import (
    bucket_join,
    right_join,
    suffix_key_join,
    two_role_dim_join,
    two_sided_bucket_join,
)
from hourloom.plans.registry import cents, events, plain, query, table


@query(
    "right_join",
    "SELECT d.doc_id, quality, toxic FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id",
)
def labels_of_documents(spark, sf):
    """Every document with its labels; most have none."""
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "labelled")
    joined = right_join(labels, table(spark, sf, "documents").select("doc_id"), "labelled", "doc_id")
    return joined.select("doc_id", "quality", "toxic")


@query(
    "two_role_dim_join",
    """SELECT c.n_name AS customer_nation, s.n_name AS supplier_nation, count(*) AS n, sum(l_quantity) AS quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation c ON c_nationkey = c.n_nationkey JOIN nation s ON s_nationkey = s.n_nationkey
       GROUP BY ALL"""
)
def two_role_join(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    facts = (
        lines.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("l_quantity", "c_nationkey", "s_nationkey")
    )
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    placed = two_role_dim_join(facts, nation, "n_nationkey", {"c_": "c_nationkey", "s_": "s_nationkey"})
    return placed.groupBy(
        F.col("c_n_name").alias("customer_nation"), F.col("s_n_name").alias("supplier_nation")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query(
    "suffix_key_join",
    """SELECT c_custkey, s_suppkey FROM customer
       JOIN supplier ON right(c_name, 5) = lpad(s_suppkey::VARCHAR, 5, '0')"""
)
def suffix_join(spark, sf):
    """Supplier numbers are shorter than five digits: without padding none would match."""
    numbers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_suppkey").cast("string").alias("number"))
    joined = suffix_key_join(table(spark, sf, "customer"), "c_name", numbers, "number", pad_key_to=5)
    return joined.select("c_custkey", "s_suppkey")


@query(
    "radians_mean",
    """SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS hour, round(avg(radians(value)), 6) AS direction
       FROM events GROUP BY ALL""",
)
def radians_mean(spark, sf):
    turned = events(spark, sf).withColumn("direction", F.radians("value"))
    means = A.hourly_mean(turned, "event_type", "ts", ["direction"])
    return means.select("event_type", plain("hour").alias("hour"), F.round("direction", 6).alias("direction"))


@query(
    "partition_mean",
    """SELECT event_id, round(avg(round(value * 100)) OVER (PARTITION BY event_type, date_trunc('hour', ts)), 4)
              AS value_mean FROM events"""
)
def partition_mean(spark, sf):
    hours = events(spark, sf).select("event_id", "event_type", utc_hour("ts").alias("hour"), cents().alias("value"))
    means = A.partition_mean(hours, ["event_type", "hour"], ["value"])
    return means.select("event_id", F.round("value_mean", 4).alias("value_mean"))


@query(
    "first_per_bucket",
    """SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS hour, user_id, event_id
       FROM events QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts)
                                              ORDER BY ts, user_id, event_id) = 1"""
)
def first_per_bucket(spark, sf):
    first = A.hourly_mean(events(spark, sf), "event_type", "ts", ["value"], ["user_id", "event_id"])
    return first.select("event_type", plain("hour").alias("hour"), "user_id", "event_id")


@query(
    "hourly_mean",
    """SELECT user_id, event_type, date_trunc('hour', ts)::TIMESTAMP AS hour,
              round(avg(CASE WHEN event_id % 4 <> 0 THEN round(value * 100) END), 4) AS value
       FROM events GROUP BY ALL"""
)
def hourly_means(spark, sf):
    """Missing readings do not count; an hour with missing readings only stays, without a mean."""
    holes = events(spark, sf).withColumn("value", F.when(F.col("event_id") % 4 != 0, cents()))
    means = A.hourly_mean(holes, ["user_id", "event_type"], "ts", ["value"])
    return means.withColumns({"hour": plain("hour"), "value": F.round("value", 4)})


@query(
    "hourly_mean_attributes",
    """SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS hour, round(avg(round(value * 100)), 4) AS value,
              arg_min(user_id, struct_pack(ts, user_id, props)) AS user_id, arg_min(props, struct_pack(ts, user_id, props)) AS props
       FROM events GROUP BY ALL""",
)
def hourly_means_with_attributes(spark, sf):
    """Means with the user and the text of the earliest reading."""
    whole = events(spark, sf).withColumn("value", cents())
    means = A.hourly_mean(whole, "event_type", "ts", ["value"], ["user_id", "props"], few_attributes=True)
    return means.withColumns({"hour": plain("hour"), "value": F.round("value", 4)})


_REST = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_linestatus"]


@query(
    "top1_per_group",
    f"""SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_extendedprice DESC, {", ".join(_REST)}) = 1"""
)
def top_per_group(spark, sf):
    order = [F.desc("l_extendedprice"), *[F.asc(c) for c in _REST]]
    top = A.top1_per_group(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], order)
    return top.select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_shipdate FROM lineitem")
def distinct_rows(spark, sf):
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate"]
    return table(spark, sf, "lineitem").select(columns).dropDuplicates()


@query(
    "except_distinct",
    """SELECT l_suppkey, l_shipdate FROM lineitem WHERE l_returnflag = 'A'
       EXCEPT SELECT l_suppkey, l_shipdate FROM lineitem WHERE l_returnflag = 'R'"""
)
def except_rows(spark, sf):
    pairs = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_returnflag")
    side = {f: pairs.where(F.col("l_returnflag") == f).drop("l_returnflag") for f in "AR"}
    return except_distinct(side["A"], side["R"])


@query(
    "first_last_non_null",
    """SELECT user_id, min(ts) FILTER (event_id % 3 <> 0) AS first_ts,
              arg_min(value, ts) FILTER (event_id % 3 <> 0) AS first_value,
              max(ts) FILTER (event_id % 3 <> 0) AS last_ts,
              arg_max(value, ts) FILTER (event_id % 3 <> 0) AS last_value
       FROM events GROUP BY user_id"""
)
def first_last_values(spark, sf):
    holes = events(spark, sf).withColumn("value", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    ends = A.first_last_non_null(holes, "user_id", "ts", "value")
    return ends.withColumns({"first_ts": plain("first_ts"), "last_ts": plain("last_ts")})


@query("min_group_size", "SELECT event_id, user_id FROM events QUALIFY count(*) OVER (PARTITION BY user_id) > 66")
def group_size_filter(spark, sf):
    return A.min_group_size(events(spark, sf), "user_id", 67).select("event_id", "user_id")


@query(
    "collect_sorted",
    """WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL)
       SELECT event_type, date_trunc('day', hour)::TIMESTAMP AS day, string_agg(n::VARCHAR, ',' ORDER BY hour) AS counts
       FROM h GROUP BY ALL"""
)
def collect_in_order(spark, sf):
    hours = events(spark, sf).groupBy("event_type", utc_hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    days = A.collect_sorted(hours, "event_type", "hour", "n")
    joined = F.array_join(F.col("ys").cast("array<string>"), ",")
    return days.select("event_type", plain("segment_start").alias("day"), joined.alias("counts"))


_HOURLY = "SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n, max(value) AS top FROM events GROUP BY ALL"


def _hourly_features(spark, sf):
    return (
        events(spark, sf)
        .groupBy(F.col("event_type").alias("place"), utc_hour("ts").alias("at"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    )


@query(
    "bucket_join",
    f"""WITH f AS ({_HOURLY})
        SELECT e.event_id, f.n, f.top FROM events e JOIN f
        ON e.event_type = f.event_type AND date_trunc('hour', e.ts) - INTERVAL 1 HOUR = f.hour"""
)
def bucket_enrich(spark, sf):
    """Each event with what happened in the hour before; events after a silent hour are dropped."""
    before = utc_hour(F.col("ts") - F.expr("interval 1 hour"))
    moves = events(spark, sf).select("event_id", "event_type", before.alias("hour"))
    return bucket_join(moves, _hourly_features(spark, sf), {"event_type": "place", "hour": "at"})


# The event types, used to make up a second place for each event.
_PLACES = ["click", "error", "purchase", "signup", "view"]


@query(
    "two_sided_bucket_join",
    f"""WITH f AS ({_HOURLY}),
        m AS (SELECT event_id, event_type, date_trunc('hour', ts) AS depart,
                     {_PLACES}[user_id % 5 + 1] AS target,
                     date_trunc('hour', date_trunc('hour', ts)
                       + to_microseconds(CAST(round((value + 60) * 60000000) AS BIGINT))) AS arrive FROM events)
        SELECT m.event_id, a.n AS origin_n, a.top AS origin_top, b.n AS target_n, b.top AS target_top
        FROM m JOIN f a ON m.event_type = a.event_type AND m.depart = a.hour
               JOIN f b ON m.target = b.event_type AND m.arrive = b.hour"""
)
def two_sided_enrich(spark, sf):
    target = F.element_at(F.array(*[F.lit(p) for p in _PLACES]), (F.col("user_id") % 5 + 1).cast("int"))
    moves = events(spark, sf).select(
        "event_id",
        "event_type",
        utc_hour("ts").alias("depart"),
        target.alias("target"),
        arrival_hour("ts", ["value", F.lit(60)]).alias("arrive"),
    )
    features = _hourly_features(spark, sf)
    here = features.withColumnsRenamed({"n": "origin_n", "top": "origin_top"})
    there = features.withColumnsRenamed({"n": "target_n", "top": "target_top"})
    return two_sided_bucket_join(
        moves, here, there, {"event_type": "place", "depart": "at"}, {"target": "place", "arrive": "at"}
    )


@query(
    "schema_merge_union",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier"""
)
def merged_union(spark, sf):
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    supplier = table(spark, sf, "supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS id", "s_name AS name")
    return schema_merge_union(customer, supplier)


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def top_n(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query("global_sort", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders ORDER BY ALL")
def global_sort(spark, sf):
    columns = ["o_custkey", "o_orderdate", "o_orderkey"]
    return table(spark, sf, "orders").select(columns).orderBy(columns)
