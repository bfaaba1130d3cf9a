"""Queries on single rows: times, casts, cleaning, predicates, arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.functions.arrays import concat_features, pack_features
from hourloom.functions.casts import lenient_double, lenient_int, null_default
from hourloom.functions.cleaning import ColumnRule, clean_measurements
from hourloom.functions.predicates import eligible, threshold_label
from hourloom.functions.text import concat_parts, suffix_key
from hourloom.functions.times import (
    arrival_hour,
    epoch_seconds,
    local_to_utc,
    offset_to_zone,
    parse_local,
    utc_hour,
)
from hourloom.operators.frames import drop_any_null, prefix_columns, required_not_null
from hourloom.plans.registry import events, plain, query, table


@query("hour_bucket", "SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS hour FROM events")
def hour_bucket(spark, sf):
    return events(spark, sf).select("event_id", plain(utc_hour("ts")).alias("hour"))


@query(
    "epoch_round_trip",
    """SELECT event_id, floor(epoch(ts))::BIGINT AS epoch,
              date_trunc('second', ts)::TIMESTAMP AS ts_back FROM events"""
)
def epoch_round_trip(spark, sf):
    seconds = events(spark, sf).select("event_id", epoch_seconds("ts").alias("epoch"))
    return seconds.withColumn("ts_back", plain(F.timestamp_seconds("epoch")))


@query(
    "local_to_utc_hour",
    """SELECT event_id,
              CASE WHEN event_id % 50 = 0 THEN NULL
                   ELSE date_trunc('hour', date_trunc('minute', ts) - to_hours((user_id % 7 - 10)::INT))
              END::TIMESTAMP AS utc_hour
       FROM events"""
)
def local_to_utc_hour(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    time = F.when(F.col("event_id") % 50 == 0, F.lit("2400")).otherwise(F.date_format("ts", "HHmm"))
    zone = offset_to_zone((F.col("user_id") % 7 - 10).cast("int"))
    local = parse_local(concat_parts([day, time], ","), "yyyy-MM-dd,HHmm")
    return events(spark, sf).select("event_id", plain(utc_hour(local_to_utc(local, zone))).alias("utc_hour"))


_MINUTES = "to_microseconds(CAST(round((value + user_id % 60) * 60000000) AS BIGINT))"


@query(
    "arrival_hour",
    f"""SELECT event_id,
               date_trunc('hour', date_trunc('hour', ts) + {_MINUTES})::TIMESTAMP AS from_hour,
               date_trunc('hour', date_trunc('second', ts) + {_MINUTES})::TIMESTAMP AS from_time
        FROM events"""
)
def arrival_hours(spark, sf):
    minutes = [F.col("value").cast("string"), F.col("user_id") % 60]
    return events(spark, sf).select(
        "event_id",
        plain(arrival_hour("ts", minutes)).alias("from_hour"),
        plain(arrival_hour("ts", minutes, truncate_first=False)).alias("from_time"),
    )


@query(
    "offset_to_zone",
    """SELECT c_custkey, CASE WHEN c_nationkey = 12 THEN 'UTC'
                              ELSE printf('UTC%+03d:00', c_nationkey - 12) END AS zone
       FROM customer"""
)
def zone_of_offset(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", offset_to_zone(F.col("c_nationkey") - 12).alias("zone"))


_DIRTY_NUMBER = """CASE event_id % 6 WHEN 0 THEN 'abc' WHEN 1 THEN concat(CAST(value AS {text}), 's')
                   WHEN 2 THEN concat('-', CAST(value AS {text})) WHEN 3 THEN '' WHEN 4 THEN '0,004'
                   ELSE CAST(value AS {text}) END"""


@query(
    "lenient_cast",
    f"""SELECT event_id, CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS INTEGER) AS as_int,
               TRY_CAST(raw AS DOUBLE) AS as_double
        FROM (SELECT event_id, {_DIRTY_NUMBER.format(text="VARCHAR")} AS raw FROM events)"""
)
def lenient_cast(spark, sf):
    raw = events(spark, sf).select("event_id", F.expr(_DIRTY_NUMBER.format(text="STRING")).alias("raw"))
    return raw.select("event_id", lenient_int("raw").alias("as_int"), lenient_double("raw").alias("as_double"))


@query(
    "measurement_clean",
    """SELECT event_id,
              CASE WHEN event_id % 7 IN (3, 4, 5) THEN NULL ELSE value END AS temperature,
              CASE WHEN event_id % 7 IN (2, 3, 4) THEN NULL ELSE value END AS rain,
              CASE WHEN event_id % 7 = 2 THEN 0.004 WHEN event_id % 7 IN (3, 4) THEN NULL
                   ELSE value END AS rain_with_trace,
              CASE WHEN event_id % 7 IN (1, 2) THEN NULL ELSE round(radians(value), 6) END AS direction
       FROM events"""
)
def measurement_clean(spark, sf):
    """Dirty text made from ``value``: every flag, sentinel and bad form once in seven rows."""

    def by_row(*forms):
        raw = F.col("value").cast("string")
        made = {"": raw, "s": F.concat(raw, F.lit("s")), "V": F.concat(raw, F.lit("V"))}
        chosen = made.get(forms[-1], F.lit(forms[-1]))
        for i, form in enumerate(forms[:-1]):
            chosen = F.when(F.col("event_id") % 7 == i, made.get(form, F.lit(form))).otherwise(chosen)
        return chosen

    raw = events(spark, sf).select(
        "event_id",
        by_row("", "s", "V", "*", "x", "abc", "").alias("temperature"),
        by_row("", "s", "T", "Ts", "V", "", "").alias("rain"),
        by_row("", "s", "T", "Ts", "V", "", "").alias("rain_with_trace"),
        by_row("", "VRB", "s", "", "", "", "").alias("direction"),
    )
    rain = {"strip_flags": "s", "null_tokens": (), "trace_token": "T"}
    rules = {
        "temperature": ColumnRule(),
        "rain": ColumnRule(**rain),
        "rain_with_trace": ColumnRule(**rain, trace_value=0.004),
        "direction": ColumnRule(strip_flags="", null_tokens=("VRB",), radians=True),
    }
    return clean_measurements(raw, rules).withColumn("direction", F.round("direction", 6))


@query(
    "null_default",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE value END AS filled,
              CASE WHEN event_id % 3 = 0 THEN -1.0 ELSE value END AS defaulted FROM events"""
)
def null_defaults(spark, sf):
    holes = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    frame = events(spark, sf).select("event_id", holes.alias("filled"), null_default(holes, -1.0).alias("defaulted"))
    return frame.na.fill(0.0, ["filled"])


@query("suffix_key", "SELECT s_suppkey, right(s_name, 5) AS suffix FROM supplier")
def suffix_keys(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", suffix_key("s_name").alias("suffix"))


@query("concat_parts", "SELECT c_custkey, c_name || ', ' || nullif(c_mktsegment, 'BUILDING') AS joined FROM customer")
def concat_columns(spark, sf):
    parts = ["c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))]
    return table(spark, sf, "customer").select("c_custkey", concat_parts(parts, ", ").alias("joined"))


# Delay-like text columns made from lineitem.
_DELAYS = """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
    CASE WHEN l_linenumber % 3 = 1 THEN NULL ELSE CAST(l_quantity - 25 AS {text}) END AS cause,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(l_tax * 20 AS {text}) END AS other,
    CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN '0.00' ELSE 'late' END AS total,
    CASE WHEN l_linestatus = 'O' THEN '0.00' WHEN l_linenumber > 5 THEN '1.00' END AS cancelled
    FROM {source}"""


@query(
    "eligible_filter",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate
        FROM ({_DELAYS.format(text="VARCHAR", source="lineitem")})
        WHERE (coalesce(trunc(TRY_CAST(cause AS DOUBLE)) > 0, FALSE)
               OR ((other IS NULL OR trunc(TRY_CAST(other AS DOUBLE)) = 0)
                   AND (total IS NULL OR trunc(TRY_CAST(total AS DOUBLE)) = 0)))
          AND (cancelled IS NULL OR trunc(TRY_CAST(cancelled AS DOUBLE)) = 0)"""
)
def eligible_filter(spark, sf):
    made = spark.sql(_DELAYS.format(text="STRING", source="{lineitem}"), lineitem=table(spark, sf, "lineitem"))
    kept = made.where(eligible("cause", ["other"], "total", "cancelled"))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query(
    "threshold_label",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN nullif(l_quantity, 20) > 15 THEN 1 ELSE 0 END AS label FROM lineitem"""
)
def threshold_labels(spark, sf):
    quantity = F.nullif(F.col("l_quantity"), F.lit(20.0))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", threshold_label(quantity, 15).alias("label")
    )


_HOLES = """SELECT l_orderkey, l_partkey, nullif(l_linenumber, 3) AS line, nullif(l_returnflag, 'A') AS flag,
            nullif(l_linestatus, 'F') AS status FROM {source}"""


@query("required_not_null", f"SELECT * FROM ({_HOLES.format(source='lineitem')}) WHERE line IS NOT NULL AND flag IS NOT NULL")
def required_columns(spark, sf):
    made = spark.sql(_HOLES.format(source="{lineitem}"), lineitem=table(spark, sf, "lineitem"))
    return required_not_null(made, ["line", "flag"])


@query(
    "drop_any_null",
    f"""SELECT * FROM ({_HOLES.format(source='lineitem')})
        WHERE line IS NOT NULL AND flag IS NOT NULL AND status IS NOT NULL"""
)
def drop_null_rows(spark, sf):
    return drop_any_null(spark.sql(_HOLES.format(source="{lineitem}"), lineitem=table(spark, sf, "lineitem")))


@query(
    "pack_features",
    """SELECT event_id, 3 AS width, round(value::FLOAT::DOUBLE, 4) AS f0,
              (user_id % 100)::FLOAT::DOUBLE AS f1, (event_id % 24)::FLOAT::DOUBLE AS f2
       FROM events WHERE value > 2"""
)
def packed_features(spark, sf):
    """Rows with a missing part have no array, and are dropped."""
    value = F.when(F.col("value") > 2, F.col("value"))
    packed = events(spark, sf).select(
        "event_id", pack_features([value, F.col("user_id") % 100, F.col("event_id") % 24]).alias("f")
    )
    return drop_any_null(packed).select("event_id", F.size("f").alias("width"), *_elements("f", 3))


@query(
    "concat_features",
    """SELECT event_id, 4 AS width, round(value::FLOAT::DOUBLE, 4) AS f0, (user_id % 100)::DOUBLE AS f1,
              (event_id % 24)::DOUBLE AS f2, round(value::FLOAT::DOUBLE, 4) AS f3
       FROM events"""
)
def concat_arrays(spark, sf):
    left = pack_features(["value", F.col("user_id") % 100])
    right = pack_features([F.col("event_id") % 24, "value"])
    both = events(spark, sf).select("event_id", concat_features(left, right).alias("f"))
    return both.select("event_id", F.size("f").alias("width"), *_elements("f", 4))


def _elements(array: str, n: int):
    return [F.round(F.col(array)[i].cast("double"), 4).alias(f"f{i}") for i in range(n)]


@query(
    "prefix_columns",
    """SELECT c_custkey AS ORIGIN_c_custkey, c_name AS ORIGIN_c_name, c_nationkey AS ORIGIN_c_nationkey,
              c_acctbal AS ORIGIN_c_acctbal, c_mktsegment AS ORIGIN_c_mktsegment FROM customer"""
)
def prefixed_columns(spark, sf):
    return prefix_columns(table(spark, sf, "customer"), "ORIGIN_")
