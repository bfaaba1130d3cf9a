"""Edge rows of casts, cleaning, predicates and times."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourloom.functions.casts import lenient_double, lenient_int
from hourloom.functions.cleaning import clean_measurements, station_rules
from hourloom.functions.predicates import eligible, threshold_label
from hourloom.functions.times import arrival_hour, local_to_utc, offset_to_zone, parse_local, utc_hour
from hourloom.schemas import MEASUREMENTS


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def texts(spark, items):
    return spark.createDataFrame([(i, t) for i, t in enumerate(items)], "i int, t string").orderBy("i")


def clean(spark, column, items, **kwargs):
    frame = texts(spark, items)
    for m in MEASUREMENTS:
        frame = frame.withColumn(m, F.col("t") if m == column else F.lit("1"))
    return values(clean_measurements(frame, station_rules(**kwargs)).orderBy("i"), column)


def test_lenient_casts(spark):
    items = ["16.00", "-1.5", " 7 ", ".5", "1e2", "abc", "", None, "99999999999"]
    assert values(texts(spark, items), lenient_int("t")) == [16, -1, 7, 0, None, None, None, None, None]
    numbers = [16.0, -1.5, 7.0, 0.5, 100.0, None, None, None, 99999999999.0]
    assert values(texts(spark, items), lenient_double("t")) == numbers


def test_temperature_rules(spark):
    got = clean(spark, "HourlyDryBulbTemperature", ["45", "45s", "45V", "*", "", "abc", None, "-3"])
    assert got == [45.0, 45.0, 45.0, None, None, None, None, -3.0]


def test_precipitation_rules(spark):
    items = ["0.10", "0.10s", "T", "Ts", "0.10V", "*"]
    assert clean(spark, "HourlyPrecipitation", items) == [0.1, 0.1, None, None, None, None]
    assert clean(spark, "HourlyPrecipitation", items, trace_value=0.004) == [0.1, 0.1, 0.004, None, None, None]


def test_direction_rules(spark):
    got = clean(spark, "HourlyWindDirection", ["180", "VRB", "180s"])
    assert got[0] == pytest.approx(math.pi) and got[1:] == [None, None]


def test_zones(spark):
    frame = spark.createDataFrame([(-10,), (0,), (5,), (None,)], "h int")
    assert values(frame, offset_to_zone("h")) == ["UTC-10:00", "UTC", "UTC+05:00", None]


def test_local_hours(spark):
    frame = texts(spark, ["2024-07-01,1259", "2024-07-01,2400", "2024-07-01,0000", None])
    got = values(frame, utc_hour(local_to_utc(parse_local("t", "yyyy-MM-dd,HHmm"), F.lit("UTC-06:00"))))
    assert got == [datetime(2024, 7, 1, 18), None, datetime(2024, 7, 1, 6), None]


def test_region_zone_follows_daylight_saving(spark):
    frame = texts(spark, ["2024-07-01,1259", "2024-01-01,1259"])
    got = values(frame, utc_hour(local_to_utc(parse_local("t", "yyyy-MM-dd,HHmm"), F.lit("America/Chicago"))))
    assert got == [datetime(2024, 7, 1, 17), datetime(2024, 1, 1, 18)]


def test_arrival_counts_from_the_full_hour(spark):
    frame = texts(spark, ["2024-07-01 12:59:00"]).select(F.col("t").cast("timestamp").alias("t"))
    assert values(frame, arrival_hour("t", [F.lit("65"), F.lit("0")])) == [datetime(2024, 7, 1, 13)]
    assert values(frame, arrival_hour("t", [F.lit("65")], truncate_first=False)) == [datetime(2024, 7, 1, 14)]
    assert values(frame, arrival_hour("t", [F.lit("late")])) == [None]


def test_eligible(spark):
    rows = [
        ("5", "9", "20", "0.00", True),
        (None, None, "0", None, True),
        (None, "1.00", "16", "0.00", False),
        (None, None, "7", None, False),
        ("5", None, "20", "1.00", False),
        (None, "bad", None, None, False),
        ("0", "0.00", None, "0.00", True),
        ("bad", None, None, None, True),
    ]
    frame = spark.createDataFrame(rows, "cause string, other string, total string, cancelled string, want boolean")
    got = frame.select(eligible("cause", ["other"], "total", "cancelled").alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_threshold(spark):
    frame = spark.createDataFrame([(15,), (16,), (None,)], "m int")
    assert values(frame, threshold_label("m", 15)) == [0, 1, 0]
