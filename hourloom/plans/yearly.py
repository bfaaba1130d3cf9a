"""The yearly job: flights enriched with lagged station weather, and a delay model.

Every stage is a function from frames to a frame. ``run_year`` strings them together
and keeps each result as a table partitioned by year, so a stage that several others
read is computed once, a stage can be run alone, and a year can be run again without
doubling its rows.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom import schemas as S
from hourloom.functions.arrays import concat_features, pack_features
from hourloom.functions.casts import lenient_double, lenient_int, null_default
from hourloom.functions.cleaning import clean_measurements, station_rules
from hourloom.functions.predicates import all_present, eligible, threshold_label
from hourloom.functions.text import concat_parts
from hourloom.functions.times import arrival_hour, local_to_utc, parse_local, utc_hour
from hourloom.operators.aggregates import hourly_mean, top1_per_group
from hourloom.operators.frames import prefix_columns, required_not_null
from hourloom.operators.joins import bucket_join, suffix_key_join, two_role_dim_join
from hourloom.operators.lags import lag_stack
from hourloom.operators.model import rf_train_score, roc_and_auc, train_curve
from hourloom.operators.resample import resample
from hourloom.operators.sampling import stratified_split, undersample
from hourloom.operators.segments import HOUR
from hourloom.operators.spline import spline_fill
from hourloom.plans.stages import Stage, StageRun
from hourloom.session import scratch_run, stored
from hourloom.sources.raw import archive_records, csv_scan, matching_files, station_map
from hourloom.sources.tables import YEAR, read_year

STATION, HOUR_COL = "WBAN_WEATHER", "DATE_TIME"
DELAY_MINUTES = 15
# Last five characters of the file name, before the extension.
STATION_FILE = r"(.{5})\.[A-Za-z]+$"


def flight_hours(raw: DataFrame, stations: DataFrame, truncate_first: bool = True) -> DataFrame:
    """Eligible flights with the stations and UTC hours of both ends, one per pair of ends and hours.

    Of several flights between the same stations in the same hours the one with the
    largest weather delay stays. A departure that cannot be read never finds weather,
    so it is dropped here.
    """
    chosen = raw.where(eligible("WeatherDelay", S.OTHER_CAUSES, "ArrDelayMinutes", "Cancelled"))
    placed = two_role_dim_join(
        required_not_null(chosen, ["FlightDate", "CRSDepTime", "CRSElapsedTime"]),
        stations,
        "AirportID",
        {"ORIGIN_": "OriginAirportID", "DEST_": "DestAirportID"},
    )
    local = parse_local(concat_parts(["FlightDate", "CRSDepTime"], ","), "yyyy-MM-dd,HHmm")
    depart = local_to_utc(local, "ORIGIN_TimeZone")
    late = null_default("ArrDelayMinutes", "0")
    timed = placed.select(
        utc_hour(depart).alias("FlightDate"),
        arrival_hour(depart, ["CRSElapsedTime", late], truncate_first).alias("ArrivalDate"),
        "ORIGIN_WBAN",
        "DEST_WBAN",
        threshold_label(lenient_int(late), DELAY_MINUTES).alias("Delay"),
        lenient_int("WeatherDelay").alias("_cause"),
    )
    keys = ["FlightDate", "ArrivalDate", "ORIGIN_WBAN", "DEST_WBAN"]
    order = [F.desc_nulls_last("_cause"), F.desc("Delay")]
    return top1_per_group(required_not_null(timed, keys[:2]), keys, order).drop("_cause")


def hourly_readings(raw: DataFrame, stations: DataFrame, trace_value: float | None = None) -> DataFrame:
    """Clean hourly means per station, in UTC."""
    side = stations.select("WBAN", "TimeZone").distinct()
    placed = suffix_key_join(raw, "STATION", side, "WBAN")
    typed = clean_measurements(placed, station_rules(trace_value)).select(
        F.col("WBAN").alias(STATION),
        local_to_utc(parse_local("DATE"), "TimeZone").alias("DATE"),
        "NAME",
        concat_parts([lenient_double("LATITUDE"), lenient_double("LONGITUDE")], ", ").alias("STATION_COORDINATES"),
        *S.MEASUREMENTS,
    )
    return hourly_mean(typed, STATION, "DATE", S.MEASUREMENTS, S.READING_ATTRS, HOUR_COL, few_attributes=True)


def regular_readings(hourly: DataFrame) -> DataFrame:
    return resample(hourly, STATION, HOUR_COL, S.SPLINED, S.MEASUREMENTS, S.READING_ATTRS)


def filled_readings(regular: DataFrame) -> DataFrame:
    return spline_fill(regular.na.fill(0.0, ["HourlyPrecipitation"]), STATION, HOUR_COL, S.SPLINED)


def station_features(filled: DataFrame) -> DataFrame:
    """The nine measurements of an hour and of the twelve before it, in one array.

    A missing measurement is an error: the hour, and the twelve after it, would be lost.
    """
    missing = F.raise_error(F.concat(F.lit("measurement missing at station "), STATION, F.lit(", "), F.col(HOUR_COL).cast("string")))
    now = F.when(all_present(S.MEASUREMENTS), pack_features(S.MEASUREMENTS)).otherwise(missing)
    packed = filled.select(HOUR_COL, STATION, now.alias("now"))
    return lag_stack(packed, STATION, HOUR_COL, "now", 12, "features", HOUR)


def in_role(features: DataFrame, prefix: str, name: str) -> DataFrame:
    """The shared features under the column names of one end of a flight."""
    return prefix_columns(features, prefix).withColumnRenamed(prefix + "features", name)


def with_origin(flights: DataFrame, origin_features: DataFrame) -> DataFrame:
    on = {"ORIGIN_WBAN": "ORIGIN_" + STATION, "FlightDate": "ORIGIN_" + HOUR_COL}
    return bucket_join(flights, origin_features, on)


def with_destination(flights: DataFrame, dest_features: DataFrame) -> DataFrame:
    on = {"DEST_WBAN": "DEST_" + STATION, "ArrivalDate": "DEST_" + HOUR_COL}
    return bucket_join(flights, dest_features, on).withColumnRenamed("Delay", "label")


def examples(both: DataFrame) -> DataFrame:
    return both.select("label", concat_features("originFeatures", "destinationFeatures").alias("features"))


@dataclass(frozen=True)
class Paths:
    """Where a run reads and writes. ``raw`` holds ``<year>/flights`` and ``<year>/weather``."""

    station_map: str
    raw: str
    tables: str
    models: str

    def table(self, name: str) -> str:
        return f"{self.tables.rstrip('/')}/{name}"

    def raw_dir(self, year: int, kind: str) -> str:
        return f"{self.raw.rstrip('/')}/{year}/{kind}"


#: The stages of a year in the order they run.
STAGES = {
    "flights": Stage({"flights": S.FLIGHTS}, ts="FlightDate"),
    "raw_weather": Stage({"raw_weather": S.READINGS}, ts=HOUR_COL),
    "weather": Stage({"weather": S.READINGS}, ("raw_weather",), HOUR_COL),
    "interpolated_weather": Stage({"interpolated_weather": S.READINGS}, ("weather",), HOUR_COL),
    "vectorized_weather": Stage({"vectorized_weather": S.station_features("", "features")}, ("interpolated_weather",), HOUR_COL),
    "org_delay": Stage({"org_delay": S.ORIGIN_DELAY}, ("flights", "vectorized_weather"), "FlightDate"),
    "org_dest_delay": Stage({"org_dest_delay": S.BOTH_DELAY}, ("org_delay", "vectorized_weather"), "FlightDate"),
    "delay": Stage({"delay": S.EXAMPLES}, ("org_dest_delay",)),
    "balance": Stage({"train_delay": S.EXAMPLES, "test_delay": S.EXAMPLES}, ("delay",)),
    "model": Stage({"train_roc": S.ROC, "test_roc": S.ROC}, ("balance",)),
}


def run_year(
    spark: SparkSession,
    year: int,
    paths: Paths,
    fmt: str = "parquet",
    seed: int = 42,
    trees: int = 25,
    depth: int = 13,
    hard_score: bool = True,
    trace_value: float | None = None,
    pad_key_to: int | None = None,
    truncate_first: bool = True,
    archived: bool = False,
    stages: Collection[str] | None = None,
    resume: bool = False,
) -> dict[str, DataFrame]:
    """Run the stages of one year and return the tables that are done.

    Training uses the balanced examples of every year up to this one. The test curve
    is drawn from the hard prediction, or from the probability if ``hard_score`` is off.
    ``trace_value``, ``pad_key_to`` and ``truncate_first`` repair what the defaults keep
    (see the README). With ``archived`` the flights are zip archives of CSV files.

    ``stages`` names those of ``STAGES`` to run, from the stored tables of the others;
    ``resume`` leaves out those that are done. Every write leaves an audit row, see
    ``audits``. Scratch tables are removed at the end.
    """
    run = StageRun(spark, paths.tables, year, STAGES, fmt, stages, resume)

    def raw_flights() -> DataFrame:
        read = archive_records if archived else csv_scan
        return read(spark, paths.raw_dir(year, "flights"), S.FLIGHT_COLUMNS)

    def raw_weather(stations: DataFrame) -> DataFrame:
        files = matching_files(spark, paths.raw_dir(year, "weather"), stations, "WBAN", STATION_FILE)
        return csv_scan(spark, files, S.READING_COLUMNS)

    def stations() -> DataFrame:
        return station_map(spark, paths.station_map, pad_key_to)

    def up_to_year(name: str) -> DataFrame:
        return read_year(spark, paths.table(name), S.EXAMPLES, fmt=fmt).where(F.col(YEAR) <= year).drop(YEAR)

    def balance() -> dict[str, DataFrame]:
        train, test = stratified_split(stored(undersample(tables["delay"], "label", seed), "balanced"))
        return {"train_delay": train, "test_delay": test}

    def model() -> dict[str, DataFrame]:
        fitted, scored = rf_train_score(up_to_year("train_delay"), up_to_year("test_delay"), trees=trees, depth=depth, seed=seed)
        fitted.write().overwrite().save(f"{paths.models.rstrip('/')}/{year}/rf_model")
        curve, area = roc_and_auc(scored, "prediction" if hard_score else "probability", "label")
        return {
            "train_roc": train_curve(fitted),
            "test_roc": curve.withColumn("areaUnderROC", F.lit(area.first()["areaUnderROC"]).cast("double")),
        }

    # One stack serves both ends of a flight; the roles differ in column names only.
    origin = lambda: in_role(tables["vectorized_weather"], "ORIGIN_", "originFeatures")
    destination = lambda: in_role(tables["vectorized_weather"], "DEST_", "destinationFeatures")
    makers = {
        "flights": lambda: flight_hours(raw_flights(), stations(), truncate_first),
        "raw_weather": lambda: hourly_readings(raw_weather(stations()), stations(), trace_value),
        "weather": lambda: regular_readings(tables["raw_weather"]),
        "interpolated_weather": lambda: filled_readings(tables["weather"]),
        "vectorized_weather": lambda: station_features(tables["interpolated_weather"]),
        "org_delay": lambda: with_origin(tables["flights"], origin()),
        "org_dest_delay": lambda: with_destination(tables["org_delay"], destination()),
        "delay": lambda: examples(tables["org_dest_delay"]),
    }
    several = {"balance": balance, "model": model}

    tables: dict[str, DataFrame] = {}
    with scratch_run(spark):
        for name in STAGES:
            tables |= run.run(name, several.get(name) or (lambda name=name: {name: makers[name]()}))
    if "vectorized_weather" in tables:
        tables |= {"org_vectorized_weather": origin(), "dest_vectorized_weather": destination()}
    run.finish()
    return tables


def pending_partitions(done: DataFrame, spark: SparkSession, first: int, last: int, column: str = YEAR) -> DataFrame:
    """Years from ``first`` to ``last`` that ``done`` has no row of.

    ``done`` should be ``finished_years``: a year without rows leaves none in the tables.
    """
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias(column))
    seen = done.select(F.col(column).alias("_seen")).distinct()
    return years.join(seen, F.col(column) == F.col("_seen"), "left_anti")


def next_year(done: DataFrame, spark: SparkSession, first: int = 2012, last: int = 2024) -> int:
    """The first year not run yet; an error when all are."""
    year = pending_partitions(done, spark, first, last).agg(F.min(YEAR)).first()[0]
    if year is None:
        raise ValueError("all years are already processed")
    return year
