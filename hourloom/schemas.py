"""Column names and schemas of the raw files and the stage tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The nine hourly measurements, in feature order.
MEASUREMENTS = [
    "HourlyDewPointTemperature",
    "HourlyDryBulbTemperature",
    "HourlyWetBulbTemperature",
    "HourlyPrecipitation",
    "HourlyRelativeHumidity",
    "HourlyWindSpeed",
    "HourlyWindDirection",
    "HourlyStationPressure",
    "HourlyVisibility",
]
# Precipitation may be missing in a complete hour and is zero-filled, not splined.
SPLINED = [m for m in MEASUREMENTS if m != "HourlyPrecipitation"]
READING_ATTRS = ["NAME", "STATION_COORDINATES"]

STATION_MAP_FILE = T.StructType(
    [
        T.StructField("AirportID", T.StringType()),
        T.StructField("WBAN", T.StringType()),
        T.StructField("TimeZone", T.StringType()),
    ]
)

# The columns used from the raw files.
FLIGHT_COLUMNS = [
    "FlightDate",
    "CRSDepTime",
    "CRSElapsedTime",
    "OriginAirportID",
    "DestAirportID",
    "ArrDelayMinutes",
    "WeatherDelay",
    "CarrierDelay",
    "NASDelay",
    "SecurityDelay",
    "LateAircraftDelay",
    "Cancelled",
]
OTHER_CAUSES = ["CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]
READING_COLUMNS = ["STATION", "DATE", "NAME", "LATITUDE", "LONGITUDE", *MEASUREMENTS]

FLIGHTS = T.StructType(
    [
        T.StructField("FlightDate", T.TimestampType()),
        T.StructField("ArrivalDate", T.TimestampType()),
        T.StructField("ORIGIN_WBAN", T.StringType()),
        T.StructField("DEST_WBAN", T.StringType()),
        T.StructField("Delay", T.IntegerType()),
    ]
)
READINGS = T.StructType(
    [
        T.StructField("DATE_TIME", T.TimestampType()),
        T.StructField("NAME", T.StringType()),
        T.StructField("WBAN_WEATHER", T.StringType()),
        T.StructField("STATION_COORDINATES", T.StringType()),
        *[T.StructField(m, T.DoubleType()) for m in MEASUREMENTS],
    ]
)
_FLOATS = T.ArrayType(T.FloatType())


def station_features(prefix: str, features: str) -> T.StructType:
    """Schema of the lagged features of one role (origin or destination)."""
    return T.StructType(
        [
            T.StructField(f"{prefix}DATE_TIME", T.TimestampType()),
            T.StructField(f"{prefix}WBAN_WEATHER", T.StringType()),
            T.StructField(features, _FLOATS),
        ]
    )


ORIGIN_FEATURES = station_features("ORIGIN_", "originFeatures")
DEST_FEATURES = station_features("DEST_", "destinationFeatures")
ORIGIN_DELAY = T.StructType(
    [
        T.StructField("ArrivalDate", T.TimestampType()),
        T.StructField("DEST_WBAN", T.StringType()),
        T.StructField("Delay", T.IntegerType()),
        T.StructField("originFeatures", _FLOATS),
    ]
)
BOTH_DELAY = T.StructType(
    [
        T.StructField("label", T.IntegerType()),
        T.StructField("originFeatures", _FLOATS),
        T.StructField("destinationFeatures", _FLOATS),
    ]
)
EXAMPLES = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("features", _FLOATS)])
ROC = T.StructType(
    [
        T.StructField("FPR", T.DoubleType()),
        T.StructField("TPR", T.DoubleType()),
        T.StructField("areaUnderROC", T.DoubleType()),
    ]
)
