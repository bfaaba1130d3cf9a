"""The catalogue of queries on the test tables, each with SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function as query ``name``, with the SQL for its result."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Times are handled in UTC, whatever the session was started with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def plain(ts: Column | str) -> Column:
    """A timestamp without time zone, the type of the tables."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def cents() -> Column:
    """The value of an event in whole hundredths.

    Sums of whole numbers are exact, so a mean does not depend on the order of its rows
    and both engines round the same number.
    """
    return F.round(F.col("value") * 100)
