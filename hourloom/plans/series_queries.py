"""Time series: spans, grids, gap filling, lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.functions.arrays import pack_features
from hourloom.functions.times import utc_hour
from hourloom.operators import resample as R
from hourloom.operators.aggregates import hourly_mean
from hourloom.operators.joins import bucket_join
from hourloom.operators.lags import lag_stack, with_lags
from hourloom.operators.segments import HOUR
from hourloom.operators.spline import spline_coefficients, spline_fill
from hourloom.plans.registry import cents, events, plain, query
from hourloom.session import stored

LAGS = 12


def _user_hours(spark, sf):
    """Two measurements per user and hour, each missing at other hours."""
    hour = F.hour("hour")
    hours = (
        events(spark, sf)
        .groupBy("user_id", utc_hour("ts").alias("hour"))
        .agg(F.max("value").alias("first"), F.count(F.lit(1)).alias("second"))
    )
    return hours.withColumns(
        {
            "first": F.when(hour % 5 != 0, F.col("first")),
            "second": F.when((hour + F.col("user_id")) % 7 != 0, F.col("second")),
        }
    )


_USER_SPAN = """
    u AS (SELECT user_id, date_trunc('hour', ts) AS hour,
                 CASE WHEN hour(ts) % 5 <> 0 THEN max(value) END AS first,
                 CASE WHEN (hour(ts) + user_id) % 7 <> 0 THEN count(*) END AS second
          FROM events GROUP BY user_id, date_trunc('hour', ts), hour(ts)),
    span AS (SELECT user_id, min(hour) AS lo, max(hour) AS hi, arg_min(first, hour) AS first
             FROM u WHERE first IS NOT NULL AND second IS NOT NULL GROUP BY user_id)"""


@query(
    "complete_span",
    f"WITH {_USER_SPAN} SELECT user_id, lo::TIMESTAMP AS lo, hi::TIMESTAMP AS hi, first FROM span",
)
def user_spans(spark, sf):
    span = R.complete_span(_user_hours(spark, sf), "user_id", "hour", ["first", "second"], ["first"])
    return span.withColumns({"lo": plain("lo"), "hi": plain("hi")})


@query(
    "hour_grid",
    f"""WITH {_USER_SPAN}
        SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR))::TIMESTAMP AS hour FROM span""",
)
def user_grid(spark, sf):
    span = R.complete_span(_user_hours(spark, sf), "user_id", "hour", ["first", "second"])
    return R.hour_grid(span, "user_id", "hour").withColumn("hour", plain("hour"))


@query(
    "resample_hourly",
    f"""WITH {_USER_SPAN},
        grid AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM span
                 WHERE hi - lo >= INTERVAL 3 HOUR)
        SELECT g.user_id, g.hour::TIMESTAMP AS hour, u.first, u.second
        FROM grid g LEFT JOIN u ON g.user_id = u.user_id AND g.hour = u.hour""",
)
def user_resampled(spark, sf):
    hours = _user_hours(spark, sf)
    grid = R.resample(hours, "user_id", "hour", ["first", "second"], ["first", "second"])
    return grid.withColumn("hour", plain("hour"))


def _type_hours(spark, sf):
    """Hourly means in hundredths per event type, stored: later steps read them, not the raw events."""
    whole = events(spark, sf).withColumn("value", cents())
    return stored(hourly_mean(whole, "event_type", "ts", ["value"]), "hourly")


def _type_grid(spark, sf):
    # Stored: the spline reads its input several times.
    return stored(R.resample(_type_hours(spark, sf), "event_type", "hour", ["value"], ["value"]), "grid")


# Natural cubic spline through the hourly means of each event type, solved forwards
# over the knots and then backwards.
_SPLINE = """
    h AS MATERIALIZED (SELECT event_type AS k, date_trunc('hour', ts) AS hour, avg(round(value * 100)) AS y
                       FROM events GROUP BY ALL),
    p AS MATERIALIZED (
        SELECT k, hour, y, row_number() OVER s - 1 AS i, count(*) OVER (PARTITION BY k) AS n,
               epoch(hour - lag(hour) OVER s) / 3600.0 AS hp, epoch(lead(hour) OVER s - hour) / 3600.0 AS hn,
               y - lag(y) OVER s AS dp, lead(y) OVER s - y AS dn
        FROM h WINDOW s AS (PARTITION BY k ORDER BY hour)),
    f AS MATERIALIZED (
        WITH RECURSIVE r AS (
            SELECT k, i, 0.0::DOUBLE AS mu, 0.0::DOUBLE AS z FROM p WHERE i = 0
            UNION ALL
            SELECT p.k, p.i, hn / (2 * (hp + hn) - hp * r.mu),
                   (3 * (dn / hn - dp / hp) - hp * r.z) / (2 * (hp + hn) - hp * r.mu)
            FROM r JOIN p ON p.k = r.k AND p.i = r.i + 1 WHERE p.i < p.n - 1)
        SELECT * FROM r),
    b AS MATERIALIZED (
        WITH RECURSIVE r AS (
            SELECT k, i, 0.0::DOUBLE AS c FROM p WHERE i = n - 1
            UNION ALL
            SELECT f.k, f.i, f.z - f.mu * r.c FROM r JOIN f ON f.k = r.k AND f.i = r.i - 1)
        SELECT * FROM r),
    coef AS MATERIALIZED (
        SELECT p.k, p.hour, p.y AS a, dn / hn - hn * (e.c + 2 * b.c) / 3 AS b, b.c AS c, (e.c - b.c) / (3 * hn) AS d
        FROM p JOIN b ON p.k = b.k AND p.i = b.i JOIN b e ON p.k = e.k AND p.i + 1 = e.i)"""

_FILLED = f"""{_SPLINE},
    grid AS (SELECT k, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM h GROUP BY k),
    filled AS MATERIALIZED (
        SELECT g.k, g.hour, coalesce(h.y, g.a + g.t * (g.b + g.t * (g.c + g.t * g.d))) AS y
        FROM (SELECT g.*, epoch(g.hour - c.hour) / 3600.0 AS t, c.* EXCLUDE (k, hour)
              FROM grid g ASOF LEFT JOIN coef c ON g.k = c.k AND g.hour >= c.hour) g
        LEFT JOIN h ON g.k = h.k AND g.hour = h.hour)"""


_CUBICS_SQL = f"""WITH {_SPLINE} SELECT k AS event_type, hour::TIMESTAMP AS hour, round(a, 4) AS a, round(b, 4) AS b,
                              round(c, 4) AS c, round(d, 4) AS d FROM coef"""
_FILLED_SQL = f"WITH {_FILLED} SELECT k AS event_type, hour::TIMESTAMP AS hour, round(y, 4) AS value FROM filled"


@query("spline_coefficients", _CUBICS_SQL)
def type_splines(spark, sf, **options):
    cubics = spline_coefficients(_type_hours(spark, sf), "event_type", "hour", "value", **options)
    return cubics.withColumns({"hour": plain("hour"), **{p: F.round(p, 4) for p in "abcd"}})


@query("spline_coefficients_segments", _CUBICS_SQL)
def type_splines_in_segments(spark, sf):
    """Each series in slices of two days, every slice solved with its halo."""
    return type_splines(spark, sf, segment_seconds=48 * HOUR)


@query("spline_fill", _FILLED_SQL)
def type_filled(spark, sf, **options):
    filled = spline_fill(_type_grid(spark, sf), "event_type", "hour", ["value"], **options)
    return filled.withColumns({"hour": plain("hour"), "value": F.round("value", 4)})


@query("spline_fill_segments", _FILLED_SQL)
def type_filled_in_segments(spark, sf):
    return type_filled(spark, sf, segment_seconds=48 * HOUR)


_USER_TOPS = "SELECT user_id, date_trunc('hour', ts) AS hour, max(value) AS top FROM events GROUP BY ALL"
_LAGGED = ", ".join(f"lag(top, {i}) OVER w AS top_lag_{i}" for i in range(1, LAGS + 1))


_LAGS_SQL = f"""SELECT user_id, hour::TIMESTAMP AS hour, top, {_LAGGED} FROM ({_USER_TOPS})
        WINDOW w AS (PARTITION BY user_id ORDER BY hour) QUALIFY top_lag_{LAGS} IS NOT NULL"""


@query("lags_1_12", _LAGS_SQL)
def user_lags(spark, sf, **options):
    """By row: hours without an event are no rows, so these series are not regular."""
    return _user_lags(events(spark, sf), **options)


def _user_lags(rows, **options):
    tops = rows.groupBy("user_id", utc_hour("ts").alias("hour")).agg(F.max("value").alias("top"))
    lagged = with_lags(tops, "user_id", "hour", ["top"], LAGS, **options)
    return lagged.where(F.col(f"top_lag_{LAGS}").isNotNull()).withColumn("hour", plain("hour"))


@query("lags_pieces", _LAGS_SQL)
def user_lags_in_pieces(spark, sf):
    """Numbered by slices of three days, lagged in pieces of 16 rows."""
    return user_lags(spark, sf, segment_seconds=72 * HOUR, piece_rows=16)


_NULL_KEY = "(SELECT * REPLACE (CASE WHEN user_id % 4 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value) FROM events)"


@query("lags_null_key", _LAGS_SQL.replace("FROM events", f"FROM {_NULL_KEY}"))
def user_lags_null_key(spark, sf):
    """A quarter of the users are one series without a key, and every third value is missing."""
    holes = {"user_id": F.when(F.col("user_id") % 4 != 0, F.col("user_id")), "value": F.when(F.col("event_id") % 3 != 0, F.col("value"))}
    return _user_lags(events(spark, sf).withColumns(holes), segment_seconds=72 * HOUR, piece_rows=16)


def _stack_sql(values: list[str], digits: int) -> str:
    """Elements f0, f1, ... of a stack: the values now, then those of each lag, as 32-bit floats."""
    out = []
    for i in range(LAGS + 1):
        for v in values:
            lagged = f"lag({v}, {i}) OVER w" if i else v
            out.append(f"round(({lagged})::FLOAT::DOUBLE, {digits}) AS f{len(out)}")
    return ", ".join(out)


def _elements(array: str, n: int, digits: int):
    return [F.round(F.col(array)[i].cast("double"), digits).alias(f"f{i}") for i in range(n)]


_STACK_SQL = f"""WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, max(value) AS top, count(*) AS n
                   FROM events GROUP BY ALL),
        grid AS (SELECT event_type, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour
                 FROM h GROUP BY event_type),
        g AS (SELECT event_type, hour, coalesce(top, 0) AS top, coalesce(n, 0) AS n
              FROM grid LEFT JOIN h USING (event_type, hour))
        SELECT event_type, hour::TIMESTAMP AS hour, {_stack_sql(["top", "n"], 3)} FROM g
        WINDOW w AS (PARTITION BY event_type ORDER BY hour)
        QUALIFY row_number() OVER w > {LAGS}"""


@query("lag_stack", _STACK_SQL)
def type_stacks(spark, sf, **options):
    hours = (
        events(spark, sf)
        .groupBy("event_type", utc_hour("ts").alias("hour"))
        .agg(F.max("value").alias("top"), F.count(F.lit(1)).alias("n"))
    )
    grid = R.resample(hours, "event_type", "hour", ["top"], ["top", "n"], min_rows=1).na.fill(0)
    packed = grid.select("event_type", "hour", pack_features(["top", "n"]).alias("now"))
    stacked = lag_stack(packed, "event_type", "hour", "now", LAGS, step_seconds=HOUR, **options)
    return stacked.select("event_type", plain("hour").alias("hour"), *_elements("features", 2 * (LAGS + 1), 3))


@query("lag_stack_pieces", _STACK_SQL)
def type_stacks_in_pieces(spark, sf):
    """Stacked in pieces of two days, each with the last hours of the piece before."""
    return type_stacks(spark, sf, piece_rows=48)


@query(
    "event_features",
    f"""WITH {_FILLED},
        s AS (SELECT k, hour, {_stack_sql(["y"], 3)} FROM filled WINDOW w AS (PARTITION BY k ORDER BY hour)
              QUALIFY row_number() OVER w > {LAGS})
        SELECT e.event_id, s.* EXCLUDE (k, hour)
        FROM events e JOIN s ON e.event_type = s.k AND date_trunc('hour', e.ts) = s.hour""",
)
def event_features(spark, sf):
    """The flagship: every event with its series' smoothed last 13 hours.

    Hourly means, a regular grid, spline-filled gaps, lag stacks, and an exact-hour join.
    """
    filled = spline_fill(_type_grid(spark, sf), "event_type", "hour", ["value"])
    packed = filled.select("event_type", "hour", pack_features(["value"]).alias("now"))
    stacked = lag_stack(packed, "event_type", "hour", "now", LAGS, step_seconds=HOUR)
    moves = events(spark, sf).select("event_id", "event_type", utc_hour("ts").alias("at"))
    joined = bucket_join(moves, stacked, {"event_type": "event_type", "at": "hour"})
    return joined.select("event_id", *_elements("features", LAGS + 1, 3))
