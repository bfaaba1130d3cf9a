"""The yearly job on small raw files, against a plain Python computation."""

import math
import pathlib
import random
import zipfile
from datetime import datetime, timedelta

import numpy as np
import pytest

from hourloom import schemas as S
from hourloom.plans import yearly
from hourloom.plans.yearly import Paths, flight_hours, run_year
from hourloom.sources.raw import archive_records, csv_scan, station_map
from hourloom.sources.tables import audits, finished_years, read_year
from tests.test_series import dense_spline

YEAR = 2020
HOURS = 120
# Airport, station, offset. The last station id is short: it never matches a file.
STATIONS = [("1", "11111", -6), ("2", "22222", -8), ("3", "33333", -5), ("4", "4444", -5)]
START = datetime(YEAR, 1, 1)


def weather_file(station, rng):
    """Raw readings in local time and the cleaned hourly values they stand for, by UTC hour."""
    offset = next(o for _, w, o in STATIONS if w == station)
    lines = ["STATION,DATE,REPORT,NAME,LATITUDE,LONGITUDE," + ",".join(S.MEASUREMENTS)]
    hourly = {}
    for h in range(HOURS):
        if 0 < h < HOURS - 1 and rng.random() < 0.15:
            continue
        readings = []
        for minute in rng.sample(range(60), rng.choice([1, 1, 2])):
            row, texts = [], []
            for m in S.MEASUREMENTS:
                v = round(rng.uniform(1, 90), 2)
                if m == "HourlyPrecipitation":
                    t, v = rng.choice([("T", None), ("", None), (f"{v}s", v), (str(v), v)])
                elif m == "HourlyWindDirection":
                    known = (str(v), math.radians(v))
                    t, v = known if h in (0, HOURS - 1) else rng.choice([("VRB", None), known, known])
                elif h in (0, HOURS - 1):
                    t = f"{v}V"
                else:
                    t, v = rng.choice([("*", None), (f"{v}s", v), (str(v), v), (str(v), v)])
                row.append(v)
                texts.append(t)
            local = START + timedelta(hours=h + offset, minutes=minute)
            place = f'"FIELD {minute:02d}, US",40.50,-90.25'
            lines.append(f"7220{station},{local.isoformat()},FM-15,{place}," + ",".join(texts))
            readings.append(row)
        columns = list(zip(*readings))
        known = [[v for v in c if v is not None] for c in columns]
        hourly[h] = [np.mean(c) if c else None for c in known]
    head, body = lines[0], lines[1:]
    rng.shuffle(body)
    return "\n".join([head, *body]) + "\n", hourly


def expected_features(hourly):
    """Gap-filled features per hour, with 12 lags, newest first."""
    grid = np.full((HOURS, len(S.MEASUREMENTS)), np.nan)
    for h, values in hourly.items():
        grid[h] = [np.nan if v is None else v for v in values]
    at = np.arange(HOURS, dtype=float)
    for i, m in enumerate(S.MEASUREMENTS):
        known = ~np.isnan(grid[:, i])
        if m == "HourlyPrecipitation":
            grid[~known, i] = 0.0
        else:
            grid[~known, i] = dense_spline(at[known], grid[known, i], at[~known])
    return {h: np.concatenate([grid[h - j] for j in range(13)]) for h in range(12, HOURS)}


def flights_file(rng, n):
    """Raw flights and the (departure, arrival, origin, destination) -> (cause, label) they stand for."""
    header = "Year," + ",".join(S.FLIGHT_COLUMNS)
    lines, kept = [header], {}
    zones = {a: (w, o) for a, w, o in STATIONS}
    for _ in range(n):
        origin, dest = rng.sample(["1", "2", "3", "4", "9"], 2)
        local = START + timedelta(hours=rng.randrange(-4, HOURS), minutes=rng.randrange(60))
        clock = "2400" if rng.random() < 0.03 else local.strftime("%H%M")
        elapsed = rng.choice(["60.00", "95.00", "180.00", ""])
        late = rng.choice(["", "0.00", "10.00", "15.00", "16.00", "40.00"])
        cause = rng.choice(["", "", "0.00", "5.00", "30.00"])
        others = [rng.choice(["", "", "", "0.00", "7.00"]) for _ in S.OTHER_CAUSES]
        cancelled = rng.choice(["0.00", "0.00", "0.00", "0.00", "1.00", ""])
        fields = [local.strftime("%Y-%m-%d"), clock, elapsed, origin, dest, late, cause, *others, cancelled]
        lines.append(f"{YEAR}," + ",".join(fields))
        by_weather = cause not in ("", "0.00")
        on_time = all(c in ("", "0.00") for c in [*others, late])
        if not (by_weather or on_time) or cancelled == "1.00" or not elapsed or clock == "2400":
            continue
        if origin not in zones or dest not in zones:
            continue
        (ow, offset), (dw, _) = zones[origin], zones[dest]
        depart = (local - timedelta(hours=offset)).replace(minute=0)
        minutes = float(elapsed) + float(late or 0)
        arrive = (depart + timedelta(minutes=minutes)).replace(minute=0)
        rank = (float(cause) if cause else -1.0, int(float(late or 0) > 15))
        key = (depart, arrive, ow, dw)
        kept[key] = max(kept.get(key, (-2.0, 0)), rank)
    return "\n".join(lines) + "\n", kept


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    rng = random.Random(5)
    root = tmp_path_factory.mktemp("job")
    (root / f"raw/{YEAR}/flights").mkdir(parents=True)
    (root / f"raw/{YEAR}/weather").mkdir(parents=True)
    (root / "map.csv").write_text(
        "AirportID,WBAN,TimeZone\n" + "".join(f"{a},{w},{o}\n" for a, w, o in STATIONS)
    )
    weather = {}
    for _, station, _ in STATIONS[:3]:
        text, weather[station] = weather_file(station, rng)
        (root / f"raw/{YEAR}/weather/7220{station}.csv").write_text(text)
    text, _ = weather_file("11111", rng)
    (root / f"raw/{YEAR}/weather/722099999.csv").write_text(text.replace("722011111", "722099999"))
    flights = {}
    for month in (1, 2):
        text, part = flights_file(rng, 1500)
        (root / f"raw/{YEAR}/flights/{month}.csv").write_text(text)
        for key, rank in part.items():
            flights[key] = max(flights.get(key, rank), rank)
    paths = Paths(str(root / "map.csv"), str(root / "raw"), str(root / "tables"), str(root / "models"))
    flights = {key: label for key, (_, label) in flights.items()}
    return paths, weather, flights, run_year(spark, YEAR, paths, trees=3, depth=3)


def test_flights(job):
    _, _, flights, tables = job
    got = {(r.FlightDate, r.ArrivalDate, r.ORIGIN_WBAN, r.DEST_WBAN): r.Delay for r in tables["flights"].collect()}
    assert got == flights and len(got) == tables["flights"].count()


def test_flights_from_archives(spark, job):
    paths, _, flights, _ = job
    folder = pathlib.Path(paths.raw_dir(YEAR, "flights"))
    zips = folder.parent / "zips"
    zips.mkdir(exist_ok=True)
    for month in folder.glob("*.csv"):
        with zipfile.ZipFile(zips / f"{month.stem}.zip", "w") as archive:
            archive.write(month, month.name)
    raw = archive_records(spark, f"{zips}/*.zip", S.FLIGHT_COLUMNS)
    hours = flight_hours(raw, station_map(spark, paths.station_map)).collect()
    assert {(r.FlightDate, r.ArrivalDate, r.ORIGIN_WBAN, r.DEST_WBAN): r.Delay for r in hours} == flights


def test_hourly_weather(job):
    _, weather, _, tables = job
    rows = tables["raw_weather"].collect()
    assert len(rows) == sum(len(h) for h in weather.values())
    for r in rows:
        h = int((r.DATE_TIME - START).total_seconds() // 3600)
        want = weather[r.WBAN_WEATHER][h]
        for m, v in zip(S.MEASUREMENTS, want):
            assert (r[m] is None) == (v is None) and (v is None or r[m] == pytest.approx(v))
        assert r.STATION_COORDINATES == "40.5, -90.25" and r.NAME.startswith("FIELD")


def test_grid_is_regular_and_filled(job):
    _, weather, _, tables = job
    assert tables["weather"].count() == tables["interpolated_weather"].count() == HOURS * len(weather)
    assert tables["interpolated_weather"].na.drop().count() == HOURS * len(weather)


def test_station_features(job):
    _, weather, _, tables = job
    want = {s: expected_features(h) for s, h in weather.items()}
    rows = tables["org_vectorized_weather"].collect()
    assert len(rows) == sum(len(f) for f in want.values())
    for r in rows:
        h = int((r.ORIGIN_DATE_TIME - START).total_seconds() // 3600)
        assert len(r.originFeatures) == 117
        assert np.allclose(r.originFeatures, want[r.ORIGIN_WBAN_WEATHER][h], rtol=1e-4, atol=1e-4)


def test_examples(job):
    _, weather, flights, tables = job
    covered = range(12, HOURS)
    hour = lambda t: int((t - START).total_seconds() // 3600)
    want = [k for k in flights if {k[2], k[3]} <= set(weather) and hour(k[0]) in covered and hour(k[1]) in covered]
    assert tables["delay"].count() == tables["org_dest_delay"].count() == len(want) > 100
    assert {len(r.features) for r in tables["delay"].select("features").collect()} == {234}


def test_balance_and_curves(job):
    *_, tables = job
    n = {r.label: r["count"] for r in tables["delay"].groupBy("label").count().collect()}
    keep = min(n.values())
    for name, size in (("train_delay", int(keep * 0.8)), ("test_delay", keep - int(keep * 0.8))):
        assert {r.label: r["count"] for r in tables[name].groupBy("label").count().collect()} == {0: size, 1: size}
    for name in ("train_roc", "test_roc"):
        points = tables[name].collect()
        assert {(0.0, 0.0), (1.0, 1.0)} <= {(p.FPR, p.TPR) for p in points}
        assert len({p.areaUnderROC for p in points}) == 1 and 0 <= points[0].areaUnderROC <= 1


def test_running_a_year_again_changes_nothing(spark, job):
    paths, _, _, tables = job
    before = {n: t.count() for n, t in tables.items()}
    again = run_year(spark, YEAR, paths, trees=3, depth=3)
    for name in set(before) - {"train_roc", "test_roc"}:
        assert again[name].count() == before[name], name
    assert read_year(spark, paths.table("delay"), S.EXAMPLES).count() == before["delay"]


def test_stages_start_alone_and_resume(spark, job):
    """Nothing is made again by a resumed run; one stage runs from stored tables, without raw files."""
    paths, _, _, tables = job
    schemas = {t: schema for s in yearly.STAGES.values() for t, schema in s.tables.items()}
    rows = lambda: {t: read_year(spark, paths.table(t), schema, YEAR).count() for t, schema in schemas.items()}
    audit = f"{paths.tables}/audit"
    stored_at = lambda: {r["name"]: r for r in audits(spark, audit).collect()}
    files = lambda name: sorted(p.name for p in pathlib.Path(paths.table(name)).rglob("*.parquet"))
    first = {n: r.asDict() for n, r in stored_at().items()}
    counts = {n: r["n_rows"] for n, r in first.items()}
    assert counts == rows()
    assert first["interpolated_weather"]["nulls"]["HourlyPrecipitation"] == 0 < first["raw_weather"]["nulls"]["HourlyPrecipitation"]
    kept = {n: files(n) for n in first}
    no_raw = Paths("nowhere.csv", "nowhere", paths.tables, paths.models)
    assert run_year(spark, YEAR, no_raw, trees=3, depth=3, resume=True).keys() == tables.keys()
    assert {n: files(n) for n in first} == kept
    done = run_year(spark, YEAR, no_raw, trees=3, depth=3, stages=["weather"])
    assert "weather" in done and "flights" in done and "interpolated_weather" not in done and "delay" not in done
    assert finished_years(spark, paths.table("finished")).count() == 0
    run_year(spark, YEAR, no_raw, trees=3, depth=3, resume=True)
    assert [r.year for r in finished_years(spark, paths.table("finished")).collect()] == [YEAR]
    assert files("flights") == kept["flights"] and files("delay") != kept["delay"]
    curves = {"train_roc", "test_roc"}
    assert {n: c for n, c in rows().items() if n not in curves} == {n: c for n, c in counts.items() if n not in curves}


def test_repairs(spark, job, tmp_path):
    """The options of the job: padded ids, trace rain, exact arrival, probability curve."""
    paths, weather, *_ = job
    schemas = {"flights": S.FLIGHTS, "raw_weather": S.READINGS}
    before = {n: read_year(spark, paths.table(n), schema, YEAR) for n, schema in schemas.items()}
    other = Paths(paths.station_map, paths.raw, str(tmp_path / "tables"), str(tmp_path / "models"))
    repaired = {"trace_value": 0.004, "pad_key_to": 5, "truncate_first": False, "hard_score": False}
    tables = run_year(spark, YEAR, other, trees=3, depth=3, **repaired)
    assert {r[0] for r in tables["flights"].select("ORIGIN_WBAN").distinct().collect()} == {*weather, "04444"}
    rain = [r[0] for r in tables["raw_weather"].select("HourlyPrecipitation").collect()]
    known = [r[0] for r in before["raw_weather"].select("HourlyPrecipitation").collect()]
    assert sum(v is None for v in rain) < sum(v is None for v in known) and 0.004 in rain
    later = {tuple(r) for r in tables["flights"].select("FlightDate", "ArrivalDate").collect()}
    assert later - {tuple(r) for r in before["flights"].select("FlightDate", "ArrivalDate").collect()}
    assert tables["test_roc"].distinct().count() > 3


def test_small_dimension_is_broadcast(spark, job):
    paths, *_ = job
    raw = csv_scan(spark, paths.raw_dir(YEAR, "flights"), S.FLIGHT_COLUMNS)
    plan = flight_hours(raw, station_map(spark, paths.station_map))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_missing_measurement_is_an_error(spark):
    """Not dropped: the hour and the twelve after it would be lost without a word."""
    values = dict.fromkeys(S.MEASUREMENTS, 1.0)
    rows = [(START + timedelta(hours=i), "w", *(values | ({S.MEASUREMENTS[0]: None} if i == 3 else {})).values()) for i in range(20)]
    schema = f"{yearly.HOUR_COL} timestamp, {yearly.STATION} string, " + ", ".join(f"{m} double" for m in S.MEASUREMENTS)
    with pytest.raises(Exception, match="measurement missing at station w"):
        yearly.station_features(spark.createDataFrame(rows, schema)).collect()
    assert yearly.station_features(spark.createDataFrame(rows, schema).na.fill(1.0)).count() == 8
