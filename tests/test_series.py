"""Grids, splines and lags, against brute force and across piece borders."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourloom.operators import lags, resample
from hourloom.operators.lags import lag_stack, with_lags
from hourloom.operators.segments import HOUR, with_series_index
from hourloom.operators.spline import HALO, fill_gaps, natural_slopes, spline_coefficients, spline_fill

START = datetime(2024, 1, 1)


def hour(i):
    return START + timedelta(hours=i)


def series(spark, points, key="a"):
    """Rows (key, hour, value) from pairs (hour number, value)."""
    return spark.createDataFrame([(key, hour(i), v) for i, v in points], "k string, ts timestamp, v double")


def dense_spline(x, y, at):
    """Natural cubic spline from the full matrix."""
    n, h = len(x), np.diff(x)
    m, r = np.eye(n), np.zeros(n)
    for i in range(1, n - 1):
        m[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        r[i] = 3 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    c = np.linalg.solve(m, r)
    out = []
    for v in at:
        i = min(int(np.searchsorted(x, v, side="right")) - 1, n - 2)
        b = (y[i + 1] - y[i]) / h[i] - h[i] * (c[i + 1] + 2 * c[i]) / 3
        d = (c[i + 1] - c[i]) / (3 * h[i])
        t = v - x[i]
        out.append(y[i] + b * t + c[i] * t**2 + d * t**3)
    return np.array(out)


def evaluate(x, y, at):
    """The spline through (x, y) at other places, as gaps of one piece."""
    every = np.concatenate([x, at])
    order = np.argsort(every, kind="stable")
    values = np.concatenate([y, np.full(len(at), np.nan)])[order]
    out = np.empty(len(every))
    out[order] = fill_gaps(np.zeros(len(every), int), every[order], values)
    return out[len(x) :]


def filled(df, **kwargs):
    return [r.v for r in spline_fill(df, "k", "ts", ["v"], **kwargs).orderBy("k", "ts").collect()]


# --- grids


def readings(spark):
    complete, partial = (1.0, 2.0), (None, 2.0)
    at = {1: partial, 2: complete, 4: partial, 6: complete, 9: partial}
    rows = [("a", hour(i), *v, None if i == 2 else 9.0, f"name{i}") for i, v in at.items()]
    rows += [("none", hour(1), None, 1.0, 0.0, "n")]
    rows += [("three", hour(i), 1.0, 1.0, 0.0, "n") for i in (0, 2)]
    rows += [("four", hour(i), 1.0, 1.0, 0.0, "n") for i in (0, 3)]
    return spark.createDataFrame(rows, "k string, ts timestamp, v double, w double, rain double, name string")


def test_resample(spark):
    grid = resample.resample(readings(spark), "k", "ts", ["v", "w"], ["v", "w", "rain"], ["name"])
    got = {(r.k, r.ts): r for r in grid.collect()}
    assert sorted(t for k, t in got if k == "a") == [hour(i) for i in range(2, 7)]
    assert got["a", hour(4)][3:] == (None, 2.0, 9.0) and got["a", hour(3)][3:] == (None, None, None)
    assert got["a", hour(2)].rain is None
    assert {r.name for (k, _), r in got.items() if k == "a"} == {"name2"}
    assert {k for k, _ in got} == {"a", "four"}


def test_resample_again_changes_nothing(spark):
    once = resample.resample(readings(spark), "k", "ts", ["w"], ["v", "w"])
    twice = resample.resample(once, "k", "ts", ["w"], ["v", "w"])
    key = lambda r: (r.k, r.ts)
    assert sorted(once.collect(), key=key) == sorted(twice.collect(), key=key)


def test_long_grid_spans_several_blocks(spark):
    n = 20_000
    span = spark.createDataFrame([("a", hour(0), hour(n - 1))], "k string, lo timestamp, hi timestamp")
    grid = resample.hour_grid(span, "k", "ts")
    row = grid.agg(F.count("*"), F.countDistinct("ts"), F.min("ts"), F.max("ts")).first()
    assert tuple(row) == (n, n, hour(0), hour(n - 1))
    assert grid.select(F.spark_partition_id()).distinct().count() > 1


# --- splines


def test_solver_matches_dense_solution():
    rng = np.random.default_rng(1)
    for n in (3, 4, 5, 64, 333):
        x = np.cumsum(rng.choice([0.5, 1, 2, 40], n) * rng.uniform(0.5, 1.5, n))
        y = rng.normal(size=n)
        at = rng.uniform(x[0], x[-1], 50)
        assert np.allclose(evaluate(x, y, at), dense_spline(x, y, at), rtol=1e-9, atol=1e-9)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.floats(1e-3, 1e4), st.floats(-1e3, 1e3)), min_size=3, max_size=60),
    st.lists(st.floats(0, 0.999), max_size=5),
)
def test_solver_on_any_spacing(steps, places):
    x = np.cumsum([h for h, _ in steps])
    y = np.array([v for _, v in steps])
    at = x[0] + np.array(places) * (x[-1] - x[0])
    scale = 1 + np.abs(dense_spline(x, y, at)).max(initial=0) + np.abs(y).max()
    assert np.allclose(evaluate(x, y, at), dense_spline(x, y, at), rtol=1e-8, atol=1e-8 * scale)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10_000), st.integers(150, 400), st.floats(1.0, 6.0))
def test_halo_carries_the_whole_series(seed, n, spread):
    """A window of knots with the halo on each side has the slopes of the whole series."""
    rng = np.random.default_rng(seed)
    x = np.cumsum(np.exp(rng.uniform(-spread, spread, n)))
    y = rng.normal(size=n) * 100
    whole = natural_slopes(x, y)
    a, b = n // 2 - 5, n // 2 + 5
    lo, hi = max(0, a - HALO), min(n, b + HALO)
    part = natural_slopes(x[lo:hi], y[lo:hi])[a - lo : b - lo]
    assert np.allclose(part, whole[a:b], rtol=1e-9, atol=1e-12 * np.abs(whole).max())


def test_middle_slope():
    assert natural_slopes(np.array([0.0, 1, 3]), np.array([0.0, 1, 0]))[1] == pytest.approx(-0.75)


def test_known_value(spark):
    assert filled(series(spark, [(0, 0.0), (1, 1.0), (2, None), (3, 0.0)]))[2] == pytest.approx(0.875)


def test_line_stays_a_line(spark):
    points = [(i, None if i in (2, 3, 7) else 2.0 * i + 1) for i in range(10)]
    assert filled(series(spark, points)) == pytest.approx([2.0 * i + 1 for i in range(10)])


def test_without_gaps_nothing_changes(spark):
    assert filled(series(spark, [(i, float(i * i)) for i in range(6)])) == [float(i * i) for i in range(6)]


def test_few_knots(spark):
    two = series(spark, [(0, 1.0), (1, None), (2, None), (3, 4.0)])
    assert filled(two) == pytest.approx([1.0, 2.0, 3.0, 4.0])
    assert filled(series(spark, [(0, None), (1, None)])) == [None, None]
    with pytest.raises(Exception, match="three knots"):
        filled(two, on_few_knots="error")


def test_gap_outside_the_knots_is_an_error(spark):
    with pytest.raises(Exception, match="outside the known points"):
        filled(series(spark, [(0, 1.0), (1, 2.0), (2, 3.0), (3, None)]))


def hard_series(spark):
    """Two keys, two columns: one with scattered gaps, one nearly empty, over many segments."""
    rng = np.random.default_rng(7)
    n = 900
    rows, expected = [], {}
    for key in ("a", "b"):
        dense = np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))
        sparse = np.where(rng.random(n) < 0.97, np.nan, rng.normal(size=n))
        for v in (dense, sparse):
            v[0] = v[-1] = 1.0
        at = np.arange(n, dtype=float)
        for name, v in (("v", dense), ("w", sparse)):
            known = ~np.isnan(v)
            expected[key, name] = np.where(known, v, dense_spline(at[known], v[known], at))
        rows += [(key, hour(i), None if np.isnan(d) else float(d), None if np.isnan(s) else float(s), f"{key}{i}")
                 for i, (d, s) in enumerate(zip(dense, sparse))]
    schema = "k string, ts timestamp, v double, w double, tag string"
    return spark.createDataFrame(rows, schema).repartition(5), expected


@pytest.mark.parametrize("hours", [24, 100, 10_000])
def test_segments_agree_with_the_whole_series(spark, hours):
    """Short segments give the spline of the whole series, also where a column has
    no knot in most segments and fewer than the halo in all."""
    frame, expected = hard_series(spark)
    result = spline_fill(frame, "k", "ts", ["v", "w"], segment_seconds=hours * HOUR)
    assert result.columns == frame.columns
    got = result.orderBy("k", "ts").toPandas()
    for (key, name), want in expected.items():
        part = got[got.k == key]
        assert np.allclose(part[name], want, rtol=1e-9, atol=1e-9)
    assert (got.tag == got.k + [str(i) for i in list(range(900)) * 2]).all()


def test_coefficients_cross_segments(spark):
    frame, expected = hard_series(spark)
    whole = spline_coefficients(frame, "k", "ts", "w", segment_seconds=10_000 * HOUR)
    cut = spline_coefficients(frame, "k", "ts", "w", segment_seconds=48 * HOUR)
    a, b = (d.orderBy("k", "ts").toPandas() for d in (whole, cut))
    assert len(a) == frame.where("w is not null").count() - 2
    pd.testing.assert_frame_equal(a, b, rtol=1e-9, atol=1e-12)
    first = a[a.k == "a"].iloc[0]
    assert first.a + first.b + first.c + first.d == pytest.approx(expected["a", "w"][1])


def test_pieces_of_a_batch_do_not_mix():
    """Short and long pieces solved as one system give what each gives alone."""
    rng = np.random.default_rng(2)
    sizes = [1, 2, 3, 50, 4, 1, 200, 2]
    pieces, xs, ys, want = [], [], [], []
    for p, n in enumerate(sizes):
        x, y = np.cumsum(rng.uniform(0.1, 9, n)), rng.normal(size=n)
        y[1:-1][rng.random(max(n - 2, 0)) < 0.4] = np.nan
        known = ~np.isnan(y)
        alone = y.copy()
        if known.sum() > 2:
            alone[~known] = dense_spline(x[known], y[known], x[~known])
        elif known.sum() == 2:
            alone[~known] = np.interp(x[~known], x[known], y[known])
        pieces.append(np.full(n, p)), xs.append(x), ys.append(y), want.append(alone)
    got = fill_gaps(np.concatenate(pieces), np.concatenate(xs), np.concatenate(ys))
    assert np.allclose(got, np.concatenate(want), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("records", [1, 7, 10_000])
def test_pieces_split_over_batches(spark, records):
    """Other columns pass through unchanged, whole numbers beyond 2**53 and nulls too."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = [
        (key, hour(i), None if i in (2, 5, 6) else float(i * i), None if i == 1 else 2**53 + i)
        for key in ("a", "b", None)
        for i in range(10)
    ]
    frame = spark.createDataFrame(rows, "k string, ts timestamp, v double, big long").repartition(3)
    at = np.array([i for i in range(10) if i not in (2, 5, 6)], float)
    want = dense_spline(at, at**2, np.arange(10.0))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        got = {(r.k, r.ts): r for r in spline_fill(frame, "k", "ts", ["v"], segment_seconds=3 * HOUR).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == len(rows)
    for key, ts, _, big in rows:
        assert got[key, ts].big == big
        assert got[key, ts].v == pytest.approx(want[ts.hour])


def test_series_are_never_grouped_whole(spark):
    """Rows reach Python by series and segment, in one stream; no call per group."""
    frame, _ = hard_series(spark)
    plan = spline_fill(frame, "k", "ts", ["v", "w"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "InPandas" not in plan
    assert "_segment" in plan.split("MapInArrow")[1].split("Exchange hashpartitioning(")[1].split(")")[0]


# --- lags


def stack(df, n=12, **kwargs):
    return [
        (r.k, r.ts, list(r.features))
        for r in lag_stack(df, "k", "ts", "f", n, **kwargs).orderBy("k", "ts").collect()
    ]


def featured(spark, n, key="a", skip=()):
    rows = [(key, hour(i), [float(i + 1)]) for i in range(n) if i not in skip]
    return spark.createDataFrame(rows, "k string, ts timestamp, f array<float>").repartition(3)


@pytest.mark.parametrize("step", [None, HOUR])
def test_stack_of_thirteen_rows(spark, step):
    assert stack(featured(spark, 13), step_seconds=step) == [("a", hour(12), [float(v) for v in range(13, 0, -1)])]
    assert stack(featured(spark, 12), step_seconds=step) == []


@pytest.mark.parametrize("step", [None, HOUR])
def test_lags_cross_pieces(spark, monkeypatch, step):
    monkeypatch.setattr(lags, "PIECE_ROWS", 7)
    frame = featured(spark, 60).unionByName(featured(spark, 30, "b"))
    got = stack(frame, 3, step_seconds=step, segment_seconds=5 * HOUR)
    want = [(k, hour(i), [float(i + 1 - j) for j in range(4)]) for k, n in (("a", 60), ("b", 30)) for i in range(3, n)]
    assert got == want


def test_lag_by_row_skips_holes_and_by_step_does_not(spark):
    frame = featured(spark, 8, skip={4})
    assert [t for _, t, _ in stack(frame, 2)] == [hour(i) for i in (2, 3, 5, 6, 7)]
    assert [t for _, t, _ in stack(frame, 2, step_seconds=HOUR)] == [hour(i) for i in (2, 3, 7)]


def test_all_lags_share_one_window(spark):
    frame = series(spark, [(i, float(i)) for i in range(5)])
    plan = with_lags(frame, "k", "ts", ["v"], 12, HOUR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


def test_series_index(spark):
    frame = series(spark, [(i * 5, float(i)) for i in range(40)]).unionByName(series(spark, [(3, 0.0)], "b"))
    got = with_series_index(frame, ["k"], "ts", "n", 7 * HOUR).orderBy("k", "ts").collect()
    assert [r.n for r in got] == [*range(40), 0]


@pytest.mark.parametrize("step", [None, HOUR])
def test_lags_keep_the_series_without_a_key(spark, step):
    frame = series(spark, [(i, float(i)) for i in range(40)], None).unionAll(series(spark, [(i, -float(i)) for i in range(40)]))
    rows = with_lags(frame, "k", "ts", ["v"], 2, step, segment_seconds=7 * HOUR, piece_rows=5).orderBy("k", "ts").collect()
    got = [(r.k, r.v, r.v_lag_2) for r in rows]
    assert got == [(k, s * i, s * (i - 2.0) if i > 1 else None) for k, s in ((None, 1.0), ("a", -1.0)) for i in range(40)]
