"""Whitening against numpy on all rows, and against what it promises."""

import math

import numpy as np
import pytest

from hourloom.llm import whitening
from tests.llm.conftest import SMALL


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]


def integers(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def check(got, rows, components=32, one=False):
    """``got`` against the fit of all ``rows`` (of one length), or of the distinct ones."""
    xs = [tuple(integers(v)) for _, v in rows]
    fit = sorted(set(xs)) if one else xs
    n, dim = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, np.float64) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == len(rows) * min(dim, components)
    deviation = {x: sum((n * v - s) ** 2 for v, s in zip(x, sums)) for x in set(xs)}
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
        assert r.n == n and math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
        assert r.identity_error <= 1e-9
    signs = {}
    for (i, v), x in zip(rows, xs):
        here = {r.component: r.whitened for r in by_row[i, deviation[x]]}
        for k in range(min(dim, components)):
            want = (np.array(x) - mean) @ vectors[:, k] / math.sqrt(values[k])
            if abs(want) > 1e-6:
                assert signs.setdefault(k, np.sign(want * here[k + 1])) == np.sign(want * here[k + 1])
            assert math.isclose(abs(here[k + 1]), abs(want), abs_tol=1e-7)


def test_whitens_the_table(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    check(whitening.whiten(frame.withColumnRenamed("label", "n")).collect(), usable(rows))


ROWS = [(i, [math.sin(i * k + k) * k for k in range(1, 6)]) for i in range(60)]
ODD = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
COPIES = [(None, ROWS[3][1]), (200, ROWS[3][1]), (3, ROWS[3][1])] + [(300 + k, ROWS[7][1]) for k in range(40)]


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_multiplicity_and_odd_rows(spark, weights):
    rows = ROWS + ODD + COPIES
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'a' AS x", "2 AS dim", "3 AS weight").repartition(4)
    check(whitening.whiten(frame, components=4, weights=weights).collect(), usable(rows), 4, weights == "one")


def test_each_length_has_its_fit(spark):
    short = [(i, [float(i % 7), float(i * i % 5)]) for i in range(500, 560)]
    frame = spark.createDataFrame(ROWS + short + [(900, [])], "vec_id long, embedding array<float>")
    got = whitening.whiten(frame).collect()
    check([r for r in got if r.vec_id < 500], ROWS)
    check([r for r in got if r.vec_id >= 500], short)


def test_no_variance_and_no_rows(spark):
    flat = spark.createDataFrame([(k, [float(k % 3), 1.0, float(k % 3)]) for k in range(9)], "vec_id long, embedding array<float>")
    got = whitening.whiten(flat).collect()
    assert len(got) == 27 and {r.component for r in got if r.whitened is not None} == {1}
    assert all(r.identity_error < 1e-9 for r in got) and math.isclose(got[0].explained + 0, [r.explained for r in got if r.component == got[0].component][0])
    alone = whitening.whiten(flat.limit(1)).collect()
    assert len(alone) == 3 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in alone)
    assert whitening.whiten(flat.where("false")).count() == 0


def test_huge_entries_are_exact_or_null(spark):
    rows = [(0, [1e30, 0.0]), (1, [-1e30, 1.0]), (2, [0.5, 2.0]), (3, [1e6, -1e6])]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert len(got) == 4 and got[0].deviation is None
    small = [(0, [1e6, 0.0]), (1, [-1e6, 1.0]), (2, [0.5, 2.0]), (3, [1e6, -1e6])]
    check(whitening.whiten(spark.createDataFrame(small, "vec_id long, embedding array<float>")).collect(), small)


def test_rejects_unknown_weights(spark):
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame(ROWS, "vec_id long, embedding array<float>"), weights="some")
