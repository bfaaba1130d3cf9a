"""Session helpers, and functions that must run where the package is not installed."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from hourloom import session
from hourloom.operators.spline import fill_gaps


def test_worker_functions_carry_their_code(tmp_path):
    (tmp_path / "fn").write_bytes(cloudpickle.dumps(fill_gaps))
    code = (
        "import pickle, numpy as np, pyspark; f = pickle.load(open('fn', 'rb'));"
        "print(f(np.zeros(4, int), np.array([0., 1, 2, 3]), np.array([0., 1, np.nan, 0]))[2])"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert float(out.stdout) == pytest.approx(0.875), out.stderr


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(root) and session.shared_root(spark) == root


def test_stored_frames_are_pruned_scans(spark):
    frame = session.stored(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    plan = frame.select("id")._jdf.queryExecution().executedPlan().toString()
    assert frame.count() == 10 and "ReadSchema: struct<id:bigint>" in plan


def test_scratch_in_a_plain_session():
    """Without a preset folder a local session makes its own, and a run can be cleared."""
    code = (
        "import os; from hourloom import session as s; k = s.get_spark('t', 'local[1]', 1, {'spark.ui.enabled': 'false'});"
        "run = s.start_run(k); f = s.stored(k.range(3)); assert f.count() == 3;"
        "at = os.path.join(s.shared_root(k), 'hourloom', run); assert os.listdir(at); s.clear(k, run); assert not os.path.exists(at)"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if "SPARK" not in k} | {"PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
