"""Run the headline queries and print one JSON line with their times in seconds.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads.
Each query is run to the end: its rows are made and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from hourloom.plans.catalog import QUERIES  # noqa: E402
from hourloom.session import get_spark  # noqa: E402

# Everything but the shortest single-row queries, in the order of the yearly job.
HEADLINE = [
    "csv_scan",
    "archive_expand",
    "measurement_clean",
    "eligible_filter",
    "local_to_utc_hour",
    "two_role_dim_join",
    "top1_per_group",
    "hourly_mean",
    "first_per_bucket",
    "complete_span",
    "hour_grid",
    "resample_hourly",
    "spline_coefficients",
    "spline_fill",
    "lags_1_12",
    "lag_stack",
    "bucket_join",
    "two_sided_bucket_join",
    "event_features",
    "undersample",
    "stratified_split",
    "roc_curve",
    "auc",
    "rf_train_score",
    "table_round_trip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}
    conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="bench-")
    spark = get_spark("bench", f"local[{cpus}]", int(cpus), conf)
    spark.sparkContext.setLogLevel("ERROR")

    QUERIES["hour_bucket"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    QUERIES["spline_fill"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
