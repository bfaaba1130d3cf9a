"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Set by this module, where the cluster names no folder and the session is a local one.
SCRATCH_KEY = "spark.hourloom.scratch"
RUN_KEY = "spark.hourloom.run"


def get_spark(
    app: str = "hourloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators rely on, and those of ``conf``.

    UTC is the only time zone used. ANSI stays on: casts that may fail are
    written as ``try_cast``. AQE coalesces small shuffles and splits skewed joins.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so that is an error.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.conf.get(SCRATCH_KEY, None)
    local = spark.sparkContext.master.split("[")[0] == "local"
    if root:
        return root
    if not local:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    # The cluster's key can't be set on a running session; this one can.
    root = tempfile.mkdtemp(prefix="hourloom-")
    spark.conf.set(SCRATCH_KEY, root)
    return root


def start_run(spark: SparkSession) -> str:
    """Begin a run: what is stored from now on lies in one folder, which ``clear`` removes."""
    run = f"run-{uuid.uuid4().hex}"
    spark.conf.set(RUN_KEY, run)
    return run


def clear(spark: SparkSession, run: str) -> None:
    """Remove what ``run`` has stored, once its results are written.

    Called by whoever began the run; frames that were read from it can't be used any more.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark).rstrip('/')}/hourloom/{run}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if spark.conf.get(RUN_KEY, None) == run:
        spark.conf.unset(RUN_KEY)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A run around a block, cleared at its end, also after an error; one around it goes on."""
    outer = spark.conf.get(RUN_KEY, None)
    run = start_run(spark)
    try:
        yield run
    finally:
        clear(spark, run)
        if outer:
            spark.conf.set(RUN_KEY, outer)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder, in that of the run if one has begun."""
    run = spark.conf.get(RUN_KEY, None)
    return "/".join([shared_root(spark).rstrip("/"), "hourloom", *([run] if run else []), f"{name}-{uuid.uuid4().hex}"])


def stored(df, name: str = "stored"):
    """Write a frame to the shared folder and read it back.

    Cuts the lineage where several branches read one costly result. The table
    outlives lost executors and its scans are pruned to the columns in use.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
