"""Spark session settings the library relies on, and the shared scratch area.

The loaders are plain DataFrame functions and work on any session; this
module only collects the settings that make their plans behave well at
scale (AQE, skew-join splitting, UTC wall clock) and the rule for where
intermediate data may be written (the cluster's ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every pipeline run wants; a caller's own builder may set more.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Python's datetime.fromtimestamp ran on UTC containers; keep Spark on UTC.
    "spark.sql.session.timeZone": "UTC",
    # A Python dict keeps the first position and the last value of a repeated
    # key; LAST_WIN gives the same for maps parsed from literal text.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Written tables are compressed; a join side is broadcast by about what its rows take in memory.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "starloom",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`RECOMMENDED_CONF` applied.

    A checkpoint directory is only invented when the session has none and
    runs in local mode (tests, benchmarks); a cluster must name a shared one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``starloom`` importable in Python workers of a dev/test session.

    Pandas UDFs are pickled by reference to this package.  Cluster jobs ship
    it with ``--py-files``/a wheel; a local session gets a zip of the source
    tree through ``addPyFile`` once per application.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not _is_local(spark):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    fd, zpath = tempfile.mkstemp(prefix="starloom-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w") as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    spark.sparkContext.addPyFile(zpath)
    _SHIPPED.add(app)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only for local runs."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder "
            "(HDFS/S3/ABFS) there for lineage cuts and scratch tables")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-"))
    return sc.getCheckpointDir()


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """The session's settings as ``wanted`` for what is run within, then as they were."""
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def compiled_methods(spark: SparkSession):
    """Plans run within have no generated method over 8,000 bytes, which the JVM would interpret row by row.

    For wide projections: Spark then runs them as several small methods.
    """
    return settings(spark, {"spark.sql.codegen.hugeMethodLimit": "8000"})


def finished_shuffles_removed(spark: SparkSession):
    """Jobs run within take their shuffle files with them as they end; else these stay until the driver collects its garbage.

    For jobs that write what later ones read.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def materialize(df):
    """Write a frame as compressed Parquet under the shared checkpoint folder and read it back.

    Used where one computed frame feeds several consumers (or a key
    assignment), so a lost executor recomputes from the copy, not from the
    raw input.  A consumer reads the columns it uses, and joins with the copy
    are planned by its size.
    """
    path = scratch_path(df.sparkSession, "materialized")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/starloom-scratch/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["RECOMMENDED_CONF", "build_session", "ensure_checkpoint_dir", "scratch_path",
           "ship_package", "materialize", "settings", "compiled_methods",
           "finished_shuffles_removed"]
