"""Spark session defaults shared by jobs, tests and the benchmark.

Every stage of the reference pins the session zone to UTC and runs with ANSI
SQL on; we do the same once here.  AQE stays on so that small build sides are
converted to broadcast joins *after* Spark has measured them, and skewed
shuffle partitions are split at runtime.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "spreadlab",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.memory", os.environ.get("SPREADLAB_DRIVER_MEMORY", "8g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings to an existing session (driver-built ones too)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    # small Arrow batches: a Python worker holds a few of them, whatever the rows' width
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", DEFAULT_CONF["spark.sql.execution.arrow.maxBytesPerBatch"])
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``spreadlab`` importable in Python workers (grouped-map and
    map-in-pandas functions are pickled by reference): zip the package once per
    SparkContext and ``addPyFile`` it, which ships it to every executor."""
    import zipfile
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="spreadlab-pyfiles-")
    zpath = os.path.join(out_dir, "spreadlab.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system path named by the cluster).  Only when it is unset, as in local
    tests, do we create a scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="spreadlab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a staged table."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/staged/{name}-{uuid.uuid4().hex[:12]}"
