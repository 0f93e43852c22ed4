"""Session construction and shared scratch locations.

Everything that is written during a job (round-trip outputs, stream
checkpoints, replay files) goes below the cluster's shared checkpoint
directory (``spark.checkpoint.dir``).  The directory is read from the
session; only when the cluster names none (local tests) is one created.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidewire", extra: dict | None = None) -> SparkSession:
    """A session with the settings the library is written for.

    AQE stays on (runtime coalescing, skew-join splitting, broadcast
    conversion from real sizes); the UI stays off; time is UTC.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        # commit only a changelog per batch; snapshots are uploaded in the background
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory of the cluster.

    Read from the session (``SparkContext.getCheckpointDir`` or the
    ``spark.checkpoint.dir`` setting).  Only if neither is set, as in
    local tests, a directory is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidewire-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def reliable_checkpoint(df):
    """``df.checkpoint()`` into the shared checkpoint directory: computes
    ``df`` once (a job), writes it there and cuts its lineage, so later
    stages neither recompute it nor inherit its shuffle."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared checkpoint directory."""
    return f"{checkpoint_root(spark)}/tidewire/{name}-{uuid.uuid4().hex[:12]}"


_shipped: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewire`` importable in Python tasks (custom sources and
    sinks, RDD functions), once per application.

    The package is zipped once on the driver and handed to
    ``SparkContext.addPyFile``, which distributes it to every executor, as
    ``--py-files`` would at submit time.  Nothing is done when the package
    is already installed on the workers' path (``TIDEWIRE_ON_WORKERS=1``).
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped or os.environ.get("TIDEWIRE_ON_WORKERS") == "1":
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tidewire-pyfiles-"), "tidewire.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)
