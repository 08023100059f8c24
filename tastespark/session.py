"""Session construction and cluster-shared folders.

The session is configured for adaptive execution (AQE coalescing and
skew-join splitting) with a UTC clock.  The checkpoint folder is read from
``spark.checkpoint.dir`` and only set here when the cluster left it unset
(tests and local runs); jobs never fall back to a machine-local folder when
a shared one is configured.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpointed intermediates are removed once no DataFrame references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Python workers already run one per core: a multi-threaded BLAS inside each
# would oversubscribe the cores, so numeric libraries get one thread each.
# Workers are reused by later stages: freed memory goes back to the system instead of staying in pools.
WORKER_ENV = {"OPENBLAS_NUM_THREADS": "1", "OMP_NUM_THREADS": "1", "MKL_NUM_THREADS": "1",
              "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": "131072"}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tastespark", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the default settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update({f"spark.executorEnv.{k}": v for k, v in WORKER_ENV.items()})
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (set if absent)."""
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir`` when the cluster sets it.  Only a session whose
    master is local (tests, one machine) gets a scratch folder of its own; anywhere
    else an unset folder is an error, since executors share no local disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
        configured = tempfile.mkdtemp(prefix="tastespark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, for written tables and
    streaming checkpoints that must survive executor loss."""
    root = checkpoint_root(spark)
    return os.path.join(root.rstrip("/"), name) if "://" not in root else root.rstrip("/") + "/" + name


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tastespark`` importable by Python workers (``--py-files`` equivalent).

    The package is zipped once per driver process and added with
    ``addPyFile``; Spark distributes it to every executor.
    """
    import zipfile

    sc = spark.sparkContext
    for k, v in WORKER_ENV.items():           # also for sessions built elsewhere
        sc.environment.setdefault(k, v)
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="tastespark-pkg-")
    path = os.path.join(out_dir, "tastespark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)
