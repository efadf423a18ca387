"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces
# shuffle partitions at runtime, skew-join splitting handles hot join keys,
# UTC keeps timestamps comparable with the SQL oracle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster the master and memory come from spark-submit; ``master`` is
    only set for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    in a local session (local runs, tests) a fresh private folder is created
    and used. A cluster session without it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to the executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("QUARRY_LOCAL_TMP", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, whatever folder they start in.

    The package's sources go out once per application as a zip through
    ``addPyFile`` (served by the driver to every executor), so Arrow functions
    of the package import on a cluster without ``--py-files``.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="quarry-", suffix=".zip")
    path = os.path.realpath(path)
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._quarry_shipped = True
