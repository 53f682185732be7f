"""Spark session and shared-storage helpers.

Library code never creates its own session; callers pass one in.  The
helpers here are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Session settings every job in this package assumes.  AQE re-plans joins
# at runtime (broadcast when a side turns out small, split skewed
# partitions); timestamps are compared in UTC.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "folioflow") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read.
    Only when it is unset (local tests) is a fresh scratch folder made.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder is not visible to the executors of a cluster
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    path = tempfile.mkdtemp(prefix="folioflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for written intermediate tables)."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet below the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor re-reads the
    files instead of recomputing the plan) and keeps parquet column pruning
    and filter pushdown for every later read.
    """
    path = shared_path(df.sparkSession, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (what ``--py-files`` does).

    Functions run by ``mapInPandas`` / ``applyInPandasWithState`` refer to
    module-level helpers of this package; the workers import them.  The
    package is zipped once per application and added with ``addPyFile``,
    which Spark distributes to every executor.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="folioflow-pyfiles-"), "folioflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, dirs, files in os.walk(pkg_dir):
            dirs[:] = [x for x in dirs if x != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
