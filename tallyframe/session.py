"""Session helpers: a local session for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, app: str = "tallyframe") -> SparkSession:
    """A local[N] session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TALLYFRAME_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tallyframe`` importable in the Python workers (pandas functions are pickled by reference).

    The package is zipped once per SparkContext and added with ``addPyFile``, Spark's own way of shipping
    code to executors; nothing depends on the workers' current directory.
    """
    sc = _context(spark)
    ident = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if ident in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="tallyframe-py-"), "tallyframe.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(ident)


# Settings we run with on a cluster (documentation; deployments set them in their own configuration).
CLUSTER_SETTINGS = {
    # AQE re-plans from runtime sizes: coalesces small shuffle partitions, broadcasts small join sides,
    # splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Start high and let AQE coalesce: about 2-3 shuffle partitions per core of the cluster.
    "spark.sql.shuffle.partitions": "8000",
    # Scan splits of up to 256 MB (Parquet row groups are the unit of work).
    "spark.sql.files.maxPartitionBytes": "256m",
    # Event time arithmetic does not depend on it, but readable day labels in logs do.
    "spark.sql.session.timeZone": "UTC",
    # Per-key streaming state (folds, dedup, Bayes) can be large: keep it in RocksDB, not the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # spark.checkpoint.dir: a shared folder (HDFS/object store), set by the deployment.
}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the folder is set by the deployment and is shared storage; only when it is unset on a local
    master (tests) do we create one ourselves, which goes when the process ends. The setting itself cannot change in
    a running session, so an own folder is known to the context only.
    """
    sc = _context(spark)
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur and sc is not None:
        cur = sc.getCheckpointDir()
    if not cur:
        master = sc.master if sc is not None else "remote"
        if not master.startswith("local[") and master != "local":
            raise RuntimeError(f"spark.checkpoint.dir is not set on {master}: stored tables need a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="tallyframe-ckpt-")
        atexit.register(shutil.rmtree, cur, ignore_errors=True)
        sc.setCheckpointDir(cur)
        return sc.getCheckpointDir()
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(cur)
    return cur


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream checkpoints, materialised tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{kind}-{uuid.uuid4().hex[:12]}"
