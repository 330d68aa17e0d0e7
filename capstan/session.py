"""Session construction and shared scratch space.

Library code never assumes a machine-local folder: intermediate tables go to
the folder named by ``spark.checkpoint.dir`` (a shared file system on a
cluster).  Only when that setting is absent, as in local tests, a private
folder under the system temp directory is created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Blobs are large cells: keep Arrow batches to the Python hook small
    # (Spark also caps a batch at spark.sql.execution.arrow.maxBytesPerBatch,
    # 64 MiB by default, whatever the session).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "capstan", **conf) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, as ``spark.checkpoint.dir`` names it.

    On a local master without the setting (tests) a fresh private folder is
    made and registered; on any other master the setting is required, as a
    machine-local folder would not be seen by the other executors.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="capstan-ckpt-")
        spark.conf.set("spark.checkpoint.dir", named)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new, unique folder name below the shared checkpoint folder (a plain
    path, or a URI of whatever file system the setting names)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if base.startswith("file:") and not base.startswith("file://"):
        base = base.removeprefix("file:")
    return f"{base}/capstan/{kind}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``capstan`` importable in Python workers, whatever the driver's
    working directory: a zip of the package, built in the driver's own
    temporary folder, goes out with ``addPyFile`` once per application (Spark
    serves it to every executor; no shared file system is involved)."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="capstan-ship-"), f"capstan-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for root, dirs, names in os.walk(pkg):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for n in sorted(names):
                if n.endswith(".py"):
                    f = os.path.join(root, n)
                    z.write(f, os.path.relpath(f, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(app)


def range_partitions(spark: SparkSession, requested: int | None = None) -> int:
    """Partition count for an explicit range repartition.

    AQE can merge small shuffle partitions but never splits an explicitly
    counted range partition, so the count is at least twice the cluster's
    task slots (and at least ``spark.sql.shuffle.partitions``).
    """
    if requested:
        return requested
    conf = spark.conf.get("spark.sql.shuffle.partitions", "200")
    shuffle = int(conf) if conf.isdigit() else 200
    return max(shuffle, 2 * spark.sparkContext.defaultParallelism)
