"""Session construction and the shared scratch location.

Library code never creates its own session: every dataset is a function of
DataFrames.  ``build_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_root: str | None = None


def build_session(
    master: str | None = None,
    app_name: str = "storelens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE (partition coalescing by size, skew-join splitting,
    runtime broadcast conversion) switched on and the UI off."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # coalesce to the advisory partition size (64 MB) rather than keeping
        # one partition per core: no floods of tiny tasks on a shared cluster
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "") or ""
    return master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting must exist (a machine-local folder would not be
    visible to other executors and would vanish with a lost node).  Only a
    local-mode session without the setting gets a fresh temporary folder,
    remembered here: the setting itself can't be changed in a running session.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; configure a shared folder for this cluster"
        )
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="storelens-ckpt-")
    return _local_root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique path under the shared checkpoint folder.  Nothing is
    created here; Spark's writer makes the folders on the cluster's store."""
    name = "-".join(parts + (uuid.uuid4().hex[:12],))
    return f"{checkpoint_root(spark)}/storelens/{name}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Has a scratch folder, which a returned DataFrame still reads, removed
    when the driver's JVM ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a scratch folder through the cluster's file system API."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
