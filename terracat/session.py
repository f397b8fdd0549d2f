"""Session helpers.

Jobs never create their own scratch folders on a cluster: lineage is cut in
the shared folder named by ``spark.checkpoint.dir``.  Only when that setting is
absent and the master is local (tests) do we pick a private folder under the
system temp dir; on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults tuned for the catalog jobs: AQE re-plans joins from runtime sizes
# (the size check behind every broadcast we do not hint ourselves), coalesces
# tiny shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting point for ~100 TB inputs on a large cluster: many initial shuffle
# partitions that AQE coalesces to ~256 MB, 256 MB scan splits, and skew
# splitting for partitions 5x above the median.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "terracat",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared lineage-cutting folder (``spark.checkpoint.dir``).  Only
    when the session names none (local tests) is a private folder chosen."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext in this client
        root = None
    if root:
        return root
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share "
                           f"(master {master or 'unknown'})")
    root = tempfile.mkdtemp(prefix="terracat-ckpt-")  # one machine: driver and executors share it
    spark.sparkContext.setCheckpointDir(root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` usable: point the context at the
    configured folder if it has none yet."""
    root = checkpoint_root(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # remote client: the server uses spark.checkpoint.dir
        return root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a materialised intermediate table in the shared root."""
    root = checkpoint_root(spark)
    if "://" not in root and not root.startswith("/"):
        root = os.path.abspath(root)
    path = f"{root.rstrip('/')}/terracat-tables/{name}-{os.urandom(6).hex()}"
    for made in getattr(_SCOPES, "open", [])[-1:]:
        made.append(path)
    return path


_SCOPES = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch folders made inside the block (by this thread) when it
    ends: for jobs that have written their results by then."""
    made: list[str] = []
    if not hasattr(_SCOPES, "open"):
        _SCOPES.open = []
    _SCOPES.open.append(made)
    try:
        yield
    finally:
        _SCOPES.open.remove(made)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
