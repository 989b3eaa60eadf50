"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every blotter job wants, whatever the cluster size.  Shuffle
# partition count is left to the caller: on a cluster it should follow the
# data volume (roughly input bytes / 128 MiB), AQE then coalesces it down.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


SCRATCH = "blotter-scratch"  # folder below the checkpoint root


def build_session(
    master: str | None = None,
    app_name: str = "blotter",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with blotter's defaults; existing sessions are reused."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a job that reads about ``input_bytes``.

    Scan splits and post-shuffle partitions both aim at ``partition_bytes``
    (256 MiB by default), so a task's working set fits executor memory and
    spills rarely; AQE then coalesces small shuffle partitions and splits
    skewed ones.  At 100 TB this gives about 400 000 scan tasks and a
    shuffle partition count of the same order.
    """
    partitions = max(200, -(-int(input_bytes) // partition_bytes))
    return {
        **BASE_CONF,
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def _one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session; only when none is configured (local runs, tests)
    a private folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    # "local[...]" runs in one process; "local-cluster[...]" has executors of their own
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured and not _one_process(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if not configured:
        configured = tempfile.mkdtemp(prefix="blotter-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def session_key(spark: SparkSession) -> str:
    """An identifier of the running application (stable for the session's life)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return spark.conf.get("spark.app.id", None) or str(id(spark))


_made: list[str] = []  # scratch paths handed out by this process, in order


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    _made.append(f"{root}/{SCRATCH}/{label}-{uuid.uuid4().hex}")
    return _made[-1]


def _delete(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written to scratch paths inside the block goes when the block ends.

    DataFrames built inside read those files: write or collect them before the
    end.  Only paths handed out by this process within the block are deleted.
    """
    before = len(_made)
    try:
        yield
    finally:
        for path in _made[before:]:
            _delete(spark, path)
        del _made[before:]


def remove_old_scratch(spark: SparkSession, older_than_hours: float) -> list[str]:
    """Delete scratch folders below the checkpoint root last changed so many hours ago, of any process; returns them.

    Choose an age above that of the longest job: its files are still read.
    """
    if older_than_hours <= 0:
        raise ValueError("an age above zero: younger folders may be in use")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/{SCRATCH}")
    files = root.getFileSystem(conf)
    if not files.exists(root):
        return []
    latest = (time.time() - 3600 * older_than_hours) * 1000
    old = [str(f.getPath()) for f in files.listStatus(root) if f.getModificationTime() < latest]
    return [path for path in old if _delete(spark, path)]


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so the path can be used by local tools."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)
