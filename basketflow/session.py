"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins and coalesces shuffle partitions
# at run time; skew-join splitting guards the (user, product) and product keyed joins.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "basketflow",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` is only set for local runs; on a cluster the launcher decides. The number of
    shuffle partitions should be sized from the data (about 128 MB per partition); AQE
    coalesces the surplus, so a generous value is cheap.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count; the default parallelism when it is not a number."""
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return max(1, spark.sparkContext.defaultParallelism)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables.

    Read from ``spark.checkpoint.dir``. Only a local-mode session without that setting (tests,
    laptop runs) gets a fresh folder under the system temp directory; a cluster session must
    name a shared folder, since a machine-local one does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = configured or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/DBFS) for it")
    path = tempfile.mkdtemp(prefix="basketflow-ckpt-")
    sc.setCheckpointDir(path)
    return path


def stage_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for a named stage table."""
    return os.path.join(checkpoint_dir(spark), *parts)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[int, list] = {}
_lock = threading.Lock()


@contextmanager
def short_shuffles(spark: SparkSession):
    """Inside, an action's shuffle files go when it ends.

    Spark keeps them otherwise until the driver collects the plan as garbage, so that a job of many steps holds the shuffles
    of all of them on disk. For steps that write their result and are not run again; threads of one session may overlap.
    """
    with _lock:
        held = _cleaning.setdefault(id(spark), [0, spark.conf.get(SHUFFLE_CLEANUP, None)])
        held[0] += 1
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                del _cleaning[id(spark)]
                if held[1] is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, held[1])
