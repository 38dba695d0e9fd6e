"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tidemark job relies on. Timestamps are compared with a
# UTC-naive oracle, so the session zone is pinned; AQE re-plans joins and
# coalesces shuffles at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # more, smaller splits, so that tokenising a few large files uses every core
    "spark.sql.files.maxPartitionBytes": "32m",
    # transformWithState needs the RocksDB store; a unix socket avoids a TCP
    # state server between the JVM and the Python worker.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.python.unix.domain.socket.enabled": "true",
    # delete checkpoint files (alarm rounds, corpus stages) once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Return a session with tidemark's defaults (local runs and tests).

    Python workers (stream processors, Python UDFs) import tidemark too: the
    package root is put on their ``PYTHONPATH`` before the JVM starts. On a
    cluster, ship the package with ``--py-files`` instead.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    A cluster names it in ``spark.checkpoint.dir``; that value is always used.
    Only a local-mode session without one (tests, a laptop) gets a private
    folder; a cluster without one is an error, since executors cannot share
    a folder on the driver's disk.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
