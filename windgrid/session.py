"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python line of every expression takes longer than planning a small query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    # Splits oversized join partitions, so one hot name does not become one slow task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose smaller side has no partition above this size is hashed instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Lets REBALANCE split a hot month over several files instead of one writer task.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "windgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is designed for; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """The results of steps that do not need each other, run side by side: the last tasks of one leave cores to the others. All steps
    end before an error of one is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach, below the session's checkpoint directory.

    A machine-local folder is used only in local mode, where driver and executors share one disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="windgrid-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
