"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Only settings that results or plans rely on; a cluster's own values for
# memory, executors and shuffle width are left alone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "tideline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the session names it.

    A temporary folder is made up only for a local master, where the driver
    and the executors are one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            current = tempfile.mkdtemp(prefix="tideline-checkpoint-")
        sc.setCheckpointDir(current)
    return current


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from there.

    Used where two passes must see the very same partitions, also when an
    executor is lost between them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def side_by_side(spark: SparkSession, tasks: Sequence[Callable], width: int = 4) -> list:
    """Results of independent fits, a few at a time, so that their small jobs fill the cluster."""
    pool = ThreadPool(max(1, min(width, len(tasks))))
    try:
        return pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks)
    finally:
        pool.close()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the checkpoint folder, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
