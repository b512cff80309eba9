"""Session and scratch-space helpers."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the engine assumes.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data (AQE coalesces
    small ones at runtime).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Without one a folder is chosen and registered
    with the context on a local master; on a cluster that is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.path.join("/tmp", "tidemark-checkpoints")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


#: The folder of scratch files of the run that is going on.
_RUN: ContextVar[str] = ContextVar("scratch_run", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tidemark/{_RUN.get()}{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_run(spark: SparkSession, run: str):
    """What is written to scratch meanwhile is removed at the end, also when the run fails. Only for
    runs whose results are stored elsewhere by then: a DataFrame over scratch can be read
    within the run alone."""
    from .sources.files import remove
    folder = f"run={run}-{uuid.uuid4().hex[:8]}/"
    token = _RUN.set(folder)
    try:
        yield f"{checkpoint_root(spark)}/tidemark/{folder}"
    finally:
        _RUN.reset(token)
        remove(spark, f"{checkpoint_root(spark)}/tidemark/{folder}")


def ntz(text: str) -> Column:
    """A TIMESTAMP_NTZ literal (driver tables store wall-clock timestamps)."""
    return F.lit(text).cast("timestamp_ntz")


def recommended_conf(input_bytes: int, total_cores: int) -> dict:
    """Sizing for a run over ``input_bytes`` on ``total_cores`` executor cores.

    Shuffle partitions: ~1 GB of *input* each (shuffled data is far smaller
    after column pruning and map-side combine), at least 3 waves of tasks and
    at most 100k (maps x reducers shuffle blocks stay manageable); AQE then
    coalesces toward 256 MB. Parquet scans split at 512 MB. Partitions over
    4x the median and 1 GB are split by AQE's skew-join handling.
    """
    parts = min(100_000, max(total_cores * 3, -(-input_bytes // (1 << 30))))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.session.timeZone": "UTC",
    }


def reliable_checkpoint(df):
    """``df.checkpoint()`` (eager, written to the shared checkpoint folder),
    making sure the folder is configured first. Never ``localCheckpoint``:
    executor-local copies do not survive the loss of an executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()
