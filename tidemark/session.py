"""Session settings the engine relies on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every operator assumes.
ENGINE_CONF = {
    # all times are naive UTC; pin the zone so NTZ <-> text conversions never shift
    "spark.sql.session.timeZone": "UTC",
    # map overlays behave like dict.update: the later map wins per key
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # series sinks rewrite only the partitions (series) present in the output
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # runtime re-planning: size-checked broadcast, partition coalescing, skew splits
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in ENGINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions for rows dealt explicitly, which runtime coalescing leaves alone."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets a folder of our own; elsewhere that is
    an error, since executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused (not yet created) folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/tidemark/{name}/{uuid.uuid4().hex}"


#: Upper bounds of one Arrow batch handed to a Python task; texts vary from empty to very long.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


@contextmanager
def batch_limits(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[None]:
    """Bounds of one Arrow batch for what runs inside; the session's own values come back after it.

    A frame takes them when it runs, so it has to be written inside.
    """
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "tidemark") -> SparkSession:
    """Session for tests and the bench (local mode, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return configure(spark)
