"""Dense 1-based position of distinct values in sort order, without a single-task window.

``row_number() over (order by x)`` with no partition moves every row into one task.
Instead the distinct values are range-partitioned and sorted (many tasks), each
partition numbers its own rows, and a tiny table of per-partition counts (one row per
partition, so bounded by the shuffle partition count) gives every partition its offset.
The sorted set is checkpointed to the shared folder first, so the numbering and the
counts are taken from the same materialised partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root


def ordinal(df: DataFrame, cols: list[str], name: str = "rank") -> DataFrame:
    """Distinct ``cols`` of ``df`` with their 1-based position in ascending order."""
    spark = df.sparkSession
    checkpoint_root(spark)
    ordered = (
        df.select(*cols).distinct()
        .repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ordered = ordered.checkpoint(eager=True)
    # position inside the partition: ids are consecutive from (pid << 33)
    local = ordered.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a window over it is over a table bounded by the partition count
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, subset=["_off"])
    return (
        local.join(F.broadcast(offsets), "_pid")
        .select(*cols, (F.col("_off") + F.col("_local") + 1).cast("long").alias(name))
    )
