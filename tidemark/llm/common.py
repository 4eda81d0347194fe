"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import BATCH_BYTES, BATCH_ROWS, batch_limits, shared_dir  # noqa: F401

#: Options of tables whose rows hold megabytes each: written and read a few rows at a time.
LARGE_ROWS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1"}


def saved(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh table folder in the shared checkpoint folder and read it back.

    Cuts the lineage so that a lost executor costs a reread, never a recomputation of an
    earlier phase, and later phases see one fixed version of the rows.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.options(**options or {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(name: str, columns: list[str]) -> str:
    """``name``, with underscores after it where a table already has a column of that name."""
    while name in columns:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(col: str = "doc_id"):
    """crc32 of an integer id written in decimal."""
    return F.crc32(F.col(col).cast("string"))
