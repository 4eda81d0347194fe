"""Run reports: AGG-7..9.

An outcome row is ``(path, symbol, status, error)`` with status one of ``produced``,
``no_new_data``, ``failed`` or ``remaining``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordinal import ordinal

CARD_WIDTH = 5


def run_totals(outcomes: DataFrame) -> DataFrame:
    """AGG-7: one row: pending, produced, failed, remaining (= pending - produced -
    failed, so no-new-data series count as remaining), no_new_data and the number of
    symbols updated / failed."""
    s = F.col("status")
    agg = outcomes.agg(
        F.count(F.lit(1)).alias("pending"),
        F.count_if(s == "produced").alias("produced"),
        F.count_if(s == "failed").alias("failed"),
        F.count_if(s == "no_new_data").alias("no_new_data"),
        F.count_distinct(F.when(s == "produced", F.col("symbol"))).alias("symbols_updated"),
        F.count_distinct(F.when(s == "failed", F.col("symbol"))).alias("symbols_failed"),
    )
    return agg.select(
        *[F.col(c).cast(T.LongType()).alias(c) for c in ("pending", "produced", "failed")],
        (F.col("pending") - F.col("produced") - F.col("failed")).cast(T.LongType()).alias("remaining"),
        *[F.col(c).cast(T.LongType()).alias(c) for c in ("no_new_data", "symbols_updated", "symbols_failed")],
    )


def run_by_symbol(outcomes: DataFrame, error_chars: int | None = None) -> DataFrame:
    """AGG-8: per symbol with any update or failure: counts, sorted series updated, and
    errors (sorted, so the report is deterministic), whole or cut to ``error_chars``.
    Groups are one symbol's series, a bounded handful."""
    s = F.col("status")
    error = F.col("error") if error_chars is None else F.substring(F.col("error"), 1, error_chars)
    g = (outcomes.where(s.isin("produced", "failed")).groupBy("symbol").agg(
        F.count_if(s == "produced").cast(T.LongType()).alias("updated"),
        F.count_if(s == "failed").cast(T.LongType()).alias("failed"),
        F.array_sort(F.collect_list(F.when(s == "produced", F.col("path")))).alias("series"),
        F.array_sort(F.collect_list(F.when(s == "failed", error))).alias("errors"),
    ))
    return g


def catalog_card(symbols: DataFrame, col: str = "symbol", width: int = CARD_WIDTH) -> DataFrame:
    """AGG-9: the symbol list, quoted, ``width`` to a line, lines but the last ending in a
    comma; plus the count on every line.  Lines are groups of ``width`` symbols."""
    ranked = ordinal(symbols, [col])
    n = ranked.agg(F.max("rank")).first()[0] or 0
    lines = (
        ranked.withColumn("line_no", F.floor((F.col("rank") - 1) / width).cast(T.LongType()))
        .groupBy("line_no")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", col))),
                                      lambda x: F.concat(F.lit('"'), x[col], F.lit('"'))), ", ").alias("_body"))
    )
    last_line = (n - 1) // width if n else -1
    return lines.select(
        "line_no",
        F.concat(F.col("_body"), F.when(F.col("line_no") < last_line, F.lit(",")).otherwise(F.lit(""))).alias("line"),
        F.lit(n).cast(T.LongType()).alias("n_symbols"),
    )
