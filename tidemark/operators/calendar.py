"""Gap planning: CAL-2 over jobs, JOIN-3, CAL-6, SRT-2.

A plan row is ``(symbol, kind, interval, freq, period)``; ``freq`` is ``monthly`` (period =
first of month) or ``daily``.  A manifest row is the same key plus ``rows``: a dump that
has landed and how many rows it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import days_in_month, enumerate_periods, months_before
from tidemark.functions.paths import dump_location
from tidemark.registry import FALLBACK_MONTHS, FUTURES_KINDS, kinds_df
from tidemark.session import shuffle_partitions

SERIES = ["symbol", "kind", "interval"]
PLAN = [*SERIES, "freq", "period"]


def _keyed(df: DataFrame) -> DataFrame:
    """Null-safe join key for the nullable interval."""
    return df.withColumn("_ik", F.coalesce(F.col("interval"), F.lit("")))


_MONTH = ["symbol", "kind", "_ik", "period"]


def _dealt(df: DataFrame) -> DataFrame:
    """Rows dealt by symbol and period into the session's number of shuffle partitions.

    Runtime coalescing would size the partitions by compressed bytes, of which a key takes so few
    that one task gets millions of them."""
    return df.repartition(shuffle_partitions(df.sparkSession), "symbol", "period")


def _kinds(spark, kinds):
    # the registry has a fixed handful of rows: broadcasting it is size-safe
    return F.broadcast(kinds_df(spark, kinds))


def plan_periods(jobs: DataFrame, end: Column, kinds=FUTURES_KINDS) -> DataFrame:
    """CAL-2 for every pending job ``(symbol, kind, interval, last_ts)`` at once."""
    k = _kinds(jobs.sparkSession, kinds)
    return (
        jobs.join(k, "kind")
        .select(*SERIES, F.explode(enumerate_periods("monthly", "daily", "since", "last_ts", end)).alias("p"))
        .select(*SERIES, "p.freq", "p.period")
    )


def _landed_months(plan: DataFrame, manifest: DataFrame, deal: bool) -> DataFrame:
    """Every planned month and whether it is in the manifest with rows (``landed``).

    Planned and landed months are counted per key in one pass, which neither sorts nor joins the
    manifest.  A key with a NULL symbol, kind or period is never landed.  ``deal`` is for whole
    manifests; a few months of one make small partitions anyway."""
    monthly = F.col("freq") == "monthly"
    none = F.lit(0).cast("long")
    planned = _keyed(plan.where(monthly)).select(
        *_MONTH, F.lit(1).cast("long").alias("n"), F.isnull("interval").cast("long").alias("n_null"), F.lit(False).alias("landed"))
    landed = _keyed(manifest.where(monthly & (F.col("rows") > 0))).dropna(subset=_MONTH).select(
        *_MONTH, none.alias("n"), none.alias("n_null"), F.lit(True).alias("landed"))
    keys = planned.unionByName(landed)
    keys = (_dealt(keys) if deal else keys).groupBy(*_MONTH).agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.max("landed").alias("landed"))
    # a month planned several times stays so, each time with its own spelling of no interval
    no_interval = F.array_repeat(F.lit(None).cast("string"), F.col("n_null").cast("int"))
    intervals = F.concat(no_interval, F.array_repeat("_ik", (F.col("n") - F.col("n_null")).cast("int")))
    return keys.where(F.col("n") > 0).select(
        "symbol", "kind", F.explode(intervals).alias("interval"), F.lit("monthly").alias("freq"), "period", "landed")


def daily_fallback(plan: DataFrame, manifest: DataFrame, end: Column, kinds=FUTURES_KINDS) -> DataFrame:
    """JOIN-3: day dumps to read.

    Planned months absent from the manifest, or present but empty, are replaced by all
    their days up to ``end`` when the kind has daily dumps and the month lies 0..2 whole
    months before ``end``; older missing months mean no data exists and add nothing.
    The result is those days together with the planned days, without repeats.
    """
    k = _kinds(plan.sparkSession, kinds)
    # the recent months alone: the filter below moves before the count
    missing = _landed_months(plan, manifest, deal=False).where(~F.col("landed"))
    distance = months_before(F.col("period"), end)
    recent = (
        missing.join(k.select("kind", "daily"), "kind")
        .where(F.col("daily") & distance.between(0, FALLBACK_MONTHS))
    )
    fallback = recent.select(*SERIES, F.lit("daily").alias("freq"),
                             F.explode(days_in_month(F.col("period"), end)).alias("period"))
    days = plan.where(F.col("freq") == "daily").select(*PLAN)
    return _dealt(days.unionByName(fallback)).distinct()


def gap_plan(jobs: DataFrame, manifest: DataFrame, end: Column, kinds=FUTURES_KINDS) -> DataFrame:
    """CAL-6: the exact dumps that close each pending series' gap, with their location.

    Months that landed with rows are read whole; every other planned or fallback day is
    requested by day.
    """
    plan = plan_periods(jobs, end, kinds)
    months = _landed_months(plan, manifest, deal=True).where("landed").select(*PLAN)
    days = daily_fallback(plan, manifest, end, kinds)
    k = _kinds(plan.sparkSession, kinds)
    return (
        months.unionByName(days)
        .join(k.select("kind", "segment", "per_interval"), "kind")
        .select(*PLAN, dump_location("segment", "per_interval", "symbol", "interval", "freq", "period").alias("location"))
    )


def first_pending(jobs: DataFrame, k: int) -> DataFrame:
    """SRT-2: bounded work per run, in job order (symbol, kind, interval)."""
    return jobs.orderBy(F.col("symbol"), F.col("kind"), F.col("interval").asc_nulls_first()).limit(k)
