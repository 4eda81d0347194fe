"""One update run as a Spark plan (the updater's main loop, SURVEY 3.1):

jobs -> subset or shard -> index (stored maxima) -> stale jobs -> gap plan -> rows from the
``source`` hook -> insert-only merge into the store -> index log -> run outcomes.

``source`` (UDF-1) is any function ``plan -> (rows, failures)``: the rows of the planned dumps
and ``(location, error)`` of those that could not be read.  The default reads dumps that have
landed under a folder, opening only the planned ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.calendar import gap_plan
from tidemark.operators.index import latest_time, pending
from tidemark.operators.universe import coins_subset, shard
from tidemark.registry import FUTURES_KINDS, Kind
from tidemark.sources.dumps import dump_lines, failed_files, landed_files, lines_without, parse_lines, whole_dump
from tidemark.sources.series import scan_series
from tidemark.streaming.ingest import SERIES, series_key_path, store_schema, upsert

Source = Callable[[DataFrame], tuple[DataFrame, DataFrame]]
_LOCATION = r"((?:monthly|daily)/.*)$"


def landed_source(spark: SparkSession, landing: str, k: Kind, ext: str = "csv") -> Source:
    """Default UDF-1: planned dumps that have landed under ``landing`` as ``csv`` or ``zip``.
    A planned dump that never landed simply yields no rows, as a missing file would; one that
    landed in several files is read from all of them; one that is unreadable or malformed yields its
    error and no rows."""

    def source(plan: DataFrame) -> tuple[DataFrame, DataFrame]:
        wanted = plan.select(F.regexp_replace("location", r"\.zip$", "." + ext).alias("_loc")).distinct()
        files = landed_files(spark, landing, ext, k)
        here = whole_dump(F.regexp_extract("path", _LOCATION, 1))
        # the paths are joined first: a file that isn't planned is never opened
        planned = files.join(wanted, here == F.col("_loc"), "left_semi")
        lines = dump_lines(planned).checkpoint()
        failures = failed_files(lines, k).select(whole_dump(F.regexp_extract("path", _LOCATION, 1)).alias("location"), "error").checkpoint()
        # a dump with a broken part is not read in part: its first lines might be the missing ones
        mine = whole_dump(F.regexp_extract("path", _LOCATION, 1))
        bad = failures.select("location").distinct()
        rows = parse_lines(lines_without(lines, bad, mine), k).drop("_file")
        return rows, failures.withColumn("location", F.regexp_replace("location", rf"\.{ext}$", ".zip"))
    return source


def chosen(symbols: DataFrame, coins: DataFrame | None = None, part: tuple[int, int] | None = None) -> DataFrame:
    """FLT-4 / WIN-2: the symbols of a run: those named in ``coins`` (which bypasses sharding),
    else those of shard ``part[0]`` of ``part[1]``, else all."""
    if coins is not None:
        return coins_subset(symbols, coins)
    if part is not None:
        mine = shard(symbols.select("symbol"), part[1]).where(F.col("shard") == part[0])
        return symbols.join(mine.select("symbol"), "symbol", "left_semi")
    return symbols


def run_update(spark: SparkSession, store: str, index_log: str, jobs: DataFrame, manifest: DataFrame,
               end: Column, k: Kind, source: Source, force_full: bool = False, kinds=FUTURES_KINDS,
               todo_limit: int | None = None) -> DataFrame:
    """Bring every stale job of kind ``k`` up to ``end``; returns the outcome of each stale series
    ``(path, symbol, status, error, fetched, appended)``.

    ``failed``: a planned dump could not be read (its error); ``produced``: rows were fetched,
    whether or not any was new; ``no_new_data``: none were; ``remaining``: beyond ``todo_limit``
    series (in path order), left to the next run.
    """
    try:
        index = spark.read.parquet(index_log).groupBy("path").agg(F.max("last_ts").alias("last_ts"))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        index = None  # no index yet: bootstrap from the store (AGG-3)
    # the store is asked only about series whose index claims to be current
    own = jobs.where(F.col("kind") == k.name)
    stored = scan_series(spark, store, store_schema(k))
    if index is not None:
        current = own.join(index.where(F.to_date("last_ts") >= end), "path", "left_semi").select("symbol").distinct()
        stored = stored.join(current, "symbol", "left_semi")
    actual = latest_time(stored, SERIES, k.time_col, "actual_ts").select(series_key_path().alias("path"), "actual_ts")
    if index is None:
        index = actual.select("path", F.col("actual_ts").alias("last_ts"))
    stale = pending(own, index, end, actual, force_full).checkpoint()
    todo = stale if todo_limit is None else stale.orderBy("path").limit(todo_limit)
    plan = gap_plan(todo, manifest, end, [kk for kk in kinds if kk.name == k.name])
    rows, failures = source(plan)
    rows = rows.persist()
    fresh, latest = upsert(spark, rows, store, k)
    latest.write.mode("append").parquet(index_log)
    count = lambda df, name: df.groupBy(series_key_path().alias("path")).agg(F.count(F.lit(1)).alias(name))
    failed = plan.select("location", *SERIES).join(failures, "location").groupBy(series_key_path().alias("path")).agg(
        F.min("error").alias("error"))
    out = (stale.select("path", "symbol").join(todo.select("path", F.lit(True).alias("_todo")), "path", "left")
           .join(count(rows, "fetched"), "path", "left").join(count(fresh, "appended"), "path", "left").join(failed, "path", "left"))
    status = (F.when(F.col("_todo").isNull(), "remaining").when(F.col("error").isNotNull(), "failed")
              .when(F.col("fetched") > 0, "produced").otherwise("no_new_data"))
    out = out.select("path", "symbol", status.alias("status"), "error", F.coalesce("fetched", F.lit(0)).cast("long").alias("fetched"),
                     F.coalesce("appended", F.lit(0)).cast("long").alias("appended")).checkpoint()
    rows.unpersist()
    return out
