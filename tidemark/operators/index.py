"""High-water-mark index and staleness: AGG-1..3, JOIN-2, JOIN-4, FLT-6, FLT-9.

An index row is ``(path, last_ts)``: the series' stored path and its latest key time.
Index text is ``yyyy-MM-dd HH:mm:ss``; the engine keeps the typed time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import parse_series_path, series_path
from tidemark.registry import FUTURES_KINDS, TIME_COLUMNS, time_column_of


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_time(df: DataFrame, keys: list[str], time_col: str, name: str = "last_ts") -> DataFrame:
    """AGG-1: latest key time per series (reads that column only; NULL if none valid)."""
    return df.select(*keys, time_col).groupBy(*keys).agg(F.max(time_col).alias(name))


def rebuild_index(tree: DataFrame, path_col: str = "path", symbols: list[str] | None = None) -> DataFrame:
    """AGG-2: latest time per stored file of a tree; the time column is chosen by the
    kind parsed from the file name; files without a valid time are left out.  ``tree``
    holds one row per stored row with its relative ``path`` (see ``sources.series.scan_tree``);
    it is reduced to one row per file before any path is parsed.  ``symbols`` limits the
    rebuild to those symbols' files."""
    present = [c for c in TIME_COLUMNS if c in tree.columns]
    tree = tree.groupBy(path_col, "format").agg(*[F.max(c).alias(c) for c in present])
    parsed = parse_series_path(tree, path_col)
    if symbols is not None:
        parsed = parsed.where(F.col("symbol").isin(list(symbols)))
    tcol = time_column_of(F.col("kind"))
    pick = None
    for c in present:
        cond = tcol == F.lit(c)
        pick = F.when(cond, F.col(c)) if pick is None else pick.when(cond, F.col(c))
    if pick is None:
        pick = F.lit(None).cast(T.TimestampNTZType())
    return (
        parsed.groupBy(path_col, "symbol", "kind", "interval", "layout", "format")
        .agg(F.max(pick).alias("last_ts"))
        .where(F.col("last_ts").isNotNull())
    )


def bootstrap_index(jobs: DataFrame, tree_index: DataFrame) -> DataFrame:
    """AGG-3: index entries for known jobs from files already stored.

    Per job path: the nested file (Parquet preferred over its CSV twin) if it yields a
    time, else the legacy flat file at the root (same preference).  Jobs with no valid
    time are omitted.  ``tree_index`` is the output of ``rebuild_index``.
    """
    canon = series_path("symbol", F.coalesce(F.col("_suffix"), F.lit("")), F.col("interval").isNotNull(), "interval")
    suffixes = F.create_map(*[F.lit(x) for k in FUTURES_KINDS for x in (k.name, k.suffix)])
    files = (
        tree_index.where(F.col("kind").isNotNull())
        .withColumn("_suffix", suffixes[F.col("kind")])
        .withColumn("job_path", canon)
        .withColumn("_layout_rank", F.when(F.col("layout") == "nested", 0).otherwise(1))
        .withColumn("_format_rank", F.when(F.col("format") == "parquet", 0).otherwise(1))
    )
    # the preferred format decides, even when it holds no valid time
    per_layout = files.groupBy("job_path", "_layout_rank").agg(
        F.min_by("last_ts", "_format_rank").alias("last_ts"))
    best = (
        per_layout.where(F.col("last_ts").isNotNull())
        .groupBy("job_path").agg(F.min_by("last_ts", "_layout_rank").alias("last_ts"))
    )
    return jobs.join(best, jobs["path"] == best["job_path"], "inner").select(jobs["path"], "last_ts")


def overlay_index(old: DataFrame, new: DataFrame, mode: str = "overlay") -> DataFrame:
    """JOIN-4: the new entry wins per path (``overlay``), or the later time (``max``);
    entries only on one side are kept."""
    o, n = old.select("path", F.col("last_ts").alias("_old")), new.select("path", F.col("last_ts").alias("_new"))
    j = o.join(n, "path", "full_outer")
    last = F.coalesce("_new", "_old") if mode == "overlay" else F.greatest("_new", "_old")
    return j.select("path", last.alias("last_ts"))


def needs_update(last, end, actual=None) -> Column:
    """FLT-6: stale when there is no index time or its date is before ``end``; an index
    that claims to be current is trusted only if the stored data (``actual``) agrees."""
    last, end = _c(last), _c(end)
    behind = last.isNull() | (F.to_date(last) < end)
    if actual is None:
        return behind
    current_in_store = F.coalesce(F.to_date(_c(actual)) >= end, F.lit(False))
    return behind | ~current_in_store


def pending(jobs: DataFrame, index: DataFrame, end: Column, actual: DataFrame | None = None,
            force_full: bool = False) -> DataFrame:
    """JOIN-2 (+FLT-9): jobs with their index time and stored maximum; keep the stale.

    ``jobs`` has ``path``; ``index`` is ``(path, last_ts)``; ``actual`` is
    ``(path, actual_ts)`` from the store (AGG-1).  With ``force_full`` the index is
    ignored: every job is pending with a NULL last time.
    """
    if force_full:
        return jobs.withColumn("last_ts", F.lit(None).cast(T.TimestampNTZType()))
    j = jobs.join(index.select("path", "last_ts"), "path", "left")
    if actual is not None:
        j = j.join(actual.select("path", "actual_ts"), "path", "left")
        cond = needs_update("last_ts", end, "actual_ts")
        return j.where(cond).drop("actual_ts")
    return j.where(needs_update("last_ts", end))


def symbols_of(index: DataFrame) -> DataFrame:
    """SET-2: distinct first path segment of the index, sorted."""
    return (index.select(F.split(F.col("path"), "/").getItem(0).alias("symbol"))
            .distinct().orderBy("symbol"))
