"""Upsert of series: SET-1, FLT-3, WIN-1, JOIN-9, SRT-1, AGG-6.

The stored row wins: a re-fetched row never corrects a stored one.  Among new rows,
monthly dumps precede daily ones, each in period order, then in row order.  Every row
carries that order as three tag columns:

* ``_source``  0 stored, 1 monthly dump, 2 daily dump (or any larger number)
* ``_period``  the dump's period (a date), NULL for stored rows
* ``_part``    only of dumps: the number of the file within a dump that came in several, else 0
* ``_row``     position inside its dump file or any unique order column

The key of a row is ``(series columns..., time column)``.  Windows and joins are
partitioned by that full key, so even a series holding a third of all rows spreads
over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import harmonize

SOURCE, PERIOD, PART, ROW = "_source", "_period", "_part", "_row"
TAGS = (SOURCE, PERIOD, PART, ROW)
STORED, MONTHLY, DAILY = 0, 1, 2


def tag(df: DataFrame, source: int, period: Column | None = None, row: Column | None = None) -> DataFrame:
    """Attach the first-wins order; ``row`` defaults to the position in the input."""
    return df.withColumns({
        SOURCE: F.lit(source).cast(T.IntegerType()),
        PERIOD: (period if period is not None else F.lit(None)).cast(T.DateType()),
        ROW: (row if row is not None else F.monotonically_increasing_id()).cast(T.LongType()),
    })


def _ensure_tags(df: DataFrame, source: int) -> DataFrame:
    return df if SOURCE in df.columns else tag(df, source)


def concat_frames(*frames: DataFrame) -> DataFrame:
    """SET-1: bag union by column name; columns missing on one side are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def drop_null_time(df: DataFrame, time_col: str) -> DataFrame:
    """FLT-3: a row without a key time is dropped (this also drops stray header rows)."""
    return df.where(F.col(time_col).isNotNull())


def _first_per_key(df: DataFrame, keys: list[str], time_col: str) -> DataFrame:
    part = [F.col(PART).asc_nulls_first()] if PART in df.columns else []
    w = Window.partitionBy(*keys, time_col).orderBy(
        F.col(SOURCE).asc(), F.col(PERIOD).asc_nulls_first(), *part, F.col(ROW).asc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def merge_first_wins(existing: DataFrame | None, new: DataFrame, keys: list[str], time_col: str,
                     keep_tags: bool = False) -> DataFrame:
    """WIN-1: harmonise times -> concat -> drop NULL time -> first row per key wins.

    ``existing`` rows are tagged as stored (source 0) unless already tagged; untagged
    ``new`` rows are tagged as source 1.  The result is unordered; see ``sort_series``.
    """
    parts = [_ensure_tags(harmonize(new), 1)]
    if existing is not None:
        parts.insert(0, _ensure_tags(harmonize(existing), STORED))
    merged = _first_per_key(drop_null_time(concat_frames(*parts), time_col), keys, time_col)
    return merged if keep_tags else merged.drop(*TAGS)


def dedupe_new(new: DataFrame, keys: list[str], time_col: str) -> DataFrame:
    """First row per key inside a batch of new rows (monthly before daily, then order)."""
    return _first_per_key(drop_null_time(_ensure_tags(harmonize(new), 1), time_col), keys, time_col)


def new_rows_only(existing: DataFrame, new: DataFrame, keys: list[str], time_col: str,
                  keep_tags: bool = False) -> DataFrame:
    """JOIN-9: the insert-only form of WIN-1.

    Because the stored row always wins, only keys the store has not seen need to be
    appended.  Only the stored keys of series present in the batch, at or after the batch's
    earliest time of the series, enter the anti join; pruning the files themselves is the
    caller's part (``streaming.ingest.stored_part``).  Keys are compared null-safely: kinds
    without intervals have a NULL interval.
    """
    # de-duplication never changes a series' earliest time, so the bound is taken from
    # the raw batch: no second window over the same rows
    out = unseen_rows(existing, dedupe_new(new, keys, time_col), keys, time_col,
                      drop_null_time(harmonize(new).select(*keys, time_col), time_col))
    return out if keep_tags else out.drop(*TAGS)


def unseen_rows(existing: DataFrame, batch: DataFrame, keys: list[str], time_col: str, times: DataFrame | None = None) -> DataFrame:
    """The rows of a de-duplicated ``batch`` whose keys ``existing`` doesn't hold, with their tags;
    ``times`` has the series and times of the batch, for where that is less work."""
    lo = (times if times is not None else batch).groupBy(*keys).agg(F.min(time_col).alias("_lo"))
    stored = harmonize(existing).select(*keys, time_col).toDF(*[f"_stored_{c}" for c in (*keys, time_col)])
    lo = lo.toDF(*[f"_lo_{c}" for c in keys], "_lo")
    stored = stored.join(lo, _same(stored, "_stored_", lo, "_lo_", keys)).where(F.col(f"_stored_{time_col}") >= F.col("_lo"))
    stored = stored.select(*[f"_stored_{c}" for c in (*keys, time_col)])
    return batch.join(stored, _same(batch, "", stored, "_stored_", [*keys, time_col]), "left_anti")


def _same(a: DataFrame, a_prefix: str, b: DataFrame, b_prefix: str, keys: list[str]) -> Column:
    """Null-safe equality of the same columns under two prefixes."""
    cond = F.lit(True)
    for c in keys:
        cond = cond & a[a_prefix + c].eqNullSafe(b[b_prefix + c])
    return cond


def join_null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``a.join(b, keys, how)`` where NULL keys (the interval of kinds without any) are equal."""
    b = b.withColumnsRenamed({c: f"_right_{c}" for c in keys})
    return a.join(b, _same(a, "", b, "_right_", keys), how).drop(*[f"_right_{c}" for c in keys])


def sort_series(df: DataFrame, keys: list[str], time_col: str) -> DataFrame:
    """SRT-1: ascending time within each series (a range-partitioned global sort)."""
    return df.orderBy(*keys, time_col)


def merge_report(existing: DataFrame | None, new: DataFrame, merged: DataFrame,
                 keys: list[str], time_col: str) -> DataFrame:
    """AGG-6: per series that received rows: fetched, before, after, delta, last date.

    ``fetched`` and ``before`` count raw rows (before de-duplication), ``after`` counts
    the merged series.  Both sides are aggregated per series before the join.
    """
    counts_new = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("fetched"))
    post = merged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("after"),
        F.to_date(F.max(time_col)).alias("last_date"),
    )
    out = join_null_safe(counts_new, post, keys, "left")
    if existing is not None:
        before = existing.groupBy(*keys).agg(F.count(F.lit(1)).alias("before"))
        out = join_null_safe(out, before, keys, "left")
    else:
        out = out.withColumn("before", F.lit(None).cast(T.LongType()))
    return out.select(
        *keys,
        F.col("fetched").cast(T.LongType()).alias("fetched"),
        F.coalesce(F.col("before"), F.lit(0)).cast(T.LongType()).alias("before"),
        F.coalesce(F.col("after"), F.lit(0)).cast(T.LongType()).alias("after"),
        (F.coalesce(F.col("after"), F.lit(0)) - F.coalesce(F.col("before"), F.lit(0))).cast(T.LongType()).alias("delta"),
        "last_date",
    )
