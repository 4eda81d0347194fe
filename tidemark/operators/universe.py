"""Which symbols and series exist: FLT-1, FLT-2, FLT-4, FLT-5, SET-3, WIN-2, WIN-4, JOIN-1, JOIN-8.

Raw exchange objects are ``map<string,string>`` (open keys; nested values kept as JSON
text) with a ``pos`` column giving their order in the source, so "a later duplicate
wins" is an aggregation, not a driver loop.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import series_path
from tidemark.functions.text import repair_text
from tidemark.operators.ordinal import ordinal
from tidemark.registry import FUTURES_KINDS, INTERVALS


def keep_last(df: DataFrame, key: str | Column, pos: str = "pos", value: str = "raw") -> DataFrame:
    """WIN-4: per key, the value at the greatest position (later duplicate wins)."""
    k = F.col(key) if isinstance(key, str) else key
    return (df.groupBy(k.alias("symbol"))
            .agg(F.max_by(F.col(value), F.col(pos)).alias(value)))


def _symbol(raw: Column) -> Column:
    return repair_text(raw["symbol"])


def futures_universe(raw: DataFrame) -> DataFrame:
    """FLT-1: trading USDT perpetuals; one row per symbol with its last raw object."""
    r = F.col("raw")
    ok = (r["quoteAsset"] == "USDT") & (r["contractType"] == "PERPETUAL") & (r["status"] == "TRADING")
    return keep_last(raw.where(ok).withColumn("_sym", _symbol(r)), "_sym")


def spot_universe(raw: DataFrame) -> DataFrame:
    """FLT-2: trading USDT pairs with ``SPOT`` among their permissions (absent -> no)."""
    r = F.col("raw")
    perms = F.coalesce(F.from_json(r["permissions"], T.ArrayType(T.StringType())),
                       F.array().cast(T.ArrayType(T.StringType())))
    ok = (r["quoteAsset"] == "USDT") & (r["status"] == "TRADING") & F.array_contains(perms, "SPOT")
    return keep_last(raw.where(ok).withColumn("_sym", _symbol(r)), "_sym")


def coins_list(coins: DataFrame, col: str = "coins") -> DataFrame:
    """FLT-4: comma lists -> distinct trimmed non-blank members."""
    parts = coins.select(F.explode(F.split(F.col(col), ",")).alias("_m"))
    return parts.select(F.trim("_m").alias("symbol")).where(F.col("symbol") != "").distinct()


def coins_subset(universe: DataFrame, coins: DataFrame, col: str = "coins", on: str = "symbol") -> DataFrame:
    """FLT-4: keep the universe rows named in the comma lists."""
    return universe.join(coins_list(coins, col).withColumnRenamed("symbol", on), on, "left_semi")


def enabled_kinds(kinds: DataFrame, toggles: dict[str, bool] | None = None) -> DataFrame:
    """FLT-5: kinds switched on (registry flag, overridden per kind by ``toggles``)."""
    flag = F.col("enabled")
    for name, on in (toggles or {}).items():
        flag = F.when(F.col("kind") == name, F.lit(on)).otherwise(flag)
    return kinds.where(flag)


def build_jobs(symbols: DataFrame, kinds=FUTURES_KINDS, intervals=INTERVALS,
               toggles: dict[str, bool] | None = None) -> DataFrame:
    """JOIN-1: every symbol x enabled kind x (interval if per-interval else NULL).

    The kind x interval list is a literal of at most 42 entries, so the product is a
    per-row ``explode`` (linear in the symbols) instead of a join.
    """
    toggles = toggles or {}
    entries = []
    for k in kinds:
        if not toggles.get(k.name, k.enabled):
            continue
        for itv in (intervals if k.per_interval else (None,)):
            entries.append(F.struct(
                F.lit(k.name).alias("kind"),
                F.lit(itv).cast(T.StringType()).alias("interval"),
                F.lit(k.suffix).alias("suffix"),
                F.lit(k.per_interval).alias("per_interval"),
            ))
    jobs = symbols.select("symbol", F.explode(F.array(*entries)).alias("j"))
    return jobs.select(
        "symbol", "j.kind", "j.interval",
        series_path("symbol", "j.suffix", "j.per_interval", "j.interval").alias("path"),
    )


def info_for_universe(info: DataFrame, universe: DataFrame) -> DataFrame:
    """JOIN-8: metadata restricted to active symbols."""
    return info.join(universe.select("symbol"), "symbol", "left_semi")


def first_available(snapshots: DataFrame, now: Column) -> DataFrame:
    """SET-3: the symbols of the first usable list.

    ``snapshots`` is long: ``(source, priority, fetched_at, ttl_hours, symbol)``.  A list
    is usable when it is non-empty and, if it has a TTL, younger than it.  The usable list
    with the lowest priority wins, of several the newest; its symbols come back sorted.  Only the per-list
    summary (one row per list) is ever small-shuffled; symbols stay distributed.
    """
    lists = snapshots.groupBy("source", "priority", "fetched_at", "ttl_hours").agg(
        F.count("symbol").alias("n"))
    age_h = (F.timestamp_diff("SECOND", F.col("fetched_at"), now) / 3600.0)
    usable = lists.where((F.col("n") > 0) & (F.col("ttl_hours").isNull() | (age_h < F.col("ttl_hours"))))
    # lowest priority first, then the newest list of that source
    rank = F.struct("priority", (-F.unix_micros(F.col("fetched_at").cast("timestamp"))).alias("age"), "source")
    best = usable.agg(F.min(rank).alias("b"), F.min_by("fetched_at", rank).alias("fetched_at")).select(
        "b.source", "b.priority", "fetched_at")
    return (snapshots.join(best, ["source", "priority", "fetched_at"], "left_semi")
            .select("symbol").distinct().orderBy("symbol"))


def shard(symbols: DataFrame, n_shards: int, col: str = "symbol") -> DataFrame:
    """WIN-2: contiguous blocks of the sorted distinct symbols, ``chunk = ceil(n / N)``.

    Ranks come from ``ordinal`` (range-partitioned, no single-task window); ``n`` is one
    scalar.
    """
    ranked = ordinal(symbols, [col])
    n = ranked.agg(F.max("rank")).first()[0] or 0
    chunk = max(1, math.ceil(n / n_shards)) if n_shards > 0 else max(1, n)
    return ranked.select(col, "rank", F.floor((F.col("rank") - 1) / F.lit(chunk)).cast("int").alias("shard"))
