"""Instrument metadata: PRJ-9, JOIN-5..7, AGG-4, AGG-5, WIN-3.

Metadata records are ``map<string,string>`` per symbol.  Key presence matters: an
absent key is left alone by an overlay, a key present with a NULL value overrides.
Overlays are ``map_concat`` under ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (set by
``tidemark.configure``), i.e. ``dict.update``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.registry import LISTING_PREFERENCE

MAP_SS = T.MapType(T.StringType(), T.StringType())
FILTERS = T.ArrayType(MAP_SS)


def _empty_map() -> Column:
    return F.create_map().cast(MAP_SS)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lift(source: Column, key: str, as_key: str | None = None) -> Column:
    """``{as_key: source[key]}`` when ``source`` has ``key``, else an empty map."""
    return F.when(F.map_contains_key(source, key),
                  F.create_map(F.lit(as_key or key), source[key])).otherwise(_empty_map())


def _last_filter(filters: Column, filter_type: str) -> Column:
    matching = F.filter(filters, lambda f: f["filterType"] == filter_type)
    # a repeated filterType: the last one wins
    return F.coalesce(F.try_element_at(matching, F.lit(-1)), _empty_map())


def flatten_symbol_info(raw) -> Column:
    """PRJ-9: drop ``filters``; lift ``tickSize``/``minPrice`` (PRICE_FILTER),
    ``minQty``/``stepSize`` (LOT_SIZE) and ``minNotional`` (MIN_NOTIONAL's ``notional``,
    else its ``minNotional``).  Keys a filter lacks stay absent."""
    raw = _c(raw)
    filters = F.coalesce(F.from_json(raw["filters"], FILTERS), F.array().cast(FILTERS))
    price, lot, notional = (_last_filter(filters, t) for t in ("PRICE_FILTER", "LOT_SIZE", "MIN_NOTIONAL"))
    min_notional = (
        F.when(F.map_contains_key(notional, "notional"), F.create_map(F.lit("minNotional"), notional["notional"]))
        .when(F.map_contains_key(notional, "minNotional"), F.create_map(F.lit("minNotional"), notional["minNotional"]))
        .otherwise(_empty_map())
    )
    base = F.map_filter(raw, lambda k, v: k != "filters")
    return F.map_concat(base, _lift(price, "tickSize"), _lift(price, "minPrice"),
                        _lift(lot, "minQty"), _lift(lot, "stepSize"), min_notional)


def overlay_info(existing: DataFrame, raw: DataFrame) -> DataFrame:
    """JOIN-5: ``existing (symbol, info)`` updated by ``raw (symbol, raw)`` flattened.

    Flattened keys win (NULL values included); custom keys of the existing record stay.
    Symbols whose raw object is empty are skipped; symbols without raw keep their record.
    """
    fresh = raw.where(F.size(F.col("raw")) > 0).select("symbol", flatten_symbol_info("raw").alias("_new"))
    j = existing.select("symbol", F.col("info").alias("_old")).join(fresh, "symbol", "full_outer")
    info = F.when(F.col("_new").isNull(), F.col("_old")).otherwise(
        F.map_concat(F.coalesce(F.col("_old"), _empty_map()), F.col("_new")))
    return j.select("symbol", info.alias("info"))


def symbol_from_flat_name(name) -> Column:
    """Legacy ``{SYM}_info.json`` file name -> symbol (NULL if it is not one)."""
    s = F.regexp_extract(_c(name), r"^(.+)_info\.json$", 1)
    return F.when(s != "", s)


def migrate_info(flat: DataFrame, nested: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """JOIN-6: legacy flat records move under their symbol; where both exist the nested
    record's keys win.  Only ``wanted`` symbols move (all when ``wanted`` is None).

    Returns ``(symbol, info, moved)``; ``sum(moved)`` is the reference's moved count.
    """
    f = flat.select("symbol", F.col("info").alias("_flat"))
    if wanted is not None:
        f = f.join(wanted.select("symbol"), "symbol", "left_semi")
    j = nested.select("symbol", F.col("info").alias("_nested")).join(f, "symbol", "full_outer")
    info = F.when(F.col("_flat").isNull(), F.col("_nested")).otherwise(
        F.map_concat(F.col("_flat"), F.coalesce(F.col("_nested"), _empty_map())))
    return j.select("symbol", info.alias("info"), F.col("_flat").isNotNull().alias("moved"))


def overlay_listing(meta: DataFrame, found: DataFrame, targets: DataFrame) -> DataFrame:
    """JOIN-7: every target symbol gets a record; ``listing_date`` is set where found,
    other records are left as they are."""
    t = targets.select("symbol").distinct()
    m = meta.select("symbol", F.col("info").alias("_old"))
    fd = found.where(F.col("listing_date").isNotNull()).select("symbol", "listing_date")
    j = m.join(t.withColumn("_t", F.lit(True)), "symbol", "full_outer").join(fd, "symbol", "left")
    info = F.when(
        F.col("listing_date").isNotNull() & F.col("_t"),
        F.map_concat(F.coalesce(F.col("_old"), _empty_map()), F.create_map(F.lit("listing_date"), F.col("listing_date"))),
    ).otherwise(F.coalesce(F.col("_old"), _empty_map()))
    return j.select("symbol", info.alias("info"))


def earliest_month(manifest: DataFrame) -> DataFrame:
    """AGG-4: the first month with a landed dump, per symbol (``yyyy-MM``)."""
    return (manifest.where(F.coalesce(F.col("rows"), F.lit(1)) > 0)
            .groupBy("symbol").agg(F.date_format(F.min("period"), "yyyy-MM").alias("listing_month")))


def prefer_series(series: DataFrame) -> DataFrame:
    """WIN-3: per symbol one stored series: fundingRate, else metrics, else 1d klines,
    else the first by path.  ``series`` is ``(symbol, kind, interval, path)``."""
    rank = (
        F.when(F.col("kind") == LISTING_PREFERENCE[0], 0)
        .when(F.col("kind") == LISTING_PREFERENCE[1], 1)
        .when((F.col("kind") == "klines") & (F.col("interval") == LISTING_PREFERENCE[2]), 2)
        .otherwise(3)
    )
    return (series.select("symbol", "path", rank.alias("_r")).distinct()
            .groupBy("symbol").agg(F.min_by("path", F.struct("_r", "path")).alias("path")))


def earliest_month_stored(stored_min: DataFrame) -> DataFrame:
    """AGG-5: ``yyyy-MM`` of the earliest time of each symbol's preferred series.

    ``stored_min`` is ``(symbol, kind, interval, path, first_ts)`` (min per series)."""
    chosen = prefer_series(stored_min)
    return (stored_min.join(chosen, ["symbol", "path"], "left_semi")
            .select("symbol", F.date_format("first_ts", "yyyy-MM").alias("listing_month"))
            .where(F.col("listing_month").isNotNull()))


def listing_months(manifest: DataFrame, stored_min: DataFrame) -> DataFrame:
    """AGG-4 with AGG-5 as fallback per symbol."""
    a = earliest_month(manifest).withColumnRenamed("listing_month", "_m")
    b = earliest_month_stored(stored_min).withColumnRenamed("listing_month", "_s")
    j = a.join(b, "symbol", "full_outer")
    return j.select(
        "symbol",
        F.coalesce("_m", "_s").alias("listing_month"),
        F.when(F.col("_m").isNotNull(), F.lit("manifest")).otherwise(F.lit("stored")).alias("found_in"),
    )


def explode_info(df: DataFrame, col: str = "info") -> DataFrame:
    """``(symbol, map)`` -> ``(symbol, key, value)`` rows (comparison and export form)."""
    return df.select("symbol", F.explode(F.col(col)).alias("key", "value"))
