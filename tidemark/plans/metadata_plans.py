"""Metadata queries on P (customers as symbol objects and curated records) and O."""

from pyspark.sql import functions as F

from tidemark.operators.metadata import (
    earliest_month, explode_info, flatten_symbol_info, listing_months, migrate_info, overlay_info,
    overlay_listing,
)
from tidemark.operators.universe import futures_universe, info_for_universe, keep_last
from tidemark.plans.catalog import query
from tidemark.plans.surrogates import customer_objects, orders_manifest, table
from tidemark.plans.universe_plans import P_SQL, raw_objects
from tidemark.session import shared_dir
from tidemark.sinks.tables import write_files
from tidemark.sources.metadata import MAP_SS, scan_symbol_info


def flat_rows(src: str) -> str:
    """Oracle: the flattened key/value rows of the objects in ``src``."""
    return f"""
SELECT symbol, 'symbol' AS key, symbol AS value FROM {src}
UNION ALL SELECT symbol, 'baseAsset', base_asset FROM {src}
UNION ALL SELECT symbol, 'quoteAsset', quote_asset FROM {src}
UNION ALL SELECT symbol, 'contractType', contract_type FROM {src}
UNION ALL SELECT symbol, 'status', status FROM {src}
UNION ALL SELECT symbol, 'permissions', CASE seg WHEN 'BUILDING' THEN '["SPOT","MARGIN"]' WHEN 'AUTOMOBILE' THEN '["MARGIN"]'
                                              ELSE '["SPOT"]' END FROM {src} WHERE seg <> 'HOUSEHOLD'
UNION ALL SELECT symbol, 'tickSize', CASE WHEN nk = 5 THEN '9.99' ELSE '0.' || lpad(CAST(nk AS VARCHAR), 2, '0') END FROM {src}
UNION ALL SELECT symbol, 'minPrice', '0.001' FROM {src} WHERE nk <> 5
UNION ALL SELECT symbol, 'minQty', '0.1' FROM {src} WHERE nk <> 0
UNION ALL SELECT symbol, 'stepSize', CAST(pos % 7 AS VARCHAR) FROM {src} WHERE nk <> 0
UNION ALL SELECT symbol, 'minNotional', CASE WHEN seg IN ('BUILDING', 'AUTOMOBILE') THEN '5' ELSE '10' END FROM {src}"""


LAST = ", l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY pos DESC) = 1)"


def _last_raw(spark, sf_dir):
    raw = raw_objects(spark, sf_dir).withColumn("_sym", F.col("raw")["symbol"])
    return keep_last(raw, "_sym")


@query("flatten_symbol_info", P_SQL + LAST + flat_rows("l"))
def q_flatten_symbol_info(spark, sf_dir):
    info = _last_raw(spark, sf_dir).select("symbol", flatten_symbol_info("raw").alias("info"))
    return explode_info(info)


@query("info_for_universe", P_SQL + LAST + """,
u AS (SELECT DISTINCT symbol FROM p WHERE quote_asset = 'USDT' AND contract_type = 'PERPETUAL' AND status = 'TRADING'),
lu AS (SELECT * FROM l WHERE symbol IN (SELECT symbol FROM u))""" + flat_rows("lu"))
def q_info_for_universe(spark, sf_dir):
    raw = raw_objects(spark, sf_dir)
    info = _last_raw(spark, sf_dir).select("symbol", flatten_symbol_info("raw").alias("info"))
    return explode_info(info_for_universe(info, futures_universe(raw)))


def _kv(m: dict) -> F.Column:
    return F.create_map(*[x for k, v in m.items() for x in (F.lit(k), v if isinstance(v, F.Column) else F.lit(v))])


@query("overlay_info", P_SQL + """,
l5 AS (SELECT * FROM p WHERE nk >= 5 OR pos % 2 = 1 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY pos DESC) = 1),
o AS (SELECT symbol, v.key, v.value FROM (SELECT symbol, seg FROM p WHERE pos % 2 = 0 AND nk < 15) e,
      LATERAL (VALUES ('symbol', e.symbol), ('sector', e.seg), ('oldOnly', 'true'), ('tickSize', '0.10')) AS v(key, value)),
n AS (""" + flat_rows("l5") + """)
SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.key, o.key) AS key,
       CASE WHEN n.key IS NOT NULL THEN n.value ELSE o.value END AS value
FROM o FULL OUTER JOIN n ON o.symbol = n.symbol AND o.key = n.key""")
def q_overlay_info(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    sym = F.concat(F.lit("C"), F.lpad((F.col("c_custkey") / 2).cast("long").cast("string"), 7, "0"))
    existing = (c.where((F.col("c_custkey") % 2 == 0) & (F.col("c_nationkey") < 15))
                .select(sym.alias("symbol"), _kv({"symbol": sym, "sector": F.col("c_mktsegment"),
                                                  "oldOnly": "true", "tickSize": "0.10"}).alias("info")))
    live = customer_objects(spark, sf_dir).join(
        c.where((F.col("c_nationkey") >= 5) | (F.col("c_custkey") % 2 == 1)).select(F.col("c_custkey").alias("pos")), "pos", "left_semi")
    raw = live.select("symbol", "pos", F.from_json("json", MAP_SS).alias("raw"))
    return explode_info(overlay_info(existing, keep_last(raw, "symbol")))


@query("migrate_info", """
WITH c AS (SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS symbol, c_mktsegment AS seg, c_nationkey AS nk FROM customer),
f AS (SELECT symbol, v.key, v.value FROM (SELECT * FROM c WHERE nk < 17 AND seg <> 'HOUSEHOLD') x,
      LATERAL (VALUES ('legacy', 'yes'), ('sector', x.seg)) AS v(key, value)),
n AS (SELECT symbol, v.key, v.value FROM (SELECT * FROM c WHERE nk >= 8) x,
      LATERAL (VALUES ('sector', lower(x.seg)), ('tier', CAST(x.nk AS VARCHAR))) AS v(key, value))
SELECT coalesce(n.symbol, f.symbol) AS symbol, coalesce(n.key, f.key) AS key,
       CASE WHEN n.key IS NOT NULL THEN n.value ELSE f.value END AS value,
       coalesce(n.symbol, f.symbol) IN (SELECT symbol FROM f) AS moved
FROM f FULL OUTER JOIN n ON f.symbol = n.symbol AND f.key = n.key""")
def q_migrate_info(spark, sf_dir):
    """Every customer has a flat file, a nested one or both; flat ones of households aren't wanted."""
    c = table(spark, sf_dir, "customer")
    sym, nk = F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")), F.col("c_nationkey")
    root = shared_dir(spark, "info")
    flat = c.where(nk < 17).select(
        F.concat(sym, F.lit("_info.json")).alias("path"),
        F.to_json(_kv({"legacy": "yes", "sector": F.col("c_mktsegment")})).alias("content"))
    nested = c.where(nk >= 8).select(
        F.concat(sym, F.lit("/"), sym, F.lit("_info.json")).alias("path"),
        F.to_json(_kv({"sector": F.lower("c_mktsegment"), "tier": nk.cast("string")})).alias("content"))
    # a file costs its task the same whatever its bytes: rows are dealt over all tasks
    p = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    write_files(flat.repartition(p, "path"), root)
    write_files(nested.repartition(p, "path"), root)
    wanted = c.where(F.col("c_mktsegment") != "HOUSEHOLD").select(sym.alias("symbol"))
    out = migrate_info(scan_symbol_info(spark, root, "flat"), scan_symbol_info(spark, root, "nested"), wanted)
    return out.select("symbol", F.explode("info").alias("key", "value"), "moved")


@query("overlay_listing", """
WITH m AS (SELECT CAST(c_custkey AS VARCHAR) AS symbol, v.key, v.value FROM customer,
           LATERAL (VALUES ('listing_date', 'unknown'), ('note', c_mktsegment)) AS v(key, value) WHERE c_nationkey < 10),
fd AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, strftime(min(o_orderdate), '%Y-%m') AS d FROM orders GROUP BY 1),
t AS (SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer),
r AS (SELECT symbol, key, value FROM m
      WHERE NOT (key = 'listing_date' AND symbol IN (SELECT symbol FROM fd))
      UNION ALL SELECT symbol, 'listing_date', d FROM fd WHERE symbol IN (SELECT symbol FROM t))
SELECT t.symbol, coalesce(string_agg(key || '=' || value, ',' ORDER BY key), '') AS info FROM t LEFT JOIN r ON t.symbol = r.symbol
GROUP BY t.symbol""")
def q_overlay_listing(spark, sf_dir):
    """Every target is there, customers without orders or curated fields with an empty record."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    meta = c.where(F.col("c_nationkey") < 10).select(
        key.alias("symbol"), _kv({"listing_date": "unknown", "note": F.col("c_mktsegment")}).alias("info"))
    found = earliest_month(orders_manifest(spark, sf_dir)).withColumnRenamed("listing_month", "listing_date")
    out = overlay_listing(meta, found, c.select(key.alias("symbol")))
    entries = F.transform(F.array_sort(F.map_entries("info")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select("symbol", F.array_join(entries, ",").alias("info"))


@query("earliest_month", """
SELECT CAST(o_custkey AS VARCHAR) AS symbol, strftime(min(o_orderdate), '%Y-%m') AS listing_month FROM orders GROUP BY 1""")
def q_earliest_month(spark, sf_dir):
    return earliest_month(orders_manifest(spark, sf_dir))


PRIORITY_KIND = {"1-URGENT": ("fundingRate", None, "_fundingRate"), "2-HIGH": ("metrics", None, "_metrics"),
                 "3-MEDIUM": ("klines", "1d", "_1d"), "4-NOT SPECIFIED": ("klines", "1h", "_1h"),
                 "5-LOW": ("markPrice", "4h", "_markPrice_4h")}


@query("earliest_month_stored", """
WITH a AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, strftime(min(o_orderdate), '%Y-%m') AS m FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 1),
s AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, o_orderpriority AS pr, min(o_orderdate) AS first_ts FROM orders GROUP BY 1, 2),
r AS (SELECT symbol, first_ts,
        CASE pr WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END AS rk,
        symbol || '/' || symbol || CASE pr WHEN '1-URGENT' THEN '_fundingRate' WHEN '2-HIGH' THEN '_metrics'
          WHEN '3-MEDIUM' THEN '_1d' WHEN '4-NOT SPECIFIED' THEN '_1h' ELSE '_markPrice_4h' END || '.parquet' AS path FROM s),
b AS (SELECT symbol, strftime(first_ts, '%Y-%m') AS s FROM r
      QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY rk, path) = 1)
SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.m, b.s) AS listing_month,
       CASE WHEN a.m IS NOT NULL THEN 'manifest' ELSE 'stored' END AS found_in
FROM a FULL OUTER JOIN b ON a.symbol = b.symbol""")
def q_earliest_month_stored(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    man = (o.where(F.col("o_orderstatus") == "F")
           .select(F.col("o_custkey").cast("string").alias("symbol"), F.trunc("o_orderdate", "month").alias("period"))
           .withColumn("rows", F.lit(1)))
    pr = F.col("o_orderpriority")
    kind, interval, tail = (F.lit(None),) * 3
    for p, (k, i, t) in PRIORITY_KIND.items():
        kind = F.when(pr == p, F.lit(k)).otherwise(kind)
        interval = F.when(pr == p, F.lit(i)).otherwise(interval)
        tail = F.when(pr == p, F.lit(t)).otherwise(tail)
    sym = F.col("o_custkey").cast("string")
    stored = (o.select(sym.alias("symbol"), kind.alias("kind"), interval.cast("string").alias("interval"),
                       F.concat(sym, F.lit("/"), sym, tail, F.lit(".parquet")).alias("path"), "o_orderdate")
              .groupBy("symbol", "kind", "interval", "path").agg(F.min("o_orderdate").alias("first_ts")))
    return listing_months(man, stored)
