"""Universe queries on P (customers as exchange symbol objects), nation and supplier."""

from pyspark.sql import functions as F

from tidemark.operators.universe import (
    coins_subset, first_available, futures_universe, keep_last, shard, spot_universe,
)
from tidemark.plans.catalog import query
from tidemark.plans.surrogates import NOW, customer_objects, lit_ts, table, write_customer_objects
from tidemark.session import shared_dir
from tidemark.sources.metadata import scan_exchange_info, scan_snapshot

P_SQL = """
WITH p AS (
  SELECT 'C' || lpad(CAST(c_custkey // 2 AS VARCHAR), 7, '0') AS symbol, c_custkey AS pos, c_name AS base_asset,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'BUSD' ELSE 'USDT' END AS quote_asset,
         CASE WHEN c_nationkey >= 20 THEN 'CURRENT_QUARTER' ELSE 'PERPETUAL' END AS contract_type,
         CASE WHEN c_nationkey IN (3, 4) THEN 'SETTLING' ELSE 'TRADING' END AS status,
         c_mktsegment AS seg, c_nationkey AS nk
  FROM customer)"""


def raw_objects(spark, sf_dir):
    return scan_exchange_info(spark, write_customer_objects(spark, sf_dir), layout="lines")


@query("futures_universe", P_SQL + """
SELECT symbol, arg_max(base_asset, pos) AS base_asset FROM p
WHERE quote_asset = 'USDT' AND contract_type = 'PERPETUAL' AND status = 'TRADING' GROUP BY symbol""")
def q_futures_universe(spark, sf_dir):
    u = futures_universe(raw_objects(spark, sf_dir))
    return u.select("symbol", F.col("raw")["baseAsset"].alias("base_asset"))


@query("spot_universe", P_SQL + """
SELECT symbol, arg_max(base_asset, pos) AS base_asset FROM p
WHERE quote_asset = 'USDT' AND status = 'TRADING' AND seg IN ('BUILDING', 'FURNITURE', 'MACHINERY') GROUP BY symbol""")
def q_spot_universe(spark, sf_dir):
    u = spot_universe(raw_objects(spark, sf_dir))
    return u.select("symbol", F.col("raw")["baseAsset"].alias("base_asset"))


@query("keep_last", P_SQL + """
SELECT symbol, arg_max(base_asset, pos) AS base_asset FROM p GROUP BY symbol""")
def q_keep_last(spark, sf_dir):
    raw = raw_objects(spark, sf_dir).withColumn("_sym", F.col("raw")["symbol"])
    return keep_last(raw, "_sym").select("symbol", F.col("raw")["baseAsset"].alias("base_asset"))


@query("coins_subset", """
SELECT s_suppkey, n_name AS symbol FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 2""")
def q_coins_subset(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    # a COINS override: comma lists with padding, blanks and repeats
    coins = nation.where(F.col("n_regionkey") < 2).select(
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ,, "), F.col("n_name"), F.lit(",")).alias("coins"))
    sup = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    universe = sup.select("s_suppkey", F.col("n_name").alias("symbol"))
    return coins_subset(universe, coins)


# (source, priority, hours old, hours it stays fresh): each list holds the suppliers of one region.
LISTS = (("cache", 0, 30, 24.0), ("live", 1, 1, None), ("live", 1, 5, None), ("committed", 2, 960, None), ("cache", 0, 26, 24.0))


def _snapshots(spark, sf_dir):
    """One snapshot file per list, written and read as the source dataset keeps them."""
    sup = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    found = None
    for region, (source, priority, hours, ttl) in enumerate(LISTS):
        root = shared_dir(spark, f"snapshot_{source}")
        at = F.unix_timestamp(F.timestamp_add("HOUR", F.lit(-hours), lit_ts(NOW).cast("timestamp"))).cast("double")
        symbols = sup.where(F.col("n_regionkey") == region).agg(F.array_sort(F.collect_list("s_name")).alias("symbols"))
        symbols.select(F.to_json(F.struct(at.alias("_fetched_at"), "symbols")).alias("value")).write.text(root)
        one = scan_snapshot(spark, root, source, priority, ttl)
        found = one if found is None else found.unionByName(one)
    return found


LISTS_SQL = "(VALUES " + ", ".join(
    f"({i}, '{s}', {p}, TIMESTAMP '{NOW}' - INTERVAL {h} HOUR, {'NULL' if t is None else t}::DOUBLE)" for i, (s, p, h, t) in enumerate(LISTS)
) + ") AS l(region, source, priority, fetched_at, ttl_hours)"


@query("scan_snapshot", f"""
SELECT source, priority, fetched_at, ttl_hours, s_name AS symbol
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN {LISTS_SQL} ON n_regionkey = region""")
def q_scan_snapshot(spark, sf_dir):
    return _snapshots(spark, sf_dir)


@query("first_available", """
SELECT s_name AS symbol FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1""")
def q_first_available(spark, sf_dir):
    return first_available(_snapshots(spark, sf_dir), lit_ts(NOW))


@query("scan_exchange_info_document", P_SQL + """
SELECT symbol, arg_max(base_asset, pos) AS base_asset, count(*) AS n FROM p GROUP BY symbol""")
def q_scan_exchange_info_document(spark, sf_dir):
    """Replies shaped ``{"symbols": [...]}``, a hundred objects to a reply."""
    root = shared_dir(spark, "exchange_documents")
    objects = customer_objects(spark, sf_dir).groupBy(F.floor(F.col("pos") / 100).alias("reply")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "json"))).alias("o"))
    text = F.concat(F.lit('{"symbols": ['), F.array_join(F.transform("o", lambda x: x["json"]), ", "), F.lit("]}"))
    objects.select("reply", text.alias("value")).write.partitionBy("reply").text(root)
    raw = scan_exchange_info(spark, f"{root}/*", layout="document").withColumn("_sym", F.col("raw")["symbol"])
    counts = raw.groupBy(F.col("_sym").alias("symbol")).agg(F.count(F.lit(1)).alias("n"))
    return keep_last(raw, "_sym").join(counts, "symbol").select("symbol", F.col("raw")["baseAsset"].alias("base_asset"), "n")


@query("shard", """
WITH s AS (SELECT DISTINCT s_name AS symbol FROM supplier),
r AS (SELECT symbol, row_number() OVER (ORDER BY symbol) AS rank FROM s),
n AS (SELECT count(*) AS n FROM s)
SELECT symbol, CAST(rank AS BIGINT) AS rank, CAST(floor((rank - 1) / ceil(n / 7.0)) AS INTEGER) AS shard FROM r, n""")
def q_shard(spark, sf_dir):
    return shard(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol")), 7)
