"""Sink round trips through the shared folder: SNK-1..5."""

from pyspark.sql import functions as F

from tidemark.operators.index import latest_time, overlay_index
from tidemark.operators.merge import join_null_safe, merge_first_wins, tag
from tidemark.operators.metadata import explode_info, flatten_symbol_info
from tidemark.operators.report import run_by_symbol, run_totals
from tidemark.plans.catalog import query
from tidemark.plans.index_plans import _l_index
from tidemark.plans.merge_plans import E_UNION
from tidemark.plans.metadata_plans import LAST, _last_raw, flat_rows
from tidemark.plans.report_plans import ERR, TOTALS_SQL, by_symbol_rows, by_symbol_sql
from tidemark.plans.source_plans import STORE_SCHEMA
from tidemark.plans.surrogates import NOW, events_existing, events_new, lit_ts, orders_outcomes, table
from tidemark.plans.universe_plans import P_SQL
from tidemark.session import shared_dir
from tidemark.sinks.tables import read_table, write_index, write_info, write_meta, write_run_summary, write_series, write_snapshot
from tidemark.sources.metadata import scan_meta
from tidemark.sources.series import scan_series

SERIES = ["kind", "interval", "symbol"]


def _as_store(df):
    return df.select(F.lit("klines").alias("kind"), F.lit("1h").alias("interval"), "symbol", "open_time",
                     F.col("event_id").cast("string").alias("open"), F.col("user_id").cast("string").alias("high"),
                     "event_id")


MERGED_TEXT_SQL = f"""
SELECT symbol, open_time, CAST(event_id AS VARCHAR) AS open, CAST(user_id AS VARCHAR) AS high FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, open_time ORDER BY src, event_id) AS rn
  FROM ({E_UNION}) u) WHERE rn = 1"""


@query("write_series", MERGED_TEXT_SQL)
def q_write_series(spark, sf_dir):
    root = shared_dir(spark, "series")
    ex = tag(_as_store(events_existing(spark, sf_dir)), 0, row=F.col("event_id"))
    stored = merge_first_wins(None, ex, SERIES, "open_time").drop("event_id")
    write_series(stored, root, SERIES, "open_time")
    nw = tag(_as_store(events_new(spark, sf_dir)), 1, row=F.col("event_id")).drop("event_id")
    current = scan_series(spark, root, STORE_SCHEMA)
    touched = join_null_safe(current, nw.select(*SERIES).distinct(), SERIES, "left_semi")
    merged = merge_first_wins(touched, nw, SERIES, "open_time")
    write_series(merged, root, SERIES, "open_time")
    return scan_series(spark, root, STORE_SCHEMA).select("symbol", "open_time", "open", "high")


@query("write_index", """
WITH o AS (SELECT CAST(l_suppkey AS VARCHAR) AS s, max(l_shipdate) AS m FROM lineitem
           WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1),
n AS (SELECT CAST(l_suppkey AS VARCHAR) AS s, max(l_shipdate) AS m FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1)
SELECT coalesce(n.s, o.s) || '/' || coalesce(n.s, o.s) || '_1d.parquet' AS path, coalesce(n.m, o.m) AS last_ts,
       strftime(coalesce(n.m, o.m), '%Y-%m-%d %H:%M:%S') AS last_text
FROM o FULL OUTER JOIN n ON o.s = n.s""")
def q_write_index(spark, sf_dir):
    root = shared_dir(spark, "index")
    write_index(_l_index(spark, sf_dir, F.col("ts") < lit_ts("2000-01-01")).select("path", "last_ts"), root)
    stored = read_table(spark, root).select("path", "last_ts")
    new = _l_index(spark, sf_dir, F.col("ts") >= lit_ts("2000-01-01")).select("path", "last_ts")
    write_index(overlay_index(stored, new), root)
    return read_table(spark, root)


@query("write_info", P_SQL + LAST + flat_rows("l"))
def q_write_info(spark, sf_dir):
    root = shared_dir(spark, "info_table")
    info = _last_raw(spark, sf_dir).select("symbol", flatten_symbol_info("raw").alias("info"))
    write_info(info, root)
    return explode_info(read_table(spark, root))


@query("write_run_summary", f"""
SELECT 'r1' AS run_id, * FROM ({TOTALS_SQL}) UNION ALL SELECT 'r2', * FROM ({TOTALS_SQL})""")
def q_write_run_summary(spark, sf_dir):
    root = shared_dir(spark, "runs")
    outcomes = orders_outcomes(spark, sf_dir)
    for run in ("r1", "r2"):
        write_run_summary(run_totals(outcomes), run_by_symbol(outcomes), root, run, lit_ts(NOW))
    return spark.read.parquet(f"{root}/runs").drop("run_at")


@query("write_run_symbols", f"SELECT 'r1' AS run_id, * FROM ({by_symbol_sql(ERR)})")
def q_write_run_symbols(spark, sf_dir):
    root = shared_dir(spark, "runs")
    outcomes = orders_outcomes(spark, sf_dir)
    write_run_summary(run_totals(outcomes), run_by_symbol(outcomes), root, "r1", lit_ts(NOW))
    stored = spark.read.parquet(f"{root}/run_symbols")
    return by_symbol_rows(stored).withColumn("run_id", F.lit("r1")).join(stored.select("symbol", "run_id"), ["symbol", "run_id"], "left_semi")


META_SQL = """
SELECT c_name AS symbol, 'listing_date' AS key,
       CASE WHEN c_nationkey % 5 <> 0 THEN '20' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-01' END AS value
FROM customer UNION ALL SELECT c_name, 'note', '"' || c_mktsegment || '"' FROM customer"""


@query("write_meta", META_SQL)
def q_write_meta(spark, sf_dir):
    """SNK-3 / SRC-10: listing metadata written as sorted JSON and read back."""
    c = table(spark, sf_dir, "customer")
    date = F.when(F.col("c_nationkey") % 5 != 0, F.concat(F.lit("20"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-01")))
    info = F.create_map(F.lit("listing_date"), date, F.lit("note"), F.concat(F.lit('"'), "c_mktsegment", F.lit('"')))
    root = shared_dir(spark, "meta")
    write_meta(c.select(F.col("c_name").alias("symbol"), info.alias("info")), root)
    return explode_info(scan_meta(spark, root))


@query("write_snapshot", f"""
SELECT 's1' AS snapshot_id, TIMESTAMP '{NOW}' AS fetched_at, s_name AS symbol FROM supplier""")
def q_write_snapshot(spark, sf_dir):
    root = shared_dir(spark, "snapshots")
    syms = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol"))
    write_snapshot(syms, root, "s1", lit_ts(NOW))
    return spark.read.parquet(root).select("snapshot_id", "fetched_at", "symbol")


@query("merge_text_store", MERGED_TEXT_SQL)
def q_merge_text_store(spark, sf_dir):
    """A store half of whose series older writers left with text times: their rows win too."""
    root = shared_dir(spark, "series")
    ex = tag(_as_store(events_existing(spark, sf_dir)), 0, row=F.col("event_id"))
    stored = merge_first_wins(None, ex, SERIES, "open_time").drop("event_id")
    old = F.col("symbol").isin("click", "signup")
    write_series(stored.where(~old), root, SERIES, "open_time")
    text = stored.where(old).withColumn("open_time", F.date_format("open_time", "yyyy-MM-dd HH:mm:ss"))
    text.write.mode("append").partitionBy(*SERIES).parquet(root)
    nw = tag(_as_store(events_new(spark, sf_dir)), 1, row=F.col("event_id")).drop("event_id")
    current = scan_series(spark, root, STORE_SCHEMA, legacy=True)
    return merge_first_wins(current, nw, SERIES, "open_time").select("symbol", "open_time", "open", "high")
