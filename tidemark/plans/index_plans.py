"""Index and staleness queries on L and on an E file tree."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import index_text, index_time
from tidemark.operators.calendar import first_pending
from tidemark.operators.index import (
    bootstrap_index, latest_time, needs_update, overlay_index, pending, rebuild_index, symbols_of,
)
from tidemark.operators.universe import build_jobs
from tidemark.plans.catalog import query
from tidemark.plans.sqlgen import job_values
from tidemark.plans.surrogates import (
    END, lineitem_series, lit_date, lit_ts, supplier_path, table, write_event_tree,
)
from tidemark.registry import KINDS_BY_NAME
from tidemark.session import shared_dir
from tidemark.sources.metadata import scan_index
from tidemark.sources.series import audit_summary, scan_audit, scan_tree

L_MAX = "SELECT CAST(l_suppkey AS VARCHAR) AS symbol, max(l_shipdate) AS last_ts FROM lineitem"


def _l_index(spark, sf_dir, cond=None):
    li = lineitem_series(spark, sf_dir)
    if cond is not None:
        li = li.where(cond)
    return latest_time(li, ["symbol"], "ts").withColumn("path", supplier_path())


@query("latest_time", f"{L_MAX} GROUP BY 1")
def q_latest_time(spark, sf_dir):
    return latest_time(lineitem_series(spark, sf_dir), ["symbol"], "ts")


@query("index_value", f"""
SELECT symbol, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_text, last_ts AS parsed_ts
FROM ({L_MAX} GROUP BY 1)""")
def q_index_value(spark, sf_dir):
    idx = latest_time(lineitem_series(spark, sf_dir), ["symbol"], "ts")
    t = idx.select("symbol", index_text("last_ts").alias("last_text"))
    return t.withColumn("parsed_ts", index_time("last_text"))


@query("scan_index", """
SELECT CAST(l_suppkey AS VARCHAR) || '/' || CAST(l_suppkey AS VARCHAR) || '_1d.parquet' AS path,
       strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_text, max(l_shipdate) AS last_ts
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE s_nationkey NOT IN (7, 8) GROUP BY l_suppkey""")
def q_scan_index(spark, sf_dir):
    idx = _l_index(spark, sf_dir)
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"), "s_nationkey")
    j = idx.join(sup, "symbol")
    # nation 7: an entry whose time is not a time; nation 8: a line that is not JSON
    value = (F.when(F.col("s_nationkey") == 8, F.concat(F.lit('{"'), F.col("path"), F.lit('": ')))
             .otherwise(F.to_json(F.create_map("path", F.when(F.col("s_nationkey") == 7, F.lit("not-a-time"))
                                               .otherwise(index_text("last_ts"))))))
    out = shared_dir(spark, "index_lines")
    j.select(value.alias("value")).write.text(out)
    return scan_index(spark, out, layout="lines")


TREE_SQL = """
WITH r AS (
  SELECT upper(event_type) || CAST(user_id AS VARCHAR) AS symbol, event_type, ts,
         CASE WHEN value < 10 THEN 'klines' WHEN value < 30 THEN 'metrics' ELSE 'fundingRate' END AS kind
  FROM events),
f AS (
  SELECT symbol || '/' || symbol || CASE WHEN kind = 'klines' THEN '_1h' ELSE '_' || kind END || '.parquet' AS path,
         symbol, kind, 'nested' AS layout, 'parquet' AS format, max(ts) AS last_ts
  FROM r WHERE event_type <> 'error' GROUP BY ALL
  UNION ALL
  SELECT symbol || CASE WHEN kind = 'klines' THEN '_1h' ELSE '_' || kind END || '.csv',
         symbol, kind, 'flat', 'csv', max(ts)
  FROM r WHERE event_type IN ('error', 'purchase') GROUP BY ALL)"""


@query("rebuild_index", TREE_SQL + """
SELECT path, symbol, kind, CASE WHEN kind = 'klines' THEN '1h' END AS interval, layout, format, last_ts FROM f""")
def q_rebuild_index(spark, sf_dir):
    root = write_event_tree(spark, sf_dir)
    return rebuild_index(scan_tree(spark, root)).select(
        "path", "symbol", "kind", "interval", "layout", "format", "last_ts")


@query("bootstrap_index", TREE_SQL + """,
c AS (SELECT symbol || '/' || symbol || CASE WHEN kind = 'klines' THEN '_1h' ELSE '_' || kind END || '.parquet' AS path,
             layout, last_ts FROM f)
SELECT path, coalesce(max(CASE WHEN layout = 'nested' THEN last_ts END),
                      max(CASE WHEN layout = 'flat' THEN last_ts END)) AS last_ts
FROM c GROUP BY path""")
def q_bootstrap_index(spark, sf_dir):
    root = write_event_tree(spark, sf_dir)
    tree = rebuild_index(scan_tree(spark, root))
    e = table(spark, sf_dir, "events")
    symbols = e.select(F.concat(F.upper("event_type"), F.col("user_id").cast("string")).alias("symbol")).distinct()
    kinds = [KINDS_BY_NAME[n] for n in ("klines", "metrics", "fundingRate")]
    jobs = build_jobs(symbols, kinds=kinds, intervals=("1h",))
    return bootstrap_index(jobs, tree)


def broken_tree(spark, sf_dir):
    """The event tree with files that are broken, empty or without a time column beside it, one
    of each per event type."""
    from tidemark.plans.surrogates import _once, _write_event_tree
    from tidemark.sinks.tables import write_files

    def make():
        root = _write_event_tree(spark, sf_dir)
        types = table(spark, sf_dir, "events").select("event_type").distinct()
        named = lambda what, content: types.select(
            F.concat(F.lit(what), F.col("event_type"), F.lit(f"/{what}_1d.parquet")).alias("path"), F.lit(content).alias("content"))
        write_files(named("BROKEN", "not parquet").unionByName(named("EMPTY", "")), root)
        for r in range(2):  # Parquet folders of one file each
            types.coalesce(1).write.parquet(f"{root}/NOTIME{r}/NOTIME{r}_1d.parquet")
        return root
    return _once(spark, ("broken_tree", sf_dir), make)


AUDIT_SQL = TREE_SQL + """,
a AS (
  SELECT path, 'indexable' AS status FROM f WHERE format = 'parquet'
  UNION ALL SELECT 'BROKEN' || event_type || '/BROKEN_1d.parquet', 'unreadable' FROM (SELECT DISTINCT event_type FROM events)
  UNION ALL SELECT 'EMPTY' || event_type || '/EMPTY_1d.parquet', 'empty' FROM (SELECT DISTINCT event_type FROM events)
  UNION ALL SELECT 'NOTIME' || i || '/NOTIME' || i || '_1d.parquet', 'no time column' FROM range(2) t(i)),
n AS (SELECT symbol || '/' || symbol || CASE WHEN kind = 'klines' THEN '_1h' ELSE '_' || kind END || '.parquet' AS path, count(*) AS n
      FROM r WHERE event_type <> 'error' GROUP BY ALL)"""


@query("scan_audit", AUDIT_SQL + """
SELECT a.path, CASE status WHEN 'indexable' THEN n.n WHEN 'empty' THEN 0
                WHEN 'no time column' THEN (SELECT count(DISTINCT event_type) FROM events) END::BIGINT AS rows,
       status = 'indexable' AS has_time_col, status FROM a LEFT JOIN n ON a.path = n.path""")
def q_scan_audit(spark, sf_dir):
    found = scan_audit(spark, broken_tree(spark, sf_dir))
    # Spark names the one file of a folder itself
    return found.select(F.regexp_replace("path", "/part-[^/]*$", "").alias("path"), "rows", "has_time_col", "status")


@query("audit_summary", AUDIT_SQL + """
SELECT count(*) AS scanned, count(*) FILTER (status = 'indexable') AS indexable, count(*) FILTER (status = 'no time column') AS no_time_column,
       count(*) FILTER (status = 'empty') AS empty, count(*) FILTER (status = 'unreadable') AS unreadable FROM a""")
def q_audit_summary(spark, sf_dir):
    return audit_summary(scan_audit(spark, broken_tree(spark, sf_dir)))


@query("rebuild_index_mixed", TREE_SQL + """
SELECT path, symbol, kind, CASE WHEN kind = 'klines' THEN '1h' END AS interval, layout, format, last_ts, false AS unreadable FROM f
UNION ALL SELECT 'BROKEN' || event_type || '/BROKEN_1d.parquet', 'BROKEN' || event_type, 'klines', '1d', 'nested', 'parquet', NULL, true
FROM (SELECT DISTINCT event_type FROM events)""")
def q_rebuild_index_mixed(spark, sf_dir):
    """Typed and text times side by side, broken files reported instead of lost."""
    from tidemark.functions.paths import parse_series_path

    tree = scan_tree(spark, broken_tree(spark, sf_dir))
    cols = ["path", "symbol", "kind", "interval", "layout", "format"]
    good = rebuild_index(tree).select(*cols, "last_ts", F.lit(False).alias("unreadable"))
    bad = parse_series_path(tree.where(F.col("error").isNotNull()), "path")
    return good.unionByName(bad.select(*cols, F.lit(None).cast("timestamp_ntz").alias("last_ts"), F.lit(True).alias("unreadable")))


@query("rebuild_index_scoped", TREE_SQL + """
SELECT path, symbol, last_ts FROM f WHERE symbol IN (SELECT upper(event_type) || CAST(user_id AS VARCHAR) FROM events ORDER BY event_id LIMIT 3)""")
def q_rebuild_index_scoped(spark, sf_dir):
    """Only the symbols asked for (a short list given by whoever runs the rebuild)."""
    first = table(spark, sf_dir, "events").orderBy("event_id").limit(3)
    symbols = [r.s for r in first.select(F.concat(F.upper("event_type"), F.col("user_id").cast("string")).alias("s")).collect()]
    return rebuild_index(scan_tree(spark, write_event_tree(spark, sf_dir), symbols), symbols=symbols).select("path", "symbol", "last_ts")


@query("overlay_index", """
WITH o AS (SELECT CAST(l_suppkey AS VARCHAR) AS s, max(l_shipdate) AS m FROM lineitem
           WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1),
n AS (SELECT CAST(l_suppkey AS VARCHAR) AS s, max(l_shipdate) AS m FROM lineitem
      WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1)
SELECT coalesce(n.s, o.s) || '/' || coalesce(n.s, o.s) || '_1d.parquet' AS path, coalesce(n.m, o.m) AS last_ts
FROM o FULL OUTER JOIN n ON o.s = n.s""")
def q_overlay_index(spark, sf_dir):
    old = _l_index(spark, sf_dir, F.col("ts") < lit_ts("2000-01-01"))
    new = _l_index(spark, sf_dir, F.col("ts") >= lit_ts("2000-01-01"))
    return overlay_index(old, new)


STALE_SQL = f"""
WITH i AS (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, max(l_shipdate) AS last_ts FROM lineitem GROUP BY 1),
a AS (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, max(l_shipdate) AS actual_ts FROM lineitem
      WHERE l_returnflag <> 'R' GROUP BY 1)"""


@query("needs_update", STALE_SQL + f"""
SELECT i.symbol, last_ts, actual_ts,
  (last_ts IS NULL OR CAST(last_ts AS DATE) < DATE '{END}') AS stale_by_index,
  (last_ts IS NULL OR CAST(last_ts AS DATE) < DATE '{END}'
   OR NOT coalesce(CAST(actual_ts AS DATE) >= DATE '{END}', false)) AS stale
FROM i LEFT JOIN a USING (symbol)""")
def q_needs_update(spark, sf_dir):
    li = lineitem_series(spark, sf_dir)
    idx = latest_time(li, ["symbol"], "ts")
    act = latest_time(li.where(F.col("l_returnflag") != "R"), ["symbol"], "ts", "actual_ts")
    j = idx.join(act, "symbol", "left")
    end = lit_date(END)
    return j.select("symbol", "last_ts", "actual_ts",
                    needs_update("last_ts", end).alias("stale_by_index"),
                    needs_update("last_ts", end, "actual_ts").alias("stale"))


def _supplier_jobs(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"))
    return build_jobs(sup, kinds=[KINDS_BY_NAME["klines"]], intervals=("1d",))


@query("pending", STALE_SQL + f"""
SELECT CAST(s_suppkey AS VARCHAR) || '/' || CAST(s_suppkey AS VARCHAR) || '_1d.parquet' AS path,
       CAST(s_suppkey AS VARCHAR) AS symbol, 'klines' AS kind, '1d' AS interval, last_ts
FROM supplier LEFT JOIN i ON i.symbol = CAST(s_suppkey AS VARCHAR) LEFT JOIN a ON a.symbol = CAST(s_suppkey AS VARCHAR)
WHERE last_ts IS NULL OR CAST(last_ts AS DATE) < DATE '{END}'
   OR NOT coalesce(CAST(actual_ts AS DATE) >= DATE '{END}', false)""")
def q_pending(spark, sf_dir):
    li = lineitem_series(spark, sf_dir)
    idx = latest_time(li, ["symbol"], "ts").withColumn("path", supplier_path()).drop("symbol")
    act = (latest_time(li.where(F.col("l_returnflag") != "R"), ["symbol"], "ts", "actual_ts")
           .withColumn("path", supplier_path()).drop("symbol"))
    return pending(_supplier_jobs(spark, sf_dir), idx, lit_date(END), act)


@query("force_full", """
SELECT CAST(s_suppkey AS VARCHAR) || '/' || CAST(s_suppkey AS VARCHAR) || '_1d.parquet' AS path,
       CAST(s_suppkey AS VARCHAR) AS symbol, 'klines' AS kind, '1d' AS interval, CAST(NULL AS TIMESTAMP) AS last_ts
FROM supplier""")
def q_force_full(spark, sf_dir):
    idx = _l_index(spark, sf_dir).drop("symbol")
    return pending(_supplier_jobs(spark, sf_dir), idx, lit_date(END), force_full=True)


@query("first_pending", f"""
WITH i AS (SELECT CAST(l_suppkey AS VARCHAR) || '/' || CAST(l_suppkey AS VARCHAR) || '_1d.parquet' AS path,
                  max(l_shipdate) AS last_ts FROM lineitem GROUP BY l_suppkey),
jobs AS (SELECT CAST(s_suppkey AS VARCHAR) AS symbol, kind, interval,
                CAST(s_suppkey AS VARCHAR) || '/' || CAST(s_suppkey AS VARCHAR) || tail || '.parquet' AS path
         FROM supplier, {job_values()})
SELECT symbol, kind, interval, jobs.path, last_ts FROM jobs LEFT JOIN i ON i.path = jobs.path
WHERE last_ts IS NULL OR CAST(last_ts AS DATE) < DATE '{END}'
ORDER BY symbol, kind, interval NULLS FIRST LIMIT 100""")
def q_first_pending(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"))
    jobs = build_jobs(sup)
    idx = _l_index(spark, sf_dir).drop("symbol")
    return first_pending(pending(jobs, idx, lit_date(END)), 100).select("symbol", "kind", "interval", "path", "last_ts")


@query("symbols_of", "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS symbol FROM lineitem")
def q_symbols_of(spark, sf_dir):
    return symbols_of(_l_index(spark, sf_dir).select("path", "last_ts"))
