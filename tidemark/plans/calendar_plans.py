"""Calendar and gap-planning queries on L (series) and O (manifest), plus job/path queries."""

from pyspark.sql import functions as F

from tidemark.functions import calendar as C
from tidemark.functions.paths import parse_series_path
from tidemark.operators.calendar import daily_fallback, gap_plan, plan_periods
from tidemark.operators.index import latest_time
from tidemark.operators.universe import build_jobs, enabled_kinds
from tidemark.plans.catalog import query
from tidemark.plans.sqlgen import job_values, kind_values
from tidemark.plans.surrogates import END, lineitem_series, lit_date, orders_manifest, table
from tidemark.registry import KINDS_BY_NAME, kinds_df, time_column_of

SUP = "CAST(l_suppkey AS VARCHAR)"


def shifted(days: int, supplier: str = "l_suppkey") -> str:
    """Index time of a supplier: its last ship date less up to ``days`` days, by its key."""
    return f"max(l_shipdate) - to_days(CAST(({supplier} * 37) % {days} AS INTEGER))"


def _shifted_index(spark, sf_dir, days: int):
    """The same over all rows: every supplier is stale, by a time of its own."""
    idx = latest_time(lineitem_series(spark, sf_dir), ["symbol"], "ts")
    back = (F.col("symbol").cast("long") * 37 % days).cast("int")
    return idx.withColumn("last_ts", F.timestamp_add("DAY", -back, F.col("last_ts")))


def _minmax(spark, sf_dir):
    li = lineitem_series(spark, sf_dir)
    return li.groupBy("symbol").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))


@query("months", f"""
SELECT symbol, CAST(unnest(range(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM (
  SELECT {SUP} AS symbol, date_trunc('month', min(l_shipdate)) AS a, date_trunc('month', max(l_shipdate)) AS b
  FROM lineitem GROUP BY 1)""")
def q_months(spark, sf_dir):
    return _minmax(spark, sf_dir).select("symbol", F.explode(C.months("a", "b")).alias("month"))


@query("days_in_month", f"""
SELECT symbol, CAST(unnest(range(date_trunc('month', b), least(last_day(b), CAST(b AS DATE))::TIMESTAMP + INTERVAL 1 DAY,
                                 INTERVAL 1 DAY)) AS DATE) AS day
FROM (SELECT {SUP} AS symbol, max(l_shipdate) AS b FROM lineitem GROUP BY 1)""")
def q_days_in_month(spark, sf_dir):
    return _minmax(spark, sf_dir).select(
        "symbol", F.explode(C.days_in_month(F.to_date("b"), F.to_date("b"))).alias("day"))


@query("months_before", f"""
SELECT symbol, CAST(date_trunc('month', a) AS DATE) AS month,
       CAST((2001 - year(a)) * 12 + (10 - month(a)) AS BIGINT) AS months_before
FROM (SELECT {SUP} AS symbol, min(l_shipdate) AS a FROM lineitem GROUP BY 1)""")
def q_months_before(spark, sf_dir):
    m = _minmax(spark, sf_dir).select("symbol", C.month_of(F.to_date("a")).alias("month"))
    return m.withColumn("months_before", C.months_before(F.col("month"), lit_date(END)).cast("long"))


@query("default_end", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1 AS end_date FROM orders""")
def q_default_end(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", C.default_end(F.col("o_orderdate")).alias("end_date"))


@query("spot_range", f"""
WITH i AS (SELECT l_suppkey, CASE WHEN l_suppkey % 3 > 0 THEN {shifted(2000)} END AS last_ts FROM lineitem GROUP BY 1)
SELECT CAST(s_suppkey AS VARCHAR) AS symbol, coalesce(CAST(last_ts AS DATE), DATE '2017-01-01') AS start_date,
       DATE '{END}' AS end_date
FROM supplier LEFT JOIN i ON i.l_suppkey = s_suppkey""")
def q_spot_range(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier")
    idx = _shifted_index(spark, sf_dir, 2000)  # a third of the suppliers have no time yet
    idx = idx.withColumn("last_ts", F.when(F.col("symbol").cast("long") % 3 > 0, F.col("last_ts")))
    jobs = sup.select(F.col("s_suppkey").cast("string").alias("symbol")).join(idx, "symbol", "left")
    return jobs.select("symbol", C.spot_range_start("last_ts").alias("start_date"), lit_date(END).alias("end_date"))


ENUM_SQL = f"""
WITH s AS (SELECT {SUP} AS symbol, CAST({shifted(700)} AS DATE) AS st FROM lineitem GROUP BY l_suppkey)
SELECT symbol, 'klines' AS kind, 'monthly' AS freq,
       CAST(unnest(range(date_trunc('month', st)::TIMESTAMP, TIMESTAMP '2001-10-01', INTERVAL 1 MONTH)) AS DATE) AS period
FROM s WHERE st <= DATE '{END}'
UNION ALL
SELECT symbol, 'klines', 'daily',
       CAST(unnest(range(greatest(st, DATE '2001-10-01')::TIMESTAMP, TIMESTAMP '2001-10-26', INTERVAL 1 DAY)) AS DATE)
FROM s WHERE st <= DATE '{END}'
UNION ALL
SELECT symbol, 'metrics', 'daily', CAST(unnest(range(st::TIMESTAMP, TIMESTAMP '2001-10-26', INTERVAL 1 DAY)) AS DATE)
FROM s WHERE st <= DATE '{END}'
UNION ALL
SELECT symbol, 'fundingRate', 'monthly',
       CAST(unnest(range(date_trunc('month', st)::TIMESTAMP, TIMESTAMP '2001-11-01', INTERVAL 1 MONTH)) AS DATE)
FROM s WHERE st <= DATE '{END}'"""


@query("enumerate_periods", ENUM_SQL)
def q_enumerate_periods(spark, sf_dir):
    idx = _shifted_index(spark, sf_dir, 700)
    kinds = [KINDS_BY_NAME[n] for n in ("klines", "metrics", "fundingRate")]
    jobs = build_jobs(idx.select("symbol"), kinds=kinds, intervals=("1d",)).join(idx, "symbol")
    return plan_periods(jobs, lit_date(END)).select("symbol", "kind", "freq", "period")


FALLBACK_SQL = f"""
WITH s AS (SELECT {SUP} AS symbol, CAST({shifted(400)} AS DATE) AS st FROM lineitem GROUP BY l_suppkey),
months AS (SELECT symbol, CAST(unnest(range(date_trunc('month', st)::TIMESTAMP, TIMESTAMP '2001-10-01',
                                             INTERVAL 1 MONTH)) AS DATE) AS period FROM s WHERE st <= DATE '{END}'),
days AS (SELECT symbol, CAST(unnest(range(greatest(st, DATE '2001-10-01')::TIMESTAMP, TIMESTAMP '2001-10-26',
                                          INTERVAL 1 DAY)) AS DATE) AS period FROM s WHERE st <= DATE '{END}'),
man AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS symbol, CAST(date_trunc('month', o_orderdate) AS DATE) AS period
        FROM orders),
missing AS (SELECT * FROM months m
            WHERE NOT EXISTS (SELECT 1 FROM man WHERE man.symbol = m.symbol AND man.period = m.period)
              AND (2001 * 12 + 10) - (year(period) * 12 + month(period)) BETWEEN 0 AND 2),
fb AS (SELECT symbol, CAST(unnest(range(period::TIMESTAMP,
                                        least(last_day(period), DATE '{END}')::TIMESTAMP + INTERVAL 1 DAY,
                                        INTERVAL 1 DAY)) AS DATE) AS period FROM missing),
dd AS (SELECT DISTINCT symbol, 'klines' AS kind, '1d' AS interval, 'daily' AS freq, period
       FROM (SELECT * FROM days UNION ALL SELECT * FROM fb))"""


def _fallback_inputs(spark, sf_dir):
    idx = _shifted_index(spark, sf_dir, 400)
    jobs = build_jobs(idx.select("symbol"), kinds=[KINDS_BY_NAME["klines"]], intervals=("1d",)).join(idx, "symbol")
    return jobs, orders_manifest(spark, sf_dir)


@query("daily_fallback", FALLBACK_SQL + "\nSELECT * FROM dd")
def q_daily_fallback(spark, sf_dir):
    jobs, manifest = _fallback_inputs(spark, sf_dir)
    plan = plan_periods(jobs, lit_date(END))
    return daily_fallback(plan, manifest, lit_date(END))


@query("gap_plan", FALLBACK_SQL + """
SELECT symbol, 'klines' AS kind, '1d' AS interval, 'monthly' AS freq, period,
       'monthly/klines/' || symbol || '/1d/' || symbol || '-1d-' || strftime(period, '%Y-%m') || '.zip' AS location
FROM months m WHERE EXISTS (SELECT 1 FROM man WHERE man.symbol = m.symbol AND man.period = m.period)
UNION ALL
SELECT symbol, kind, interval, freq, period,
       'daily/klines/' || symbol || '/1d/' || symbol || '-1d-' || strftime(period, '%Y-%m-%d') || '.zip'
FROM dd""")
def q_gap_plan(spark, sf_dir):
    jobs, manifest = _fallback_inputs(spark, sf_dir)
    return gap_plan(jobs, manifest, lit_date(END))


def _customer_symbols(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_name").alias("symbol"))


@query("build_jobs", f"""
SELECT c_name AS symbol, kind, interval, c_name || '/' || c_name || tail || '.parquet' AS path
FROM customer, {job_values()}""")
def q_build_jobs(spark, sf_dir):
    return build_jobs(_customer_symbols(spark, sf_dir))


@query("enabled_kinds", f"""
SELECT c_name AS symbol, kind, interval, c_name || '/' || c_name || tail || '.parquet' AS path
FROM customer, {job_values(skip=('metrics', 'premiumIndex'))}""")
def q_enabled_kinds(spark, sf_dir):
    toggles = {"metrics": False, "premiumIndex": False}
    on = enabled_kinds(kinds_df(spark), toggles).select("kind")
    return build_jobs(_customer_symbols(spark, sf_dir)).join(F.broadcast(on), "kind", "left_semi")  # a registry of six rows


@query("series_path", f"""
SELECT s_name AS symbol, kind, interval, s_name || '/' || s_name || tail || '.parquet' AS path
FROM supplier, {job_values()}""")
def q_series_path(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol"))
    return build_jobs(sup)


@query("parse_series_path", f"""
SELECT s_name || '/' || s_name || tail || '.parquet' AS path, s_name AS symbol, kind, interval, 'nested' AS layout
FROM supplier, {job_values()}
UNION ALL
SELECT s_name || tail || '.csv', s_name, kind, interval, 'flat' FROM supplier, {job_values()}""")
def q_parse_series_path(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol"))
    jobs = build_jobs(sup)
    flat = jobs.select(F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"\.parquet$", ".csv").alias("path"))
    paths = jobs.select("path").unionByName(flat)
    return parse_series_path(paths, "path").select("path", "symbol", "kind", "interval", "layout")


@query("time_column", f"""
SELECT c_name AS symbol, j.kind, j.interval, k.time_col
FROM customer, {job_values()} JOIN {kind_values()} ON j.kind = k.kind""")
def q_time_column(spark, sf_dir):
    jobs = build_jobs(_customer_symbols(spark, sf_dir))
    return jobs.select("symbol", "kind", "interval", time_column_of(F.col("kind")).alias("time_col"))
