"""Run-report queries on O (order status as series outcome)."""

from pyspark.sql import functions as F

from tidemark.operators.report import catalog_card, run_by_symbol, run_totals
from tidemark.plans.catalog import query
from tidemark.plans.surrogates import orders_outcomes, table

ERR = "'order ' || o_orderkey || ' failed: ' || o_orderpriority || ' ' || repeat('x', CAST(o_orderkey % 300 AS INTEGER))"

TOTALS_SQL = """
SELECT CAST(count(*) AS BIGINT) AS pending,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS produced,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS failed,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS remaining,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS no_new_data,
       CAST(count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS symbols_updated,
       CAST(count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS symbols_failed
FROM orders"""


@query("run_totals", TOTALS_SQL)
def q_run_totals(spark, sf_dir):
    return run_totals(orders_outcomes(spark, sf_dir))


def by_symbol_sql(error: str) -> str:
    return f"""
SELECT CAST(o_custkey AS VARCHAR) AS symbol,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS updated,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS failed,
       coalesce(array_to_string(list_sort(list('O' || o_orderkey) FILTER (WHERE o_orderstatus = 'F')), ','), '') AS series,
       coalesce(array_to_string(list_sort(list({error}) FILTER (WHERE o_orderstatus = 'P')), '|'), '') AS errors
FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1"""


@query("run_by_symbol", by_symbol_sql(ERR))
def q_run_by_symbol(spark, sf_dir):
    return by_symbol_rows(run_by_symbol(orders_outcomes(spark, sf_dir)))


@query("run_by_symbol_short", by_symbol_sql(f"substr({ERR}, 1, 200)"))
def q_run_by_symbol_short(spark, sf_dir):
    """Errors cut as the source dataset's report cuts them."""
    return by_symbol_rows(run_by_symbol(orders_outcomes(spark, sf_dir), error_chars=200))


def by_symbol_rows(r):
    return r.select("symbol", "updated", "failed", F.array_join("series", ",").alias("series"),
                    F.array_join("errors", "|").alias("errors"))


@query("catalog_card", """
WITH s AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS symbol FROM orders),
r AS (SELECT symbol, row_number() OVER (ORDER BY symbol) AS rn FROM s),
n AS (SELECT count(*) AS n FROM s),
l AS (SELECT (rn - 1) // 5 AS line_no, string_agg('"' || symbol || '"', ', ' ORDER BY symbol) AS body FROM r GROUP BY 1)
SELECT CAST(line_no AS BIGINT) AS line_no, body || CASE WHEN line_no < (n - 1) // 5 THEN ',' ELSE '' END AS line,
       CAST(n AS BIGINT) AS n_symbols
FROM l, n""")
def q_catalog_card(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    syms = o.select(F.col("o_custkey").cast("string").alias("symbol"))
    return catalog_card(syms)
