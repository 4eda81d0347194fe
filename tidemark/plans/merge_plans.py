"""Merge queries on E: WIN-1, JOIN-9, AGG-6, SRT-1, SET-1, FLT-3."""

from pyspark.sql import functions as F

from tidemark.operators.merge import (
    concat_frames, drop_null_time, merge_first_wins, merge_report, new_rows_only, sort_series, tag,
)
from tidemark.plans.catalog import query
from tidemark.plans.surrogates import EXISTING_BEFORE, NEW_FROM, events_existing, events_new, lineitem_series

OUT = ["symbol", "open_time", "event_id", "user_id", "value"]

E_UNION = f"""
  SELECT event_type AS symbol, date_trunc('hour', ts) AS open_time, event_id, user_id, value, 0 AS src
  FROM events WHERE ts < TIMESTAMP '{EXISTING_BEFORE}'
  UNION ALL
  SELECT event_type, date_trunc('hour', ts), event_id, user_id, value, 1
  FROM events WHERE ts >= TIMESTAMP '{NEW_FROM}'"""

MERGED_SQL = f"""
SELECT symbol, open_time, event_id, user_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, open_time ORDER BY src, event_id) AS rn
  FROM ({E_UNION}) u) WHERE rn = 1"""


def merged_events(spark, sf_dir):
    ex = tag(events_existing(spark, sf_dir).drop("ts"), 0, row=F.col("event_id"))
    nw = tag(events_new(spark, sf_dir).drop("ts"), 1, row=F.col("event_id"))
    return merge_first_wins(ex, nw, ["symbol"], "open_time")


@query("merge_first_wins", MERGED_SQL)
def q_merge_first_wins(spark, sf_dir):
    return merged_events(spark, sf_dir).select(*OUT)


@query("new_rows_only", f"""
WITH ex AS (SELECT DISTINCT event_type AS symbol, date_trunc('hour', ts) AS open_time
            FROM events WHERE ts < TIMESTAMP '{EXISTING_BEFORE}'),
nw AS (SELECT * FROM (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS open_time, event_id, user_id, value,
         row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) AS rn
  FROM events WHERE ts >= TIMESTAMP '{NEW_FROM}') WHERE rn = 1)
SELECT symbol, open_time, event_id, user_id, value FROM nw
WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.symbol = nw.symbol AND ex.open_time = nw.open_time)""")
def q_new_rows_only(spark, sf_dir):
    stored = tag(events_existing(spark, sf_dir).drop("ts"), 0, row=F.col("event_id"))
    stored = merge_first_wins(None, stored, ["symbol"], "open_time")
    nw = tag(events_new(spark, sf_dir).drop("ts"), 1, row=F.col("event_id"))
    return new_rows_only(stored, nw, ["symbol"], "open_time").select(*OUT)


@query("merge_report", f"""
WITH m AS ({MERGED_SQL}),
post AS (SELECT symbol, count(*) AS after, CAST(max(open_time) AS DATE) AS last_date FROM m GROUP BY symbol),
nw AS (SELECT event_type AS symbol, count(*) AS fetched FROM events WHERE ts >= TIMESTAMP '{NEW_FROM}' GROUP BY 1),
ex AS (SELECT event_type AS symbol, count(*) AS before FROM events WHERE ts < TIMESTAMP '{EXISTING_BEFORE}' GROUP BY 1)
SELECT nw.symbol, CAST(fetched AS BIGINT) AS fetched, CAST(coalesce(before, 0) AS BIGINT) AS before,
       CAST(coalesce(after, 0) AS BIGINT) AS after,
       CAST(coalesce(after, 0) - coalesce(before, 0) AS BIGINT) AS delta, last_date
FROM nw LEFT JOIN post USING (symbol) LEFT JOIN ex USING (symbol)""")
def q_merge_report(spark, sf_dir):
    ex, nw = events_existing(spark, sf_dir), events_new(spark, sf_dir)
    merged = merged_events(spark, sf_dir)
    return merge_report(ex, nw, merged, ["symbol"], "open_time")


@query("concat_frames", f"""
SELECT event_type AS symbol, date_trunc('hour', ts) AS open_time, event_id, CAST(NULL AS BIGINT) AS user_id
FROM events WHERE ts < TIMESTAMP '{EXISTING_BEFORE}'
UNION ALL
SELECT event_type, date_trunc('hour', ts), event_id, user_id FROM events WHERE ts >= TIMESTAMP '{NEW_FROM}'""")
def q_concat_frames(spark, sf_dir):
    ex = events_existing(spark, sf_dir).select("symbol", "open_time", "event_id")
    nw = events_new(spark, sf_dir).select("symbol", "open_time", "event_id", "user_id")
    return concat_frames(ex, nw)


@query("drop_null_time", """
SELECT event_id, ts FROM events WHERE NOT (value > 45)""")
def q_drop_null_time(spark, sf_dir):
    from tidemark.plans.surrogates import table
    e = table(spark, sf_dir, "events")
    # rows whose time did not parse carry NULL; here: a time blanked where value > 45
    df = e.select("event_id", F.when(~(F.col("value") > 45), F.col("ts")).alias("ts"))
    return drop_null_time(df, "ts")


@query("sort_series", """
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS ts, l_orderkey, l_linenumber FROM lineitem
ORDER BY 1, 2, 3, 4""")
def q_sort_series(spark, sf_dir):
    li = lineitem_series(spark, sf_dir).select("symbol", "ts", "l_orderkey", "l_linenumber")
    return sort_series(li, ["symbol"], "ts")
