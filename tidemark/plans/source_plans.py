"""Source and projection queries on E and D: dumps, zipped dumps, JSON pages, series
tables, time parsing, column names, text checks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import canonical_columns
from tidemark.functions.text import has_non_ascii, is_valid_text, repair_text
from tidemark.functions.times import harmonize, normalize_times
from tidemark.operators.merge import PERIOD, ROW, SOURCE
from tidemark.plans.catalog import query
from tidemark.plans.surrogates import (
    EXISTING_BEFORE, NEW_FROM, events_series, hour, lit_ts, ms_text, table, write_event_dumps,
)
from tidemark.registry import KINDS_BY_NAME, SPACED_KLINE_HEADERS
from tidemark.session import shared_dir
from tidemark.sinks.tables import write_series
from tidemark.sources.dumps import land_zip_dumps, scan_dump, scan_kline_json
from tidemark.sources.series import load_subset, scan_series, scan_series_any

KLINES = KINDS_BY_NAME["klines"]


@query("normalize_times", """
SELECT event_id,
  CASE WHEN event_id % 97 = 0 THEN NULL
       WHEN event_id % 5 = 1 THEN make_timestamp((epoch_us(ts) // 1000) * 1000 + 500)
       ELSE make_timestamp((epoch_us(ts) // 1000) * 1000) END AS open_time,
  CASE WHEN event_id % 89 = 0 THEN date_trunc('day', ts) ELSE ts END AS create_time
FROM events""")
def q_normalize_times(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    ms = ms_text("ts")
    raw = e.select(
        "event_id",
        F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("bad"), ms))
         .when(F.col("event_id") % 5 == 1, F.concat(F.lit(" "), ms, F.lit(".5 ")))
         .otherwise(ms).alias("open_time"),
        F.when(F.col("event_id") % 89 == 0, F.date_format("ts", "yyyy-MM-dd"))
         .otherwise(F.col("ts").cast("string")).alias("create_time"),
    )
    return normalize_times(raw, ms_cols=["open_time"], text_cols=["create_time"])


@query("harmonize_times", f"""
SELECT event_id, 0 AS part, ts AS open_time FROM events WHERE ts < TIMESTAMP '{EXISTING_BEFORE}'
UNION ALL
SELECT event_id, 1, ts FROM events WHERE ts >= TIMESTAMP '{NEW_FROM}'""")
def q_harmonize_times(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    stored = e.where(F.col("ts") < lit_ts(EXISTING_BEFORE)).select("event_id", F.lit(0).alias("part"),
                                                                     F.col("ts").alias("open_time"))
    landed = e.where(F.col("ts") >= lit_ts(NEW_FROM)).select("event_id", F.lit(1).alias("part"),
                                                               F.col("ts").cast("string").alias("open_time"))
    return harmonize(stored).unionByName(harmonize(landed))


DUMP_SQL = """
SELECT event_type AS symbol, 'klines' AS kind, '1h' AS interval,
       make_timestamp(epoch_ms(date_trunc('hour', ts)) * 1000) AS open_time,
       CAST(event_id AS VARCHAR) AS open, CAST(user_id AS VARCHAR) AS high, props AS close,
       CAST(NULL AS VARCHAR) AS volume, 2 AS _source, CAST(ts AS DATE) AS _period
FROM events"""

DUMP_COLS = ["symbol", "kind", "interval", "open_time", "open", "high", "close", "volume", SOURCE, PERIOD]


@query("scan_dump", DUMP_SQL)
def q_scan_dump(spark, sf_dir):
    root = write_event_dumps(spark, sf_dir)
    return scan_dump(spark, root, KLINES).select(*DUMP_COLS)


@query("land_zip_dumps", DUMP_SQL)
def q_land_zip_dumps(spark, sf_dir):
    root = write_event_dumps(spark, sf_dir, zipped=True)
    return land_zip_dumps(spark, root, KLINES).select(*DUMP_COLS)


@query("scan_kline_json", """
SELECT event_type AS symbol, CAST(ts AS DATE) AS day, make_timestamp(epoch_ms(date_trunc('hour', ts)) * 1000) AS open_time,
       CAST(event_id AS VARCHAR) AS open, CAST(user_id AS VARCHAR) AS high,
       event_id // 1000 AS page,
       CAST(row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), event_id // 1000 ORDER BY event_id) - 1 AS BIGINT) AS _row
FROM events""")
def q_scan_kline_json(spark, sf_dir):
    e = events_series(spark, sf_dir)
    cells = F.array(ms_text("open_time"), F.col("event_id").cast("string"), F.col("user_id").cast("string"))
    # REST pages of at most 1000 arrays per (symbol, day), arrays in event order
    page = F.floor(F.col("event_id") / 1000).cast("long").alias("page")
    pages = (e.groupBy("symbol", F.to_date("ts").alias("day"), page)
             .agg(F.array_sort(F.collect_list(F.struct("event_id", cells.alias("a")))).alias("r"))
             .select("symbol", "day", "page", F.to_json(F.transform("r", lambda x: x["a"])).alias("payload")))
    rows = scan_kline_json(pages, "payload", KLINES)
    return rows.select("symbol", "day", "page", "open_time", "open", "high", F.col(ROW).cast("long").alias(ROW))


def _store_events(spark, sf_dir, where=None):
    e = events_series(spark, sf_dir)
    if where is not None:
        e = e.where(where)
    rows = e.select(F.lit("klines").alias("kind"), F.lit("1h").alias("interval"), "symbol",
                    F.col("ts").alias("open_time"), F.col("event_id").cast("string").alias("open"),
                    F.col("user_id").cast("string").alias("high"))
    root = shared_dir(spark, "store")
    write_series(rows, root, ["kind", "interval", "symbol"], "open_time")
    return root


STORE_SCHEMA = T.StructType([
    T.StructField("open_time", T.TimestampNTZType()), T.StructField("open", T.StringType()),
    T.StructField("high", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("interval", T.StringType()), T.StructField("symbol", T.StringType()),
])


@query("scan_series", """
SELECT event_type AS symbol, '1h' AS interval, ts AS open_time, CAST(event_id AS VARCHAR) AS open FROM events""")
def q_scan_series(spark, sf_dir):
    root = _store_events(spark, sf_dir)
    return scan_series(spark, root, STORE_SCHEMA, ["symbol", "interval", "open_time", "open"])


@query("load_subset", """
SELECT event_type AS symbol, ts AS open_time, CAST(event_id AS VARCHAR) AS open FROM events
WHERE event_type IN ('click', 'view')""")
def q_load_subset(spark, sf_dir):
    df = scan_series(spark, _store_events(spark, sf_dir), STORE_SCHEMA)
    return load_subset(df, symbols=["click", "view"], intervals=["1h"]).select("symbol", "open_time", "open")


@query("scan_series_any", """
SELECT event_type AS symbol, ts AS open_time, CAST(event_id AS VARCHAR) AS open FROM events
WHERE event_type IN ('click', 'view', 'purchase')
UNION ALL
SELECT event_type, ts, CAST(event_id AS VARCHAR) FROM events WHERE event_type IN ('error', 'signup')""")
def q_scan_series_any(spark, sf_dir):
    e = events_series(spark, sf_dir)
    pq_root = _store_events(spark, sf_dir, F.col("symbol").isin("click", "view", "purchase"))
    # CSV twins: error and signup only there; purchase also, but with other content
    csv_rows = e.where(F.col("symbol").isin("error", "signup", "purchase")).select(
        F.lit("klines").alias("kind"), F.lit("1h").alias("interval"), "symbol",
        F.col("ts").alias("open_time"),
        F.when(F.col("symbol") == "purchase", F.lit("stale-csv-copy")).otherwise(F.col("event_id").cast("string")).alias("open"),
        F.col("user_id").cast("string").alias("high"))
    csv_root = shared_dir(spark, "store_csv")
    (csv_rows.write.partitionBy("kind", "interval", "symbol").option("header", "true")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(csv_root))
    df = scan_series_any(spark, pq_root, csv_root, ["kind", "interval", "symbol"], STORE_SCHEMA)
    return harmonize(df).select("symbol", "open_time", "open")


@query("canonical_columns", """
SELECT ts AS open_time, CAST(event_id AS VARCHAR) AS open, CAST(user_id AS VARCHAR) AS count,
       date_trunc('hour', ts) AS close_time, event_type AS "ignore" FROM events""")
def q_canonical_columns(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    spaced = e.select(F.col("ts").alias(SPACED_KLINE_HEADERS[0]), F.col("event_id").cast("string").alias("open"),
                      F.col("user_id").cast("string").alias(SPACED_KLINE_HEADERS[8]),
                      hour().alias(SPACED_KLINE_HEADERS[6]), F.col("event_type").alias(SPACED_KLINE_HEADERS[11]))
    return canonical_columns(spaced)


TAIL_SQL = """
SELECT doc_id, lang, text, CASE doc_id % 4 WHEN 0 THEN 'FF41' WHEN 1 THEN 'C3A9' WHEN 2 THEN '80' ELSE '41' END AS tail,
       CASE doc_id % 4 WHEN 0 THEN chr(65533) || 'A' WHEN 1 THEN 'é' WHEN 2 THEN chr(65533) ELSE 'A' END AS repaired FROM documents"""


def with_tail(spark, sf_dir):
    """Whole texts, each with bytes after it that are not valid for two ids of four."""
    k = F.col("doc_id") % 4
    tail = F.when(k == 0, "FF41").when(k == 1, "C3A9").when(k == 2, "80").otherwise("41")
    raw = F.concat(F.encode("text", "UTF-8"), F.unhex(tail)).cast("string")
    return table(spark, sf_dir, "documents").select("doc_id", "lang", raw.alias("raw"))


@query("repair_text", f"""
SELECT doc_id, CAST(length(text || repaired) AS BIGINT) AS n_chars, right(text || repaired, 2) AS ends, tail IN ('FF41', '80') AS changed
FROM ({TAIL_SQL})""")
def q_repair_text(spark, sf_dir):
    d = with_tail(spark, sf_dir).withColumn("fixed", repair_text("raw"))
    return d.select("doc_id", F.length("fixed").cast("long").alias("n_chars"), F.right("fixed", F.lit(2)).alias("ends"),
                    (F.col("fixed").cast("binary") != F.col("raw").cast("binary")).alias("changed"))


@query("non_ascii", f"""
SELECT doc_id, lang, tail NOT IN ('FF41', '80') AS valid FROM ({TAIL_SQL}) WHERE regexp_matches(text || repaired, '[^\\x00-\\x7F]')""")
def q_non_ascii(spark, sf_dir):
    d = with_tail(spark, sf_dir)
    return d.where(has_non_ascii("raw")).select("doc_id", "lang", is_valid_text("raw").alias("valid"))
