"""Structured Streaming queries: E's new part landed as daily dumps, streamed into a
store that already holds E's existing part.  The stored row wins and replays add
nothing, so the final store equals the batch first-wins merge (same oracle)."""

import uuid

from pyspark.sql import functions as F

from tidemark.operators.merge import merge_first_wins, tag
from tidemark.operators.report import run_totals
from tidemark.plans.catalog import query
from tidemark.plans.sink_plans import MERGED_TEXT_SQL
from tidemark.plans.surrogates import EXISTING_BEFORE, NEW_FROM, PART_ROWS
from tidemark.plans.surrogates import events_existing, events_new, write_event_dumps
from tidemark.registry import KINDS_BY_NAME, KLINE_COLUMNS
from tidemark.session import shared_dir
from tidemark.sinks.store import append_cells, compact_series, create_store, merge_bucketed, scan_cells, write_bucketed
from tidemark.sinks.tables import write_series
from tidemark.sources.dumps import scan_dump
from tidemark.sources.series import scan_series
from tidemark.streaming.ingest import SERIES, compact_index_log, read_index_log, store_schema, stream_ingest, upsert

KLINES = KINDS_BY_NAME["klines"]


def existing_rows(spark, sf_dir):
    """E existing, first row per key, with the columns of the store."""
    ex = events_existing(spark, sf_dir)
    rows = ex.select(F.lit("klines").alias("kind"), F.lit("1h").alias("interval"), "symbol", "open_time",
                     *[(F.col("event_id").cast("string") if c == "open" else
                        F.col("user_id").cast("string") if c == "high" else
                        F.lit(None).cast("timestamp_ntz") if c == "close_time" else
                        F.lit(None).cast("string")).alias(c) for c in KLINE_COLUMNS if c != "open_time"],
                     "event_id")
    return merge_first_wins(None, tag(rows, 0, row=F.col("event_id")), SERIES, "open_time").drop("event_id")


def prepare(spark, sf_dir, cells=False):
    """A store holding E existing (first row per key) and a landing folder of E new."""
    store = shared_dir(spark, "stream_store")
    if cells:
        create_store(spark, store, SERIES)
        append_cells(existing_rows(spark, sf_dir), store, SERIES, "open_time")
    else:
        write_series(existing_rows(spark, sf_dir), store, SERIES, "open_time")
    landing = write_event_dumps(spark, sf_dir, part=events_new(spark, sf_dir), part_name="new")
    return store, landing


def run(spark, sf_dir, max_files=None, runs=1):
    store, landing = prepare(spark, sf_dir)
    index = shared_dir(spark, "stream_index")
    for _ in range(runs):
        # each run gets its own checkpoint: a second run replays every file
        stream_ingest(spark, landing, store, index, shared_dir(spark, "stream_ckpt"), KLINES,
                      max_files_per_trigger=max_files)
    return store, index


def _store_rows(spark, store):
    return scan_series(spark, store, store_schema(KLINES)).select("symbol", "open_time", "open", "high")


@query("stream_ingest", MERGED_TEXT_SQL)
def q_stream_ingest(spark, sf_dir):
    store, _ = run(spark, sf_dir)
    return _store_rows(spark, store)


@query("bounded_catch_up", MERGED_TEXT_SQL)
def q_bounded_catch_up(spark, sf_dir):
    store, _ = run(spark, sf_dir, max_files=16)
    return _store_rows(spark, store)


@query("compact_series", MERGED_TEXT_SQL)
def q_compact_series(spark, sf_dir):
    """A store of cells, filled by small batches, after its files were merged."""
    store, landing = prepare(spark, sf_dir, cells=True)
    stream_ingest(spark, landing, store, shared_dir(spark, "stream_index"), shared_dir(spark, "stream_ckpt"), KLINES, max_files_per_trigger=40)
    schema = store_schema(KLINES)
    compact_series(spark, store, schema, SERIES, "open_time")
    return scan_cells(spark, store, schema, SERIES).select("symbol", "open_time", "open", "high")


@query("merge_bucketed", MERGED_TEXT_SQL)
def q_merge_bucketed(spark, sf_dir):
    """E existing as a bucketed table, and E new merged into it without a shuffle of stored rows."""
    name = f"tidemark_bucketed_{uuid.uuid4().hex}"
    rows = existing_rows(spark, sf_dir).select("symbol", "open_time", "open", "high")
    write_bucketed(rows, name, shared_dir(spark, "bucketed"), ["symbol"], "open_time", partitions_of(spark))
    new = scan_dump(spark, write_event_dumps(spark, sf_dir, part=events_new(spark, sf_dir), part_name="new"), KLINES).drop("_file")
    return merge_bucketed(spark, name, new, ["symbol"], "open_time").select("symbol", "open_time", "open", "high")


def partitions_of(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("idempotent_rerun", MERGED_TEXT_SQL)
def q_idempotent_rerun(spark, sf_dir):
    store, _ = run(spark, sf_dir, runs=2)
    return _store_rows(spark, store)


INDEX_SQL = f"""
SELECT event_type || '/' || event_type || '_1h.parquet' AS path, max(date_trunc('hour', ts)) AS last_ts FROM events
GROUP BY event_type HAVING count(*) FILTER (ts >= TIMESTAMP '{NEW_FROM}') > 0"""


@query("stream_index", INDEX_SQL)
def q_stream_index(spark, sf_dir):
    """After two runs, and with the log compacted."""
    _, index = run(spark, sf_dir, runs=2)
    compacted = shared_dir(spark, "stream_index_compacted")
    compact_index_log(spark, index, compacted)
    return read_index_log(spark, compacted)


@query("stream_index_replay", INDEX_SQL)
def q_stream_index_replay(spark, sf_dir):
    """A crash after the append and before the index: the replay appends nothing, but its series
    are in the index all the same."""
    store, landing = prepare(spark, sf_dir)
    upsert(spark, scan_dump(spark, landing, KLINES).drop("_file"), store, KLINES)
    index = shared_dir(spark, "stream_index")
    stream_ingest(spark, landing, store, index, shared_dir(spark, "stream_ckpt"), KLINES)
    return read_index_log(spark, index)


@query("stream_ingest_zip", MERGED_TEXT_SQL)
def q_stream_ingest_zip(spark, sf_dir):
    """The same landing as zip archives, one of which is broken and one malformed, both reported."""
    store, _ = prepare(spark, sf_dir)
    landing = zip_landing(spark, sf_dir)
    errors = shared_dir(spark, "stream_errors")
    stream_ingest(spark, landing, store, shared_dir(spark, "stream_index"), shared_dir(spark, "stream_ckpt"), KLINES,
                  ext="zip", errors_root=errors)
    if spark.read.parquet(errors).count() != 2:
        raise ValueError("the broken archive and the malformed one must be reported once")
    return _store_rows(spark, store)


def zip_landing(spark, sf_dir):
    """E new as zipped daily dumps, an archive that is none for the symbol ``broken``, and one with a
    line of too many cells for the symbol ``ragged``."""
    import io
    import zipfile

    from tidemark.plans.surrogates import _once, _write_event_dumps
    from tidemark.sinks.tables import write_files

    wide = io.BytesIO()
    with zipfile.ZipFile(wide, "w") as z:
        z.writestr("ragged-1h-2024-01-30.csv", "1706572800000" + "," * 11 + "\n1706576400000" + "," * 12 + "\n")

    def make():
        root = _write_event_dumps(spark, sf_dir, True, events_new(spark, sf_dir))
        bad = spark.createDataFrame([("daily/klines/broken/1h/broken-1h-2024-01-30.zip", bytearray(b"no archive")),
                                     ("daily/klines/ragged/1h/ragged-1h-2024-01-30.zip", bytearray(wide.getvalue()))], "path string, content binary")
        write_files(bad, root)
        return root
    return _once(spark, ("zip_landing", sf_dir), make)


def update_outcome(spark, sf_dir, ext="csv", extra=(), todo_limit=None, coins=None, part=None):
    """One update run over the event types (and ``extra`` symbols); (store, outcomes)."""
    from tidemark.operators.universe import build_jobs
    from tidemark.plans.surrogates import lit_date, table
    from tidemark.plans.update import chosen, landed_source, run_update

    store, landing = prepare(spark, sf_dir)
    landing = zip_landing(spark, sf_dir) if ext == "zip" else landing
    symbols = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol")).distinct()
    if extra:
        symbols = symbols.unionByName(spark.createDataFrame([(x,) for x in extra], "symbol string"))
    jobs = build_jobs(chosen(symbols, coins, part), kinds=[KLINES], intervals=("1h",))
    manifest = spark.createDataFrame([], "symbol string, kind string, interval string, freq string, period date, rows long")
    return store, run_update(spark, store, shared_dir(spark, "update_index"), jobs, manifest, lit_date("2024-01-30"), KLINES,
                             landed_source(spark, landing, KLINES, ext), todo_limit=todo_limit)


@query("update_run", MERGED_TEXT_SQL)
def q_update_run(spark, sf_dir):
    """The batch update loop (UDF-1 hook = landed dumps) on the same store and landing."""
    return _store_rows(spark, update_outcome(spark, sf_dir)[0])


OUTCOME_SQL = f"""
WITH ex AS (SELECT event_type AS symbol, date_trunc('hour', ts) AS h FROM events WHERE ts < TIMESTAMP '{EXISTING_BEFORE}'),
l AS (SELECT symbol, max(h) AS last FROM ex GROUP BY symbol),
nw AS (SELECT event_type AS symbol, date_trunc('hour', ts) AS h FROM events JOIN l ON event_type = symbol
       WHERE ts >= TIMESTAMP '{NEW_FROM}' AND CAST(ts AS DATE) >= CAST(last AS DATE) AND CAST(ts AS DATE) <= DATE '2024-01-30'),
o AS (SELECT l.symbol, 'produced' AS status, false AS has_error, (SELECT count(*) FROM nw WHERE nw.symbol = l.symbol) AS fetched,
        (SELECT count(DISTINCT h) FROM nw WHERE nw.symbol = l.symbol AND h NOT IN (SELECT h FROM ex WHERE ex.symbol = l.symbol)) AS appended
      FROM l
      UNION ALL SELECT 'absent', 'no_new_data', false, 0, 0 UNION ALL SELECT 'broken', 'failed', true, 0, 0
      UNION ALL SELECT 'ragged', 'failed', true, 0, 0
      UNION ALL SELECT 'zzz', 'remaining', false, 0, 0)"""


def _outcomes(spark, sf_dir):
    # event types and these four; the last in path order is left to the next run
    n = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type").distinct().count()
    return update_outcome(spark, sf_dir, ext="zip", extra=("absent", "broken", "ragged", "zzz"), todo_limit=n + 3)[1]


@query("update_outcomes", OUTCOME_SQL + """
SELECT symbol || '/' || symbol || '_1h.parquet' AS path, symbol, status, has_error, fetched, appended FROM o""")
def q_update_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir).withColumn("has_error", F.col("error").isNotNull()).select(
        "path", "symbol", "status", "has_error", "fetched", "appended")


@query("update_totals", OUTCOME_SQL + """
SELECT count(*) AS pending, count(*) FILTER (status = 'produced') AS produced, count(*) FILTER (status = 'failed') AS failed,
       count(*) FILTER (status NOT IN ('produced', 'failed')) AS remaining, count(*) FILTER (status = 'no_new_data') AS no_new_data,
       count(DISTINCT symbol) FILTER (status = 'produced') AS symbols_updated, count(DISTINCT symbol) FILTER (status = 'failed') AS symbols_failed
FROM o""")
def q_update_totals(spark, sf_dir):
    return run_totals(_outcomes(spark, sf_dir))


@query("quarantine_rows", f"""
WITH e AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS day, event_id, event_id - event_id % {PART_ROWS} AS cell FROM events),
c AS (SELECT symbol, day, cell, coalesce(sum(n) OVER (PARTITION BY symbol, day ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        // {PART_ROWS} AS part FROM (SELECT symbol, day, cell, count(*) AS n FROM e GROUP BY ALL)),
f AS (SELECT symbol, day, part, min(event_id) AS event_id FROM e JOIN c USING (symbol, day, cell) GROUP BY ALL)
SELECT symbol, day, event_id, CASE WHEN event_id % 7 = 0 THEN '13 cells, 12 expected' ELSE '10 cells, 12 expected' END AS reason,
       event_id % 7 = 0 OR (day(day) % 2 = 1 AND EXISTS (SELECT 1 FROM f WHERE f.symbol = e.symbol AND f.day = e.day AND f.event_id = e.event_id)) AS fatal
FROM e WHERE event_id % 7 = 0 OR event_id % 11 = 5""")
def q_quarantine_rows(spark, sf_dir):
    """E as dumps in which every 7th event's line has a cell too many and every 11th's lacks two: the
    lines that aren't taken as they are, with the reason and whether their file fails."""
    from tidemark.plans.surrogates import _once, dump_files, event_dump_lines, write_dump_files
    from tidemark.sources.dumps import dump_lines, landed_files, malformed, parse_dump_location

    def make():
        root = shared_dir(spark, "ragged_landing")
        line, i = F.col("line"), F.col("event_id")
        ragged = F.when(i % 7 == 0, F.concat(line, F.lit(",x"))).when(
            i % 11 == 5, F.regexp_replace(line, ",[^,]*,[^,]*$", "")).otherwise(line)
        write_dump_files(dump_files(event_dump_lines(spark, sf_dir).withColumn("line", ragged)), root, False)
        return root

    root = _once(spark, ("ragged_landing", sf_dir), make)
    found = malformed(dump_lines(landed_files(spark, root, "csv", KLINES)), KLINES)
    loc = parse_dump_location(F.col("path"))
    return found.select(loc["symbol"].alias("symbol"), loc["period"].alias("day"), F.split("line", ",")[1].cast("long").alias("event_id"), "reason", "fatal")


@query("shard_override", """
SELECT event_type AS symbol FROM (SELECT DISTINCT event_type FROM events) WHERE event_type IN ('click', 'view')""")
def q_shard_override(spark, sf_dir):
    """Named symbols bypass sharding: both are there, whatever the shard of the run."""
    from tidemark.plans.surrogates import table
    from tidemark.plans.update import chosen

    symbols = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol")).distinct()
    coins = spark.createDataFrame([("view, click,,",)], "coins string")
    return chosen(symbols, coins, (0, 5))


KINDS_SQL = """
WITH r AS (SELECT CASE WHEN value < 10 THEN 'klines' WHEN value < 30 THEN 'metrics' ELSE 'fundingRate' END AS kind,
                  event_type AS symbol, date_trunc('hour', ts) AS t, event_id FROM events)
SELECT kind, symbol, t, CAST(min(event_id) AS VARCHAR) AS cell FROM r GROUP BY kind, symbol, t
UNION ALL SELECT 'spot', symbol, t, CAST(min(event_id) AS VARCHAR) FROM r WHERE kind = 'klines' GROUP BY symbol, t"""


def kinds_landing(spark, sf_dir, part_rows=PART_ROWS):
    """E as zipped dumps of three kinds (times in ms, as text, in ms); (folder, monthly manifest)."""
    from tidemark.plans.surrogates import (
        _once, hour, ms_text, numbered_parts, part_suffix, table, tree_kind, write_dump_files,
    )

    e = table(spark, sf_dir, "events").select(tree_kind().alias("kind"), F.col("event_type").alias("symbol"), hour().alias("t"), "event_id", "ts")
    monthly = F.col("kind") == "fundingRate"
    period = F.when(monthly, F.trunc("ts", "month")).otherwise(F.to_date("ts"))

    def make():
        cell = F.col("event_id").cast("string")
        klines = F.concat(ms_text("t"), F.lit(","), cell, F.lit("," * 10))
        metrics = F.concat(F.date_format("t", "yyyy-MM-dd HH:mm:ss"), F.lit(",inner,"), cell, F.lit("," * 5))
        line = F.when(F.col("kind") == "klines", klines).when(F.col("kind") == "metrics", metrics).otherwise(
            F.concat(ms_text("t"), F.lit(","), cell, F.lit(",")))
        lines = numbered_parts(e.withColumns({"period": period, "line": line}), ["kind", "symbol", "period"], part_rows)
        files = lines.groupBy("kind", "symbol", "period", "part").agg(
            F.array_sort(F.collect_list(F.struct("event_id", "line"))).alias("rows"))  # one part is one file
        name = F.when(F.col("kind") == "klines", "1h").otherwise(F.col("kind"))
        stamp = F.when(monthly, F.date_format("period", "yyyy-MM")).otherwise(F.date_format("period", "yyyy-MM-dd"))
        path = F.concat_ws("/", F.when(monthly, "monthly").otherwise("daily"), "kind", "symbol", F.when(F.col("kind") == "klines", "1h"),
                           F.concat(F.col("symbol"), F.lit("-"), name, F.lit("-"), stamp, part_suffix(), F.lit(".zip")))
        text = F.concat(F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), F.lit("\n"))
        root = shared_dir(spark, "kinds_landing")
        write_dump_files(files.select(path.alias("path"), text.alias("content"), "part"), root, True)
        return root

    manifest = e.where(monthly).groupBy("symbol", "kind", F.trunc("ts", "month").alias("period")).agg(F.count(F.lit(1)).alias("rows"))
    return _once(spark, ("kinds_landing", sf_dir, part_rows), make), manifest.select(
        "symbol", "kind", F.lit(None).cast("string").alias("interval"), F.lit("monthly").alias("freq"), "period", "rows")


@query("update_run_kinds", KINDS_SQL)
def q_update_run_kinds(spark, sf_dir):
    """Update runs of three futures kinds and of the spot dataset, from nothing stored."""
    from tidemark.operators.universe import build_jobs
    from tidemark.plans.surrogates import lit_date, table
    from tidemark.plans.update import landed_source, run_update
    from tidemark.registry import FUTURES_KINDS, SPOT_KINDS

    landing, manifest = kinds_landing(spark, sf_dir)
    symbols = table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol")).distinct()
    found = None
    for label, kinds in (("", FUTURES_KINDS), ("spot", SPOT_KINDS)):
        for k in kinds:
            if k.name not in ("klines", "metrics", "fundingRate"):
                continue
            store = shared_dir(spark, f"kinds_store_{label}{k.name}")
            jobs = build_jobs(symbols, kinds=[k], intervals=("1h",))
            run_update(spark, store, shared_dir(spark, "kinds_index"), jobs, manifest, lit_date("2024-01-31"), k,
                       landed_source(spark, landing, k, "zip"), kinds=kinds)
            cell = {"klines": "open", "metrics": "sum_open_interest", "fundingRate": "funding_interval_hours"}[k.name]
            rows = scan_series(spark, store, store_schema(k)).select(
                F.lit(label or k.name).alias("kind"), "symbol", F.col(k.time_col).alias("t"), F.col(cell).alias("cell"))
            found = rows if found is None else found.unionByName(rows)
    return found
