"""Continuous landing of dumps into series: STR-1..4 (and the UDF-1 source hook).

A stream of the files landed for one kind (CSV or zipped CSV dumps, see ``admission``) feeds
``foreachBatch``; each micro-batch opens its files in tasks, is de-duplicated, anti-joined against
the store (JOIN-9: the stored row wins, so only unseen keys are appended), appended, and then the
index is moved to the latest time now stored of every series in the batch (data first, index second).
Replaying a batch after a failure appends nothing, because the anti join sees the rows that
already landed, but writes its index entries again.  No watermark is used: late rows with
unseen keys are inserted however old they are.

Only the partitions of the batch's series are read from the store, and of these only times from the
batch's first to its last, which in a store of cells (``sinks.store``) are the months between.  The
latest stored times come from the index log; the store is asked only about series new to it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import series_path
from tidemark.operators.index import latest_time
from tidemark.operators.merge import TAGS, dedupe_new, join_null_safe, unseen_rows
from tidemark.registry import FUTURES_KINDS, Kind, series_schema
from tidemark.session import checkpoint_root
from tidemark.sinks.store import MONTH, append_cells, live_version, scan_cells
from tidemark.sinks.tables import append_series
from tidemark.sources.dumps import dump_lines, failed_files, lines_without, parse_lines
from tidemark.sources.series import scan_series
from tidemark.streaming.admission import admitted_files

SERIES = ["kind", "interval", "symbol"]
#: Series of a batch up to this number become literal partition filters; beyond it the batch's
#: distinct series are joined, which prunes while the query runs.
LITERAL_SERIES = 512


def store_schema(k: Kind) -> T.StructType:
    """Stored columns of a kind: its cells and the series columns (a metrics dump's own symbol
    column is the series' symbol)."""
    own = [f for f in series_schema(k).fields if f.name not in SERIES]
    return T.StructType(own + [T.StructField(c, T.StringType()) for c in SERIES])


def series_key_path() -> F.Column:
    suffix = F.create_map(*[x for k in FUTURES_KINDS for x in (F.lit(k.name), F.lit(k.suffix))])
    return series_path("symbol", suffix[F.col("kind")], F.col("interval").isNotNull(), "interval")


def stored_part(spark: SparkSession, store: str, rows: DataFrame, k: Kind) -> DataFrame:
    """The stored rows of the series that ``rows`` touch, other partitions unread.  In a store of
    cells these are the rows of the months between the first and the last time of ``rows``."""
    version = live_version(spark, store)
    if version is None:
        existing = scan_series(spark, store, store_schema(k))
    else:
        span = rows.agg(F.min(k.time_col), F.max(k.time_col)).first()
        existing = scan_cells(spark, store, store_schema(k), SERIES, version, None if span[0] is None else tuple(span)).drop(MONTH)
    return of_series(existing, rows.select(*SERIES).distinct())


def of_series(existing: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows of ``existing`` of the distinct series ``touched``: by literal partition filters, or by a
    join that prunes while the query runs where there are many."""
    few = touched.limit(LITERAL_SERIES + 1).collect()
    if len(few) > LITERAL_SERIES:
        return join_null_safe(existing, touched, SERIES, "left_semi")
    for c in SERIES:
        values = {r[c] for r in few}
        keep = F.col(c).isin([v for v in values if v is not None])
        existing = existing.where(keep | F.col(c).isNull() if None in values else keep)
    return existing


def stored_maxima(spark: SparkSession, store: str, touched: DataFrame, k: Kind, index_root: str | None = None) -> DataFrame:
    """(path, last_ts): latest stored time of the series in ``touched``.

    The index log knows them already; only series that aren't in it are looked up in the store."""
    known = None
    if index_root is not None:
        try:
            known = read_index_log(spark, index_root).join(touched.select(series_key_path().alias("path")), "path", "left_semi")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    if known is not None:
        known = known.checkpoint(eager=True)
        touched = touched.withColumn("_path", series_key_path()).join(known.select(F.col("path").alias("_path")), "_path", "left_anti").drop("_path")
    if not touched.limit(1).count():
        return known
    version = live_version(spark, store)
    schema = store_schema(k)
    stored = scan_series(spark, store, schema) if version is None else scan_cells(spark, store, schema, SERIES, version)
    mine = of_series(stored.select(*SERIES, k.time_col), touched.select(*SERIES))
    found = latest_time(join_null_safe(mine, touched.select(*SERIES), SERIES, "left_semi"), SERIES, k.time_col)
    found = found.select(series_key_path().alias("path"), "last_ts")
    return found if known is None else known.unionByName(found)


def upsert(spark: SparkSession, rows: DataFrame, store: str, k: Kind, index_root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Append the unseen keys of tagged ``rows``; returns (appended rows, latest stored time by
    series path of every series in ``rows``)."""
    # written out: everything below asks only for the first row of each key, so lines are parsed once
    batch = dedupe_new(rows, SERIES, k.time_col).checkpoint(eager=True)
    stored = stored_part(spark, store, batch, k)
    span = batch.agg(F.min(k.time_col), F.max(k.time_col)).first()
    near = stored
    if span[0] is not None:
        near = stored.where(F.col(k.time_col).between(*[F.lit(t).cast(T.TimestampNTZType()) for t in span]))
    # written out: the rows that were new then, not those new to a store that has them by now
    fresh = unseen_rows(near, batch, SERIES, k.time_col).drop(*TAGS).checkpoint(eager=True)
    seen = latest_time(batch, SERIES, k.time_col)
    before = stored_maxima(spark, store, seen.select(*SERIES), k, index_root)
    touched = seen.select(series_key_path().alias("path"), "last_ts").unionByName(before)
    latest = touched.groupBy("path").agg(F.max("last_ts").alias("last_ts")).checkpoint(eager=True)
    if live_version(spark, store) is None:
        append_series(fresh, store, SERIES, k.time_col)
    else:
        append_cells(fresh, store, SERIES, k.time_col)
    return fresh, latest


def ingest_batch(files: DataFrame, store: str, index_root: str, k: Kind, batch_id: int = 0, errors_root: str | None = None) -> None:
    """One micro-batch of landed files ``(path, length)``: append unseen keys, then move the index forward.

    Unreadable archives and malformed files go to ``errors_root`` as (path, error, batch_id) and yield
    no rows; without one they fail the batch."""
    spark = files.sparkSession
    lines = dump_lines(files).persist()
    try:
        bad = failed_files(lines, k).checkpoint(eager=True)
        if errors_root:
            bad.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(errors_root)
        elif (worst := bad.limit(1).collect()):
            raise ValueError(f"{worst[0].path}: {worst[0].error}")
        rows = parse_lines(lines_without(lines, bad.select("path"), F.col("path")), k).drop("_file")
        _, latest = upsert(spark, rows, store, k, index_root)
        # the index is a log of stored maxima: appending never rewrites earlier entries
        latest.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(index_root)
    finally:
        lines.unpersist()


def stream_ingest(spark: SparkSession, landing: str, store: str, index_root: str, checkpoint: str, k: Kind,
                  max_files_per_trigger: int | None = None, available_now: bool = True, ext: str = "csv",
                  errors_root: str | None = None, max_bytes_per_trigger: int | None = None):
    """STR-1/3/4: run the landing stream into the store.  Batches take the landed dumps in the order
    of their periods, each within the bounds on bytes and files.  With ``available_now`` the backlog
    drains in such batches and the query stops; the checkpoint makes the next start resume after
    the last batch."""
    checkpoint_root(spark)
    log = f"{checkpoint.rstrip('/')}_admissions"
    stream = admitted_files(spark, landing, k.segment, ext, log, max_bytes_per_trigger, max_files_per_trigger)
    writer = (stream.writeStream.foreachBatch(lambda df, epoch: ingest_batch(df, store, index_root, k, epoch, errors_root))
              .option("checkpointLocation", checkpoint))
    if not available_now:
        return writer.trigger(processingTime="1 minute").start()
    q = writer.start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q


def read_index_log(spark: SparkSession, index_root: str) -> DataFrame:
    """STR-4: the current index: latest time per path over the batch log."""
    return spark.read.parquet(index_root).groupBy("path").agg(F.max("last_ts").alias("last_ts"))


def compact_index_log(spark: SparkSession, index_root: str, new_root: str) -> None:
    """One entry per path, written to a folder of its own; the caller switches to it."""
    read_index_log(spark, index_root).withColumn("batch_id", F.lit(-1).cast("long")).write.parquet(new_root)
