"""Sinks: SNK-1..5 plus a one-file-per-row writer for the source dataset's file layouts.

Write order is data first, index second: a crash leaves the index behind the data,
never ahead of it, and the next run's anti join absorbs whatever already landed.
"""

from __future__ import annotations

import os
import time
import uuid
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.session import batch_limits
from tidemark.sources.files import file_system


def _clustered(df: DataFrame, series_cols: list[str], time_col: str) -> DataFrame:
    # range partitioning on (series, time) splits a hot series over many writers while
    # keeping each output file a sorted run of one series
    return df.repartitionByRange(*series_cols, time_col).sortWithinPartitions(*series_cols, time_col)


def write_series(df: DataFrame, root: str, series_cols: list[str], time_col: str) -> None:
    """SNK-1: rewrite only the series present in ``df`` (dynamic partition overwrite),
    each sorted by time.  Untouched series keep their files."""
    (_clustered(df, series_cols, time_col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*series_cols).parquet(root))


def append_series(df: DataFrame, root: str, series_cols: list[str], time_col: str) -> None:
    """Append new rows (the output of JOIN-9) to the series table."""
    _clustered(df, series_cols, time_col).write.mode("append").partitionBy(*series_cols).parquet(root)


def write_table(df: DataFrame, root: str) -> None:
    """Replace a small table: a new version folder, then an entry that makes it the current one.

    The version before stays readable until then, also for ``df`` itself; a crash in between
    leaves it current."""
    version = time.time_ns()
    df.write.parquet(f"{root}/data/version={version}")
    spark = df.sparkSession
    spark.range(1).select(F.lit(version).alias("version")).coalesce(1).write.mode("append").parquet(f"{root}/versions")


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a table of ``write_table``; other versions' files aren't read."""
    current = spark.read.parquet(f"{root}/versions").agg(F.max("version")).scalar()
    return spark.read.parquet(f"{root}/data").where(F.col("version") == current).drop("version")


def write_index(index: DataFrame, root: str) -> None:
    """SNK-2: the overlaid index ``(path, last_ts)`` with its text form, sorted by path."""
    from tidemark.functions.times import index_text

    out = index.select("path", "last_ts", index_text("last_ts").alias("last_text")).orderBy("path")
    write_table(out, root)


def index_lines(index: DataFrame) -> DataFrame:
    """Index as JSON lines ``{"path": "yyyy-MM-dd HH:mm:ss"}`` (see ``scan_index``)."""
    from tidemark.functions.times import index_text

    return index.select(F.to_json(F.create_map("path", index_text("last_ts"))).alias("value"))


def write_info(info: DataFrame, root: str, json_root: str | None = None) -> None:
    """SNK-3: metadata records as a Parquet table; optionally also one JSON text per
    symbol (keys sorted) partitioned by symbol."""
    write_table(info.select("symbol", "info"), root)
    if json_root:
        sorted_map = F.map_from_entries(F.array_sort(F.map_entries("info")))
        (info.select("symbol", F.to_json(sorted_map).alias("value"))
         .write.mode("overwrite").partitionBy("symbol").text(json_root))


def write_meta(info: DataFrame, root: str) -> None:
    """SNK-3: listing metadata ``(symbol, info)`` as JSON objects ``{SYM: {...}}``, one to a line,
    sorted by symbol and with sorted keys (see ``scan_meta``).  Keys without a value are kept."""
    entries = F.transform(F.array_sort(F.map_entries("info")), lambda e: F.concat(
        F.to_json(F.array(e["key"])).substr(F.lit(2), F.length(F.to_json(F.array(e["key"]))) - 2), F.lit(": "),
        F.coalesce(F.to_json(F.array(e["value"])).substr(F.lit(2), F.length(F.to_json(F.array(e["value"]))) - 2), F.lit("null"))))
    name = F.to_json(F.array("symbol"))
    line = F.concat(F.lit("{"), name.substr(F.lit(2), F.length(name) - 2), F.lit(": {"), F.array_join(entries, ", "), F.lit("}}"))
    info.orderBy("symbol").select(line.alias("value")).write.mode("overwrite").text(root)


def write_run_summary(totals: DataFrame, by_symbol: DataFrame, root: str, run_id: str, run_at: Column) -> None:
    """SNK-4: append the run's totals and per-symbol rows, stamped with the run."""
    stamp = {"run_id": F.lit(run_id), "run_at": run_at.cast(T.TimestampNTZType())}
    totals.withColumns(stamp).write.mode("append").parquet(f"{root}/runs")
    by_symbol.withColumns(stamp).write.mode("append").parquet(f"{root}/run_symbols")


def write_snapshot(symbols: DataFrame, root: str, snapshot_id: str, fetched_at: Column) -> None:
    """SNK-5: append a timestamped symbol list (long form, one row per symbol)."""
    (symbols.select(F.lit(snapshot_id).alias("snapshot_id"), fetched_at.cast(T.TimestampNTZType()).alias("fetched_at"),
                    "symbol")
     .write.mode("append").partitionBy("snapshot_id").parquet(root))


#: Files handed to a writing task at a time, where they are small.
FILE_ROWS = 4096


@dataclass
class Written(WriterCommitMessage):
    """What a task of ``write_files`` has put in place."""

    files: int


class _FilesWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.root, self.ordered, self.start = options["path"], options["ordered"] == "true", int(options["start"])

    def write(self, iterator) -> Written:
        """Write all of a task's files under other names, then put them in place; a task that fails
        before has left none, one that is repeated replaces its own."""
        system, base = file_system(self.root)
        mark = f".{uuid.uuid4().hex}.tmp"
        made: list[tuple[str, int | None]] = []
        try:
            for batch in iterator:
                order = batch.column(2).to_pylist() if self.ordered else [None] * batch.num_rows
                for i in range(batch.num_rows):
                    target = f"{base}/{batch.column(0)[i].as_py()}"
                    folder, _, name = target.rpartition("/")
                    system.create_dir(folder, recursive=True)
                    made.append((target, order[i]))
                    with system.open_output_stream(f"{folder}/.{name}{mark}") as f:
                        f.write(batch.column(1)[i].as_buffer())
        except BaseException:
            for target, _ in made:
                folder, _, name = target.rpartition("/")
                if system.get_file_info(f"{folder}/.{name}{mark}").is_file:
                    system.delete_file(f"{folder}/.{name}{mark}")
            raise
        for target, place in made:
            folder, _, name = target.rpartition("/")
            if place is not None and isinstance(system, pafs.LocalFileSystem):
                os.utime(f"{folder}/.{name}{mark}", ns=(self.start + int(place) * 1_000_000,) * 2)
            system.move(f"{folder}/.{name}{mark}", target)
        return Written(len(made))

    def commit(self, messages) -> None:
        """Every task has put its own files in place."""

    def abort(self, messages) -> None:
        """A failed task has removed its files; those of tasks that ended stay, as whole files."""


class _Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_files"

    def schema(self) -> str:
        return "path string, content binary, place long"

    def writer(self, schema, overwrite) -> _FilesWriter:
        return _FilesWriter(self.options)


def write_files(df: DataFrame, root: str, path_col: str = "path", content_col: str = "content",
                order_col: str | None = None) -> None:
    """Write each row's ``content`` (text or bytes) to ``root/<path>`` from the executors.

    For the per-file layouts of the source dataset (``SYM/SYM_info.json``, zip dumps,
    a legacy ``_index.json``).  ``root`` is a folder every executor mounts (the shared checkpoint
    folder is one) or a URI that pyarrow's file systems know.  A task's files appear when all of them
    are written.  In a mounted folder a file of larger ``order_col`` (a number from 0) gets a later
    modification time, whenever its task runs.
    """
    try:
        file_system(root)
    except (ValueError, OSError) as e:
        raise ValueError(f"{root}: neither a mounted folder nor a file system that pyarrow knows: {e}") from e
    df.sparkSession.dataSource.register(_Files)
    place = F.col(order_col).cast("long") if order_col else F.lit(None).cast("long")
    rows = df.select(F.col(path_col).alias("path"), F.col(content_col).cast("binary").alias("content"), place.alias("place"))
    # whole files are cells: a batch is bounded by their bytes, here and in what makes them
    with batch_limits(df.sparkSession, FILE_ROWS):
        (rows.write.format("tidemark_files").mode("append").option("path", root).option("ordered", "true" if order_col else "false")
         .option("start", str(time.time_ns())).save())
