"""A series store in cells, compacted while readers go on, and one in buckets.

Cells: files lie under ``<series>/month=yyyy-MM/gen=<n>/``, so rows of a span of time are found by
partition pruning.  Appending adds files to the current generation.  ``compact_series`` rewrites the
cells that have more files than their bytes need into a new generation and then publishes it: a new
version of the small table ``_live`` with the committed generations and, for each rewritten cell, its
first generation that counts.  A reader takes one version before it lists files and reads, of every
cell, committed generations from the cell's first one on.  Until that version is written a new
generation is invisible, so a crash loses and doubles nothing; old files stay for running readers
until ``vacuum_store``.  There is one writer at a time: appends and compactions take turns.

Buckets: a table bucketed and sorted by series and time.  A merge shuffles the batch to the buckets
and never the stored rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import TAGS, dedupe_new, join_null_safe
from tidemark.sinks.tables import write_table
from tidemark.sources.files import file_system, list_files, relative

MONTH, GEN = "month", "gen"
#: Bytes of a compacted file, about.
TARGET_BYTES = 128 << 20


def _live_schema(series: list[str]) -> T.StructType:
    return T.StructType([*[T.StructField(c, T.StringType()) for c in series], T.StructField(MONTH, T.StringType()),
                         T.StructField("first_gen", T.IntegerType())])


def create_store(spark: SparkSession, root: str, series: list[str]) -> None:
    """An empty store of cells: one committed generation, 0."""
    write_table(spark.createDataFrame([(*[None] * len(series), None, 0)], _live_schema(series)), f"{root}/_live")


def live_version(spark: SparkSession, root: str) -> int | None:
    """The version that a reader starting now takes; None if ``root`` is no store of cells."""
    try:
        return spark.read.parquet(f"{root}/_live/versions").agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _live(spark: SparkSession, root: str, series: list[str], version: int) -> tuple[list[int], DataFrame]:
    """(committed generations, first generation of the rewritten cells) of a version."""
    table = spark.read.schema(_live_schema(series)).parquet(f"{root}/_live/data/version={version}")
    gens = [r.first_gen for r in table.where(F.col(MONTH).isNull()).select("first_gen").collect()]  # a row for each compaction
    return gens, table.where(F.col(MONTH).isNotNull())


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


def scan_cells(spark: SparkSession, root: str, schema: T.StructType, series: list[str], version: int | None = None,
               between: tuple | None = None, path_col: str | None = None) -> DataFrame:
    """Rows of a store of cells as of a version (the current one), with their month and, as
    ``path_col``, their file's path under ``root``.

    ``between`` (first, last time) prunes to the months that may hold such times."""
    version = version or live_version(spark, root)
    gens, first = _live(spark, root, series, version)
    own = [f for f in schema.fields if f.name not in (*series, MONTH)]
    full = T.StructType([*own, *[T.StructField(c, T.StringType()) for c in (*series, MONTH)], T.StructField(GEN, T.IntegerType())])
    try:
        rows = spark.read.schema(full).option("basePath", root).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        rows = spark.createDataFrame([], full)
    rows = rows.where(F.col(GEN).isin(gens))
    if path_col is not None:
        rows = rows.withColumn(path_col, relative(root, F.url_decode(F.col("_metadata.file_path"))))
    if between is not None:
        rows = rows.where(F.col(MONTH).between(*[f"{t:%Y-%m}" for t in between]))
    if len(gens) > 1:  # nothing has been rewritten else
        rows = join_null_safe(rows, first, [*series, MONTH], "left").where(F.col(GEN) >= F.coalesce("first_gen", F.lit(0))).drop("first_gen")
    return rows.select(*[f.name for f in schema.fields if f.name != MONTH], MONTH, *([path_col] if path_col else []))


def append_cells(df: DataFrame, root: str, series: list[str], time_col: str, gen: int | None = None) -> None:
    """Add rows to the current generation, each file a sorted run of a cell."""
    spark = df.sparkSession
    if gen is None:
        gen = max(_live(spark, root, series, live_version(spark, root))[0])
    rows = df.drop(MONTH, GEN).withColumns({MONTH: month_of(F.col(time_col)), GEN: F.lit(gen)})
    order = [*series, MONTH, time_col]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("append").partitionBy(*series, MONTH, GEN).parquet(root))


def cell_files(spark: SparkSession, root: str, series: list[str]) -> DataFrame:
    """(path, length, series columns, month, gen) of all files of a store of cells, listed in tasks."""
    files = list_files(spark, root, (".parquet",))

    def value(c: str) -> Column:
        v = F.url_decode(F.regexp_extract("path", rf"(?:^|/){c}=([^/]*)/", 1))
        return F.when(v != "__HIVE_DEFAULT_PARTITION__", v)
    return files.select("path", "length", *[value(c).alias(c) for c in (*series, MONTH)], value(GEN).cast("int").alias(GEN))


def live_files(spark: SparkSession, root: str, series: list[str]) -> DataFrame:
    """``cell_files`` that a reader starting now reads."""
    gens, first = _live(spark, root, series, live_version(spark, root))
    files = join_null_safe(cell_files(spark, root, series).where(F.col(GEN).isin(gens)), first, [*series, MONTH], "left")
    return files.where(F.col(GEN) >= F.coalesce("first_gen", F.lit(0))).drop("first_gen")


def write_generation(spark: SparkSession, root: str, schema: T.StructType, series: list[str], time_col: str,
                     target_bytes: int = TARGET_BYTES) -> tuple[int, DataFrame]:
    """First half of a compaction: (new generation, its cells with what they were made from).

    The files of a cell are packed into bins of about ``target_bytes`` in path order; each bin becomes
    one sorted file.  Nothing refers to the new generation yet."""
    cell = [*series, MONTH]
    by_cell = Window.partitionBy(*cell)
    before = by_cell.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = live_files(spark, root, series).withColumns({
        "files": F.count(F.lit(1)).over(by_cell), "bytes": F.sum("length").over(by_cell),
        "bin": F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / target_bytes)})
    files = files.where(F.col("files") > F.ceil(F.col("bytes") / target_bytes)).checkpoint()
    cells = files.select(*cell, "files", "bytes").distinct()
    gen = (cell_files(spark, root, series).agg(F.max(GEN)).first()[0] or 0) + 1
    rows = join_null_safe(scan_cells(spark, root, schema, series, path_col="_path"), cells.select(*cell), cell, "left_semi")
    rows = rows.join(files.select(F.url_decode("path").alias("_path"), "bin"), "_path").drop("_path").withColumn(GEN, F.lit(gen))
    (rows.repartition(*cell, "bin").sortWithinPartitions(*cell, time_col).drop("bin")
     .write.mode("append").partitionBy(*cell, GEN).parquet(root))
    return gen, cells


def publish(spark: SparkSession, root: str, series: list[str], gen: int, cells: DataFrame) -> None:
    """Second half of a compaction: make the new generation the one that counts for its cells.

    Cells that got files since they were read would lose them: that is an error."""
    cell = [*series, MONTH]
    gens, first = _live(spark, root, series, live_version(spark, root))
    now = live_files(spark, root, series).groupBy(*cell).agg(F.count(F.lit(1)).alias("_files"), F.sum("length").alias("_bytes"))
    changed = join_null_safe(cells, now, cell, "left").where("files <> _files OR bytes <> _bytes OR _files IS NULL")
    if changed.limit(1).count():
        raise ValueError("files were appended while their cells were compacted")
    new = cells.select(*cell, F.lit(gen).alias("first_gen"))
    kept = join_null_safe(first, new.drop("first_gen"), cell, "left_anti")
    committed = spark.createDataFrame([(*[None] * len(cell), g) for g in (*gens, gen)], _live_schema(series))
    write_table(committed.unionByName(kept).unionByName(new), f"{root}/_live")


def compact_series(spark: SparkSession, root: str, schema: T.StructType, series: list[str], time_col: str,
                   target_bytes: int = TARGET_BYTES) -> int:
    """Rewrite every cell that has more files than ceil(bytes / ``target_bytes``); returns how many."""
    gen, cells = write_generation(spark, root, schema, series, time_col, target_bytes)
    n = cells.count()
    if n:
        publish(spark, root, series, gen, cells)
    return n


def vacuum_store(spark: SparkSession, root: str, series: list[str]) -> int:
    """Delete the files that no reader starting now reads (replaced ones, and those of a compaction
    that was never published); returns how many.  Readers of older versions must have ended."""
    import pyarrow as pa

    dead = cell_files(spark, root, series).join(live_files(spark, root, series).select("path"), "path", "left_anti").select("path").checkpoint()

    def delete(batches):
        for batch in batches:
            system, base = file_system(root)
            for path in batch.column(0).to_pylist():
                if system.get_file_info(f"{base}/{path}").is_file:  # a repeated task finds some gone
                    system.delete_file(f"{base}/{path}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return dead.mapInArrow(delete, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


# ---- buckets -------------------------------------------------------------------

def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], time_col: str, buckets: int) -> None:
    """A table of unique rows bucketed and sorted by series and time; keys hold no NULLs."""
    order = [*keys, time_col]
    (df.repartition(buckets, *order).write.format("parquet").option("path", path)
     .bucketBy(buckets, *order).sortBy(*order).mode("overwrite").saveAsTable(table))


def merge_bucketed(spark: SparkSession, table: str, new: DataFrame, keys: list[str], time_col: str) -> DataFrame:
    """WIN-1 on a bucketed table: its rows, and the first new row of every unseen key.

    The batch goes to the buckets; stored rows are read where they lie."""
    stored = spark.table(table)
    order = [*keys, time_col]
    seen = stored.select(*order)
    batch = dedupe_new(new, keys, time_col).drop(*TAGS)
    # a broadcast of either side would be a choice by size; the merge is planned for large ones
    return stored.unionByName(batch.join(seen.hint("merge"), order, "left_anti"), allowMissingColumns=True)
