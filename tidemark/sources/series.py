"""Stored series: SRC-1, SRC-2, SRC-11 and the file-tree scan used by index rebuilds.

The engine's store is one Parquet table per schema, partitioned by the series columns
(``kind``, ``interval``, ``symbol``); a series is a partition, so selecting series is
partition pruning.  ``scan_tree`` reads the per-file layout of the source dataset
(``SYM/SYM_1d.parquet``, legacy ``SYM_1d.csv`` at the root) for adoption and audits.
"""

from __future__ import annotations

import io
import itertools

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import parse_series_path
from tidemark.functions.times import harmonize, text_to_time
from tidemark.registry import TIME_COLUMNS, time_column_of
from tidemark.sources.files import list_files, opened, spread


def _empty(spark: SparkSession, schema: T.StructType, columns=None) -> DataFrame:
    df = spark.createDataFrame([], schema)
    return df.select(*columns) if columns else df


def _missing(e: AnalysisException) -> bool:
    """Whether an analysis error only says that there is nothing to read."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def scan_series(spark: SparkSession, root: str, schema: T.StructType | None = None,
                columns: list[str] | None = None, legacy: bool = False) -> DataFrame:
    """SRC-1: the stored series table (optionally a column subset); missing -> empty.

    With a ``schema`` no inference runs; column pruning and predicate pushdown on the
    selected columns are Catalyst's.  A file that can't be read, or whose time columns have
    another type than the schema, fails the scan: skipping it would let its rows be fetched
    again and win.  ``legacy`` is for stores with files that older writers left, whose times
    are text: every file is opened by itself and its times brought to the schema's type.
    """
    if legacy:
        df = _legacy_series(spark, root, schema)
        return df.select(*columns) if columns else df
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.parquet(root)
    except AnalysisException as e:
        if not _missing(e) or schema is None:
            raise
        return _empty(spark, schema, columns)
    return df.select(*columns) if columns else df


def _naive(column):
    """A time column as microseconds without zone (zoned ones in UTC)."""
    import pyarrow as pa

    if pa.types.is_timestamp(column.type) and column.type.tz:
        column = column.cast(pa.timestamp("us", column.type.tz), safe=False).cast(pa.int64())
    return column.cast(pa.timestamp("us"), safe=False)


def _legacy_series(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Each file by itself, a row group at a time."""
    times = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    names = [f.name for f in schema.fields]

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        def rows(path, found):
            out = {"_path": pa.array([path] * found.num_rows, pa.string())}
            nothing = pa.nulls(found.num_rows, pa.string())
            for c in names:
                have = found.column(c) if c in found.schema.names else nothing
                text = pa.types.is_string(have.type) or pa.types.is_large_string(have.type)
                if c in times:
                    out[c] = pa.nulls(found.num_rows, pa.timestamp("us")) if text else _naive(have)
                    out[f"{c}_text"] = have.cast(pa.string()) if text else nothing
                else:
                    out[c] = have.cast(pa.string())
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with opened(root, path) as file:
                        for found in pq.ParquetFile(pa.PythonFile(file, "r")).iter_batches(batch_size=20_000):
                            yield rows(path, found)
                except (pa.ArrowException, OSError) as e:
                    raise ValueError(f"unreadable series file {path}: {e}") from e

    fields = ", ".join(f"`{c}` timestamp_ntz, `{c}_text` string" if c in times else f"`{c}` string" for c in names)
    files = spread(list_files(spark, root, (".parquet",)).where("length > 0"))
    rows = files.mapInArrow(read, f"_path string, {fields}")
    out = []
    for f in schema.fields:
        folder = F.regexp_extract(F.concat(F.lit("/"), "_path"), rf"/{f.name}=([^/]*)/", 1)
        value = F.coalesce(F.col(f.name), text_to_time(f"{f.name}_text")) if f.name in times else F.coalesce(
            F.col(f.name), F.when(~folder.isin("", "__HIVE_DEFAULT_PARTITION__"), F.url_decode(folder)))
        out.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*out)


def load_subset(df: DataFrame, symbols: list[str] | None = None, intervals: list[str] | None = None,
                kinds: list[str] | None = None) -> DataFrame:
    """SRC-11: the chosen symbols / intervals / kinds only (partition filters)."""
    cond = F.lit(True)
    if symbols is not None:
        cond = cond & F.col("symbol").isin(list(symbols))
    if intervals is not None:
        cond = cond & F.col("interval").isin(list(intervals))
    if kinds is not None:
        cond = cond & F.col("kind").isin(list(kinds))
    return df.where(cond)


#: Text times of a file handed on at a time.
_TEXTS = 20_000


def _latest(file, column: str):
    """Latest value of a typed time column: from the footer, or from the column where a row group
    has no statistics."""
    import pyarrow as pa
    import pyarrow.compute as pc

    kind = file.schema_arrow.field(column).type
    leaf = next(i for i in range(file.metadata.num_columns) if file.metadata.schema.column(i).path == column)
    best, unknown = [], []
    for g in range(file.metadata.num_row_groups):
        stats = file.metadata.row_group(g).column(leaf).statistics
        if stats is not None and stats.has_min_max:
            best.append(pc.max(_naive(pa.array([stats.max], kind))).as_py())
        elif stats is None or not stats.has_null_count or stats.null_count < file.metadata.row_group(g).num_rows:
            unknown.append(g)
    for part in file.iter_batches(row_groups=unknown, columns=[column]) if unknown else ():
        best.append(pc.max(_naive(part.column(0))).as_py())
    return max((x for x in best if x is not None), default=None)


def _first_cells(root: str, path: str):
    """Lists of the lines of a CSV file after its header, as Spark's reader splits them; of a line that
    doesn't begin with a quote only the first cell."""
    blank = "".join(map(chr, range(33)))
    with opened(root, path) as file:
        lines = (x for x in io.TextIOWrapper(io.BufferedReader(file.raw(), 1 << 16), "utf-8", errors="replace") if x.strip(blank))
        next(lines, None)
        while part := list(itertools.islice(lines, _TEXTS)):
            yield [x.removesuffix("\n") if x[0] == '"' else x.removesuffix("\n").partition(",")[0] for x in part]


def _file_times(root: str):
    """For each Parquet file one row with the latest value of its typed time columns, or why it can't
    be read, and the bytes read; and a row for each of its text times.  Of a CSV file a row for each line."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        schema = pa.schema([pa.field("path", pa.string()), *[pa.field(c, pa.timestamp("us")) for c in TIME_COLUMNS],
                            *[pa.field(f"{c}_text", pa.string()) for c in TIME_COLUMNS], pa.field("error", pa.string()),
                            pa.field("bytes", pa.int64()), pa.field("line", pa.string())])

        def texts(column, held):
            n = sum(len(x) for _, x in held)
            paths = pa.concat_arrays([pa.repeat(pa.scalar(p, pa.string()), len(x)) for p, x in held])
            values = pa.concat_arrays([x for _, x in held])
            return pa.RecordBatch.from_arrays([paths if f.name == "path" else values if f.name == column else pa.nulls(n, f.type)
                                               for f in schema], schema=schema)

        # rows of many files go on together: a batch for each would cost more than its file
        ones, held = [], {}

        def add(column, path, values):
            held.setdefault(column, []).append((path, values))
            if sum(len(x) for _, x in held[column]) >= _TEXTS or len(held[column]) >= _TEXTS:
                yield texts(column, held.pop(column))

        for batch in batches:
            for path in batch.column(0).to_pylist():
                if path.endswith(".csv"):
                    for lines in _first_cells(root, path):
                        yield from add("line", path, pa.array(lines, pa.string()))
                    continue
                one = {"path": path}
                try:
                    with opened(root, path) as raw:
                        try:
                            file = pq.ParquetFile(pa.PythonFile(raw, "r"))
                            for c in (c for c in TIME_COLUMNS if c in file.schema_arrow.names):
                                kind = file.schema_arrow.field(c).type
                                if pa.types.is_string(kind) or pa.types.is_large_string(kind):
                                    for part in file.iter_batches(batch_size=_TEXTS, columns=[c]):
                                        yield from add(f"{c}_text", path, part.column(0).cast(pa.string()))
                                elif pa.types.is_temporal(kind):
                                    one[c] = _latest(file, c)
                        finally:
                            one["bytes"] = raw.bytes
                except (pa.ArrowException, OSError) as e:
                    one["error"] = f"{type(e).__name__}: {e}"
                ones.append(one)
                if len(ones) == _TEXTS:
                    yield pa.RecordBatch.from_pylist(ones, schema=schema)
                    ones = []
        if ones:
            yield pa.RecordBatch.from_pylist(ones, schema=schema)
        for column, rest in held.items():
            yield texts(column, rest)
    return run


def scan_tree(spark: SparkSession, root: str, symbols: list[str] | None = None) -> DataFrame:
    """Every ``*.parquet`` and ``*.csv`` file under ``root``: relative ``path``, ``format``, the
    latest value of each time column that it has, ``error`` if it can't be read, and the ``bytes``
    that were read of it (of a Parquet file).

    Of a Parquet file the footer is read: row groups' statistics give the latest time.  Only a time
    column without them, or of text times, is read itself.  A broken file is a row with its error,
    never a missing row.  CSV files are the legacy text series: header, time in the first column.
    ``symbols`` (a short list) opens only these symbols' folders and flat files.
    """
    folders = None if symbols is None else spark.createDataFrame([(s,) for s in symbols], "path string")
    files = list_files(spark, root, (".parquet", ".csv"), folders).where("length > 0")
    if symbols is not None:
        files = parse_series_path(files, "path").where(F.col("symbol").isin(symbols)).select("path", "length")
    schema = "path string, " + ", ".join(f"{c} timestamp_ntz" for c in TIME_COLUMNS) + ", " + ", ".join(
        f"{c}_text string" for c in TIME_COLUMNS) + ", error string, bytes long, line string"
    p = spread(files).mapInArrow(_file_times(root), schema)
    p = p.withColumn("_first", F.when(F.startswith("line", F.lit('"')), F.from_csv("line", "_first string")["_first"]).otherwise(F.col("line")))
    p = p.withColumns({**{c: F.coalesce(F.col(c), text_to_time(f"{c}_text")) for c in TIME_COLUMNS}, "_t": text_to_time("_first")})
    p = p.groupBy("path").agg(*[F.max(c).alias(c) for c in (*TIME_COLUMNS, "error", "bytes", "_t")])
    # a CSV file's one time is that of its kind
    csv = F.endswith("path", F.lit(".csv"))
    tcol = time_column_of(F.col("kind"))
    return parse_series_path(p, "path").select(
        "path", *[F.when(csv, F.when(tcol == F.lit(c), F.col("_t"))).otherwise(F.col(c)).alias(c) for c in TIME_COLUMNS],
        "error", "bytes", F.when(csv, "csv").otherwise("parquet").alias("format"))


def scan_series_any(spark: SparkSession, parquet_root: str, csv_root: str, keys: list[str],
                    schema: T.StructType | None = None) -> DataFrame:
    """SRC-2: per series the Parquet copy, else its CSV twin, all values as text.

    The CSV side keeps only series absent from the Parquet side (anti join on the
    series keys, the Parquet side reduced to its distinct keys first).
    """
    pq = scan_series(spark, parquet_root, schema)
    cs = (spark.read.option("header", "true").option("basePath", csv_root)
          .option("recursiveFileLookup", "false").csv(csv_root))
    pq_text = pq.select(*[F.col(c).cast(T.StringType()).alias(c) if c not in keys else F.col(c) for c in pq.columns])
    from tidemark.operators.merge import join_null_safe

    only_csv = join_null_safe(cs, pq.select(*keys).distinct(), keys, "left_anti")
    only_csv = only_csv.select(*[F.col(c).cast(T.StringType()) if c not in keys else F.col(c) for c in only_csv.columns])
    return pq_text.unionByName(only_csv, allowMissingColumns=True)


def _footers(root: str):
    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                raw = None
                try:
                    with opened(root, path) as raw:
                        file = pq.ParquetFile(pa.PythonFile(raw, "r"))
                        has = any(c in file.schema_arrow.names for c in TIME_COLUMNS)
                        out.append((path, file.metadata.num_rows, has, "indexable" if has else "no time column", None, raw.bytes))
                except (pa.ArrowException, OSError) as e:
                    out.append((path, None, False, "unreadable", f"{type(e).__name__}: {e}", raw.bytes if raw else 0))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64()))],
                names=["path", "rows", "has_time_col", "status", "error", "bytes"])
    return run


def scan_audit(spark: SparkSession, root: str) -> DataFrame:
    """FLT-8: every ``*.parquet`` file under ``root`` with its row count, whether it has a time
    column, its ``status`` (indexable, no time column, empty, unreadable), the read error and the
    ``bytes`` read, which are those of its footer.

    Tasks list the folders and open the files; a file of no bytes is known by its length."""
    files = list_files(spark, root, (".parquet",))
    audited = spread(files.where("length > 0")).mapInArrow(
        _footers(root), "path string, rows long, has_time_col boolean, status string, error string, bytes long")
    empty = files.where("length = 0").select(
        "path", F.lit(0).cast("long").alias("rows"), F.lit(False).alias("has_time_col"), F.lit("empty").alias("status"),
        F.lit(None).cast("string").alias("error"), F.lit(0).cast("long").alias("bytes"))
    return audited.unionByName(empty)


def audit_summary(audit: DataFrame) -> DataFrame:
    """FLT-8: how many files there are of each status."""
    return audit.agg(
        F.count(F.lit(1)).alias("scanned"),
        *[F.count_if(F.col("status") == s).alias(s.replace(" ", "_")) for s in ("indexable", "no time column", "empty", "unreadable")])
