"""Landed exchange dumps: SRC-3 (CSV), SRC-4 (zipped CSV), SRC-5 (JSON arrays).

Every cell stays exact text (``1.50000000`` survives); NA spellings become NULL; a first
row that repeats the first column name is a header and is dropped.  Each row carries
the first-wins order tags (``_source`` 1 monthly / 2 daily, ``_period`` and ``_part`` from
the file name, ``_row`` its position in the file) and its series from the dump location
``{freq}/{segment}/{SYM}[/{interval}]/{name}-{stamp}[.part{n}].{zip|csv}``.  A dump of many
rows may come in several files: the first without a part number, the others numbered from 1.

A line of more cells than its kind has columns is never cut, and makes its file fail, as does a
first line of fewer; a later line of fewer cells is read with NULLs for the rest.  ``malformed`` lists
all three with path, line number and reason.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import na_to_null
from tidemark.functions.times import normalize_times
from tidemark.operators.merge import DAILY, MONTHLY, PART, PERIOD, ROW, SOURCE
from tidemark.registry import FUTURES_KINDS, Kind
from tidemark.sources.files import list_files, opened, spread

_LOCATION = r"(monthly|daily)/([^/]+)/([^/]+)/(?:([^/]+)/)?[^/]+-(\d{4}-\d{2}(?:-\d{2})?)(?:\.part(\d+))?\.(?:zip|csv)$"


def whole_dump(path: Column) -> Column:
    """The path of the dump that a file is a part of."""
    return F.regexp_replace(path, r"\.part\d+(\.(?:zip|csv))$", "$1")


def parse_dump_location(path: Column) -> dict[str, Column]:
    """Inverse of PRJ-3: freq, kind, symbol, interval, period and part number of a dump path."""
    return _located(location_cells(path))


def location_cells(path: Column) -> Column:
    """The parts of a dump path in an array, found by one match; of another path, the path alone."""
    groups = "\u0001".join(f"${i}" for i in range(1, 7))
    return F.split(F.regexp_replace(path, r"(?s)^.*?" + _LOCATION, groups), "\u0001")


def _located(cells: Column) -> dict[str, Column]:
    """``parse_dump_location`` from ``location_cells``."""
    seg_to_kind = F.create_map(*[x for k in FUTURES_KINDS for x in (F.lit(k.segment), F.lit(k.name))])
    found = F.size(cells) == 6
    part = lambda i: F.when(found, cells[i - 1]).otherwise(F.lit(""))
    freq, stamp, itv = part(1), part(5), part(4)
    return {
        "freq": F.when(freq != "", freq),
        "kind": seg_to_kind[part(2)],
        "symbol": F.when(freq != "", part(3)),
        "interval": F.when(itv != "", itv),
        "period": F.when(F.length(stamp) == 7, F.to_date(F.concat(stamp, F.lit("-01"))))
                   .when(F.length(stamp) == 10, F.to_date(stamp)),
        "part": F.coalesce(part(6).try_cast("long"), F.lit(0).cast("long")),
    }


def _tags(loc: dict[str, Column], row: Column) -> dict[str, Column]:
    return {
        SOURCE: F.when(loc["freq"] == "daily", F.lit(DAILY)).otherwise(F.lit(MONTHLY)).cast(T.IntegerType()),
        PERIOD: loc["period"],
        PART: loc["part"],
        ROW: row.cast(T.LongType()),
    }


def _finish(df: DataFrame, k: Kind, loc: dict[str, Column], row: Column, normalize: bool) -> DataFrame:
    first = k.columns[0]
    df = df.withColumns({c: na_to_null(F.col(c)) for c in k.columns})
    df = df.where(F.coalesce(F.trim(F.col(first)) != F.lit(first), F.lit(True)))
    df = df.withColumns({**{n: loc[n] for n in ("symbol", "kind", "interval")}, **_tags(loc, row)})
    if normalize:
        text_cols = () if k.time_col in k.ms_time_cols else (k.time_col,)
        df = normalize_times(df, k.ms_time_cols, text_cols)
    return df


def cells_of(line: Column) -> Column:
    """How many cells a CSV line has; commas inside quotes separate none."""
    bare = F.when(F.instr(line, F.lit('"')) > 0, F.regexp_replace(line, r'"(?:[^"\\]++|\\.|"")*+"', "")).otherwise(line)
    return F.size(F.split(bare, ",", -1))


def _problem(line: Column, first: Column, k: Kind) -> tuple[Column, Column]:
    """(reason or NULL, whether the file fails by it) of a line."""
    n = len(k.columns)
    cells = cells_of(line)
    return F.when(cells != n, F.concat(cells.cast("string"), F.lit(f" cells, {n} expected"))), (cells > n) | (first & (cells < n))


def _parsed(lines: DataFrame, line: str, k: Kind) -> DataFrame:
    ddl = ", ".join(f"`{c}` STRING" for c in k.columns)
    rest = [c for c in lines.columns if c != line]
    # a generator: filters on the cells stay above it, so that a line is parsed once
    return lines.select(*rest, F.inline(F.array(F.from_csv(line, ddl))).alias(*k.columns))


def scan_dump(spark: SparkSession, path: str, k: Kind, normalize: bool = True, on_bad: str = "fail") -> DataFrame:
    """SRC-3: positional CSV dumps (header optional) under ``path``.

    Row order inside a dump comes from the reader: a file is read in order, and the id
    increases along it (a split of a large file gets higher ids than the one before).  A line of too
    many cells fails the read; with ``on_bad="report"`` it is absent here (see ``malformed``).
    """
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(path)
    raw = raw.select("value", F.url_decode(F.col("_metadata.file_path")).alias("_file"), F.monotonically_increasing_id().alias("_rowid"))
    raw = raw.where(F.trim("value") != "")
    long = cells_of(F.col("value")) > len(k.columns)
    if on_bad == "fail":
        told = F.concat(F.col("_file"), F.lit(": "), _problem(F.col("value"), F.lit(False), k)[0], F.lit(": "), F.left("value", F.lit(200)))
        raw = raw.where(F.when(long, F.raise_error(told).cast("boolean")).otherwise(F.lit(True)))
    else:
        raw = raw.where(~long)
    raw = raw.withColumn("_loc", location_cells(F.col("_file")))
    return _finish(_parsed(raw, "value", k), k, _located(F.col("_loc")), F.col("_rowid"), normalize).drop("_rowid", "_loc")


LINES = "path string, line_no long, line string, error string"
#: Lines and characters of a file handed on at a time.
_CHUNK_LINES, _CHUNK_SIZE = 20_000, 8 << 20
#: Failed files up to this number become a literal filter on the lines.
LITERAL_FILES = 512


def landed_files(spark: SparkSession, path: str, ext: str, k: Kind | None = None) -> DataFrame:
    """(path, length) of the dumps landed under ``path``; of kind ``k`` only its own folders are listed."""
    root = path.rstrip("/")
    roots = [f"{root}/{freq}/{k.segment}" for freq in ("monthly", "daily")] if k else [root]
    found = [list_files(spark, r, (f".{ext}",)).select(F.concat(F.lit(r + "/"), "path").alias("path"), "length") for r in roots]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def zip_files(spark: SparkSession, path: str) -> DataFrame:
    return landed_files(spark, path, "zip")


def _member(archive: zipfile.ZipFile) -> str:
    names = [n for n in archive.namelist() if not n.endswith("/")]
    if len(names) != 1:
        raise ValueError(f"{len(names)} members, one expected")
    return names[0]


def _text_lines(path: str) -> Iterator[tuple[int, str]]:
    """(number, line) of a file's lines that aren't blank, read as they are asked for.  Only line
    feeds end a line."""
    with opened("", path) as file:
        if path.endswith(".zip"):
            with zipfile.ZipFile(file) as z, z.open(_member(z)) as f:
                yield from _split(f)
        else:
            yield from _split(io.BufferedReader(file.raw(), 1 << 20))


def _split(file) -> Iterator[tuple[int, str]]:
    for i, x in enumerate(io.TextIOWrapper(file, "utf-8", errors="replace", newline="\n")):
        x = x.removesuffix("\n").removesuffix("\r")
        if x.strip():
            yield i, x


def _checked(path: str) -> str | None:
    """Why an archive can't be read, found by reading it through once without keeping it."""
    if not path.endswith(".zip"):
        return None
    try:
        with opened("", path) as file, zipfile.ZipFile(file) as z, z.open(_member(z)) as f:
            while f.read(1 << 20):
                pass
    except pa.ArrowInvalid as e:  # a place that the file doesn't have was sought
        return f"not a zip archive: {e}"
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, ValueError) as e:
        return str(e) if type(e) is ValueError else f"{type(e).__name__}: {e}"
    return None


def _read_lines(batches):
    """Files -> a row for each text line, or one row with the error that keeps an archive from being
    read.  A task holds some lines of one file, however long the file."""
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.string()))],
                                          names=["path", "line_no", "line", "error"])

    for batch in batches:
        for path in batch.column(0).to_pylist():
            error = _checked(path)
            if error is not None:
                yield batch_of([(path, None, None, error)])
                continue
            held, size = [], 0
            for i, line in _text_lines(path):
                held.append((path, i, line, None))
                size += len(line)
                if len(held) == _CHUNK_LINES or size >= _CHUNK_SIZE:
                    yield batch_of(held)
                    held, size = [], 0
            if held:
                yield batch_of(held)


def dump_lines(files: DataFrame) -> DataFrame:
    """(path, line_no, line, error) of CSV dumps and archives of one, given as ``(path, length)``.

    Each file is opened by the task that reads it, and read as a stream: neither an archive nor its
    lines have to fit in memory.  What isn't in ``files`` isn't opened."""
    return spread(files.select("path", "length")).select("path").mapInArrow(_read_lines, LINES)


def bad_archives(lines: DataFrame) -> DataFrame:
    """(path, error) of the archives that could not be read."""
    return lines.where(F.col("error").isNotNull()).select("path", "error")


def malformed(lines: DataFrame, k: Kind) -> DataFrame:
    """(path, line_no, line, reason, fatal) of the lines whose number of cells isn't that of ``k``."""
    reason, fatal = _problem(F.col("line"), F.col("line_no") == 0, k)
    return lines.where(F.col("error").isNull()).select("path", "line_no", "line", reason.alias("reason"), fatal.alias("fatal")).where(
        "reason IS NOT NULL")


def failed_files(lines: DataFrame, k: Kind) -> DataFrame:
    """(path, error) of the files that can't be taken: unreadable archives, and files with a line that
    makes them fail (the first such line is told)."""
    first = F.min(F.struct("line_no", "reason")).alias("f")
    lines_of = malformed(lines, k).where("fatal").groupBy("path").agg(first).select(
        "path", F.concat(F.lit("line "), (F.col("f.line_no") + 1).cast("string"), F.lit(": "), F.col("f.reason")).alias("error"))
    return bad_archives(lines).unionByName(lines_of)


def lines_without(lines: DataFrame, bad: DataFrame, name: Column) -> DataFrame:
    """The ``lines`` whose ``name`` isn't in ``bad`` (one column): few become a literal filter, and the
    lines stay where they are; more are joined."""
    few = bad.limit(LITERAL_FILES + 1).collect()
    if len(few) > LITERAL_FILES:
        return lines.join(bad.toDF("_bad"), name == F.col("_bad"), "left_anti")
    return lines.where(~name.isin([r[0] for r in few])) if few else lines


def parse_lines(lines: DataFrame, k: Kind, normalize: bool = True) -> DataFrame:
    """Rows of one kind from file lines; lines of too many cells are left out (see ``malformed``)."""
    kept = lines.where(F.col("error").isNull() & (cells_of(F.col("line")) <= len(k.columns))).select(
        "path", "line_no", "line", location_cells(F.col("path")).alias("_loc"))
    rows = _finish(_parsed(kept, "line", k), k, _located(F.col("_loc")), F.col("line_no"), normalize)
    return rows.withColumnRenamed("path", "_file").drop("line_no", "_loc")


def land_zip_dumps(spark: SparkSession, path: str, k: Kind, normalize: bool = True, on_bad: str = "fail") -> DataFrame:
    """SRC-4: zipped single-CSV dumps, which Spark's CSV reader does not open.  A corrupt or
    many-member archive and a line of too many cells fail the read; with ``on_bad="report"`` what
    they hold is absent and ``bad_archives`` and ``malformed`` of ``dump_lines`` name it."""
    lines = dump_lines(zip_files(spark, path))
    if on_bad == "fail":
        reason, _ = _problem(F.col("line"), F.lit(False), k)
        told = F.concat(F.col("path"), F.lit(": "), F.coalesce("error", reason))
        wrong = F.col("error").isNotNull() | (cells_of(F.col("line")) > len(k.columns))
        lines = lines.where(F.when(wrong, F.raise_error(told).cast("boolean")).otherwise(F.lit(True)))
    return parse_lines(lines, k, normalize)


def scan_kline_json(df: DataFrame, payload: str, k: Kind, normalize: bool = True) -> DataFrame:
    """SRC-5: an array-of-arrays payload (one REST page per row) -> one row per inner
    array, positional columns as text, the ms time columns as times."""
    arr = F.from_json(F.col(payload), T.ArrayType(T.ArrayType(T.StringType())))
    rows = df.select(*[c for c in df.columns if c != payload], F.posexplode(arr).alias("_pos", "_a"))
    out = rows.select(*[c for c in rows.columns if c not in ("_a",)],
                      *[F.try_element_at(F.col("_a"), F.lit(i + 1)).alias(c) for i, c in enumerate(k.columns)])
    if normalize:
        out = normalize_times(out, k.ms_time_cols)
    return out.withColumnRenamed("_pos", ROW)
