"""Metadata files: SRC-6 (exchange info), SRC-7 (symbol info), SRC-8 (index),
SRC-9 (symbol-list snapshots), SRC-10 (listing metadata).

Each JSON document is parsed by ``from_json`` into open ``map<string,string>`` records;
nested values stay JSON text.  Whole-document reads (``wholetext``) are used only for
formats that are one object per file; line layouts are split like any text file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import index_time, micros_to_time
from tidemark.operators.metadata import symbol_from_flat_name
from tidemark.sources.files import list_files, small_files

MAP_SS = T.MapType(T.StringType(), T.StringType())


def _path() -> F.Column:
    return F.url_decode(F.col("_metadata.file_path"))


def scan_exchange_info(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """SRC-6: one row per raw symbol object: ``(pos, raw)``.

    ``document``: files shaped ``{"symbols": [...]}`` (the exchange's reply), position =
    (file, index in the array).  ``lines``: one object per line, position = (file, split
    start, reading order).
    """
    if layout == "document":
        docs = spark.read.text(path, wholetext=True).select(_path().alias("_f"), "value")
        arr = F.from_json("value", T.StructType([T.StructField("symbols", T.ArrayType(T.StringType()))]))["symbols"]
        objs = docs.select("_f", F.posexplode(arr).alias("_i", "_o"))
        return objs.select(F.struct("_f", "_i").alias("pos"), F.from_json("_o", MAP_SS).alias("raw")) \
                   .where(F.col("raw").isNotNull())
    lines = spark.read.text(path).select(
        _path().alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_i"), "value")
    return lines.select(F.struct("_f", "_b", "_i").alias("pos"), F.from_json("value", MAP_SS).alias("raw")) \
                .where(F.col("raw").isNotNull())


def scan_symbol_info(spark: SparkSession, root: str, layout: str = "nested") -> DataFrame:
    """SRC-7: per-symbol JSON objects -> ``(symbol, info)``; unreadable or non-object
    content gives an empty record.  ``nested``: ``root/SYM/SYM_info.json``;
    ``flat``: legacy ``root/SYM_info.json``.  Tasks list the folders and read the files."""
    docs = small_files(list_files(spark, root, ("_info.json",), depth=2 if layout == "nested" else 1), root)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    info = F.coalesce(F.from_json("value", MAP_SS), F.create_map().cast(MAP_SS))
    return docs.select(symbol_from_flat_name(name).alias("symbol"), info.alias("info"))


def scan_index(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """SRC-8: an index file -> ``(path, last_text, last_ts)``; invalid JSON or an invalid
    time leaves the entry out.  ``object``: one JSON object per file (the source
    dataset's ``_index.json``); ``lines``: one object per line (splittable).
    Spark's file listing hides names starting with ``_`` or ``.``: a legacy ``_index.json``
    has to be copied to a visible name (e.g. ``index.json``) before it can be read."""
    if layout == "object":
        src = spark.read.text(path, wholetext=True)
    else:
        src = spark.read.text(path)
    entries = src.select(F.explode(F.from_json("value", MAP_SS)).alias("path", "last_text"))
    return entries.withColumn("last_ts", index_time("last_text")).where(F.col("last_ts").isNotNull())


def scan_snapshot(spark: SparkSession, path: str, source: str, priority: int,
                  ttl_hours: float | None = None) -> DataFrame:
    """SRC-9: ``{_fetched_at, symbols}`` snapshots -> long rows
    ``(source, priority, fetched_at, ttl_hours, symbol)``."""
    schema = T.StructType([T.StructField("_fetched_at", T.DoubleType()),
                           T.StructField("symbols", T.ArrayType(T.StringType()))])
    docs = spark.read.schema(schema).option("multiLine", "true").json(path)
    fetched = micros_to_time((F.col("_fetched_at") * 1_000_000).cast(T.LongType()))
    return docs.select(
        F.lit(source).alias("source"), F.lit(priority).alias("priority"), fetched.alias("fetched_at"),
        F.lit(ttl_hours).cast(T.DoubleType()).alias("ttl_hours"),
        F.explode(F.coalesce("symbols", F.array().cast(T.ArrayType(T.StringType())))).alias("symbol"),
    )


def scan_meta(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: listing metadata ``{SYM: {listing_date: ...}}`` -> ``(symbol, info)``; the object
    may fill a file or there may be one object to a line."""
    doc = spark.read.text(path, wholetext=True)
    kind = T.MapType(T.StringType(), MAP_SS)
    whole = F.from_json("value", kind)
    lines = spark.read.text(path).select(_path().alias("_f"), F.from_json("value", kind).alias("m")).where("m IS NOT NULL")
    broken = doc.where(whole.isNull() | F.col("value").rlike(r"\}\s*\n\s*\{")).select(_path().alias("_f"))
    by_line = lines.join(broken, "_f", "left_semi").select(F.explode("m").alias("symbol", "info"))
    doc = doc.where(whole.isNotNull() & ~F.col("value").rlike(r"\}\s*\n\s*\{"))
    m = whole
    return doc.select(F.explode(m).alias("symbol", "info")).unionByName(by_line)
