"""Reading stored and landed files without losing any, and reading only what is needed."""

import datetime as dt
import io
import os
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.registry import KINDS_BY_NAME
from tidemark.session import shared_dir
from tidemark.sinks.tables import read_table, write_files, write_table
from tidemark.sources.dumps import bad_archives, dump_lines, land_zip_dumps, zip_files
from tidemark.sources.series import scan_series, scan_tree
from tidemark.streaming.ingest import SERIES, store_schema, stored_part, upsert
from tidemark.operators.merge import tag

K = KINDS_BY_NAME["klines"]
METRICS = KINDS_BY_NAME["metrics"]


def rows(spark, values, k=K):
    """(symbol, time, second cell) as stored rows of a kind."""
    cells = [c for c in k.columns if c not in SERIES]
    df = spark.createDataFrame(values, "symbol string, t timestamp_ntz, x string")
    types = {f.name: f.dataType for f in store_schema(k).fields}
    out = [F.col("t").alias(c) if c == k.time_col else F.col("x").alias(c) if c == cells[1] else F.lit(None).cast(types[c]).alias(c) for c in cells]
    return df.select(*out, F.lit(k.name).alias("kind"), F.lit("1h" if k.per_interval else None).cast("string").alias("interval"), "symbol")


def at(day, hour=0):
    return dt.datetime(2024, 2, day, hour)


@pytest.mark.parametrize("k", [K, METRICS])
def test_upsert_reads_only_the_batch_s_series(spark, k):
    store = shared_dir(spark, "t_store")
    first = rows(spark, [(s, at(1, h), f"{s}{h}") for s in "ABCD" for h in range(5)], k)
    upsert(spark, tag(first, 1), store, k)
    batch = rows(spark, [("B", at(1, 3), "again"), ("B", at(1, 9), "new")], k)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = stored_part(spark, store, batch, k)._jdf.queryExecution().executedPlan().toString()
    found = [line for line in plan.splitlines() if "PartitionFilters" in line][0].split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert re.search(r"symbol#\d+ (= B|IN \(B\))", found), found
    fresh, latest = upsert(spark, tag(batch, 1), store, k)
    assert [r[k.time_col] for r in fresh.collect()] == [at(1, 9)]
    assert {r.path.split("/")[0]: r.last_ts for r in latest.collect()} == {"B": at(1, 9)}
    cell = [c for c in k.columns if c not in SERIES][1]
    stored = {(r.symbol, r[k.time_col].hour): r[cell] for r in scan_series(spark, store, store_schema(k)).collect()}
    assert len(stored) == 21 and stored["B", 3] == "B3" and stored["B", 9] == "new"


def test_replayed_rows_move_the_index_again(spark):
    store = shared_dir(spark, "t_store")
    batch = tag(rows(spark, [("A", at(3), "x"), ("Z", at(5), "y")]), 1)
    upsert(spark, batch, store, K)
    older = tag(rows(spark, [("A", at(2), "late")]), 1)
    fresh, latest = upsert(spark, older.unionByName(batch.where("symbol = 'A'")), store, K)
    assert fresh.count() == 1 and [(r.path, r.last_ts) for r in latest.collect()] == [("A/A_1h.parquet", at(3))]


def test_a_time_stored_as_text_is_never_skipped(spark):
    store = shared_dir(spark, "t_store")
    rows(spark, [("A", at(1), "typed")]).write.partitionBy(*SERIES).parquet(store)
    text = rows(spark, [("B", at(2), "text")]).withColumn("open_time", F.date_format("open_time", "yyyy-MM-dd"))
    text.write.mode("append").partitionBy(*SERIES).parquet(store)
    with pytest.raises(Exception, match="(?i)convert|read.*file|type"):
        scan_series(spark, store, store_schema(K)).collect()
    got = scan_series(spark, store, store_schema(K), legacy=True).collect()
    assert {(r.symbol, r.open_time, r.open) for r in got} == {("A", at(1), "typed"), ("B", at(2), "text")}
    upsert_into = tag(rows(spark, [("A", at(1), "late"), ("A", at(4), "new")]), 1)
    fresh, _ = upsert(spark, upsert_into, store, K)  # series A is typed: B's files aren't opened
    assert [r.open for r in fresh.collect()] == ["new"]


def test_a_broken_file_of_a_tree_is_a_row_with_its_error(spark):
    root = shared_dir(spark, "t_tree")
    rows(spark, [("A", at(1), "x")]).drop(*SERIES).coalesce(1).write.parquet(f"{root}/A/A_1d.parquet")
    write_files(spark.createDataFrame([("B/B_1d.parquet", "junk"), ("C_1d.csv", "time,open\n2024-02-03,1\nnever,2\n")], "path string, content string"), root)
    got = {r.path.split("/part-")[0]: r for r in scan_tree(spark, root).collect()}
    assert set(got) == {"A/A_1d.parquet", "B/B_1d.parquet", "C_1d.csv"}
    assert got["A/A_1d.parquet"].open_time == at(1) and got["A/A_1d.parquet"].error is None
    assert got["B/B_1d.parquet"].error and got["C_1d.csv"].open_time == at(3)


def test_an_empty_tree(spark):
    root = shared_dir(spark, "t_tree")
    os.makedirs(root.replace("file:", "", 1))
    assert scan_tree(spark, root).count() == 0


def archive(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in members:
            z.writestr(name, text)
    return bytearray(out.getvalue())


def test_bad_archives_fail_or_are_reported(spark):
    root = shared_dir(spark, "t_zip")
    line = "1706745600000,1.50000000,2\u2028x,3"  # a line separator inside a cell ends no line
    good = archive([("a.csv", f"open_time,open,high,low\r\n{line}\r\n\n")])
    files = [("daily/klines/A/1h/A-1h-2024-02-01.zip", good), ("daily/klines/B/1h/B-1h-2024-02-01.zip", bytearray(b"no archive")),
             ("daily/klines/C/1h/C-1h-2024-02-01.zip", archive([("a.csv", "1"), ("b.csv", "2")])), ("daily/klines/D/1h/D-1h-2024-02-01.zip", good[:-30])]
    write_files(spark.createDataFrame(files, "path string, content binary"), root)
    bad = bad_archives(dump_lines(zip_files(spark, root))).collect()
    assert sorted(r.path.split("/klines/")[1][0] for r in bad) == ["B", "C", "D"]
    got = land_zip_dumps(spark, root, K, on_bad="report").collect()
    assert [(r.symbol, r.open_time, r.open, r.high) for r in got] == [("A", at(1), "1.50000000", "2\u2028x")]
    with pytest.raises(Exception, match="members|BadZip|not a zip"):
        land_zip_dumps(spark, root, K).collect()


def test_a_table_is_replaced_in_versions(spark):
    root = shared_dir(spark, "t_table")
    write_table(spark.range(3), root)
    write_table(read_table(spark, root).where("id > 0"), root)
    assert sorted(r.id for r in read_table(spark, root).collect()) == [1, 2]


def test_single_files_need_a_mounted_folder(spark):
    with pytest.raises(ValueError, match="mounted"):
        write_files(spark.createDataFrame([("a", "b")], "path string, content string"), "s3a://bucket/x")
