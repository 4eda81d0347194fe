"""Work and memory that grow no faster than the input."""

import datetime as dt
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark.operators.calendar import PLAN, gap_plan
from tidemark.operators.merge import dedupe_new
from tidemark.registry import KINDS_BY_NAME
from tidemark.session import shared_dir
from tidemark.sinks.tables import write_files
from tidemark.sources.dumps import LINES, location_cells, parse_lines
from tidemark.sources.files import list_files
from tidemark.sources.series import _file_times, scan_tree


def test_a_line_is_parsed_once(spark):
    rows = parse_lines(spark.createDataFrame([], LINES), KINDS_BY_NAME["klines"]).drop("_file")
    plan = dedupe_new(rows, ["kind", "interval", "symbol"], "open_time")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1 and plan.count("regexp_replace(path") == 1


def test_location_cells(spark):
    paths = [("/x/daily/y/daily/klines/A/1h/A-1h-2024-01-30.part2.zip",), ("monthly/fundingRate/A/A-fundingRate-2024-01.csv",), ("none",)]
    got = [r[0] for r in spark.createDataFrame(paths, "p string").select(location_cells(F.col("p"))).collect()]
    assert got == [["daily", "klines", "A", "1h", "2024-01-30", "2"], ["monthly", "fundingRate", "A", "", "2024-01", ""], ["none"]]


def test_rows_of_many_files_share_batches(spark, tmp_path):
    root = str(tmp_path)
    paths = [f"S{i}_1h.parquet" for i in range(40)] + [f"S{i}_metrics.parquet" for i in range(40)] + [f"S{i}_1h.csv" for i in range(40)]
    for p in paths:
        if p.endswith(".csv"):
            open(os.path.join(root, p), "w").write('\nopen_time,x\n"2024-03-01 07:00:00",1\n2024-03-01 06:00:00,"a,b"\n \n')
        else:
            times = ["2024-03-02 01:00:00"] if "metrics" in p else [dt.datetime(2024, 3, 1)]
            pq.write_table(pa.table({"create_time" if "metrics" in p else "open_time": times}), os.path.join(root, p))
    batch = pa.RecordBatch.from_arrays([pa.array(paths)], names=["path"])
    assert len(list(_file_times(root)([batch]))) == 3  # one batch for a file before
    got = {r.path: (r.open_time, r.create_time, r.format) for r in scan_tree(spark, root).collect()}
    assert len(got) == 120
    assert got["S0_1h.csv"] == (dt.datetime(2024, 3, 1, 7), None, "csv")
    assert got["S0_metrics.parquet"] == (None, dt.datetime(2024, 3, 2, 1), "parquet")


def test_listing_depth(spark, tmp_path):
    root = str(tmp_path)
    for p in ("a_info.json", "x/b_info.json", "x/y/c_info.json"):
        os.makedirs(os.path.dirname(os.path.join(root, p)), exist_ok=True)
        open(os.path.join(root, p), "w").write("{}")
    found = lambda depth: {r.path for r in list_files(spark, root, ("_info.json",), depth=depth).collect()}
    assert (found(1), found(2)) == ({"a_info.json"}, {"x/b_info.json"})
    assert found(None) == {"a_info.json", "x/b_info.json", "x/y/c_info.json"}


def test_contents_are_made_a_few_at_a_time(spark):
    def named(batches):
        for pdf in batches:
            yield pd.DataFrame({"path": [f"{i}-{len(pdf)}" for i in pdf["i"]], "content": pdf["content"]})

    root = shared_dir(spark, "t_contents")
    rows = spark.range(0, 48, 1, 1).select(F.col("id").alias("i"), F.repeat(F.lit("x"), F.lit(1 << 20)).alias("content"))
    write_files(rows.mapInPandas(named, "path string, content string"), root)
    sizes = [int(f.split("-")[1]) for f in os.listdir(root)]
    assert len(sizes) == 48 and max(sizes) < 24  # 16 MB a batch; all 48 before


JOB, MANIFEST = "symbol string, kind string, interval string, last_ts timestamp_ntz", "symbol string, kind string, interval string, freq string, period date, rows long"


def test_the_keys_of_a_gap_plan_are_dealt_over_all_partitions(spark):
    jobs = [(f"S{i}", "klines", "1d", dt.datetime(2024, 1, 9)) for i in range(300)]
    manifest = [(s, k, i, "monthly", dt.date(2024, 1, 1), 1) for s, k, i, _ in jobs[:200]]
    jobs, manifest = (spark.createDataFrame(*x).coalesce(1) for x in ((jobs, JOB), (manifest, MANIFEST)))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        end = F.lit(dt.date(2024, 2, 3))
        plan = gap_plan(jobs, manifest, end)
        got = {f: plan.where(F.col("freq") == f).groupBy(F.spark_partition_id().alias("task")).count().collect() for f in ("monthly", "daily")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert {f: sum(r["count"] for r in rows) for f, rows in got.items()} == {"monthly": 200, "daily": 300 * 3 + 100 * 31}
    assert {f: len(rows) for f, rows in got.items()} == {"monthly": 4, "daily": 4}  # one task for each before


def test_gap_plan_of_repeated_and_null_keys(spark):
    day = dt.date
    months = lambda *m: [day(2024, x, 1) for x in m]
    jobs = [("A", "klines", "1h", dt.datetime(2024, 1, 15))] * 2 + [
        ("F", "fundingRate", None, dt.datetime(2024, 1, 1)), ("F", "fundingRate", "", dt.datetime(2024, 2, 1)), (None, "klines", "1h", dt.datetime(2024, 2, 20))]
    manifest = [("A", "klines", "1h", "monthly", months(1)[0], 5)] * 3 + [
        ("A", "klines", "1h", "monthly", months(2)[0], 0), ("A", "klines", "1h", "daily", months(2)[0], 9), ("A", "klines", "2h", "monthly", months(2)[0], 9),
        ("F", "fundingRate", "", "monthly", months(2)[0], 1), (None, "klines", "1h", "monthly", months(2)[0], 3), ("Z", "klines", "1h", "monthly", months(2)[0], 3),
        ("A", "klines", "1h", "monthly", None, 3)]
    jobs, manifest = spark.createDataFrame(jobs, JOB), spark.createDataFrame(manifest, MANIFEST)
    end = F.lit(day(2024, 3, 10))
    days = [day(2024, 2, d) for d in range(1, 30)] + [day(2024, 3, d) for d in range(1, 11)]
    want = [("A", "klines", "1h", "monthly", months(1)[0])] * 2 + [("F", "fundingRate", i, "monthly", months(2)[0]) for i in (None, "")]
    want += [(s, "klines", "1h", "daily", d) for s in ("A", None) for d in days]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in gap_plan(jobs, manifest, end).select(*PLAN).collect())
