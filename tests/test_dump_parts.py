"""Dumps of many rows come in several files of bounded size, and first wins across them."""

import datetime as dt
import glob
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.plans.stream_plans import KLINES, kinds_landing
from tidemark.plans.surrogates import dump_files, numbered_parts, write_dump_files
from tidemark.plans.update import landed_source
from tidemark.session import shared_dir
from tidemark.sources.dumps import parse_dump_location
from tidemark.sources.series import scan_series
from tidemark.streaming.ingest import store_schema, stream_ingest, upsert

SF = "/root/testdata/sf0.001"
MS = 1706572800000  # 2024-01-30


def lines(spark, n=70):
    """One symbol and day; every hour's lines are spread over all event ids."""
    e = spark.range(n).select(F.lit("A").alias("symbol"), F.lit("2024-01-30").cast("date").alias("day"), F.col("id").alias("event_id"))
    cells = F.concat((F.lit(MS) + F.col("event_id") % 3 * 3_600_000).cast("string"), F.lit(","), F.col("event_id").cast("string"), F.lit("," * 10))
    return e.withColumn("line", cells)


@pytest.mark.parametrize("ids", [list(range(100)), [i * i * 7 - 50 for i in range(100)], list(range(30)) + [10**15 + i for i in range(70)]])
def test_parts_are_bounded_ranges_of_ids(spark, ids):
    df = spark.createDataFrame([("A", i) for i in ids], "d string, event_id long")
    parts = {}
    for r in numbered_parts(df, ["d"], 10).collect():
        parts.setdefault(r.part, []).append(r.event_id)
    assert sorted(parts) == list(range(len(parts))) and sorted(sum(parts.values(), [])) == sorted(ids)
    assert max(map(len, parts.values())) < 20 and len(parts) >= 6
    assert all(max(parts[p]) < min(parts[p + 1]) for p in range(len(parts) - 1))


@pytest.mark.parametrize("ext", ["csv", "zip"])
def test_first_line_wins_across_files(spark, ext):
    root = shared_dir(spark, "t_parts")
    write_dump_files(dump_files(lines(spark), ext, 7), root, ext == "zip")
    found = glob.glob(root.replace("file:", "", 1) + f"/daily/klines/A/1h/A-1h-2024-01-30*.{ext}")
    assert len(found) >= 9 and sum(".part" not in f for f in found) == 1
    in_order = sorted(found, key=lambda f: int(f.split(".part")[1].split(".")[0]) if ".part" in f else 0)
    times = [os.stat(f).st_mtime_ns // 1_000_000 for f in in_order]
    assert times == sorted(set(times))
    want = {dt.datetime(2024, 1, 30, h): str(h) for h in range(3)}

    plan = spark.createDataFrame([("daily/klines/A/1h/A-1h-2024-01-30.zip",)], "location string")
    rows, failures = landed_source(spark, root, KLINES, ext)(plan)
    assert rows.count() == 70 and failures.count() == 0
    fresh, _ = upsert(spark, rows, shared_dir(spark, "t_store"), KLINES)
    assert {r.open_time: r.open for r in fresh.collect()} == want

    store = shared_dir(spark, "t_store")  # a file to a batch: a later part must not come first
    stream_ingest(spark, root, store, shared_dir(spark, "t_index"), shared_dir(spark, "t_ckpt"), KLINES, max_files_per_trigger=1, ext=ext)
    stored = scan_series(spark, store, store_schema(KLINES))
    assert {r.open_time: r.open for r in stored.collect()} == want and "_part" not in stored.columns


def test_a_broken_part_fails_its_dump(spark):
    root = shared_dir(spark, "t_parts")
    write_dump_files(dump_files(lines(spark), "zip", 20), root, True)
    broken = glob.glob(root.replace("file:", "", 1) + "/daily/klines/A/1h/*.part1.zip")[0]
    with open(broken, "wb") as f:
        f.write(b"no archive")
    plan = spark.createDataFrame([("daily/klines/A/1h/A-1h-2024-01-30.zip",)], "location string")
    rows, failures = landed_source(spark, root, KLINES, "zip")(plan)
    assert rows.count() == 0
    assert [r.location for r in failures.collect()] == ["daily/klines/A/1h/A-1h-2024-01-30.zip"]


def test_part_numbers_of_locations(spark):
    names = ["daily/klines/A/1h/A-1h-2024-01-30.zip", "x/monthly/fundingRate/A/A-fundingRate-2024-01.part12.zip"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, p string").orderBy("i")
    loc = parse_dump_location(F.col("p"))
    got = [(r.symbol, str(r.period), r.part) for r in df.select(*[c.alias(n) for n, c in loc.items()]).collect()]
    assert got == [("A", "2024-01-30", 0), ("A", "2024-01-01", 12)]


def test_monthly_dumps_of_a_kind_are_cut(spark):
    root, manifest = kinds_landing(spark, SF, part_rows=20)
    sizes = []
    for f in glob.glob(root.replace("file:", "", 1) + "/monthly/fundingRate/*/*.zip"):
        with zipfile.ZipFile(f) as z:
            sizes.append(len(z.read(z.namelist()[0]).splitlines()))
    total = manifest.groupBy().sum("rows").first()[0]
    assert max(sizes) < 40 and sum(sizes) == total and len(sizes) > manifest.count()
