"""Order and bounds of admissions, malformed lines, and dumps larger than what a task holds."""

import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.plans.stream_plans import KLINES
from tidemark.plans.update import landed_source
from tidemark.session import shared_dir
from tidemark.sinks.tables import write_files
from tidemark.sources import dumps
from tidemark.sources.dumps import cells_of, dump_lines, failed_files, land_zip_dumps, landed_files, malformed, scan_dump
from tidemark.sources.series import scan_series
from tidemark.streaming.admission import admission_order, admit
from tidemark.streaming.ingest import store_schema, stream_ingest

DAY = 86_400_000
T0 = 1_706_572_800_000  # 2024-01-30


def line(day, cell, extra=0):
    return ",".join([str(T0 + day * DAY), str(cell)] + [""] * (10 + extra))


def location(symbol, stamp, ext="csv", freq="daily", part=""):
    return f"{freq}/klines/{symbol}/1h/{symbol}-1h-{stamp}{part}.{ext}"


def archive(text):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.csv", text)
    return bytearray(out.getvalue())


def land(spark, files, ext="csv"):
    root = shared_dir(spark, "t_landing")
    rows = [(p, archive(t) if ext == "zip" else bytearray(t.encode())) for p, t in files]
    write_files(spark.createDataFrame(rows, "path string, content binary"), root)
    return root


def test_order_of_admissions():
    names = [location("A", "2024-01-31"), location("A", "2024-01-02"), location("A", "2024-01", freq="monthly"), location("A", "2024-01-01", part=".part2"),
             location("A", "2024-01-01"), location("A", "2024-01-01", part=".part10"), "odd.csv"]
    got = sorted(names, key=admission_order)
    assert got == [names[2], names[4], names[3], names[5], names[1], names[0], names[6]]
    files = [(n, 10) for n in names]
    assert [p for p, _ in admit(files, 30, None)] == got[:3] and [p for p, _ in admit(files, None, 2)] == got[:2]
    assert [p for p, _ in admit(files, 1, None)] == got[:1] and len(admit(files, None, None)) == 7 and admit([], 5, 5) == []


def test_periods_come_in_order_whatever_the_modification_times(spark):
    """A month's dump holds the same time as a later one; newest files first by their times."""
    files = [(location("A", "2024-01-31"), line(1, "day") + "\n" + line(0, "late")), (location("A", "2024-01", freq="monthly"), line(0, "month")),
             (location("A", "2024-01-30"), line(0, "own day"))]
    root = land(spark, files)
    base = root.replace("file:", "", 1)
    for i, (p, _) in enumerate(files):  # the last of the periods is the oldest file
        os.utime(os.path.join(base, p), (1_000_000 + i, 1_000_000 + i))
    checkpoint, store, index = (shared_dir(spark, f"t_{x}") for x in ("ckpt", "store", "index"))
    size = max(os.path.getsize(os.path.join(base, p)) for p, _ in files)
    stream_ingest(spark, root, store, index, checkpoint, KLINES, max_bytes_per_trigger=size)
    log = checkpoint.replace("file:", "", 1) + "_admissions"
    admitted = [[p.split("/klines/")[0].rsplit("/", 1)[-1] for p, _ in json.load(open(os.path.join(log, n)))] for n in sorted(os.listdir(log))]
    assert admitted == [["monthly"], ["daily"], ["daily"]]
    got = {r.open for r in scan_series(spark, store, store_schema(KLINES)).collect()}
    assert got == {"month", "day"}
    # a restart admits only what is new, though its period is older
    more = [(location("A", "2024-01-29"), line(-1, "older")), (location("B", "2024-01-31"), line(1, "b"))]
    write_files(spark.createDataFrame([(p, bytearray(t.encode())) for p, t in more], "path string, content binary"), root)
    stream_ingest(spark, root, store, index, checkpoint, KLINES)
    assert len(os.listdir(log)) == 4 and {r.open for r in scan_series(spark, store, store_schema(KLINES)).collect()} == {"month", "day", "older", "b"}


QUOTED = [('a,b', 2), ('"a,b",c', 2), (r'"x \"y, z\" w",1,', 3), ('"say ""hi, you""",2', 2), ('', 1), ('"' + 'q,' * 30_000 + '",1', 2), ("," * 5, 6)]


def test_cells_are_counted_outside_quotes(spark):
    df = spark.createDataFrame(QUOTED, "line string, n int")
    assert [(r.n, r.c) for r in df.select("n", cells_of(F.col("line")).alias("c")).collect()] == [(n, n) for _, n in QUOTED]


@pytest.mark.parametrize("ext", ["csv", "zip"])
def test_malformed_lines_are_told(spark, ext):
    good = line(0, "good")
    files = [(location("G", "2024-01-30", ext), good), (location("W", "2024-01-30", ext), good + "\n" + line(1, "wide", 2) + "\n" + line(2, "after")),
             (location("N", "2024-01-30", ext), good + "\n" + "1,2,3\n"), (location("F", "2024-01-30", ext), "1,2,3\n" + good)]
    root = land(spark, files, ext)
    lines = dump_lines(landed_files(spark, root, ext))
    told = {(r.path.split("/")[-3], r.line_no, r.reason, r.fatal) for r in malformed(lines, KLINES).collect()}
    assert told == {("W", 1, "14 cells, 12 expected", True), ("N", 1, "3 cells, 12 expected", False), ("F", 0, "3 cells, 12 expected", True)}
    assert {(r.path.split("/")[-3], r.error) for r in failed_files(lines, KLINES).collect()} == {
        ("W", "line 2: 14 cells, 12 expected"), ("F", "line 1: 3 cells, 12 expected")}
    plan = spark.createDataFrame([(location(s, "2024-01-30", "zip"),) for s in "GWNF"], "location string")
    rows, failures = landed_source(spark, root, KLINES, ext)(plan)
    assert sorted(r.symbol for r in rows.collect()) == ["G", "N", "N"]  # a short line is read, its rest is NULL
    assert {r.location for r in failures.collect()} == {location(s, "2024-01-30", "zip") for s in "WF"}
    read = scan_dump if ext == "csv" else land_zip_dumps
    with pytest.raises(Exception, match="14 cells, 12 expected"):
        read(spark, root, KLINES).collect()
    assert {r.open for r in read(spark, root, KLINES, on_bad="report").where("symbol = 'W'").collect()} == {"good", "after"}


@pytest.mark.parametrize("ext", ["csv", "zip"])
def test_only_planned_dumps_are_opened(spark, ext):
    files = [(location("A", "2024-01-30", ext), line(0, "a")), (location("B", "2024-01-30", ext), line(0, "b"))]
    root = land(spark, files, ext)
    # a dump that would be an error if it were opened
    other = os.path.join(root.replace("file:", "", 1), files[1][0])
    with open(other, "wb") as f:
        f.write(b"no archive" if ext == "zip" else (line(0, "wide", 3) + "\n").encode())
    plan = spark.createDataFrame([(location("A", "2024-01-30", "zip"),)], "location string")
    rows, failures = landed_source(spark, root, KLINES, ext)(plan)
    assert [r.open for r in rows.collect()] == ["a"] and failures.count() == 0


def test_an_archive_is_read_as_a_stream(monkeypatch, tmp_path):
    """Far more text than is held at a time: batches stay small, and no read asks for it all."""
    path = str(tmp_path / "A-1h-2024-01-30.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open("x.csv", "w", force_zip64=True) as f:
        for i in range(60):
            f.write((line(i, "x" * 900) + "\n").encode() * 1000)
    asked = []
    from tidemark.sources.files import Counted
    plain = Counted.read
    monkeypatch.setattr(Counted, "read", lambda self, n=-1: asked.append(n) or plain(self, n))
    monkeypatch.setattr(dumps, "_CHUNK_SIZE", 1 << 20)
    import pyarrow as pa

    sizes = [b.nbytes for b in dumps._read_lines([pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])])]
    assert sum(sizes) > 50_000_000 and max(sizes) < 3_000_000 and max(n or 0 for n in asked) <= 1 << 20
