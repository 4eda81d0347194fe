"""Footer reads and listing in tasks: which bytes and which files are touched."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from tidemark.operators.index import rebuild_index
from tidemark.sources.files import glob_of, list_files
from tidemark.sources.series import audit_summary, scan_audit, scan_series, scan_tree

T0 = dt.datetime(2024, 3, 1)


def put(root, path, times, column="open_time", rows=None, **options):
    where = os.path.join(root, path)
    os.makedirs(os.path.dirname(where), exist_ok=True)
    n = len(times)
    pad = pa.array([os.urandom(400).hex() for _ in range(n)]) if rows else pa.array(["x"] * n)
    pq.write_table(pa.table({column: times, "pad": pad}), where, row_group_size=rows or n or 1, **options)
    return where


def hours(n, kind=None):
    return pa.array([T0 + dt.timedelta(hours=i) for i in range(n)], kind or pa.timestamp("us"))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tree")


def rows(df, *columns):
    return {r.path: tuple(r[c] for c in columns) for r in df.collect()}


def test_footers_alone_are_read(spark, root):
    size = os.path.getsize(put(root, "AAA/AAA_1h.parquet", hours(5000), rows=500))
    got = scan_tree(spark, root).first()
    assert got.open_time == T0 + dt.timedelta(hours=4999) and got.error is None
    assert size > 3_000_000 and got.bytes <= 70_000
    audited = scan_audit(spark, root).first()
    assert (audited.rows, audited.status) == (5000, "indexable") and audited.bytes <= 70_000


def test_text_times_and_columns_without_statistics(spark, root):
    whole = {}
    whole["T"] = os.path.getsize(put(root, "T/T_metrics.parquet", pa.array(["2024-03-02 01:00:00", "none", "2024-03-01"] * 900), "create_time", 300))
    whole["S"] = os.path.getsize(put(root, "S/S_1h.parquet", hours(3000), rows=300, write_statistics=False))
    put(root, "N/N_1h.parquet", pa.nulls(20, pa.timestamp("us")))
    put(root, "Z/Z_1h.parquet", hours(30, pa.timestamp("ns", "Asia/Tokyo")))
    put(root, "D/D_1h.parquet", pa.array([dt.date(2024, 3, 5), None]))
    got = rows(scan_tree(spark, root), "open_time", "create_time", "bytes")
    assert got["T/T_metrics.parquet"][1] == dt.datetime(2024, 3, 2, 1)
    assert got["S/S_1h.parquet"][0] == T0 + dt.timedelta(hours=2999)
    assert got["N/N_1h.parquet"][0] is None
    assert got["Z/Z_1h.parquet"][0] == T0 + dt.timedelta(hours=29)
    assert got["D/D_1h.parquet"][0] == dt.datetime(2024, 3, 5)
    # the time column is read, not what stands beside it
    assert got["S/S_1h.parquet"][2] < whole["S"] / 3 and got["T/T_metrics.parquet"][2] < whole["T"] / 3


def test_broken_empty_and_hidden_files(spark, root):
    good = put(root, "A/A_1h.parquet", hours(3))
    for name, content in (("B/B_1h.parquet", b"PAR1 but not really"), ("C/C_1h.parquet", b""), ("A/_SUCCESS.parquet", b"x"),
                          ("A/.A_1h.parquet", b"x"), ("CUT/CUT_1h.parquet", open(good, "rb").read()[:-20])):
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        open(os.path.join(root, name), "wb").write(content)
    put(root, "P/P_1h.parquet", pa.array([1, 2]), "other")
    got = rows(scan_audit(spark, root), "status", "rows")
    assert got == {"A/A_1h.parquet": ("indexable", 3), "B/B_1h.parquet": ("unreadable", None), "C/C_1h.parquet": ("empty", 0),
                   "CUT/CUT_1h.parquet": ("unreadable", None), "P/P_1h.parquet": ("no time column", 2)}
    assert audit_summary(scan_audit(spark, root)).first().scanned == 5
    tree = rows(scan_tree(spark, root), "error")
    assert {p for p, (e,) in tree.items() if e} == {"B/B_1h.parquet", "CUT/CUT_1h.parquet"} and "C/C_1h.parquet" not in tree


def test_a_scoped_rebuild_opens_its_symbols_only(spark, root):
    for s in ("AAA", "AAB", "B{1}", "ÄÖ"):
        put(root, f"{s}/{s}_1h.parquet", hours(4))
        put(root, f"{s}_1d.parquet", hours(2))
        open(os.path.join(root, f"{s}_1h.csv"), "w").write("open_time,x\n2024-03-01 07:00:00,1\n")
    for s in ("AAB", "ZZZ"):  # opening any of these would show as an error
        os.makedirs(os.path.join(root, s), exist_ok=True)
        open(os.path.join(root, s, f"{s}_4h.parquet"), "wb").write(b"broken")
    tree = scan_tree(spark, root, ["AAA", "B{1}", "ÄÖ", "none"])
    got = rows(tree, "error")
    assert set(got) == {x for s in ("AAA", "B{1}", "ÄÖ") for x in (f"{s}/{s}_1h.parquet", f"{s}_1d.parquet", f"{s}_1h.csv")}
    assert all(e is None for e, in got.values())
    index = rows(rebuild_index(tree, symbols=["AAA"]), "last_ts")
    assert index == {"AAA/AAA_1h.parquet": (T0 + dt.timedelta(hours=3),), "AAA_1d.parquet": (T0 + dt.timedelta(hours=1),),
                     "AAA_1h.csv": (T0 + dt.timedelta(hours=7),)}


def test_listing(spark, root):
    for p in ("a.parquet", "x/b.parquet", "x/y/z/c.parquet", "x/d.csv", "k=1/e.parquet", "_t/f.parquet"):
        put(root, p, hours(1))
    assert {r.path for r in list_files(spark, root, (".parquet",)).collect()} == {"a.parquet", "x/b.parquet", "x/y/z/c.parquet", "k=1/e.parquet"}
    only = list_files(spark, "file://" + root, (".parquet", ".csv"), spark.createDataFrame([("x",)], "f string"))
    assert {r.path for r in only.collect()} == {"a.parquet", "x/b.parquet", "x/y/z/c.parquet", "x/d.csv"}
    assert list_files(spark, root + "/none", (".parquet",)).count() == 0
    assert glob_of(["a", "b*"]) == "{a,b\\*}"


def test_the_driver_holds_no_paths(spark, root, monkeypatch):
    """The audit's plan has no list of files, and nothing asks for one."""
    put(root, "A/A_1h.parquet", hours(2))
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    for name in ("inputFiles", "collect", "toLocalIterator", "toPandas"):
        monkeypatch.setattr(Classic, name, lambda *_: pytest.fail("paths in the driver"))
    audited = scan_audit(spark, root)
    assert "A_1h" not in audited._jdf.queryExecution().toString()
    assert audited.count() == 1


def test_a_legacy_store_is_read_a_row_group_at_a_time(spark, root):
    put(root, "symbol=A/one.parquet", hours(3000), rows=100)
    put(root, "symbol=B/two.parquet", pa.array(["2024-03-01 01:00:00", "bad"]))
    schema = T.StructType([T.StructField("open_time", T.TimestampNTZType()), T.StructField("pad", T.StringType()), T.StructField("symbol", T.StringType())])
    got = scan_series(spark, root, schema, legacy=True)
    assert got.groupBy("symbol").count().orderBy("symbol").collect() == [("A", 3000), ("B", 2)]
    assert got.where("symbol = 'B' AND open_time IS NULL").count() == 1
    open(os.path.join(root, "bad.parquet"), "wb").write(b"none")
    with pytest.raises(Exception, match="unreadable series file bad.parquet"):
        scan_series(spark, root, schema, legacy=True).count()


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    """A task writes some of its files and fails: none is there, nor anything half-written."""
    from pyspark.sql import functions as F

    from tidemark.sinks.tables import write_files

    root = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"D/f{i}.txt", f"text {i}", i) for i in range(30)], "path string, content string, n int").coalesce(1)
    bad = rows.withColumn("content", F.when(F.col("n") == 29, F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("content")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        with pytest.raises(Exception, match="broken row"):
            write_files(bad, root)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    left = [f for _, _, names in os.walk(root) for f in names]
    assert left == []
    write_files(rows, "file://" + root)
    assert sorted(os.listdir(root + "/D")) == sorted(f"f{i}.txt" for i in range(30))
    assert open(root + "/D/f7.txt").read() == "text 7"
