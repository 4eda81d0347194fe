"""A store of cells: pruning by month, compaction with readers and crashes, and merges into buckets."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import merge_first_wins, tag
from tidemark.registry import KINDS_BY_NAME
from tidemark.session import shared_dir
from tidemark.sinks import store as cells
from tidemark.streaming.ingest import SERIES, store_schema, stored_part, upsert
from tests.test_ingest import rows

K = KINDS_BY_NAME["klines"]
SCHEMA = store_schema(K)


def at(month, day, hour=0):
    return dt.datetime(2024, month, day, hour)


def made(spark, batches):
    root = shared_dir(spark, "t_cells")
    cells.create_store(spark, root, SERIES)
    for b in batches:
        upsert(spark, tag(rows(spark, b), 1), root, K)
    return root


def content(spark, root, version=None):
    return sorted((r.symbol, r.open_time, r.open) for r in cells.scan_cells(spark, root, SCHEMA, SERIES, version).collect())


def per_cell(spark, root):
    return {(r.symbol, r.month): r["count"] for r in cells.live_files(spark, root, SERIES).groupBy("symbol", "month").count().collect()}


BATCHES = [[(s, at(m, d), f"{s}{m}{d}") for s in "AB" for m in (1, 2, 3)] for d in range(1, 3)]


def test_a_batch_of_a_day_opens_its_month_alone(spark):
    root = made(spark, BATCHES)
    batch = rows(spark, [("A", at(2, 9), "new"), ("A", at(2, 2), "seen")])
    found = stored_part(spark, root, batch, K).select(F.col("_metadata.file_path")).distinct().collect()
    assert found and all("/symbol=A/month=2024-02/" in r.file_path for r in found)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = stored_part(spark, root, batch, K)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert re.search(r"month#\d+ = 2024-02|month#\d+ >= 2024-02.*month#\d+ <= 2024-02", filters), filters
    fresh, latest = upsert(spark, tag(batch, 1), root, K)
    assert [r.open for r in fresh.collect()] == ["new"] and latest.first().last_ts == at(3, 2)


def test_compaction_keeps_rows_and_bounds_files(spark):
    root = made(spark, BATCHES)
    before, version = content(spark, root), cells.live_version(spark, root)
    assert set(per_cell(spark, root).values()) == {2}
    running = cells.scan_cells(spark, root, SCHEMA, SERIES)  # a reader that began before
    assert cells.compact_series(spark, root, SCHEMA, SERIES, "open_time") == 6
    assert set(per_cell(spark, root).values()) == {1}
    assert content(spark, root) == before == content(spark, root, version)
    assert sorted((r.symbol, r.open_time, r.open) for r in running.collect()) == before
    # appends go on, first wins still, and only the cells with new files are written again
    upsert(spark, tag(rows(spark, [("A", at(1, 1), "late"), ("A", at(1, 20), "more")]), 1), root, K)
    assert content(spark, root) == sorted([*before, ("A", at(1, 20), "more")])
    assert cells.compact_series(spark, root, SCHEMA, SERIES, "open_time") == 1
    assert cells.compact_series(spark, root, SCHEMA, SERIES, "open_time") == 0
    assert content(spark, root) == sorted([*before, ("A", at(1, 20), "more")])
    assert cells.vacuum_store(spark, root, SERIES) == 12 + 2
    assert content(spark, root) == sorted([*before, ("A", at(1, 20), "more")])
    assert cells.vacuum_store(spark, root, SERIES) == 0


def test_files_by_their_bytes(spark):
    """A cell of many bytes keeps several files, as many as its bytes need."""
    root = made(spark, [[("A", at(1, 1 + d, h), "x" * 2000 + str(h)) for h in range(24)] for d in range(4)])
    files = cells.live_files(spark, root, SERIES).collect()
    total = sum(r.length for r in files)
    target = total // 3 + 1
    cells.compact_series(spark, root, SCHEMA, SERIES, "open_time", target)
    assert per_cell(spark, root)["A", "2024-01"] <= -(-total // target) == 3
    assert len(content(spark, root)) == 96


def test_a_crash_between_write_and_switch(spark):
    root = made(spark, BATCHES)
    before = content(spark, root)
    gen, todo = cells.write_generation(spark, root, SCHEMA, SERIES, "open_time")
    assert gen == 1 and todo.count() == 6
    assert content(spark, root) == before  # what isn't published isn't there
    upsert(spark, tag(rows(spark, [("B", at(2, 28), "after")]), 1), root, K)
    want = sorted([*before, ("B", at(2, 28), "after")])
    assert content(spark, root) == want
    assert cells.compact_series(spark, root, SCHEMA, SERIES, "open_time") == 6
    assert content(spark, root) == want and set(per_cell(spark, root).values()) == {1}
    assert cells.vacuum_store(spark, root, SERIES) == 12 + 6 + 1
    assert content(spark, root) == want


def test_an_append_meanwhile_is_not_lost(spark):
    root = made(spark, BATCHES)
    gen, todo = cells.write_generation(spark, root, SCHEMA, SERIES, "open_time")
    upsert(spark, tag(rows(spark, [("B", at(2, 28), "after")]), 1), root, K)
    with pytest.raises(ValueError, match="appended while"):
        cells.publish(spark, root, SERIES, gen, todo)
    assert ("B", at(2, 28), "after") in content(spark, root)


def test_an_empty_store_and_null_intervals(spark):
    root = made(spark, [])
    assert content(spark, root) == [] and cells.compact_series(spark, root, SCHEMA, SERIES, "open_time") == 0
    k = KINDS_BY_NAME["metrics"]
    for d in (1, 2):
        upsert(spark, tag(rows(spark, [("A", at(1, d), "x")], k), 1), root, k)
    assert cells.compact_series(spark, root, store_schema(k), SERIES, k.time_col) == 1
    got = cells.scan_cells(spark, root, store_schema(k), SERIES).collect()
    assert [(r.interval, r.month) for r in got] == [(None, "2024-01")] * 2


def test_a_bucketed_merge_moves_no_stored_row(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.range(3000).select(F.concat(F.lit("S"), (F.col("id") % 7).cast("string")).alias("symbol"),
                                          F.timestamp_add("HOUR", F.floor(F.col("id") / 7).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("t"),
                                          F.col("id").cast("string").alias("v"))
        new = stored.where("symbol IN ('S1', 'S2')").withColumn("t", F.col("t") + F.expr("INTERVAL 3 DAY")).withColumn("v", F.concat(F.lit("n"), "v"))
        name = f"t_bucketed_{uuid.uuid4().hex}"
        cells.write_bucketed(stored, name, shared_dir(spark, "t_bucketed"), ["symbol"], "t", 4)
        merged = cells.merge_bucketed(spark, name, new, ["symbol"], "t")
        want = merge_first_wins(stored, new, ["symbol"], "t")
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, want.select("symbol", "t", "v").collect()))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        tree = plan.split("Initial Plan")[-1] if "Initial Plan" in plan else plan
        scans = [i for i, x in enumerate(tree.splitlines()) if f"{name}" in x and "Scan" in x]
        assert len(scans) == 2
        lines = tree.splitlines()
        depth = lambda x: len(x) - len(x.lstrip(" :+-|"))
        for i in scans:  # nothing above a scan of stored rows is an exchange, up to the join or the union
            here = depth(lines[i])
            for x in reversed(lines[:i]):
                if depth(x) < here:
                    here = depth(x)
                    assert "Exchange" not in x, tree
        assert "SortMergeJoin" in tree
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
