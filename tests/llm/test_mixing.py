"""Poisson replication: target shares, the distribution itself, edge cases."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


def docs(spark, sizes, extra=""):
    rows = [(i, f"t{i}", s) for s, n in sizes.items() for i in [len(sizes) * k + list(sizes).index(s) for k in range(n)]]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_sources_reach_their_weights(spark):
    got = Counter(r.source for r in mixing.mix(docs(spark, {"hot": 6000, "small": 300}), {"hot": 1, "small": 3}, total=4000).collect())
    assert abs(got["hot"] - 1000) < 5 * math.sqrt(1000) and abs(got["small"] - 3000) < 5 * math.sqrt(3000)


@pytest.mark.parametrize("rate", [0.2, 3.0, 8.0, 41.5])
def test_counts_are_poisson(spark, rate):
    n = 3000
    times = Counter(r.doc_id for r in mixing.mix(docs(spark, {"a": n}), total=round(n * rate)).select("doc_id").collect())
    counts = [times.get(i, 0) for i in range(n)]
    mean = sum(counts) / n
    spread = sum((c - mean) ** 2 for c in counts) / n
    assert abs(mean - rate) < 5 * math.sqrt(rate / n) and abs(spread / rate - 1) < 0.2
    if rate < 4:
        for k in range(4):
            p = math.exp(-rate) * rate**k / math.factorial(k)
            assert abs(sum(c == k for c in counts) - n * p) < 5 * math.sqrt(n * p) + 1


def test_cumulative_table_reaches_one(spark):
    table = spark.range(1).select(mixing.cumulative(F.lit(mixing.STEP))).first()[0]
    assert len(table) == mixing.TERMS and table[-1] == pytest.approx(1, abs=1e-15) and table == sorted(table)


def test_the_order_is_shuffled_and_fixed(spark):
    d = docs(spark, {"a": 500, "b": 500})
    one, again, other = [[(r.doc_id, r.copy) for r in mixing.mix(d, seed=s).collect()] for s in (1, 1, 2)]
    assert one == again and sorted(one) != sorted(other) and one != sorted(one)


def test_many_sources_go_by_a_shuffle(spark, monkeypatch):
    d = docs(spark, {"a": 300, "b": 40})
    want = sorted(map(tuple, mixing.mix(d).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing.mix(d).collect())) == want


def test_nulls_repeats_and_other_columns(spark):
    rows = [(None, None, None, 1)] * 50 + [(1, "x", None, 2), (1, "x", None, 2)] + [(2, "", "s", 3)] * 3
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, _rate int")
    got = mixing.mix(d.drop("_rate"), total=550).collect()
    by = Counter((r.doc_id, r.source) for r in got)
    assert by[(None, None)] % 50 == 0 and by[(1, None)] % 2 == 0 and by[(2, "s")] % 3 == 0
    assert max(r.copy for r in got) > 1
    clash = mixing.mix(d.withColumnRenamed("_rate", "copy").withColumn("_rate", d["doc_id"]).limit(10), total=40)
    assert clash.columns == ["doc_id", "text", "source", "copy", "_rate", "copy_"] and clash.count() > 0
    assert mixing.mix(d.limit(0)).count() == 0
    assert Counter(r.source for r in mixing.mix(d.drop("_rate"), {"s": 1.0}, total=300).collect()).keys() <= {"s"}


def test_rows_without_an_id_spread(spark):
    """Copies of rows that have no id lie in all tasks, not in the few of one hash."""
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"),
                                    F.lit("s").alias("source"), F.create_map(F.lit("k"), "id").alias("m"))
    got = mixing.mix(docs, total=8000)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 2 * sum(sizes) / len(sizes)
    # one draw for all that have the same (no) id
    assert got.groupBy("text").count().select("count").distinct().count() <= 1
