"""Rules on small frames: leap years, year ends, ends on the first of a month, ties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import calendar as C
from tidemark.functions.paths import dump_location, parse_series_path, series_path
from tidemark.functions.times import index_text, ms_to_time, text_to_time
from tidemark.operators.calendar import daily_fallback, plan_periods
from tidemark.operators.index import latest_time, needs_update, rebuild_index
from tidemark.operators.merge import merge_first_wins, new_rows_only, tag
from tidemark.operators.metadata import MAP_SS, explode_info, migrate_info, overlay_info
from tidemark.operators.universe import build_jobs, first_available, futures_universe
from tidemark.registry import FUTURES_KINDS, INTERVALS, KINDS_BY_NAME, SPOT_KINDS

DAY, AT = dt.date, dt.datetime


def days(first: DAY, last: DAY) -> list[DAY]:
    return [first + dt.timedelta(i) for i in range((last - first).days + 1)]


def firsts(first: DAY, last: DAY) -> list[DAY]:
    return [d for d in days(first, last) if d.day == 1]


# ---- times and paths ----------------------------------------------------------

@pytest.mark.parametrize("text,micros", [
    ("0", 0), ("-86400000", -86_400_000_000), ("2.25", 2_250), (" 7 ", 7_000), ("4e2", 400_000),
    ("", None), ("seven", None), ("9223372036854775", None),  # beyond the nanosecond clock
])
def test_milliseconds(spark, text, micros):
    got = spark.createDataFrame([(text,)], "t string").select(ms_to_time("t")).first()[0]
    assert got == (None if micros is None else AT(1970, 1, 1) + dt.timedelta(microseconds=micros))


@pytest.mark.parametrize("text,time", [
    ("2024-02-29 23:59:59", AT(2024, 2, 29, 23, 59, 59)), ("2024-02-29", AT(2024, 2, 29)), (" 1999-12-31 ", AT(1999, 12, 31)),
    ("2023-02-29", None), ("soon", None), ("", None), (None, None),
])
def test_time_text(spark, text, time):
    assert spark.createDataFrame([(text,)], "t string").select(text_to_time("t")).first()[0] == time


@pytest.mark.parametrize("kind", [k.name for k in FUTURES_KINDS])
def test_series_path_round_trip(spark, kind):
    k = KINDS_BY_NAME[kind]
    symbols = ["AAA", "fundingRateX", "A_1d", "A_metrics_B"]  # also ones that look like other kinds
    rows = [(s, i) for s in symbols for i in (k.intervals[:2] or [None])]
    df = spark.createDataFrame(rows, "s string, i string")
    paths = df.select("s", "i", series_path("s", F.lit(k.suffix), F.lit(k.per_interval), "i").alias("path"))
    for r in parse_series_path(paths).collect():
        assert (r.symbol, r.kind, r.interval, r.layout) == (r.s, kind, r.i, "nested")


def test_flat_path(spark):
    r = parse_series_path(spark.createDataFrame([("QQQ_12h.csv",)], "path string")).first()
    assert (r.symbol, r.kind, r.interval, r.layout) == ("QQQ", "klines", "12h", "flat")


def test_dump_location_follows_frequency(spark):
    for k in FUTURES_KINDS:
        for freq, stamp in (("daily", "2031-03-01"), ("monthly", "2031-03")):
            itv = INTERVALS[-1] if k.per_interval else None
            df = spark.createDataFrame([("XYZ", itv, DAY(2031, 3, 1))], "s string, i string, p date")
            got = df.select(dump_location(F.lit(k.segment), F.lit(k.per_interval), "s", "i", F.lit(freq), "p")).first()[0]
            middle = ["XYZ", itv] if itv else ["XYZ"]
            assert got == "/".join([freq, k.segment, *middle, f"XYZ-{itv or k.name}-{stamp}.zip"])


def test_kinds():
    assert {k.segment for k in FUTURES_KINDS if k.per_interval} == {"klines"} | {
        k.name + "Klines" for k in FUTURES_KINDS if k.per_interval and k.name != "klines"}
    assert all(k.time_col in k.columns and set(k.ms_time_cols) <= set(k.columns) for k in FUTURES_KINDS + SPOT_KINDS)


# ---- months and plans ----------------------------------------------------------

@pytest.mark.parametrize("a,b", [(DAY(2023, 12, 1), DAY(2024, 3, 1)), (DAY(2024, 2, 1), DAY(2024, 2, 1)), (DAY(2024, 5, 1), DAY(2024, 1, 1))])
def test_months(spark, a, b):
    got = spark.createDataFrame([(a, b)], "a date, b date").select(C.months("a", "b")).first()[0]
    assert got == [m for m in firsts(a, b) if m < b]


def periods(spark, kind, last, end):
    itv = "4h" if KINDS_BY_NAME[kind].per_interval else None
    jobs = spark.createDataFrame([("PPP", kind, itv, last)], "symbol string, kind string, interval string, last_ts timestamp_ntz")
    rows = plan_periods(jobs, F.lit(end)).collect()
    return [sorted(r.period for r in rows if r.freq == f) for f in ("monthly", "daily")]


LEAP_END = DAY(2024, 2, 29)
FIRST_END = DAY(2025, 1, 1)


def test_a_new_series_is_planned_from_its_first_month(spark):
    for k in FUTURES_KINDS:
        months, dates = periods(spark, k.name, None, LEAP_END)
        since = DAY.fromisoformat(k.since + "-01")
        if k.published == {"monthly", "daily"}:
            assert months == [m for m in firsts(since, LEAP_END) if m < DAY(2024, 2, 1)] and dates == days(DAY(2024, 2, 1), LEAP_END)
        elif k.published == {"daily"}:
            assert months == [] and dates == days(since, LEAP_END)
        else:
            assert months == firsts(since, LEAP_END) and dates == []


def test_an_end_on_the_first_of_a_month_has_one_day(spark):
    assert periods(spark, "klines", AT(2024, 11, 15), FIRST_END) == [[DAY(2024, 11, 1), DAY(2024, 12, 1)], [FIRST_END]]


def test_a_series_current_within_the_month_needs_days_only(spark):
    assert periods(spark, "markPrice", AT(2024, 2, 27, 8), LEAP_END) == [[], days(DAY(2024, 2, 27), LEAP_END)]


def test_a_series_ahead_of_the_end_needs_nothing(spark):
    assert periods(spark, "klines", AT(2024, 3, 1), LEAP_END) == [[], []]


def test_missing_months_fall_back_to_days_for_two_months(spark):
    schema = "symbol string, kind string, interval string, freq string, period date, rows long"
    end = DAY(2024, 3, 2)
    for kind, last, first in (("klines", AT(2019, 5, 5), DAY(2024, 1, 1)), ("fundingRate", AT(2023, 12, 3), None)):
        itv = "4h" if KINDS_BY_NAME[kind].per_interval else None
        jobs = spark.createDataFrame([("PPP", kind, itv, last)], "symbol string, kind string, interval string, last_ts timestamp_ntz")
        plan = plan_periods(jobs, F.lit(end))
        got = sorted(r.period for r in daily_fallback(plan, spark.createDataFrame([], schema), F.lit(end)).collect())
        assert got == ([] if first is None else days(first, end))


# ---- merge, index, universe -----------------------------------------------------

def test_stored_rows_win_over_text_times(spark):
    stored = spark.createDataFrame([("Q", AT(2024, 2, 28), "keep"), ("Q", AT(2024, 2, 29), "0.50")],
                                   "symbol string, open_time timestamp_ntz, close string")
    new = spark.createDataFrame([("Q", "2024-02-29", "0.5"), ("Q", "2024-03-01 00:00:00", "new"), ("Q", None, "lost"), ("R", "2024-02-29", "other")],
                                "symbol string, open_time string, close string")
    got = {(r.symbol, r.open_time.date()): r.close for r in merge_first_wins(stored, new, ["symbol"], "open_time").collect()}
    assert got == {("Q", DAY(2024, 2, 28)): "keep", ("Q", DAY(2024, 2, 29)): "0.50", ("Q", DAY(2024, 3, 1)): "new", ("R", DAY(2024, 2, 29)): "other"}
    added = new_rows_only(stored, new, ["symbol"], "open_time").collect()
    assert {(r.symbol, r.close) for r in added} == {("Q", "new"), ("R", "other")}


def test_monthly_rows_win_over_daily_ones(spark):
    rows = [("Q", AT(2024, 2, 29), source, n) for source, n in (("daily", 2), ("monthly", 1))]
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz, close string, n int")
    tagged = tag(df, 1, row=F.col("n").cast("long")).withColumn("_source", F.col("n")).drop("n")
    assert [r.close for r in merge_first_wins(None, tagged, ["symbol"], "open_time").collect()] == ["monthly"]


def test_latest_time(spark):
    df = spark.createDataFrame([("V", AT(2023, 12, 31, 23, 59, 59, 5)), ("V", AT(2023, 1, 1)), ("W", None)], "symbol string, t timestamp_ntz")
    got = {r.symbol: r.x for r in latest_time(df, ["symbol"], "t").select("symbol", index_text("last_ts").alias("x")).collect()}
    assert got == {"V": "2023-12-31 23:59:59", "W": None}


def test_rebuild_index_of_some_symbols_leaves_out_files_without_times(spark):
    rows = [("V/V_1d.parquet", "parquet", AT(2024, 1, 1)), ("V/V_1h.parquet", "parquet", None), ("W/W_1d.parquet", "parquet", AT(2024, 1, 2))]
    tree = spark.createDataFrame(rows, "path string, format string, open_time timestamp_ntz")
    assert {r.path for r in rebuild_index(tree).collect()} == {"V/V_1d.parquet", "W/W_1d.parquet"}
    assert {r.path for r in rebuild_index(tree, symbols=["W"]).collect()} == {"W/W_1d.parquet"}


def test_stale_series(spark):
    last = [None, AT(2024, 2, 28, 23), AT(2024, 2, 29), AT(2024, 3, 1)]
    df = spark.createDataFrame([(x,) for x in last], "l timestamp_ntz")
    assert [r[0] for r in df.select(needs_update("l", F.lit(LEAP_END))).collect()] == [x is None or x.date() < LEAP_END for x in last]
    nothing = F.lit(None).cast("timestamp_ntz")  # the index claims more than the store holds
    assert all(r[0] for r in df.select(needs_update("l", F.lit(LEAP_END), nothing)).collect())


def test_build_jobs(spark):
    symbols = spark.createDataFrame([("U",), ("V",)], "symbol string")
    every = sum(len(k.intervals) or 1 for k in FUTURES_KINDS)
    assert build_jobs(symbols).count() == 2 * every
    assert build_jobs(symbols, toggles={"metrics": False}).count() == 2 * (every - 1)
    assert build_jobs(symbols, kinds=SPOT_KINDS, intervals=("5m",)).count() == 2


def _maps(spark, name, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField("symbol", T.StringType()), T.StructField(name, MAP_SS)]))


def test_info_overlay_and_migration(spark):
    held = _maps(spark, "info", [("U", {"note": "old", "tickSize": "9"})])
    raw = _maps(spark, "raw", [("U", {"symbol": "U", "filters": '[{"filterType":"PRICE_FILTER","tickSize":"0.5"}]'})])
    got = {r.key: r.value for r in explode_info(overlay_info(held, raw)).collect()}
    assert got["note"] == "old" and got["tickSize"] == "0.5" and got["symbol"] == "U"
    moved = migrate_info(held, held.limit(0)).collect()
    assert [(r.moved, r.info["note"]) for r in moved] == [(True, "old")]


def test_futures_universe_keeps_the_last_trading_perpetual(spark):
    def obj(symbol, quote="USDT", contract="PERPETUAL", status="TRADING", base="b"):
        return {"symbol": symbol, "quoteAsset": quote, "contractType": contract, "status": status, "baseAsset": base}

    objs = [obj("VUSDT", base="first"), obj("XEUR", quote="EUR"), obj("YUSDT", status="BREAK"), obj("ZUSDT", contract="NEXT_QUARTER"),
            obj("ØUSDT"), obj("VUSDT", base="last")]
    raw = spark.createDataFrame(list(enumerate(objs)), T.StructType([T.StructField("pos", T.LongType()), T.StructField("raw", MAP_SS)]))
    assert {r.symbol: r.raw["baseAsset"] for r in futures_universe(raw).collect()} == {"VUSDT": "last", "ØUSDT": "b"}


LISTS = "source string, priority int, fetched_at timestamp_ntz, ttl_hours double, symbol string"


@pytest.mark.parametrize("rows,want", [
    ([("own", 0, 1, 24.0, "B"), ("own", 0, 1, 24.0, "A"), ("kept", 2, 900, None, "Z")], ["A", "B"]),
    ([("own", 0, 30, 24.0, "B"), ("kept", 2, 900, None, "Z")], ["Z"]),          # too old
    ([("own", 0, 3, 24.0, "A"), ("own", 0, 30, 24.0, "OLD")], ["A"]),            # an expired list of the same source
    ([("own", 0, 3, 24.0, "NEWER"), ("own", 0, 5, 24.0, "OLDER")], ["NEWER"]),   # both usable: the newest
    ([], []),
])
def test_first_available(spark, rows, want):
    now = AT(2024, 3, 1)
    df = spark.createDataFrame([(s, p, now - dt.timedelta(hours=h), ttl, x) for s, p, h, ttl, x in rows], LISTS)
    assert [r.symbol for r in first_available(df, F.lit(now)).collect()] == want
