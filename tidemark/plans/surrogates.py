"""The driver tables seen as series, manifests and metadata (FIXTURES.md part B).

* E  ``events`` as series: symbol = event_type, key time = ts truncated to the hour,
     order = event_id; *existing* = ts < 2024-01-20, *new* = ts >= 2024-01-18 (overlap).
* L  ``lineitem`` as series: symbol = l_suppkey, time = l_shipdate.
* O  ``orders`` as manifest / run outcomes: symbol = o_custkey, month of o_orderdate.
* P  ``customer`` rows as raw exchange symbol objects (two customers per symbol).
* D  ``documents`` as text.

Writers here build the on-disk layouts the sources read (dumps, file trees, info
files) from those tables, always with Spark; per-file groups are a bounded part
of a series-day or series-month, a series of the tree, or one symbol record.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import epoch
from tidemark.registry import KINDS_BY_NAME
from tidemark.session import configure, shared_dir
from tidemark.sinks.tables import write_files

EXISTING_BEFORE = "2024-01-20"
NEW_FROM = "2024-01-18"
END = "2001-10-25"          # fixed 'end' for L: separates stale from fresh suppliers
NOW = "2001-10-26 06:00:00"  # fixed 'now' for freshness checks


#: A file of a dump holds fewer than twice as many lines.
PART_ROWS = 20_000

_FIXTURES: dict[tuple, str] = {}


def _once(spark: SparkSession, key: tuple, make) -> str:
    """Read-only fixture folders are written once per application and table folder."""
    k = (spark.sparkContext.applicationId, *key)
    if k not in _FIXTURES:
        _FIXTURES[k] = make()
    return _FIXTURES[k]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lit_ts(s: str):
    return F.lit(s).cast(T.TimestampNTZType())


def lit_date(s: str):
    return F.lit(s).cast(T.DateType())


def hour(ts: str = "ts"):
    return F.date_trunc("hour", F.col(ts)).cast(T.TimestampNTZType())


def ms_text(ts) -> F.Column:
    """Epoch milliseconds of a time, as text (how dumps carry times)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MILLISECOND", epoch(), c).cast(T.StringType())


# ---- E --------------------------------------------------------------------

def events_series(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("symbol"), hour().alias("open_time"),
                    "event_id", "user_id", "value", "ts")


def events_existing(spark, sf_dir) -> DataFrame:
    return events_series(spark, sf_dir).where(F.col("ts") < lit_ts(EXISTING_BEFORE))


def events_new(spark, sf_dir) -> DataFrame:
    return events_series(spark, sf_dir).where(F.col("ts") >= lit_ts(NEW_FROM))


# ---- L --------------------------------------------------------------------

def lineitem_series(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").cast(T.StringType()).alias("symbol"),
                     F.col("l_shipdate").alias("ts"), "l_orderkey", "l_linenumber", "l_returnflag")


def supplier_path(symbol_col: str = "symbol", interval: str = "1d") -> F.Column:
    return F.concat(F.col(symbol_col), F.lit("/"), F.col(symbol_col), F.lit(f"_{interval}.parquet"))


# ---- O --------------------------------------------------------------------

def orders_manifest(spark, sf_dir, kind="klines", interval="1d") -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.select(F.col("o_custkey").cast(T.StringType()).alias("symbol"),
                     F.trunc("o_orderdate", "month").alias("period"))
            .groupBy("symbol", "period").agg(F.count(F.lit(1)).alias("rows"))
            .select("symbol", F.lit(kind).alias("kind"), F.lit(interval).alias("interval"),
                    F.lit("monthly").alias("freq"), "period", "rows"))


def orders_outcomes(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", "produced")
              .when(F.col("o_orderstatus") == "O", "no_new_data").otherwise("failed"))
    err = F.when(F.col("o_orderstatus") == "P", F.concat(
        F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" failed: "), F.col("o_orderpriority"),
        F.lit(" "), F.repeat(F.lit("x"), (F.col("o_orderkey") % 300).cast("int"))))
    return o.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("path"),
                    F.col("o_custkey").cast("string").alias("symbol"), status.alias("status"), err.alias("error"))


# ---- P --------------------------------------------------------------------

def customer_objects(spark, sf_dir) -> DataFrame:
    """Raw exchange objects as JSON text, one per customer, plus its order ``pos``."""
    c = table(spark, sf_dir, "customer")
    nk, seg, ck = F.col("c_nationkey"), F.col("c_mktsegment"), F.col("c_custkey")
    symbol = F.concat(F.lit("C"), F.lpad((ck / 2).cast("long").cast("string"), 7, "0"))
    perms = (F.when(seg == "BUILDING", F.array(F.lit("SPOT"), F.lit("MARGIN")))
             .when(seg == "AUTOMOBILE", F.array(F.lit("MARGIN")))
             .when(seg == "HOUSEHOLD", F.lit(None).cast(T.ArrayType(T.StringType())))
             .otherwise(F.array(F.lit("SPOT"))))
    m = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    price = m("filterType", "PRICE_FILTER", "tickSize", F.concat(F.lit("0."), F.lpad(nk.cast("string"), 2, "0")),
              "minPrice", "0.001")
    lot = m("filterType", "LOT_SIZE", "stepSize", (ck % 7).cast("string"), "minQty", "0.1")
    notional = (F.when(seg == "BUILDING", m("filterType", "MIN_NOTIONAL", "notional", "5"))
                .when(seg == "AUTOMOBILE", m("filterType", "MIN_NOTIONAL", "notional", "5", "minNotional", "10"))
                .otherwise(m("filterType", "MIN_NOTIONAL", "minNotional", "10")))
    price2 = m("filterType", "PRICE_FILTER", "tickSize", "9.99")
    filters = (F.when(nk == 0, F.array(price, notional))
               .when(nk == 5, F.array(price, lot, notional, price2))
               .otherwise(F.array(price, lot, notional)))
    obj = F.struct(
        symbol.alias("symbol"), F.col("c_name").alias("baseAsset"),
        F.when(seg == "MACHINERY", "BUSD").otherwise("USDT").alias("quoteAsset"),
        F.when(nk >= 20, "CURRENT_QUARTER").otherwise("PERPETUAL").alias("contractType"),
        F.when(nk.isin(3, 4), "SETTLING").otherwise("TRADING").alias("status"),
        perms.alias("permissions"), filters.alias("filters"),
    )
    return c.select(symbol.alias("symbol"), ck.alias("pos"), F.to_json(obj).alias("json"))


def write_customer_objects(spark, sf_dir) -> str:
    """P as JSON lines; both customers of a symbol land in one file, in custkey order."""
    return _once(spark, ("exchange_info", sf_dir), lambda: _write_customer_objects(spark, sf_dir))


def _write_customer_objects(spark, sf_dir) -> str:
    out = shared_dir(spark, "exchange_info")
    (customer_objects(spark, sf_dir).repartition(8, "symbol").sortWithinPartitions("symbol", "pos")
     .select(F.col("json").alias("value")).write.text(out))
    return out


# ---- dumps and trees written from E ------------------------------------------

def event_dump_lines(spark, sf_dir, part: DataFrame | None = None) -> DataFrame:
    """E as kline dump lines: open_time = ms of the hour, open = event_id, high = user_id,
    close = props; one dump per (symbol, day), lines in event order."""
    e = part if part is not None else events_series(spark, sf_dir)
    cells = [ms_text("open_time"), F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.lit(""),
             F.col("props"), F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit("")]
    props = table(spark, sf_dir, "events").select("event_id", "props")
    e = e.join(props, "event_id")
    line = F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells)]))
    return e.select("symbol", F.to_date("ts").alias("day"), "event_id", line.alias("line"))


def numbered_parts(lines: DataFrame, dump: list[str], part_rows: int = PART_ROWS) -> DataFrame:
    """``lines`` with ``part``, numbered from 0 within each dump: ranges of event ids that follow
    each other, each of fewer than 2 * ``part_rows`` lines."""
    # ids are unique, so a cell of part_rows ids holds no more lines; parts are runs of cells
    cells = lines.withColumn("_cell", F.col("event_id") - F.pmod("event_id", F.lit(part_rows)))
    before = Window.partitionBy(*dump).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = cells.groupBy(*dump, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    parts = counts.select(*dump, "_cell", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / part_rows).alias("part"))
    return cells.join(parts, [*dump, "_cell"]).drop("_cell")


def part_suffix() -> F.Column:
    """What the name of a part has after the dump's; the first part has the dump's own name."""
    return F.when(F.col("part") > 0, F.concat(F.lit(".part"), F.col("part").cast("string"))).otherwise(F.lit(""))


def dump_files(lines: DataFrame, ext: str = "csv", part_rows: int = PART_ROWS) -> DataFrame:
    """(symbol, day, event_id, line) -> one row per file of a dump: relative location, CSV text
    and part number.  Files of even days carry a header line."""
    from tidemark.registry import KLINE_COLUMNS

    grouped = numbered_parts(lines, ["symbol", "day"], part_rows).groupBy("symbol", "day", "part").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "line"))).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["line"]), "\n")
    header = F.lit(",".join(KLINE_COLUMNS) + "\n")
    text = F.concat(F.when(F.dayofmonth("day") % 2 == 0, header).otherwise(F.lit("")), body, F.lit("\n"))
    loc = F.concat_ws("/", F.lit("daily"), F.lit("klines"), "symbol", F.lit("1h"),
                      F.concat_ws("-", "symbol", F.lit("1h"), F.date_format("day", "yyyy-MM-dd")))
    return grouped.select(F.concat(loc, part_suffix(), F.lit("." + ext)).alias("path"), text.alias("content"), "part")


def _zip_rows(batches):
    for pdf in batches:
        out = []
        for path, text in zip(pdf["path"], pdf["content"]):
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(path.rsplit("/", 1)[-1][:-4] + ".csv", text)
            out.append(buf.getvalue())
        yield pd.DataFrame({"path": pdf["path"], "content": out, "part": pdf["part"]})


def write_dump_files(files: DataFrame, root: str, zipped: bool) -> None:
    """(path, content, part) -> files under ``root``, a dump's parts with times in their order."""
    if zipped:
        files = files.mapInPandas(_zip_rows, "path string, content binary, part long")
    write_files(files, root, order_col="part")


def write_event_dumps(spark, sf_dir, zipped: bool = False, part: DataFrame | None = None,
                      part_name: str = "all") -> str:
    return _once(spark, ("landing", sf_dir, zipped, part_name),
                 lambda: _write_event_dumps(spark, sf_dir, zipped, part))


def _write_event_dumps(spark, sf_dir, zipped: bool, part: DataFrame | None, part_rows: int = PART_ROWS) -> str:
    root = shared_dir(spark, "landing")
    write_dump_files(dump_files(event_dump_lines(spark, sf_dir, part), "zip" if zipped else "csv", part_rows), root, zipped)
    return root


# tree fixture: E rows as per-file series of the source dataset's layout
def tree_kind() -> F.Column:
    return F.when(F.col("value") < 10, "klines").when(F.col("value") < 30, "metrics").otherwise("fundingRate")


def tree_rows(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    sym = F.concat(F.upper("event_type"), F.col("user_id").cast("string"))
    return e.select(sym.alias("symbol"), F.col("event_type"), tree_kind().alias("kind"), "ts", "event_id")


def _tree_name(kind_col: str = "kind") -> F.Column:
    k = F.col(kind_col)
    return F.when(k == "klines", F.concat(F.col("symbol"), F.lit("_1h"))).otherwise(
        F.concat(F.col("symbol"), F.lit("_"), k))


def _parquet_files(batches):
    """(path, kind, rows) of series -> each as one Parquet file; metrics files store their times as text."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    for batch in batches:
        paths, kinds, rows = batch.column("path"), batch.column("kind").to_pylist(), batch.column("rows")
        contents = []
        for i, kind in enumerate(kinds):
            ts, event = rows[i].values.flatten()
            if kind == "metrics":
                ts = pc.strftime(ts, "%Y-%m-%d %H:%M:%S")  # with the fraction
            buf = io.BytesIO()
            pq.write_table(pa.table({KINDS_BY_NAME[kind].time_col: ts, "event_id": event.cast(pa.string())}), buf)
            contents.append(buf.getvalue())
        yield pa.RecordBatch.from_arrays([paths, pa.array(contents, pa.binary())], names=["path", "content"])


def write_event_tree(spark, sf_dir) -> str:
    """Nested Parquet files ``SYM/SYM_x.parquet`` for all event types but error, and flat CSV
    files ``SYM_x.csv`` for error and purchase.  One file per series, written by the task that
    holds that series' rows; metrics files store text times, as older writers did."""
    return _once(spark, ("tree", sf_dir), lambda: _write_event_tree(spark, sf_dir))


def _write_event_tree(spark, sf_dir) -> str:
    root = shared_dir(spark, "tree")
    rows = tree_rows(spark, sf_dir)
    nested = (rows.where(F.col("event_type") != "error")
              .withColumn("path", F.concat(F.col("symbol"), F.lit("/"), _tree_name(), F.lit(".parquet"))))
    # a file costs its task the same whatever its bytes: series are dealt over all tasks
    p = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    files = nested.repartition(p, "path").groupBy("path", "kind").agg(F.collect_list(F.struct("ts", "event_id")).alias("rows"))
    write_files(files.mapInArrow(_parquet_files, "path string, content binary"), root)
    flat = rows.where(F.col("event_type").isin("error", "purchase"))
    tcol = F.when(F.col("kind") == "klines", "open_time").when(F.col("kind") == "metrics", "create_time").otherwise("calc_time")
    csv_files = (flat.repartition(p, "symbol", "kind").groupBy("symbol", "kind").agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id"))).alias("r"), F.first(tcol).alias("tcol"))
        .select(F.concat(_tree_name(), F.lit(".csv")).alias("path"),
                F.concat(F.col("tcol"), F.lit(",event_id\n"),
                         F.array_join(F.transform("r", lambda x: F.concat(
                             F.date_format(x["ts"], "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(","), x["event_id"].cast("string"))), "\n"),
                         F.lit("\n")).alias("content")))
    write_files(csv_files, root)
    return root


def write_fixtures(spark, sf_dir) -> None:
    """All read-only folders that queries share, so that a bench can write them before its clock."""
    from tidemark.plans.index_plans import broken_tree
    from tidemark.plans.stream_plans import zip_landing

    write_customer_objects(spark, sf_dir)
    write_event_dumps(spark, sf_dir)
    write_event_dumps(spark, sf_dir, zipped=True)
    write_event_dumps(spark, sf_dir, part=events_new(spark, sf_dir), part_name="new")
    write_event_tree(spark, sf_dir)
    broken_tree(spark, sf_dir)
    zip_landing(spark, sf_dir)
