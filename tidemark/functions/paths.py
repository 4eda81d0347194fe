"""Path expressions (PRJ-1..3, PRJ-10): built and parsed as columns, never per row in Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.registry import FUTURES_KINDS, INTERVALS, KLINE_COLUMNS, SPACED_KLINE_HEADERS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def series_path(symbol, suffix, per_interval, interval) -> Column:
    """PRJ-1: ``SYM/SYM_1d.parquet``, ``SYM/SYM_markPrice_1h.parquet``, ``SYM/SYM_metrics.parquet``."""
    symbol, suffix, per_interval, interval = map(_c, (symbol, suffix, per_interval, interval))
    tail = (
        F.when(per_interval & (suffix == ""), F.concat(F.lit("_"), interval))
        .when(per_interval, F.concat(F.lit("_"), suffix, F.lit("_"), interval))
        .otherwise(F.concat(F.lit("_"), suffix))
    )
    return F.concat(symbol, F.lit("/"), symbol, tail, F.lit(".parquet"))


_INTERVAL_ALT = "|".join(INTERVALS)
_VARIANTS = [k for k in FUTURES_KINDS if k.per_interval and k.suffix]
_VARIANT_ALT = "|".join(k.suffix for k in _VARIANTS)
_SINGLE = [k for k in FUTURES_KINDS if not k.per_interval]
_SINGLE_ALT = "|".join(k.suffix for k in _SINGLE)
_STEM = r"^(?:.*/)?([^/]+)\.(?:parquet|csv)$"


def parse_series_path(df: DataFrame, path_col: str = "path") -> DataFrame:
    """PRJ-2: symbol, kind, interval and layout from a stored file path.

    The kind is chosen from the parsed file stem anchored at its end, so a symbol that
    happens to contain a kind name is read correctly.  ``SYM/SYM_x.parquet`` is the nested
    layout (symbol = folder), a bare ``SYM_x.csv`` the legacy flat one.
    """
    p = F.col(path_col)
    stem = F.regexp_extract(p, _STEM, 1)
    v = F.regexp_extract(stem, rf"^(.+)_({_VARIANT_ALT})_({_INTERVAL_ALT})$", 0) != ""
    k = F.regexp_extract(stem, rf"^(.+)_({_INTERVAL_ALT})$", 0) != ""
    s = F.regexp_extract(stem, rf"^(.+)_({_SINGLE_ALT})$", 0) != ""
    suffix_to_kind = F.create_map(*[x for kd in _VARIANTS + _SINGLE
                                    for x in (F.lit(kd.suffix), F.lit(kd.name))])
    nested = F.instr(p, "/") > 0
    folder = F.regexp_extract(p, r"([^/]+)/[^/]+$", 1)
    parsed_symbol = (
        F.when(v, F.regexp_extract(stem, rf"^(.+)_({_VARIANT_ALT})_({_INTERVAL_ALT})$", 1))
        .when(k, F.regexp_extract(stem, rf"^(.+)_({_INTERVAL_ALT})$", 1))
        .when(s, F.regexp_extract(stem, rf"^(.+)_({_SINGLE_ALT})$", 1))
    )
    return df.withColumns({
        "symbol": F.when(nested, folder).otherwise(parsed_symbol),
        "kind": (
            F.when(v, suffix_to_kind[F.regexp_extract(stem, rf"_({_VARIANT_ALT})_({_INTERVAL_ALT})$", 1)])
            .when(k, F.lit("klines"))
            .when(s, suffix_to_kind[F.regexp_extract(stem, rf"_({_SINGLE_ALT})$", 1)])
        ),
        "interval": (
            F.when(v, F.regexp_extract(stem, rf"_({_INTERVAL_ALT})$", 1))
            .when(k, F.regexp_extract(stem, rf"_({_INTERVAL_ALT})$", 1))
        ),
        "layout": F.when(nested, F.lit("nested")).otherwise(F.lit("flat")),
    })


def dump_location(segment, per_interval, symbol, interval, freq, period) -> Column:
    """PRJ-3: location of a month or day dump relative to the landing root.

    ``{freq}/{segment}/{SYM}/{interval}/{SYM}-{interval}-{stamp}.zip`` for per-interval kinds,
    ``{freq}/{segment}/{SYM}/{SYM}-{segment}-{stamp}.zip`` otherwise; the stamp is
    ``yyyy-MM`` for monthly and ``yyyy-MM-dd`` for daily dumps.
    """
    seg, per, sym, itv, freq, period = map(_c, (segment, per_interval, symbol, interval, freq, period))
    stamp = F.when(freq == "monthly", F.date_format(period, "yyyy-MM")).otherwise(
        F.date_format(period, "yyyy-MM-dd"))
    return F.concat(
        F.when(per, F.concat_ws("/", freq, seg, sym, itv, F.concat_ws("-", sym, itv, stamp)))
        .otherwise(F.concat_ws("/", freq, seg, sym, F.concat_ws("-", sym, seg, stamp))),
        F.lit(".zip"),
    )


def canonical_columns(df: DataFrame, to: str = "snake") -> DataFrame:
    """PRJ-10: spaced published headers <-> snake_case names, by position."""
    src, dst = (SPACED_KLINE_HEADERS, KLINE_COLUMNS) if to == "snake" else (KLINE_COLUMNS, SPACED_KLINE_HEADERS)
    mapping = {s: d for s, d in zip(src, dst) if s in df.columns and s != d}
    return df.withColumnsRenamed(mapping) if mapping else df
