"""Time column expressions (PRJ-4..6): lenient, per value, ANSI-safe.

All times are ``TIMESTAMP_NTZ`` (naive UTC).  Conversions never pass through a
session-zoned ``TIMESTAMP`` so the result does not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.registry import TIME_COLUMNS

def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())

# A nanosecond int64 clock (the dumps' consumer format) spans this many microseconds
# either side of the epoch; times outside it are unrepresentable there and become NULL.
_MAX_ABS_MICROS = 9223372036854775


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_to_time(micros) -> Column:
    m = _col(micros)
    ok = m.between(-_MAX_ABS_MICROS, _MAX_ABS_MICROS)
    return F.when(ok, F.timestamp_add("MICROSECOND", m, epoch()))


def time_to_micros(ts) -> Column:
    return F.timestamp_diff("MICROSECOND", epoch(), _col(ts))


def ms_to_time(value) -> Column:
    """Epoch milliseconds as text (``"1783468800000"``, ``"1.5"``, ``" 5 "``, ``"1e3"``)
    to a time; empty, text, or out-of-range values give NULL."""
    ms = F.expr("try_cast(try_cast(__v AS DECIMAL(38,6)) * 1000 AS BIGINT)".replace(
        "__v", _sql(value)))
    return micros_to_time(ms)


def text_to_time(value) -> Column:
    """ISO-like text (date only, ``T`` or space separated, fractional seconds) to a time,
    each value parsed by itself; anything unparseable gives NULL."""
    ts = F.expr(f"try_cast(trim({_sql(value)}) AS TIMESTAMP_NTZ)")
    return micros_to_time(time_to_micros(ts))


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def harmonize(df: DataFrame, columns=TIME_COLUMNS) -> DataFrame:
    """PRJ-5: whichever of the known time columns are present become TIMESTAMP_NTZ.

    Schema driven, so a stored part with real times and a landed part with text times
    line up for a union.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in columns:
        if c not in types:
            continue
        t = types[c]
        if isinstance(t, T.TimestampNTZType):
            continue
        if isinstance(t, T.TimestampType):
            out[c] = F.col(c).cast(T.TimestampNTZType())
        elif isinstance(t, T.StringType):
            out[c] = text_to_time(c)
        elif isinstance(t, T.DateType):
            out[c] = F.col(c).cast(T.TimestampNTZType())
        else:
            out[c] = F.lit(None).cast(T.TimestampNTZType())
    return df.withColumns(out) if out else df


def normalize_times(df: DataFrame, ms_cols=(), text_cols=()) -> DataFrame:
    """PRJ-4: epoch-ms text columns and time-text columns to times, bad values NULL."""
    out = {c: ms_to_time(c) for c in ms_cols}
    out.update({c: text_to_time(c) for c in text_cols if c not in out})
    return df.withColumns(out) if out else df


def index_text(ts) -> Column:
    """PRJ-6: time -> ``yyyy-MM-dd HH:mm:ss`` (sub-second truncated)."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def index_time(text) -> Column:
    """PRJ-6 inverse: index text -> time, invalid -> NULL."""
    return text_to_time(text)


def count_unrepresentable(raw_col: str, parsed_col: str) -> Column:
    """Aggregate: values present in text but NULL after parsing."""
    return F.count_if(F.col(raw_col).isNotNull() & F.col(parsed_col).isNull())
