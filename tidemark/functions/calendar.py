"""Calendar expressions (CAL-1, CAL-3..5, CAL-7) and the period generator (CAL-2).

Every list is a guarded ``sequence``: Spark's ``sequence(a, b)`` counts down when
``a > b``, so each call is wrapped in ``when(start <= end, ...)`` and yields an empty
array otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.registry import SPOT_START

PERIOD_TYPE = T.ArrayType(T.StructType([
    T.StructField("freq", T.StringType(), False),
    T.StructField("period", T.DateType(), False),
]))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty_dates() -> Column:
    return F.array().cast(T.ArrayType(T.DateType()))


def month_of(d) -> Column:
    return F.trunc(_c(d), "month")


def months(start, end_exclusive) -> Column:
    """CAL-1: first-of-month dates from start's month up to, not including, end's month."""
    s, e = month_of(start), month_of(end_exclusive)
    return F.when(s < e, F.sequence(s, F.add_months(e, -1), F.expr("INTERVAL 1 MONTH"))).otherwise(_empty_dates())


def month_range_inclusive(start, end) -> Column:
    s, e = month_of(start), month_of(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 MONTH"))).otherwise(_empty_dates())


def day_range(start, end) -> Column:
    s, e = _c(start), _c(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).otherwise(_empty_dates())


def days_in_month(month, end) -> Column:
    """CAL-3: the days of a month, clipped to ``end``."""
    m = month_of(month)
    return day_range(m, F.least(F.last_day(m), _c(end)))


def months_before(month, end) -> Column:
    """CAL-4: whole-month distance from ``month`` to ``end``'s month."""
    m, e = _c(month), _c(end)
    return (F.year(e) - F.year(m)) * 12 + (F.month(e) - F.month(m))


def default_end(now) -> Column:
    """CAL-5: yesterday, in UTC."""
    return F.date_sub(F.to_date(_c(now)), 1)


def spot_range_start(last) -> Column:
    """CAL-7: spot fetch start: date of the last stored time, else the spot start."""
    return F.coalesce(F.to_date(_c(last)), F.lit(SPOT_START).cast(T.DateType()))


def enumerate_periods(has_monthly, has_daily, floor_ym, last, end) -> Column:
    """CAL-2: the month and day dumps that cover ``[date(last) or floor, end]``.

    * monthly+daily kinds: whole months before ``end``'s month, then the days of
      ``end``'s month from ``max(start, first of month)``;
    * monthly only: every month through ``end``'s month;
    * daily only: every day.

    Returns ``array<struct<freq, period>>``; empty when the start is after ``end``.
    """
    hm, hd, e = _c(has_monthly), _c(has_daily), _c(end)
    start = F.coalesce(F.to_date(_c(last)), F.to_date(F.concat(_c(floor_ym), F.lit("-01"))))
    first_of_end = month_of(e)

    def tagged(freq: str, dates: Column) -> Column:
        return F.transform(dates, lambda d: F.struct(F.lit(freq).alias("freq"), d.alias("period")))

    both = F.concat(
        tagged("monthly", months(start, e)),
        tagged("daily", day_range(F.greatest(start, first_of_end), e)),
    )
    monthly_only = tagged("monthly", month_range_inclusive(start, e))
    daily_only = tagged("daily", day_range(start, e))
    plan = F.when(hm & hd, both).when(hm, monthly_only).otherwise(daily_only)
    return F.when(start <= e, plan).otherwise(F.array().cast(PERIOD_TYPE))
