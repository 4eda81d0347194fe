"""SQL fragments derived from the registry, so oracles list the same kinds and intervals."""

from __future__ import annotations

from tidemark.registry import FUTURES_KINDS, INTERVALS


def job_values(kinds=FUTURES_KINDS, intervals=INTERVALS, skip=()) -> str:
    """``(VALUES ...) AS j(kind, interval, tail)``: tail completes ``SYM/SYM{tail}.parquet``."""
    rows = []
    for k in kinds:
        if k.name in skip:
            continue
        for itv in (intervals if k.per_interval else (None,)):
            tail = (f"_{itv}" if not k.suffix else f"_{k.suffix}_{itv}") if k.per_interval else f"_{k.suffix}"
            rows.append("('%s', %s, '%s')" % (k.name, "NULL" if itv is None else f"'{itv}'", tail))
    return "(VALUES " + ", ".join(rows) + ") AS j(kind, interval, tail)"


def kind_values(kinds=FUTURES_KINDS) -> str:
    rows = [f"('{k.name}', '{k.segment}', {str(k.per_interval).upper()}, {str('monthly' in k.published).upper()}, "
            f"{str('daily' in k.published).upper()}, '{k.time_col}', '{k.since}', '{k.suffix}')" for k in kinds]
    return "(VALUES " + ", ".join(rows) + ") AS k(kind, segment, per_interval, monthly, daily, time_col, since, suffix)"
