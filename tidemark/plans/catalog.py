"""Registration of operator queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the result is expressible in SQL, an independent DuckDB oracle over the
same tables."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    import importlib

    for mod in ("merge_plans", "index_plans", "calendar_plans", "source_plans", "universe_plans",
                "metadata_plans", "report_plans", "sink_plans", "stream_plans"):
        try:
            importlib.import_module(f"tidemark.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"tidemark.plans.{mod}":
                raise
