"""Queries on the supplied tables, each next to the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {name: run for name, (run, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql}


def _entries() -> dict[str, tuple[Query, str | None]]:
    from paneloom.catalog import cleaning, entities, layers, statistics, summaries, windows

    found: dict[str, tuple[Query, str | None]] = {}
    for module in (layers, cleaning, entities, summaries, windows, statistics):
        found.update(module.ENTRIES)
    return found
