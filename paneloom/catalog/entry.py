"""Registration of a query with its SQL, and access to the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def registrar(entries: dict):
    """Decorator factory that stores a query and its SQL under a name."""

    def register(name: str, sql: str | None = None):
        def keep(run):
            entries[name] = (run, sql)
            return run

        return keep

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(column: str | Column, digits: int = 4) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, digits)
