"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterspark.session import configure

AS_OF = date(2024, 1, 31)

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that gives the same rows."""
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        _queries[fn.__name__] = run
        if sql:
            _sql[fn.__name__] = sql
        return run
    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")
