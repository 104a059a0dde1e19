"""Merging legacy tables that differ only in name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterspark.functions.skew import last_by
from meterspark.operators import legacy

KEY = ["hash", "start_time"]
TABLE = "table_seq"
# Order of the columns in exchange files, which carry no header.
EXCHANGE = T.StructType([
    T.StructField("hash", T.StringType()), T.StructField("start_time", T.LongType()),
    T.StructField("consumptionKWh", T.FloatType()), T.StructField("datetime", T.StringType()),
    T.StructField("obtainMethod", T.StringType())])


def export_tables(tables: list[DataFrame], path: str) -> None:
    """Write all rows of tables with composite keys as exchange files, a folder for each table."""
    rows = legacy.union_tables([legacy.composite_key_scan(t) for t in tables])
    legacy.write_tsv(rows.select(*EXCHANGE.fieldNames(), TABLE), path, (TABLE,))


def import_rows(spark: SparkSession, path: str, order: list[str]) -> DataFrame:
    """Exported tables as one with unique keys: later tables win, then the last row by `order`."""
    rows = legacy.read_tsv(spark, path, T.StructType([*EXCHANGE, T.StructField(TABLE, T.IntegerType())]))
    return last_by(rows, KEY, [TABLE, *order])


def merge_legacy(tables: list[DataFrame], order: list[str]) -> DataFrame:
    """Rows `key 'hash~start_time', ...` of several tables as one table with unique keys."""
    return legacy.merge_tables_lww([legacy.composite_key_scan(t) for t in tables], KEY, order)
