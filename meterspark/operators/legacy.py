"""Legacy keyed tables: composite keys, text exchange files and last-write-wins merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from meterspark.functions.skew import last_by, numbered

TSV_NULL = "\\N"


def composite_key_scan(rows: DataFrame, key: str = "key") -> DataFrame:
    """Read the `hash~start_time` row key as two typed columns."""
    parts = F.split(key, "~")
    return rows.select(
        parts.getItem(0).alias("hash"), F.try_element_at(parts, F.lit(2)).try_cast("bigint")
        .alias("start_time"), *[c for c in rows.columns if c != key])


def write_tsv(rows: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Exchange files without a header; columns of `by` become folders, not fields."""
    (rows.write.mode("overwrite").partitionBy(*by).option("sep", "\t").option("nullValue", TSV_NULL)
     .option("emptyValue", "").option("quote", "").csv(path))


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back the exchange files; the null marker and empty text become null."""
    return (spark.read.schema(schema).option("sep", "\t").option("nullValue", TSV_NULL)
            .option("emptyValue", "").option("quote", "").csv(path))


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """All rows of every table, numbered by the table's position in the list."""
    return reduce(DataFrame.unionByName,
                  [t.withColumn("table_seq", F.lit(i)) for i, t in enumerate(tables)])


def merge_tables_lww(tables: list[DataFrame], keys: list[str],
                     order: list[str]) -> DataFrame:
    """One row per key over all tables: later tables win, then the larger `order`.

    A key written many times is reduced to one row in each task before the shuffle.
    """
    return last_by(union_tables(tables), keys, ["table_seq", *order])


def write_keyed(rows: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def group_values(rows: DataFrame, key: str, value: str, seq: str,
                 values_per_row: int = 1000) -> DataFrame:
    """The values of each key in the order of `seq`, in parts of at most `values_per_row`.

    The parts of a key, in order of `part`, are its whole list; no row and no task ever holds
    more than one part of a heavy key.
    """
    part = F.floor((F.col("rn") - 1) / values_per_row)
    listed = F.sort_array(F.collect_list(F.struct("rn", F.col(value).alias("v"))))
    return (numbered(rows.select(*dict.fromkeys([key, value, seq])), [key], seq)
            .groupBy(key, part.alias("part"))
            .agg(listed.alias("l"))
            .select(key, "part", F.col("l.v").alias("values")))
