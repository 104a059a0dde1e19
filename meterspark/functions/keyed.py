"""Stored tables of one row per key, laid out in slots so that an update rewrites few of them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from meterspark.functions.skew import upsert

#: Slots of a table; the number is part of its layout. A slot should hold some 100 MB at most.
SLOTS = 256
SLOT = "slot"
#: A task of an update writes about so many rows; a larger slot is written by several.
WRITE_ROWS = 1 << 18


def slot(keys: list[str], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int").alias(SLOT)


def write_keyed(rows: DataFrame, path: str, by: list[str], slots: int = SLOTS) -> None:
    """Write `rows` as a new table, dealt to slots by a hash of `by`. Keys are unique."""
    _write(rows.withColumn(SLOT, slot(by, slots)), path, "errorifexists", slots)


def create_keyed(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table, where there is none yet."""
    (spark.createDataFrame([], schema).withColumn(SLOT, F.lit(0)).write.mode("ignore").partitionBy(SLOT).parquet(path))


def read_keyed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table's rows, with the slot of each, so that a filter on it reads just its files."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(SLOT, T.IntegerType())])).parquet(path)


def update_keyed(spark: SparkSession, path: str, new: DataFrame, keys: list[str], by: list[str] | None = None,
                 slots: int = SLOTS, replace: bool = True) -> None:
    """Put the rows of `new` into the table, in place of those with the same `keys`; without `replace`,
    just the rows whose keys it does not have yet.

    Just the slots that `new` touches are read and written; the files of all others stay. Their new
    contents are first written beside the table, so that an update whose driver is lost while folders are
    replaced is carried on by the next one (or by `recover`) before it reads anything. `by` are the keys that
    rows are dealt by, all of them unless said otherwise. An update that is repeated leaves the same rows.
    `new` is read twice (the slots first), so a costly one is better stored before. Rows of both sides are
    counted by slot, so that a large slot is written by several tasks.
    """
    recover(spark, path, new.schema, slots)
    by = by or keys
    placed = new.withColumn(SLOT, slot(by, slots))
    added = _sizes(placed)
    if not added:
        return
    rows = read_keyed(spark, path, new.schema).filter(F.col(SLOT).isin(list(added)))
    sides = (rows, placed.select(rows.columns))
    held = _sizes(rows)
    largest = max(n + held.get(s, 0) for s, n in added.items())
    _write(upsert(*(sides if replace else sides[::-1]), [SLOT, *keys]), _beside(path), "overwrite", slots, "static",
           _parts(largest))
    recover(spark, path, new.schema, slots)


def recover(spark: SparkSession, path: str, schema: T.StructType, slots: int = SLOTS) -> None:
    """Put what an update has left beside the table into it, if there is any. Each slot there is whole, so
    doing so again, or for some of an update's slots alone, does no harm."""
    try:
        left = read_keyed(spark, _beside(path), schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    held = _sizes(left)
    if held:
        _write(left, path, "overwrite", slots, "dynamic", _parts(max(held.values())))
        empty = spark.createDataFrame([], left.schema)
        _write(empty, _beside(path), "overwrite", 1, "static")


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}_pending"


def _sizes(placed: DataFrame) -> dict[int, int]:
    """Rows by slot: at most as many numbers as there are slots."""
    return dict(placed.groupBy(SLOT).count().collect())


def _parts(rows: int) -> int:
    return -(-rows // WRITE_ROWS)


def _write(placed: DataFrame, path: str, mode: str, slots: int, overwrite: str = "dynamic", parts: int = 1) -> None:
    """A slot's rows meet in one task, which writes its one file, or in `parts` tasks by a hash of the whole
    row; slots are even, as keys are hashed."""
    part = [] if parts == 1 else [F.pmod(F.xxhash64(*placed.columns), F.lit(parts))]
    (placed.repartition(slots * parts, SLOT, *part).write.mode(mode).option("partitionOverwriteMode", overwrite)
     .partitionBy(SLOT).parquet(path))
