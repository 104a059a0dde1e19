"""Landed snapshots and state tables, always read with their declared layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from meterspark import schemas as S
from meterspark.functions import clock, keyed
from meterspark.streaming.envelopes import fits, is_good, parsed


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def read_supplies(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_table(spark, path, S.LANDED_SUPPLY, fmt)


def read_contracts(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_table(spark, path, S.CONTRACT, fmt)


def supplies_in(documents: DataFrame, column: str = "value") -> DataFrame:
    """Supply records inside JSON documents `{"supplies": [...]}`; items that are not what a supply
    record holds are left to `rejected_documents`."""
    # Parsed before the items become rows, so that the check and the fields share one parse.
    read = F.transform(_items(column), lambda item: F.struct(item.alias("item"), parsed(item, S.SUPPLY).alias("r")))
    return (documents.select(F.explode(read).alias("i")).filter(is_good(F.col("i.item"), F.col("i.r")))
            .select("i.r.*").drop("_bad"))


def rejected_documents(documents: DataFrame, column: str = "value") -> DataFrame:
    """What `supplies_in` leaves out, for quarantine: a row with the document and, in `item`, the JSON
    of an item that does not fit; documents that cannot be read come once, with `item` null."""
    unread = F.col("_items").isNull()
    return (documents.filter(F.col(column).isNotNull()).withColumn("_items", _items(column))
            .withColumn("item", F.explode(F.coalesce("_items", F.array(F.lit(None).cast("string")))))
            .filter(~fits(F.col("item"), S.SUPPLY))
            .withColumn("item", F.when(~unread, F.coalesce("item", F.lit("null")))).drop("_items"))


def _items(column: str) -> Column:
    return F.from_json(column, "supplies array<string>")["supplies"]


def read_chunk_state(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.CHUNK_STATE).select(S.CHUNK_STATE.fieldNames())


def write_chunk_state(state: DataFrame, path: str, slots: int = keyed.SLOTS) -> None:
    """Write a chunk state as a new table, dealt by meter."""
    keyed.write_keyed(state.select(S.CHUNK_STATE.fieldNames()), path, ["cups"], slots)


def update_chunk_state(spark: SparkSession, path: str, new: DataFrame, slots: int = keyed.SLOTS) -> None:
    """Put chunks into the stored table, in place of those with the same key. Files of meters' slots that
    `new` does not touch stay as they are."""
    keyed.update_keyed(spark, path, new.select(S.CHUNK_STATE.fieldNames()), S.CHUNK_KEY, ["cups"], slots)


def local_month(epoch: Column) -> Column:
    """Month, as text, of an instant in local time: that of the chunk it belongs to."""
    return F.date_format(clock.local_date(epoch), "yyyy-MM")


def write_readings(readings: DataFrame, path: str, mode: str = "append") -> None:
    """Land readings by series and local month, the columns that requests select on."""
    (readings
     .withColumn("data_type", F.concat_ws("_", "prop", "freq"))
     .withColumn("month", local_month(F.col("timestamp")))
     .hint("rebalance", "data_type", "month")
     .write.mode(mode).partitionBy("data_type", "month").parquet(path))


def requested_readings(landed: DataFrame, requests: DataFrame) -> DataFrame:
    """Landed readings of the meters, series and days asked for (`request_plan`).

    A meter asked for through several logins is asked for once here. The few pairs of series and
    month asked for (at most 64: 23 months of two series, 18 of the third) are broadcast, so that
    Spark reads just those partitions. Meters and days are settled by a join; should a meter hold a large
    share of the readings, adaptive execution splits its partition. Requests are read twice.
    """
    day = clock.local_date(F.col("timestamp"))
    asked = (requests
             .select("cups", "data_type", F.to_date("start_date").alias("lo"),
                     F.to_date("end_date").alias("hi")).distinct()
             .withColumn("first", F.explode(F.sequence(
                 F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("INTERVAL 1 MONTH")))))
    month = F.substring(F.col("first").cast("string"), 1, 7).alias("month")
    parts = asked.select("data_type", "first").distinct().select("data_type", month)
    return (landed.join(F.broadcast(parts), ["data_type", "month"], "left_semi")
            .withColumn("day", day)
            .join(asked.select("cups", "data_type", "lo", "hi", month),
                  ["cups", "data_type", "month"])
            .filter(F.col("day").between(F.col("lo"), F.col("hi")))
            .drop("day", "lo", "hi"))
