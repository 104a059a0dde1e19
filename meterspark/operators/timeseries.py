"""Harmonized points: identity, bucket layout and the range each sensor covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterspark import vocabulary as V
from meterspark.schemas import HARMONIZED


def bucket(start: Column) -> Column:
    """Storage bucket of an epoch second; floors, also before 1970."""
    return F.pmod(F.floor(start / V.BUCKET_SECONDS), F.lit(V.BUCKETS)).cast("int")


def step_seconds(freq: Column) -> Column:
    step = F.lit(None).cast("long")
    for s in HARMONIZED:
        step = F.when(freq == s.freq, F.lit(s.step_seconds).cast("long")).otherwise(step)
    return step


def bucket_keys(readings: DataFrame) -> DataFrame:
    """Add start, end (exclusive) and bucket of every reading."""
    start = F.col("timestamp")
    return readings.withColumns({
        "start": start, "end": start + step_seconds(F.col("freq")), "bucket": bucket(start)})


def sensor_uri(cups: Column, prop: Column, freq: Column) -> Column:
    return F.format_string(V.SENSOR_URI, cups, prop, freq)


def sensor_identity(series: DataFrame) -> DataFrame:
    """Add the identifiers of the device, sensor and measurement behind (cups, prop, freq)."""
    return (series
            .withColumn("device_uri", F.format_string(V.DEVICE_URI, F.col("cups")))
            .withColumn("sensor_uri", sensor_uri(F.col("cups"), F.col("prop"), F.col("freq")))
            .withColumn("hash", F.sha2("sensor_uri", 256))
            .withColumn("measurement_uri", F.format_string(V.MEASUREMENT_URI, F.col("hash"))))


def harmonized_only(readings: DataFrame) -> DataFrame:
    """Just the series that become points."""
    return readings.filter(
        F.col("prop").isin(sorted({s.prop for s in HARMONIZED}))
        & F.col("freq").isin([s.freq for s in HARMONIZED]))


def harmonize_timeseries(readings: DataFrame, constant_is_real: bool = False) -> DataFrame:
    """Points ready for storage, one per reading; the last covered second is `end`.

    `constant_is_real` writes the text "True" for every point, as older runs did, in place of
    whether the reading was measured.
    """
    real = (F.lit("True") if constant_is_real
            else F.coalesce(F.col("obtainMethod") == "Real", F.lit(False)))
    uri = sensor_uri(F.col("cups"), F.col("prop"), F.col("freq"))
    return bucket_keys(harmonized_only(readings)).select(
        F.col("prop").alias("property"), "freq", "bucket", F.sha2(uri, 256).alias("hash"),
        "start", (F.col("end") - 1).alias("end"), F.col("consumptionKWh").alias("value"),
        real.alias("isReal"))


def batch_coverage(readings: DataFrame) -> DataFrame:
    """First and last instant per meter and series; combined before the shuffle."""
    return (readings.groupBy("cups", "prop", "freq")
            .agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")))


def sensor_coverage(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Range of each delivered sensor, widened by the range on record (`uri`,
    `timeSeriesStart`, `timeSeriesEnd`), if any. Readings are reduced before the join."""
    stored = sensors.select(F.col("uri").alias("sensor_uri"),
                            F.unix_seconds("timeSeriesStart").alias("stored_first"),
                            F.unix_seconds("timeSeriesEnd").alias("stored_last"))
    return (sensor_identity(batch_coverage(harmonized_only(readings)))
            .join(stored, "sensor_uri", "left")
            .withColumn("first_ts", F.least("first_ts", "stored_first"))
            .withColumn("last_ts", F.greatest("last_ts", "stored_last"))
            .drop("stored_first", "stored_last"))


def write_points(points: DataFrame, path: str, mode: str = "append",
                 rows_per_file: int = 20_000_000) -> None:
    """Write points by property, frequency and bucket.

    A two-year history falls into a few buckets; the rebalance lets adaptive execution cut a
    heavy one into several files and fold the light ones, and files stay bounded without it.
    """
    (points.hint("rebalance", "property", "freq", "bucket")
     .sortWithinPartitions("property", "freq", "bucket", "hash", "start")
     .write.mode(mode).option("maxRecordsPerFile", rows_per_file)
     .partitionBy("property", "freq", "bucket").parquet(path))
