"""Raw readings as delivered, turned into long typed rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from meterspark.functions.skew import last_by


def parse_consumption(raw: DataFrame, prop: str | None = None,
                      freq: str | None = None) -> DataFrame:
    """Add the epoch second of every reading, and its series when given."""
    parsed = raw.withColumn("timestamp", F.unix_seconds("datetime"))
    if prop:
        parsed = parsed.withColumn("prop", F.lit(prop))
    if freq:
        parsed = parsed.withColumn("freq", F.lit(freq))
    return parsed


def rejected_readings(raw: DataFrame) -> DataFrame:
    """Readings without a meter or an instant: for quarantine, never counted."""
    return raw.filter(F.col("cups").isNull() | F.col("datetime").isNull())


def max_power_long(wide: DataFrame) -> DataFrame:
    """One row per meter, instant and tariff period, from any number of period columns.

    A period without an instant is dropped together with its value; without period columns there
    are no rows.
    """
    periods = sorted({int(m[1]) for c in wide.columns
                      if (m := re.fullmatch(r"datetime_period_(\d+)", c))})
    pairs = F.array(*[F.struct(
        F.lit(n).alias("period"),
        F.unix_seconds(f"datetime_period_{n}").alias("period_ts"),
        F.col(f"maxPower_period_{n}").cast("double").alias("max_power")) for n in periods]).cast(
        "array<struct<period:int,period_ts:bigint,max_power:double>>")
    return (wide
            .select(F.col("cups_period_").alias("cups"),
                    F.unix_seconds("datetime").alias("timestamp"), F.explode(pairs).alias("p"))
            .select("cups", "timestamp", *[F.col(f"p.{c}") for c in ("period", "period_ts", "max_power")])
            .filter(F.col("period_ts").isNotNull()))


def power_readings(wide: DataFrame) -> DataFrame:
    """Maximum-power rows as delivered, one reading each, for counting against their chunk."""
    return wide.select(F.col("cups_period_").alias("cups"),
                       F.unix_seconds("datetime").alias("timestamp"),
                       F.lit("Power").alias("prop"), F.lit("P1M").alias("freq"))


def power_messages(wide: DataFrame) -> DataFrame:
    """Maximum power as it is published: one reading per meter, instant and tariff period."""
    return max_power_long(wide).withColumns({"prop": F.lit("Power"), "freq": F.lit("P1M")})


def latest_readings(readings: DataFrame, order: list[str]) -> DataFrame:
    """Re-delivered readings overwrite earlier ones of the same meter, series and instant."""
    return last_by(readings, ["cups", "prop", "freq", "timestamp"], order)


def audit_counters(time: str = "timestamp") -> list[Column]:
    """What is counted of readings while they are written: rows, those without value, first and last."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("consumptionKWh").isNull()).alias("without_value"),
            F.min(time).alias("first_ts"), F.max(time).alias("last_ts")]


def write_audited(readings: DataFrame, write: Callable[[DataFrame], None]) -> dict:
    """Write readings, and count them on the same pass. Returns the counters (`audit_counters`)."""
    seen = Observation("ingest")
    write(readings.observe(seen, *audit_counters()))
    return seen.get


def ingest_audit(readings: DataFrame, by: list[str]) -> DataFrame:
    """Rows and meters' spans per audit key, e.g. login, meter, type and chunk."""
    return readings.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_values"), F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"))
