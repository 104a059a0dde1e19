"""Parsed readings, harmonized points and sensors."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterspark import vocabulary as V
from meterspark.catalog import tables as t
from meterspark.catalog.registry import query, table
from meterspark.operators import graph, readings as R, timeseries as TS
from meterspark.plans import harmonize
from meterspark.session import shared_dir

HARMONIZED_SQL = "prop = 'EnergyConsumptionGridElectricity' AND freq IN ('PT1H', 'PT15M')"
URI_SQL = f"printf('{V.SENSOR_URI}', cups, prop, freq)"


@query(f"""WITH {t.READINGS}
SELECT seq, cups, "timestamp", "consumptionKWh", "obtainMethod", prop, freq FROM readings""")
def parse_consumption(spark, sf_dir):
    return t.readings(spark, sf_dir).drop("datetime")


@query(f"""WITH {t.READINGS}
SELECT cups, prop, freq, "timestamp", "consumptionKWh", seq FROM (
  SELECT *, row_number() OVER (PARTITION BY cups, prop, freq, "timestamp" // 86400
                               ORDER BY seq DESC) AS rn FROM (
    SELECT cups, prop, freq, "timestamp" // 86400 * 86400 AS "timestamp", "consumptionKWh", seq
    FROM readings)) WHERE rn = 1""")
def latest_readings(spark, sf_dir):
    """Readings taken to the day, so that many overwrite one another."""
    daily = t.readings(spark, sf_dir).select(
        "cups", "prop", "freq",
        (F.floor(F.col("timestamp") / 86400) * 86400).alias("timestamp"), "consumptionKWh", "seq")
    return R.latest_readings(daily, ["seq"])


WIDE = """
best AS (
  SELECT user_id, date_trunc('day', ts) AS day, event_type, ts, value,
         row_number() OVER (PARTITION BY user_id, date_trunc('day', ts), event_type
                            ORDER BY value DESC, ts DESC) AS rn FROM events)"""
PERIODS = ["view", "click", "purchase", "signup", "error"]


def _max_power_wide(spark, sf_dir):
    """Per meter and day, the highest value and its time for each kind of event."""
    of_kind = [F.col("event_type") == kind for kind in PERIODS]
    wide = (table(spark, sf_dir, "events")
            .groupBy(F.col("user_id").cast("string").alias("cups_period_"),
                     F.to_date("ts").cast("timestamp").alias("datetime"))
            .agg(*[F.max(F.when(k, F.struct("value", "ts"))).alias(f"p{i}")
                   for i, k in enumerate(of_kind, 1)]))
    return wide.select(
        "cups_period_", "datetime",
        *[F.col(f"p{i}.ts").cast("timestamp").alias(f"datetime_period_{i}")
          for i in range(1, len(PERIODS) + 1)],
        *[F.col(f"p{i}.value").alias(f"maxPower_period_{i}")
          for i in range(1, len(PERIODS) + 1)])


@query(f"""WITH {WIDE}
SELECT CAST(user_id AS VARCHAR) AS cups, epoch_us(day) // 1000000 AS "timestamp",
  CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
       WHEN 'signup' THEN 4 ELSE 5 END AS BIGINT) AS period,
  epoch_us(ts) // 1000000 AS period_ts, value AS max_power FROM best WHERE rn = 1""")
def max_power_long(spark, sf_dir):
    return R.max_power_long(_max_power_wide(spark, sf_dir)).withColumn(
        "period", F.col("period").cast("long"))


@query(f"""WITH {t.READINGS}
SELECT cups, prop, freq, count(*) AS total_values, min("timestamp") AS first_ts,
  max("timestamp") AS last_ts FROM readings GROUP BY cups, prop, freq""")
def ingest_audit(spark, sf_dir):
    return R.ingest_audit(t.readings(spark, sf_dir), ["cups", "prop", "freq"])


@query(f"""WITH {t.READINGS}
SELECT count(*) AS rows, count(*) FILTER ("consumptionKWh" IS NULL) AS without_value, min("timestamp") AS first_ts,
  max("timestamp") AS last_ts FROM readings""")
def ingest_observed(spark, sf_dir):
    """All readings written, and counted on the same pass."""
    path = shared_dir(spark, "audited")
    seen = R.write_audited(t.readings(spark, sf_dir), lambda df: df.write.parquet(path))
    return spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in seen.items()])


@query(f"""WITH {t.READINGS}
SELECT seq, cups, freq, "timestamp" AS "start",
  "timestamp" + CASE freq WHEN 'PT1H' THEN 3600 WHEN 'PT15M' THEN 900 END AS "end",
  CAST("timestamp" // 10000000 % 20 AS BIGINT) AS bucket
FROM readings WHERE {HARMONIZED_SQL}""")
def bucket_keys(spark, sf_dir):
    return TS.bucket_keys(TS.harmonized_only(t.readings(spark, sf_dir))).select(
        "seq", "cups", "freq", "start", "end", F.col("bucket").cast("long").alias("bucket"))


@query(f"""WITH {t.READINGS}
SELECT DISTINCT cups, prop, freq, {URI_SQL} AS sensor_uri, sha256({URI_SQL}) AS hash,
  printf('{V.DEVICE_URI}', cups) AS device_uri,
  printf('{V.MEASUREMENT_URI}', sha256({URI_SQL})) AS measurement_uri FROM readings""")
def sensor_identity(spark, sf_dir):
    return TS.sensor_identity(t.readings(spark, sf_dir).select("cups", "prop", "freq").distinct())


POINTS = f"""
SELECT prop AS property, freq, CAST("timestamp" // 10000000 % 20 AS BIGINT) AS bucket,
  sha256({URI_SQL}) AS hash, "timestamp" AS "start",
  "timestamp" + CASE freq WHEN 'PT1H' THEN 3599 ELSE 899 END AS "end",
  "consumptionKWh" AS value, "obtainMethod" = 'Real' AS "isReal"
FROM readings WHERE {HARMONIZED_SQL}"""


@query(f"WITH {t.READINGS} {POINTS}")
def harmonize_timeseries(spark, sf_dir):
    return TS.harmonize_timeseries(t.readings(spark, sf_dir)).withColumn(
        "bucket", F.col("bucket").cast("long"))


def _stored_sensors(spark, sf_dir):
    """Ranges on record for customers' hourly sensors: some earlier, some later, some inside."""
    balance = F.col("c_acctbal")
    day = F.floor(F.abs(balance) / 250).cast("int")
    uri = TS.sensor_uri(F.col("c_custkey").cast("string"), F.lit(t.CONSUMPTION), F.lit("PT1H"))
    return (table(spark, sf_dir, "customer").filter(balance < 5000)
            .select(uri.alias("uri"),
                    F.date_add(F.lit("2023-12-25").cast("date"), day).cast("timestamp")
                    .alias("timeSeriesStart"),
                    F.date_add(F.lit("2024-01-20").cast("date"), day).cast("timestamp")
                    .alias("timeSeriesEnd")))


COVERAGE = f"""
stored AS (
  SELECT printf('{V.SENSOR_URI}', CAST(c_custkey AS VARCHAR),
                'EnergyConsumptionGridElectricity', 'PT1H') AS sensor_uri,
         epoch_us(TIMESTAMP '2023-12-25' + to_days(CAST(floor(abs(c_acctbal) / 250) AS INTEGER)))
           // 1000000 AS lo,
         epoch_us(TIMESTAMP '2024-01-20' + to_days(CAST(floor(abs(c_acctbal) / 250) AS INTEGER)))
           // 1000000 AS hi
  FROM customer WHERE c_acctbal < 5000),
seen AS (
  SELECT cups, prop, freq, {URI_SQL} AS sensor_uri, min("timestamp") AS lo, max("timestamp") AS hi
  FROM readings WHERE {HARMONIZED_SQL} GROUP BY ALL),
coverage AS (
  SELECT cups, prop, freq, sensor_uri, sha256(sensor_uri) AS hash,
    least(seen.lo, coalesce(stored.lo, seen.lo)) AS first_ts,
    greatest(seen.hi, coalesce(stored.hi, seen.hi)) AS last_ts
  FROM seen LEFT JOIN stored USING (sensor_uri))"""


def _coverage(spark, sf_dir):
    return TS.sensor_coverage(t.readings(spark, sf_dir), _stored_sensors(spark, sf_dir))


@query(f"""WITH {t.READINGS}, {COVERAGE}
SELECT cups, prop, freq, hash, first_ts, last_ts FROM coverage""")
def sensor_coverage(spark, sf_dir):
    return _coverage(spark, sf_dir).select("cups", "prop", "freq", "hash", "first_ts", "last_ts")


@query(f"""WITH {t.READINGS}, {COVERAGE}
SELECT 'point' AS kind, hash AS a, CAST("start" AS BIGINT) AS b, CAST("end" AS BIGINT) AS c, value AS v FROM ({POINTS})
UNION ALL SELECT 'sensor', hash, first_ts, last_ts, 0 FROM coverage
UNION ALL SELECT 'Start', sensor_uri, first_ts, 0, 0 FROM coverage
UNION ALL SELECT 'End', sensor_uri, last_ts, 0, 0 FROM coverage""")
def harmonize_series(spark, sf_dir):
    """Points of all readings, the sensors behind them with their ranges on record widened, and those as triples."""
    made = harmonize.harmonize_series(t.readings(spark, sf_dir), _stored_sensors(spark, sf_dir))
    none = F.lit(0).cast("long")
    which = F.regexp_extract("predicate", "#timeSeries(Start|End)$", 1)
    return made.points.select(F.lit("point").alias("kind"), F.col("hash").alias("a"), F.col("start").alias("b"),
                              F.col("end").alias("c"), F.col("value").alias("v")).union(
        made.sensors.select(F.lit("sensor"), "hash", "first_ts", "last_ts", F.lit(0.0))).union(
        made.triples.filter(which != "").select(which, "subject", F.unix_timestamp(F.to_timestamp("object")), none, F.lit(0.0)))


BIGG = "http://bigg-project.eu/ontology#"
XSD = "http://www.w3.org/2001/XMLSchema#"
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"


@query(f"""WITH {t.READINGS}, {COVERAGE},
ids AS (
  SELECT *, printf('{V.DEVICE_URI}', cups) AS device, printf('{V.MEASUREMENT_URI}', hash) AS meas,
    strftime(make_timestamp(first_ts * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS lo,
    strftime(make_timestamp(last_ts * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS hi
  FROM coverage)
SELECT t.subject, t.predicate, t.object, t.datatype, t.object_kind FROM (
  SELECT unnest([
    {{'subject': device, 'predicate': '{BIGG}hasSensor', 'object': sensor_uri, 'datatype': NULL, 'object_kind': 'iri'}},
    {{'subject': sensor_uri, 'predicate': '{TYPE}', 'object': '{BIGG}Sensor', 'datatype': NULL, 'object_kind': 'iri'}},
    {{'subject': sensor_uri, 'predicate': '{TYPE}', 'object': '{BIGG}TimeSeriesList', 'datatype': NULL, 'object_kind': 'iri'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}timeSeriesEnd', 'object': hi, 'datatype': '{XSD}dateTime', 'object_kind': 'literal'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}timeSeriesFrequency', 'object': freq, 'datatype': NULL, 'object_kind': 'literal'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}timeSeriesIsCumulative', 'object': 'false', 'datatype': '{XSD}boolean', 'object_kind': 'literal'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}timeSeriesIsOnChange', 'object': 'false', 'datatype': '{XSD}boolean', 'object_kind': 'literal'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}timeSeriesIsRegular', 'object': 'true', 'datatype': '{XSD}boolean', 'object_kind': 'literal'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}timeSeriesStart', 'object': lo, 'datatype': '{XSD}dateTime', 'object_kind': 'literal'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}timeSeriesTimeAggregationFunction', 'object': 'SUM', 'datatype': NULL, 'object_kind': 'literal'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}hasMeasuredProperty', 'object': '{BIGG}EnergyConsumptionGridElectricity', 'datatype': NULL, 'object_kind': 'iri'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}hasMeasurementUnit', 'object': 'http://qudt.org/vocab/unit/KiloW-HR', 'datatype': NULL, 'object_kind': 'iri'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}hasEstimationMethod', 'object': '{BIGG}Profiled', 'datatype': NULL, 'object_kind': 'iri'}},
    {{'subject': sensor_uri, 'predicate': '{BIGG}hasMeasurement', 'object': meas, 'datatype': NULL, 'object_kind': 'iri'}},
    {{'subject': meas, 'predicate': '{TYPE}', 'object': '{BIGG}Measurement', 'datatype': NULL, 'object_kind': 'iri'}},
    {{'subject': meas, 'predicate': '{TYPE}', 'object': '{BIGG}TimeSeriesPoint', 'datatype': NULL, 'object_kind': 'iri'}},
    {{'subject': meas, 'predicate': '{BIGG}hash', 'object': hash, 'datatype': NULL, 'object_kind': 'literal'}}
  ]) AS t FROM ids)""")
def sensor_triples(spark, sf_dir):
    return graph.sensor_triples(_coverage(spark, sf_dir))
