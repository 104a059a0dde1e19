"""Chunk calendar, coverage and state."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterspark.catalog import tables as t
from meterspark.catalog.registry import AS_OF, query, stamp, table, text
from meterspark.functions import clock
from meterspark.operators import chunks
from meterspark.schemas import SERIES
from meterspark.session import shared_dir
from meterspark.sources import landing

STATE_SQL = """cups, data_type, chunk_key, strftime(date_ini, '%Y-%m-%d %H:%M:%S') AS date_ini,
  strftime(date_end, '%Y-%m-%d %H:%M:%S') AS date_end, CAST("values" AS BIGINT) AS "values",
  CAST(total AS BIGINT) AS total, CAST(retries AS BIGINT) AS retries,
  strftime(date_min, '%Y-%m-%d %H:%M:%S') AS date_min,
  strftime(date_max, '%Y-%m-%d %H:%M:%S') AS date_max"""


def state_columns(df):
    return df.select("cups", "data_type", "chunk_key", stamp("date_ini").alias("date_ini"),
                     stamp("date_end").alias("date_end"), "values", "total",
                     F.col("retries").cast("long").alias("retries"),
                     stamp("date_min").alias("date_min"), stamp("date_max").alias("date_max"))


@query(f"""WITH {t.CALENDAR}
SELECT cups, data_type, chunk_key, strftime(date_ini, '%Y-%m-%d %H:%M:%S') AS date_ini,
  strftime(date_end, '%Y-%m-%d %H:%M:%S') AS date_end, CAST(total AS BIGINT) AS total
FROM calendar""")
def chunk_calendar(spark, sf_dir):
    return t.calendar(spark, sf_dir).select(
        "cups", "data_type", "chunk_key", stamp("date_ini").alias("date_ini"),
        stamp("date_end").alias("date_end"), "total")


@query("""
WITH days AS (
  SELECT DISTINCT date_trunc('month', o_orderdate) AS ini,
         last_day(o_orderdate) + TIME '23:59:59' AS fin
  FROM orders),
per AS (
  SELECT ini, fin, CAST(floor((epoch(fin AT TIME ZONE 'Europe/Madrid')
         - epoch(CAST(ini AS TIMESTAMP) AT TIME ZONE 'Europe/Madrid')) / 3600) AS BIGINT) + 1 AS h,
         CAST(floor((epoch(fin AT TIME ZONE 'Europe/Madrid')
         - epoch(CAST(ini AS TIMESTAMP) AT TIME ZONE 'Europe/Madrid')) / 900) AS BIGINT) + 1 AS q
  FROM days)
SELECT o_orderkey AS supply, strftime(o_orderdate, '%Y-%m') AS month, h AS pt1h, q AS pt15m,
       CAST(1 AS BIGINT) AS p1m
FROM orders JOIN per ON date_trunc('month', o_orderdate) = ini""")
def expected_elements(spark, sf_dir):
    """Readings a complete month has, for the month of every order."""
    ini = F.trunc("o_orderdate", "month")
    end = clock.end_of_day(F.last_day("o_orderdate"))
    step = {x.freq: F.lit(x.step_seconds).cast("int") for x in SERIES}
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("supply"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        *[clock.expected_elements(ini.cast("timestamp_ntz"), end, s).alias(freq.lower())
          for freq, s in step.items()])


@query(f"""WITH {t.READINGS}, {t.OBSERVED}
SELECT cups, data_type, chunk_key, observed, first_ts, last_ts FROM observed""")
def chunk_observed(spark, sf_dir):
    return t.observed(spark, sf_dir)


@query(f"""WITH {t.READINGS}, {t.CALENDAR}, {t.OBSERVED}
SELECT cups, data_type, chunk_key, strftime(date_ini, '%Y-%m-%d %H:%M:%S') AS date_ini,
  CAST(total AS BIGINT) AS total, coalesce(observed, 0) AS observed,
  CAST(greatest(total - coalesce(observed, 0), 0) AS BIGINT) AS missing,
  coalesce(observed, 0) >= total AS complete
FROM calendar LEFT JOIN observed USING (cups, data_type, chunk_key)""")
def chunk_coverage(spark, sf_dir):
    covered = chunks.chunk_coverage(t.calendar(spark, sf_dir), t.observed(spark, sf_dir))
    return covered.select("cups", "data_type", "chunk_key", stamp("date_ini").alias("date_ini"),
                          "total", "observed", "missing", "complete")


@query(f"WITH {t.CALENDAR}, {t.STATE} SELECT {STATE_SQL} FROM state")
def chunk_state_init(spark, sf_dir):
    return state_columns(chunks.chunk_state_init(
        t.calendar(spark, sf_dir), t.stored_state(spark, sf_dir)))


@query(f"""WITH {t.CALENDAR}, {t.STATE}
SELECT {STATE_SQL} FROM state
WHERE "values" < total AND retries > 0 AND date_ini > TIMESTAMP '2022-02-01'""")
def incomplete_chunks(spark, sf_dir):
    return state_columns(chunks.incomplete_chunks(t.state(spark, sf_dir), AS_OF))


@query(f"""WITH {t.CALENDAR}, {t.STATE}
SELECT username, cups, data_type, chunk_key,
  CASE WHEN data_type = 'Power_P1M' THEN 'max_power' ELSE 'consumption' END AS endpoint,
  "distributorCode" AS distributor_code, strftime(date_ini, '%Y-%m-%d') AS start_date,
  strftime(date_end, '%Y-%m-%d') AS end_date,
  CASE data_type WHEN 'EnergyConsumptionGridElectricity_PT1H' THEN '0'
                 WHEN 'EnergyConsumptionGridElectricity_PT15M' THEN '1' END AS measurement_type,
  CASE WHEN data_type <> 'Power_P1M' THEN CAST("pointType" AS VARCHAR) END AS point_type,
  authorized_nif
FROM state JOIN supplies USING (cups)
WHERE "values" < total AND retries > 0 AND date_ini > TIMESTAMP '2022-02-01'""")
def request_plan(spark, sf_dir):
    return chunks.request_plan(t.state(spark, sf_dir), t.supplies(spark, sf_dir), AS_OF)


RETRY = """
tried AS MATERIALIZED (
  SELECT s.*, "values" < total AND retries > 0 AND date_ini > TIMESTAMP '2022-02-01' AS attempted,
         coalesce(observed, 0) AS seen, first_ts, last_ts
  FROM state s LEFT JOIN observed USING (cups, data_type, chunk_key)),
retried AS MATERIALIZED (
  SELECT chunk_id, cups, data_type, chunk_key, date_ini, date_end, total,
    CASE WHEN attempted THEN seen ELSE "values" END AS "values",
    CASE WHEN attempted AND seen = "values" THEN retries - 1 ELSE retries END AS retries,
    CASE WHEN attempted AND seen > 0 THEN make_timestamp(first_ts * 1000000) ELSE date_min END AS date_min,
    CASE WHEN attempted AND seen > 0 THEN make_timestamp(last_ts * 1000000) ELSE date_max END AS date_max
  FROM tried)"""


@query(f"""WITH {t.READINGS}, {t.CALENDAR}, {t.OBSERVED}, {t.STATE}, {RETRY}
SELECT {STATE_SQL} FROM retried""")
def retry_state(spark, sf_dir):
    return state_columns(chunks.retry_state(
        t.state(spark, sf_dir), t.observed(spark, sf_dir), AS_OF))


UPSERT = f"""WITH {t.READINGS}, {t.CALENDAR}, {t.OBSERVED}, {t.STATE}, {RETRY},
delivered AS MATERIALIZED (SELECT DISTINCT cups FROM observed),
fresh AS MATERIALIZED (SELECT * FROM retried SEMI JOIN delivered USING (cups)),
kept AS (SELECT * FROM stored ANTI JOIN fresh USING (chunk_id))
SELECT {STATE_SQL} FROM fresh
UNION ALL
SELECT {STATE_SQL} FROM (
  SELECT cups, data_type, chunk_key, date_ini, date_end, total, "values", retries,
         CASE WHEN "values" > 0 THEN date_ini END AS date_min,
         CASE WHEN "values" > 0 THEN date_end END AS date_max FROM kept)"""


def _delivered(spark, sf_dir):
    """New state of the meters that delivered."""
    seen = t.observed(spark, sf_dir)
    new = chunks.retry_state(t.state(spark, sf_dir), seen, AS_OF)
    return new.join(seen.select("cups").distinct(), "cups", "left_semi")


@query(UPSERT)
def chunk_state_upsert(spark, sf_dir):
    """Chunks of the meters that delivered replace those on record."""
    return state_columns(chunks.chunk_state_upsert(t.stored_state(spark, sf_dir), _delivered(spark, sf_dir)))


@query(UPSERT)
def chunk_state_update(spark, sf_dir):
    """The same in a stored table, of which just the slots of those meters are written again."""
    path, new = shared_dir(spark, "chunk-state"), shared_dir(spark, "chunk-state-new")
    landing.write_chunk_state(t.stored_state(spark, sf_dir), path, slots=32)
    _delivered(spark, sf_dir).write.parquet(new)
    landing.update_chunk_state(spark, path, landing.read_chunk_state(spark, new), slots=32)
    return state_columns(landing.read_chunk_state(spark, path))


@query(f"""WITH {t.CALENDAR}, {t.STATE}
SELECT {STATE_SQL} FROM state WHERE chunk_key < '2023-06-01~2023-06-30'""")
def chunk_prune(spark, sf_dir):
    return state_columns(chunks.chunk_prune(t.state(spark, sf_dir), "2023-06-01~2023-06-30"))


@query(f"""WITH {t.CALENDAR}, {t.STATE}
SELECT cups, string_agg(p, ',' ORDER BY p) AS measurements FROM (
  SELECT DISTINCT cups, split_part(data_type, '_', 1) || '/' || split_part(data_type, '_', 2) AS p
  FROM state WHERE "values" < total AND retries > 0 AND date_ini > TIMESTAMP '2022-02-01')
GROUP BY cups""")
def supply_measurements(spark, sf_dir):
    pairs = F.transform("measurements", lambda m: F.concat_ws("/", m["property"], m["freq"]))
    return chunks.supply_measurements(t.state(spark, sf_dir), AS_OF).select(
        "cups", F.array_join(F.sort_array(pairs), ",").alias("measurements"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS cups,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS start_date,
  strftime(last_day(o_orderdate), '%Y-%m-%d') AS end_date FROM orders""")
def month_request_window(spark, sf_dir):
    start, end = chunks.month_request_window(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("cups"), text(start).alias("start_date"),
        text(end).alias("end_date"))


@query(f"""WITH {t.READINGS}, {t.CALENDAR}, {t.STATE},
asked AS (
  SELECT cups, data_type, date_ini, date_end FROM state
  WHERE "values" < total AND retries > 0 AND date_ini > TIMESTAMP '2022-02-01')
SELECT r.cups, data_type, r."timestamp", r.seq FROM readings r
JOIN asked a ON a.cups = r.cups AND a.data_type = r.prop || '_' || r.freq
 AND to_timestamp(r."timestamp") AT TIME ZONE 'Europe/Madrid' BETWEEN date_ini AND date_end""")
def requested_readings(spark, sf_dir):
    """Readings of the chunks that are still worth a request."""
    landed = t.readings(spark, sf_dir).select(
        "cups", "seq", "timestamp", F.concat_ws("_", "prop", "freq").alias("data_type"),
        landing.local_month(F.col("timestamp")).alias("month"))
    requests = chunks.request_plan(t.state(spark, sf_dir), t.supplies(spark, sf_dir), AS_OF)
    return landing.requested_readings(landed, requests).select(
        "cups", "data_type", "timestamp", "seq")
