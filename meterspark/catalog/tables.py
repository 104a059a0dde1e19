"""The synthetic tables in the roles of this domain, as DataFrames and as SQL.

Each function has a constant of the same name in capitals: the same relation as a SQL
common table expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterspark.catalog.registry import AS_OF, table
from meterspark.operators import chunks, readings as R

CONSUMPTION = "EnergyConsumptionGridElectricity"


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as meter readings; the kind of event decides the series."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as seq", "cast(user_id as string) as cups", "cast(ts as timestamp) as datetime",
        "value as consumptionKWh",
        "if(event_type = 'purchase', 'Real', 'Estimated') as obtainMethod",
        f"if(event_type = 'error', 'Power', '{CONSUMPTION}') as prop",
        "case event_type when 'signup' then 'PT15M' when 'error' then 'P1M' else 'PT1H' end as freq")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.parse_consumption(raw_readings(spark, sf_dir))


READINGS = """
readings AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS cups, ts AS datetime,
         epoch_us(ts) // 1000000 AS "timestamp", value AS "consumptionKWh",
         CASE WHEN event_type = 'purchase' THEN 'Real' ELSE 'Estimated' END AS "obtainMethod",
         CASE WHEN event_type = 'error' THEN 'Power'
              ELSE 'EnergyConsumptionGridElectricity' END AS prop,
         CASE event_type WHEN 'signup' THEN 'PT15M' WHEN 'error' THEN 'P1M' ELSE 'PT1H' END AS freq
  FROM events)"""


def supplies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as supply points; some ended in 2023, some end later, some have no usable date."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as seq", "cast(c_custkey as string) as cups",
        "concat('U', c_nationkey) as username",
        "case when c_acctbal < 3000 then '' when c_acctbal < 7000 then concat('N', c_nationkey) "
        "else concat('M', c_nationkey) end as authorized_nif",
        "c_mktsegment as distributorCode", "c_nationkey % 5 as pointType",
        "case when c_acctbal < 0 then concat('2023/', c_nationkey div 3 + 1, '/', c_nationkey + 1) "
        "when c_acctbal > 9000 then '2031/12/31' when c_acctbal > 8000 then 'n/a' end "
        "as validDateTo",
        "c_acctbal as balance", "c_nationkey as nation")


SUPPLIES = """
supplies AS (
  SELECT c_custkey AS seq, CAST(c_custkey AS VARCHAR) AS cups, 'U' || c_nationkey AS username,
         CASE WHEN c_acctbal < 3000 THEN '' WHEN c_acctbal < 7000 THEN 'N' || c_nationkey
              ELSE 'M' || c_nationkey END AS authorized_nif,
         c_mktsegment AS "distributorCode", c_nationkey % 5 AS "pointType",
         CASE WHEN c_acctbal < 0 THEN '2023/' || (c_nationkey // 3 + 1) || '/' || (c_nationkey + 1)
              WHEN c_acctbal > 9000 THEN '2031/12/31'
              WHEN c_acctbal > 8000 THEN 'n/a' END AS "validDateTo",
         c_acctbal AS balance, c_nationkey AS nation
  FROM customer)"""


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_calendar(chunks.by_meter(supplies(spark, sf_dir)), AS_OF)


CALENDAR = SUPPLIES + """,
months AS MATERIALIZED (
  SELECT CAST(unnest(generate_series(TIMESTAMP '2022-02-01', TIMESTAMP '2024-01-01',
                                     INTERVAL 1 MONTH)) AS DATE) AS m),
blocks AS (
  SELECT 'EnergyConsumptionGridElectricity_PT1H' AS data_type, m AS ini, last_day(m) AS fin,
         3600 AS step FROM months
  UNION ALL
  SELECT 'EnergyConsumptionGridElectricity_PT15M', m, last_day(m), 900 FROM months
  UNION ALL
  SELECT 'Power_P1M', m, last_day(CAST(m + INTERVAL 5 MONTH AS DATE)), NULL FROM months
  WHERE month(m) IN (2, 8)),
sized AS MATERIALIZED (
  SELECT data_type, ini, strftime(ini, '%Y-%m-%d') || '~' || strftime(fin, '%Y-%m-%d') AS chunk_key,
         CAST(ini AS TIMESTAMP) AS date_ini, fin + TIME '23:59:59' AS date_end,
         CASE WHEN step IS NULL THEN 6
              ELSE CAST(floor((epoch((fin + TIME '23:59:59') AT TIME ZONE 'Europe/Madrid')
                   - epoch(CAST(ini AS TIMESTAMP) AT TIME ZONE 'Europe/Madrid')) / step) AS BIGINT) + 1
              END AS total
  FROM blocks),
tracked AS MATERIALIZED (
  SELECT cups, CAST(unnest(generate_series(TIMESTAMP '2022-02-01', history_end, INTERVAL 1 MONTH)) AS DATE) AS ini
  FROM (SELECT cups, CASE WHEN last_day(TRY_STRPTIME("validDateTo", '%Y/%m/%d')) <= DATE '2024-01-31'
                          THEN last_day(TRY_STRPTIME("validDateTo", '%Y/%m/%d'))
                          ELSE DATE '2024-01-31' END + TIME '23:59:59' AS history_end
        FROM supplies)),
calendar AS MATERIALIZED (
  SELECT cups || '/' || data_type || '/' || chunk_key AS chunk_id, cups, data_type, chunk_key, date_ini, date_end,
         total
  FROM tracked JOIN sized USING (ini))"""


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_observed(readings(spark, sf_dir), AS_OF)


OBSERVED = """
local AS (
  SELECT cups, prop || '_' || freq AS data_type, "timestamp",
         CAST(date_trunc('month', to_timestamp("timestamp") AT TIME ZONE 'Europe/Madrid') AS DATE) AS m
  FROM readings),
chunked AS (
  SELECT cups, data_type, "timestamp",
         CASE WHEN data_type <> 'Power_P1M' THEN m
              WHEN month(m) IN (2, 3, 4, 5, 6, 7) THEN make_date(year(m), 2, 1)
              WHEN month(m) = 1 THEN make_date(year(m) - 1, 8, 1)
              ELSE make_date(year(m), 8, 1) END AS ini
  FROM local WHERE m >= DATE '2022-02-01'),
observed AS MATERIALIZED (
  SELECT cups, data_type,
         strftime(ini, '%Y-%m-%d') || '~' || strftime(last_day(CASE WHEN data_type = 'Power_P1M'
           THEN CAST(ini + INTERVAL 5 MONTH AS DATE) ELSE ini END), '%Y-%m-%d') AS chunk_key,
         count(*) AS observed, min("timestamp") AS first_ts, max("timestamp") AS last_ts
  FROM chunked GROUP BY ALL)"""


def stored_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of an earlier run: two segments' chunks, some complete, some out of retries."""
    stored = supplies(spark, sf_dir).filter(F.col("distributorCode").isin("BUILDING", "MACHINERY"))
    return (chunks.chunk_calendar(chunks.by_meter(stored), AS_OF, keep=("balance", "nation"))
            .withColumn("values", F.expr(
                "if(balance > 5000, total, cast(floor(abs(balance) / 100) as bigint))"))
            .selectExpr("cups", "data_type", "chunk_key", "date_ini", "date_end", "values", "total",
                        "cast(nation div 4 as int) as retries",
                        "cast(if(values > 0, date_ini, null) as timestamp) as date_min",
                        "cast(if(values > 0, date_end, null) as timestamp) as date_max"))


STORED_STATE = """
stored AS MATERIALIZED (
  SELECT c.*, CASE WHEN balance > 5000 THEN total ELSE CAST(floor(abs(balance) / 100) AS BIGINT) END
           AS "values", nation // 4 AS retries
  FROM calendar c JOIN supplies USING (cups)
  WHERE "distributorCode" IN ('BUILDING', 'MACHINERY'))"""


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.tracked_state(calendar(spark, sf_dir), stored_state(spark, sf_dir))


STATE = STORED_STATE + """,
state AS MATERIALIZED (
  SELECT c.chunk_id, c.cups, c.data_type, c.chunk_key, c.date_ini, c.date_end, c.total,
         CASE WHEN s.cups IS NULL THEN 0 ELSE s."values" END AS "values",
         CASE WHEN s.cups IS NULL THEN 6 ELSE s.retries END AS retries,
         CASE WHEN s."values" > 0 THEN s.date_ini END AS date_min,
         CASE WHEN s."values" > 0 THEN s.date_end END AS date_max
  FROM calendar c LEFT JOIN stored s
    ON c.chunk_id = s.chunk_id)"""


def iso_day(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")
