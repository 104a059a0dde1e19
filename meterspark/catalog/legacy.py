"""Line items, split by return flag, as two legacy tables with composite keys."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterspark.catalog.registry import query, table
from meterspark.operators import legacy
from meterspark.plans.legacy import merge_legacy
from meterspark.session import shared_dir

NEWEST = ["day", "part", "supplier", "consumptionKWh", "price", "obtainMethod", "flag"]


def _rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("~", "l_orderkey", "l_linenumber").alias("key"),
        F.col("l_quantity").alias("consumptionKWh"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("obtainMethod"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag"))


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS hash, CAST(l_linenumber AS BIGINT) AS start_time,
  l_quantity AS "consumptionKWh", strftime(l_shipdate, '%Y-%m-%d') AS day, l_partkey AS part
FROM lineitem""")
def composite_key_scan(spark, sf_dir):
    return legacy.composite_key_scan(_rows(spark, sf_dir)).select(
        "hash", "start_time", "consumptionKWh", "day", "part")


@query("""SELECT l_orderkey || '~' || l_linenumber AS key, l_quantity AS "consumptionKWh",
  CASE WHEN l_returnflag <> 'N' THEN l_linestatus ELSE '<null>' END AS "obtainMethod",
  strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem""")
def tsv_roundtrip(spark, sf_dir):
    """Write the rows as tab-separated text, nulls marked, and read them back."""
    path = shared_dir(spark, "tsv")
    rows = _rows(spark, sf_dir).select("key", "consumptionKWh", "obtainMethod", "day")
    legacy.write_tsv(rows, path)
    return (legacy.read_tsv(spark, path, T.StructType(rows.schema.fields))
            .withColumn("obtainMethod", F.coalesce("obtainMethod", F.lit("<null>"))))


@query("""
SELECT hash, start_time, "consumptionKWh", day, part, flag FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS hash, CAST(l_linenumber AS BIGINT) AS start_time,
    l_quantity AS "consumptionKWh", strftime(l_shipdate, '%Y-%m-%d') AS day, l_partkey AS part,
    l_returnflag AS flag,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY (l_returnflag = 'R') DESC,
      l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def merge_tables_lww(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    tables = [rows.filter("flag <> 'R'"), rows.filter("flag = 'R'")]
    return merge_legacy(tables, NEWEST).select(
        "hash", "start_time", "consumptionKWh", "day", "part", "flag")


@query("""
SELECT event_type, (rn - 1) // 1000 AS part, string_agg(user_id, ',' ORDER BY rn) AS "values"
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
GROUP BY ALL""")
def group_values(spark, sf_dir):
    """Meters in the order of their events, by kind of event: five keys hold all rows."""
    return legacy.group_values(table(spark, sf_dir, "events"), "event_type", "user_id",
                               "event_id").withColumn("values", F.array_join("values", ","))


@query("""SELECT event_type, count(*) AS n, min(value) AS low, max(value) AS high
FROM events GROUP BY event_type""")
def reduce_groups(spark, sf_dir):
    """A reducer of older runs is an aggregate here; no operator stands behind it."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
