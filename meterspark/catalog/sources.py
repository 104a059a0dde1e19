"""Landed snapshots, state and exchange files: written in their layouts, then read by the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterspark.catalog import tables as t
from meterspark.catalog.chunks import STATE_SQL, state_columns
from meterspark.catalog.registry import query, table, text
from meterspark.operators import legacy, readings as R
from meterspark.plans.legacy import export_tables, import_rows
from meterspark.session import shared_dir
from meterspark.sources import landing
from meterspark.sources.subscriptions import subscription_scan as scan_users


@query("""SELECT CAST(c_custkey AS BIGINT) AS seq, c_name AS username,
  CASE WHEN c_acctbal < 3000 THEN '-' ELSE 'N' || c_nationkey END AS nifs, c_acctbal > 0 AS self,
  CASE WHEN c_nationkey % 2 = 0 THEN c_custkey || ',' || c_nationkey ELSE '-' END AS cups FROM customer""")
def subscription_scan(spark, sf_dir):
    """Users as nodes that also hold a password and an address, which are not read."""
    nodes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("long").alias("seq"), F.col("c_name").alias("username"),
        F.when(F.col("c_acctbal") >= 3000, F.array(F.concat(F.lit("N"), "c_nationkey"))).alias("authorized_nif"),
        (F.col("c_acctbal") > 0).alias("self"),
        F.when(F.col("c_nationkey") % 2 == 0, F.array(text("c_custkey"), text("c_nationkey"))).alias("cups"),
        F.lit("secret").alias("password"), F.col("c_mktsegment").alias("address"))
    users = scan_users(nodes)
    assert "password" not in users.columns
    return users.select("seq", "username", "self", *[
        F.coalesce(F.array_join(c, ","), F.lit("-")).alias(name)
        for c, name in (("authorized_nif", "nifs"), ("cups", "cups"))])


@query(f"""WITH {t.SUPPLIES}
SELECT CAST(seq AS BIGINT) AS seq, cups, username, authorized_nif, "distributorCode",
  CAST("pointType" AS BIGINT) AS "pointType", coalesce("validDateTo", '-') AS "validDateTo",
  '-' AS province FROM supplies""")
def supplies_scan(spark, sf_dir):
    """Supplies landed as JSON: columns beyond the layout are left, absent ones are null."""
    path = shared_dir(spark, "supplies")
    t.supplies(spark, sf_dir).write.mode("overwrite").json(path)
    return landing.read_supplies(spark, path).select(
        "seq", "cups", "username", "authorized_nif", "distributorCode",
        F.col("pointType").cast("long").alias("pointType"),
        F.coalesce("validDateTo", F.lit("-")).alias("validDateTo"),
        F.coalesce("province", F.lit("-")).alias("province"))


@query("""SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS seq, CAST(l_orderkey AS VARCHAR) AS cups,
  strftime(l_shipdate, '%Y-%m-%d') AS "startDate",
  CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE '-' END AS marketer,
  CASE WHEN l_linestatus = 'F' THEN '[' || l_linenumber || ',' || l_suppkey || ']'
       ELSE CAST(l_linenumber AS VARCHAR) END AS power FROM lineitem""")
def contract_scan(spark, sf_dir):
    """Contracts landed as JSON, whose power is a number or a list of numbers: both are kept as given."""
    path = shared_dir(spark, "contracts")
    both = F.format_string('{"seq":%d,"cups":"%d","startDate":"%s","marketer":%s,"contractedPowerkW":%s}',
                           F.col("l_orderkey") * 8 + F.col("l_linenumber"), F.col("l_orderkey"),
                           t.iso_day("l_shipdate"),
                           F.when(F.col("l_returnflag") != "N", F.concat(F.lit('"'), "l_returnflag", F.lit('"')))
                           .otherwise("null"),
                           F.when(F.col("l_linestatus") == "F", F.concat(
                               F.lit("["), "l_linenumber", F.lit(","), "l_suppkey", F.lit("]")))
                           .otherwise(text("l_linenumber")))
    table(spark, sf_dir, "lineitem").select(both.alias("value")).write.mode("overwrite").text(path)
    return landing.read_contracts(spark, path).select(
        "seq", "cups", "startDate", F.coalesce("marketer", F.lit("-")).alias("marketer"),
        F.col("contractedPowerkW").alias("power"))


@query(f"""WITH {t.CALENDAR}, {t.STORED_STATE},
kept AS (
  SELECT *, CASE WHEN "values" > 0 THEN date_ini END AS date_min,
         CASE WHEN "values" > 0 THEN date_end END AS date_max FROM stored)
SELECT {STATE_SQL} FROM kept""")
def chunk_state_read(spark, sf_dir):
    """The state of an earlier run, stored and read in its declared layout."""
    path = shared_dir(spark, "chunk-state")
    t.stored_state(spark, sf_dir).write.mode("overwrite").parquet(path)
    return state_columns(landing.read_chunk_state(spark, path))


@query("""SELECT CAST(event_id AS BIGINT) AS seq, CAST(user_id AS VARCHAR) AS key, value FROM events""")
def keyed_sink(spark, sf_dir):
    """Keyed rows written in files of a bounded number of rows."""
    path = shared_dir(spark, "keyed")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("long").alias("seq"), text("user_id").alias("key"), "value")
    legacy.write_keyed(rows, path, rows_per_file=10_000)
    return spark.read.schema(rows.schema).parquet(path)


@query("""
SELECT hash, start_time, consumption, datetime, coalesce(obtain, '-') AS obtain FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS hash, CAST(l_linenumber AS BIGINT) AS start_time,
    l_quantity AS consumption, strftime(l_shipdate, '%Y-%m-%d') AS datetime,
    CASE WHEN l_returnflag <> 'N' THEN l_linestatus END AS obtain,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY (l_returnflag = 'R') DESC,
      l_shipdate DESC, l_quantity DESC,
      CASE WHEN l_returnflag <> 'N' THEN l_linestatus ELSE '' END DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def legacy_exchange(spark, sf_dir):
    """Two legacy tables as exchange files and back: rows of the later table win."""
    path = shared_dir(spark, "exchange")
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("~", "l_orderkey", "l_linenumber").alias("key"),
        F.col("l_quantity").cast("float").alias("consumptionKWh"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("obtainMethod"),
        t.iso_day("l_shipdate").alias("datetime"), F.col("l_returnflag").alias("flag"))
    export_tables([rows.filter("flag <> 'R'").drop("flag"), rows.filter("flag = 'R'").drop("flag")], path)
    return import_rows(spark, path, ["datetime", "consumptionKWh", "obtainMethod"]).select(
        "hash", "start_time", F.col("consumptionKWh").cast("double").alias("consumption"), "datetime",
        F.coalesce("obtainMethod", F.lit("-")).alias("obtain"))


@query("""SELECT CAST(event_id AS BIGINT) AS seq, value FROM events
WHERE event_type IN ('signup', 'view') OR value > 60""")
def rejected_readings(spark, sf_dir):
    """Readings whose meter or instant is missing go to quarantine."""
    missing_meter, missing_time = F.col("consumptionKWh") > 60, F.col("event_type").isin("signup", "view")
    raw = table(spark, sf_dir, "events").withColumnRenamed("value", "consumptionKWh").select(
        F.col("event_id").cast("long").alias("seq"), F.when(~missing_meter, text("user_id")).alias("cups"),
        F.when(~missing_time, F.col("ts")).alias("datetime"), "consumptionKWh")
    return R.rejected_readings(raw).select("seq", F.col("consumptionKWh").alias("value"))
