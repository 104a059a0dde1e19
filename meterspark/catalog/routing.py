"""Subscriptions and routing: suppliers subscribe, by nation, to customers' supply points."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterspark.catalog import tables as t
from meterspark.catalog.registry import query, table
from meterspark.operators import routing
from meterspark.session import shared_dir
from meterspark.sources import subscriptions as sub

# Projects by balance of the supplier that subscribes: name, from, below.
BANDS = (("alpha", -1e9, 2500.0), ("beta", 2500.0, 5000.0), ("gamma", 5000.0, 7500.0),
         ("delta", 7500.0, 1e9))


def _users(sf_dir, low, high):
    def load(spark):
        return (table(spark, sf_dir, "supplier")
                .filter((F.col("s_acctbal") >= low) & (F.col("s_acctbal") < high))
                .selectExpr(
                    "s_suppkey as seq", "concat('U', s_nationkey) as username",
                    "case when s_acctbal < 4000 then array(concat('N', s_nationkey)) "
                    "when s_acctbal < 8000 then "
                    "array(concat('N', s_nationkey), concat('M', s_nationkey)) end "
                    "as authorized_nif",
                    "case when s_acctbal < 1000 then false when s_acctbal < 6000 then true end "
                    "as self",
                    "if(pmod(floor(s_acctbal / 1250), 2) = 0, cast(sequence(s_nationkey * 10, "
                    "s_nationkey * 10 + cast(floor(abs(s_acctbal) / 8) as int)) as array<string>), "
                    "null) as cups"))
    return load


def specs(sf_dir):
    return [sub.SourceSpec(name, _users(sf_dir, low, high), topic=f"{name}.readings")
            for name, low, high in BANDS]


def _subscriptions(spark, sf_dir):
    return sub.sources_union(spark, specs(sf_dir))


def _logins(spark, sf_dir):
    return routing.login_sources(_subscriptions(spark, sf_dir))


def _supplies(spark, sf_dir):
    return t.supplies(spark, sf_dir).select("seq", "username", "authorized_nif", "cups")


SUBS = """
subs AS (
  SELECT CASE WHEN s_acctbal < 2500 THEN 0 WHEN s_acctbal < 5000 THEN 1
              WHEN s_acctbal < 7500 THEN 2 ELSE 3 END AS pos,
         ['alpha', 'beta', 'gamma', 'delta'][pos + 1] AS source, s_suppkey,
         pos * 1000000000000 + s_suppkey AS seq, 'U' || s_nationkey AS username,
         CASE WHEN s_acctbal < 4000 THEN ['N' || s_nationkey]
              WHEN s_acctbal < 8000 THEN ['N' || s_nationkey, 'M' || s_nationkey] END AS nifs,
         CASE WHEN s_acctbal < 1000 THEN false WHEN s_acctbal < 6000 THEN true END AS self,
         CASE WHEN CAST(floor(s_acctbal / 1250) AS BIGINT) % 2 = 0
              THEN range(s_nationkey * 10,
                         s_nationkey * 10 + CAST(floor(abs(s_acctbal) / 8) AS INTEGER) + 1) END AS cups
  FROM supplier)"""

EXPLODED = SUBS + """,
exploded AS (
  SELECT * EXCLUDE (nifs), unnest(list_concat(coalesce(nifs, []), [''])) AS authorized_nif
  FROM subs)"""

LOGINS = EXPLODED + """,
logins AS (
  SELECT username, authorized_nif, self_wish, source, first_seq, cups FROM (
    SELECT *, coalesce(CAST(self AS VARCHAR), '') AS self_wish,
      min(seq) OVER (PARTITION BY username, authorized_nif, self, source) AS first_seq,
      row_number() OVER (PARTITION BY username, authorized_nif, self, source
                         ORDER BY seq DESC) AS rn
    FROM exploded WHERE NOT (self IS NOT DISTINCT FROM false AND authorized_nif = ''))
  WHERE rn = 1)"""

NAMED = """
listed AS (
  SELECT username, authorized_nif, self_wish, source, CAST(unnest(cups) AS VARCHAR) AS cups
  FROM logins WHERE cups IS NOT NULL),
named AS (
  SELECT username, authorized_nif, self_wish, cups, string_agg(source, ',' ORDER BY source) AS owners
  FROM listed GROUP BY ALL)"""

ROUTED = LOGINS + "," + t.SUPPLIES + "," + NAMED + """,
readers AS (
  SELECT username, authorized_nif, self_wish,
         string_agg(CASE WHEN cups IS NULL THEN source END, ',' ORDER BY first_seq) AS wild
  FROM logins GROUP BY ALL),
routed AS (
  SELECT s.seq, s.cups, r.username, r.authorized_nif, r.self_wish, coalesce(n.owners, '') AS route,
         concat_ws(',', r.wild, n.owners) AS db_list
  FROM supplies s JOIN readers r USING (username, authorized_nif)
  LEFT JOIN named n ON n.username = r.username AND n.authorized_nif = r.authorized_nif
    AND n.self_wish = r.self_wish AND n.cups = s.cups)"""


def _list_text():
    return F.coalesce(F.concat_ws(":", F.size("cups"), F.col("cups")[0]), F.lit("*"))


LIST_SQL = "CASE WHEN cups IS NULL THEN '*' ELSE len(cups) || ':' || cups[1] END"


@query(f"""WITH {SUBS}
SELECT s_suppkey AS seq, source, username, array_to_string(nifs, ',') AS authorized_nif,
  coalesce(CAST(self AS VARCHAR), '') AS self, {LIST_SQL} AS cups,
  'raw_ts_{{prop}}_{{freq}}' AS tables, 'cups,timestamp' AS row_keys FROM subs""")
def sources_union(spark, sf_dir):
    return _subscriptions(spark, sf_dir).select(
        F.col("seq.seq").alias("seq"), "source", "username",
        F.array_join("authorized_nif", ",").alias("authorized_nif"),
        F.coalesce(F.col("self").cast("string"), F.lit("")).alias("self"),
        F.when(F.col("cups").isNull(), "*").otherwise(_list_text()).alias("cups"),
        F.array_join("tables", ",").alias("tables"),
        F.array_join(F.flatten("row_keys"), ",").alias("row_keys"))


@query(f"""WITH {EXPLODED}
SELECT s_suppkey AS seq, source, username, authorized_nif,
  coalesce(CAST(self AS VARCHAR), '') AS self FROM exploded""")
def explode_authorized(spark, sf_dir):
    return routing.explode_authorized(_subscriptions(spark, sf_dir)).select(
        F.col("seq.seq").alias("seq"), "source", "username", "authorized_nif",
        F.coalesce(F.col("self").cast("string"), F.lit("")).alias("self"))


@query(f"""WITH {LOGINS}
SELECT username, authorized_nif, self_wish, string_agg(source, ',' ORDER BY first_seq) AS sources,
  string_agg(source || '=' || {LIST_SQL}, ';' ORDER BY source) AS lists
FROM logins GROUP BY username, authorized_nif, self_wish""")
def user_aggregate(spark, sf_dir):
    users = routing.user_aggregate(_subscriptions(spark, sf_dir))
    lists = F.transform(F.map_entries("dict_cups"), lambda e: F.concat(
        e["key"], F.lit("="), F.when(e["value"].isNull(), "*").otherwise(
            F.concat_ws(":", F.size(e["value"]), e["value"][0]))))
    return users.select(*routing.LOGIN, F.array_join("source", ",").alias("sources"),
                        F.array_join(F.sort_array(lists), ";").alias("lists"))


@query(f"""WITH {LOGINS}, {NAMED}
SELECT username, authorized_nif, self_wish, cups, owners,
  CAST(length(owners) AS BIGINT) AS owners_length FROM named""")
def membership_partition(spark, sf_dir):
    lists = routing.explicit_lists(_logins(spark, sf_dir))
    return routing.membership_partition(lists, routing.LOGIN, "cups", "source").select(
        *routing.LOGIN, "cups", "owners", F.col("owners_length").cast("long")
        .alias("owners_length"))


@query(f"""WITH {ROUTED}
SELECT seq, cups, username, authorized_nif, self_wish, route, db_list FROM routed""")
def route_supplies(spark, sf_dir):
    return routing.route_supplies(_logins(spark, sf_dir), _supplies(spark, sf_dir)).withColumn(
        "db_list", F.array_join("db_list", ","))


@query(f"""WITH {ROUTED}
SELECT seq, cups, username, authorized_nif, self_wish FROM routed WHERE route = ''""")
def unrouted_supplies(spark, sf_dir):
    return routing.unrouted_supplies(_logins(spark, sf_dir), _supplies(spark, sf_dir))


@query(f"""WITH {ROUTED}
SELECT seq, cups, username, authorized_nif, self_wish, route, position,
  (position - 1) // 10 AS batch_id FROM (
  SELECT *, row_number() OVER (PARTITION BY username, authorized_nif, self_wish, route
                               ORDER BY seq) AS position FROM routed)""")
def work_batches(spark, sf_dir):
    """Routed supplies, stored first, since they are counted and then numbered."""
    path = shared_dir(spark, "routed")
    routing.route_supplies(_logins(spark, sf_dir), _supplies(spark, sf_dir)).drop("db_list").write.parquet(path)
    return routing.work_batches(spark.read.parquet(path))


@query(f"""WITH {t.SUPPLIES}, known AS (SELECT DISTINCT 'U' || s_nationkey AS username FROM supplier),
large AS (
  SELECT 'U' || s_nationkey AS username, count(*) * 15 AS min_supplies FROM supplier GROUP BY ALL
  HAVING max(s_acctbal) > 7000),
counted AS (SELECT username, count(*) AS supplies FROM supplies GROUP BY ALL)
SELECT username, coalesce(supplies, 0) AS supplies, coalesce(min_supplies, 0) AS min_supplies,
  CASE WHEN coalesce(supplies, 0) > coalesce(min_supplies, 0) THEN 'complete' ELSE 'too_few' END
    AS status
FROM known LEFT JOIN counted USING (username) LEFT JOIN large USING (username)""")
def snapshot_gate(spark, sf_dir):
    login = F.format_string("U%d", "s_nationkey").alias("username")
    suppliers = table(spark, sf_dir, "supplier")
    large = (suppliers.groupBy(login)
             .agg((F.count(F.lit(1)) * 15).alias("min_supplies"), F.max("s_acctbal").alias("top"))
             .filter("top > 7000").select("username", "min_supplies"))
    return routing.snapshot_gate(_supplies(spark, sf_dir), large, suppliers.select(login))


@query(f"""WITH {t.READINGS}
SELECT 'alpha' AS source, seq, cups, "consumptionKWh" AS value FROM readings
UNION ALL
SELECT 'beta', seq, cups, "consumptionKWh" * 1000 FROM readings WHERE "obtainMethod" = 'Real'""")
def plugin_transform(spark, sf_dir):
    """One source takes readings as they are, another only measured ones, in watt-hours."""
    def measured(df):
        return (df.filter(F.col("obtainMethod") == "Real")
                .withColumn("consumptionKWh", F.col("consumptionKWh") * 1000))

    plain = sub.SourceSpec("alpha", lambda s: None)
    watts = sub.SourceSpec("beta", lambda s: None, prepare=measured)
    parts = sub.plugin_transform(t.readings(spark, sf_dir), [plain, watts])
    tagged = [df.select(F.lit(name).alias("source"), "seq", "cups",
                        F.col("consumptionKWh").alias("value")) for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1])
