"""Operators in the modes that older runs used, and helpers of the graph tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterspark.catalog import tables as t
from meterspark.catalog.readings import POINTS
from meterspark.catalog.registry import AS_OF, query, stamp, table, text
from meterspark.catalog.supplies import LATEST, PLACES, gazetteer, latest_contracts
from meterspark import vocabulary as V
from meterspark.functions.text import any_order_similarity
from meterspark.operators import chunks, graph, supplies as S, timeseries as TS
from meterspark.schemas import SERIES
from meterspark.sources.gazetteer import gazetteer_pattern

HOURLY = next(s.name for s in SERIES if s.name.endswith("_PT1H"))
CUTOFF = "2023-06-01~2023-06-30"

STRICT_CALENDAR = t.CALENDAR.replace("        FROM supplies)),\ncalendar", """        FROM (
    SELECT cups, CASE WHEN regexp_full_match("validDateTo", '[0-9]{4}/[0-9]{1,2}/[0-9]')
                      THEN "validDateTo" END AS "validDateTo" FROM supplies))),
calendar""")


@query(f"""WITH {STRICT_CALENDAR}
SELECT cups, data_type, chunk_key, strftime(date_end, '%Y-%m-%d %H:%M:%S') AS date_end,
  CAST(total AS BIGINT) AS total FROM calendar""")
def chunk_calendar_strict(spark, sf_dir):
    """Only ends whose day has one digit are read, so other supplies that ended stay active."""
    return chunks.chunk_calendar(chunks.by_meter(t.supplies(spark, sf_dir)), AS_OF, strict_valid_to=True).select(
        "cups", "data_type", "chunk_key", stamp("date_end").alias("date_end"), "total")


@query(f"""WITH {t.READINGS} SELECT * REPLACE ('True' AS "isReal") FROM ({POINTS})""")
def harmonize_constant_real(spark, sf_dir):
    points = TS.harmonize_timeseries(t.readings(spark, sf_dir), constant_is_real=True)
    return points.withColumn("bucket", F.col("bucket").cast("long"))


@query(f"""WITH {LATEST}
SELECT CAST(o_orderkey AS VARCHAR) AS cups, CAST(o_custkey AS VARCHAR) AS username,
  coalesce("startDate", '-') AS "startDate", part
FROM orders LEFT JOIN (SELECT * FROM latest WHERE tension = 'F') ON cups = CAST(o_orderkey AS VARCHAR)""")
def keep_uncontracted(spark, sf_dir):
    """Supplies without a contract stay, with nulls."""
    given = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("cups"), text("o_custkey").alias("username"))
    offers = latest_contracts(spark, sf_dir).filter("tension = 'F'")
    return S.supply_contract_merge(given, offers, keep_uncontracted=True).select(
        "cups", "username", F.coalesce("startDate", F.lit("-")).alias("startDate"), "part")


@query(f"""WITH {PLACES},
probes AS (
  SELECT DISTINCT array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS probe FROM part),
names AS (
  SELECT probe, lower(probe) AS p, array_to_string(list_sort(string_split(lower(probe), ' ')), ' ') AS ps
  FROM probes),
entries AS (
  SELECT lower(name) AS g, array_to_string(list_sort(string_split(lower(name), ' ')), ' ') AS gs,
         min(geo_id) AS geo_id FROM places GROUP BY ALL),
scored AS (
  SELECT probe, geo_id, greatest(
    1.0::DOUBLE - levenshtein(p, g)::DOUBLE / greatest(length(p), length(g), 1),
    CASE WHEN p = g THEN 0 ELSE 0.95::DOUBLE * (
      1.0::DOUBLE - levenshtein(ps, gs)::DOUBLE / greatest(length(ps), length(gs), 1)) END) AS score
  FROM names, entries)
SELECT probe, geo_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY probe ORDER BY score DESC, geo_id) AS rn FROM scored)
WHERE rn = 1""")
def fuzzy_any_order(spark, sf_dir):
    """Names of parts, their words in reverse order."""
    names = table(spark, sf_dir, "part").select(
        F.array_join(F.reverse(F.split("p_name", " ")), " ").alias("municipality"))
    places = gazetteer_pattern(gazetteer(spark, sf_dir), V.MUNICIPALITY_LEVEL)
    return S.fuzzy_place_match(names, places, "municipality", score=any_order_similarity).withColumn(
        "score", F.round("score", 6))


@query(f"""WITH {t.CALENDAR}, {t.STORED_STATE}
SELECT cups, chunk_key, CAST("values" AS BIGINT) AS "values" FROM stored
WHERE data_type = '{HOURLY}' AND chunk_key < '{CUTOFF}'""")
def chunk_prune_nested(spark, sf_dir):
    """Documents with one map of chunks each, pruned and taken apart."""
    documents = (t.stored_state(spark, sf_dir).filter(F.col("data_type") == HOURLY).groupBy("cups")
                 .agg(F.map_from_entries(F.collect_list(F.struct("chunk_key", "values"))).alias("hourly")))
    return chunks.chunk_prune_nested(documents, CUTOFF, ["hourly"]).select(
        "cups", F.explode("hourly").alias("chunk_key", "values"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS uri, c_name AS name,
  CASE WHEN c_acctbal > 0 THEN 'new' ELSE c_mktsegment END AS segment,
  CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '-' END AS nation FROM customer""")
def stored_properties(spark, sf_dir):
    """Properties on record, some replaced and some new, as one row per node."""
    customers = table(spark, sf_dir, "customer")

    def rows(df, **values):
        facts = F.array(*[F.struct(F.lit(p).alias("property"), v.alias("value"),
                                   F.lit("string").alias("datatype")) for p, v in values.items()])
        return df.select(text("c_custkey").alias("uri"), F.explode(facts).alias("f")).select("uri", "f.*")

    merged = graph.upsert_properties(
        rows(customers, name=F.col("c_name"), segment=F.col("c_mktsegment")),
        rows(customers.filter("c_acctbal > 0"), segment=F.lit("new"), nation=text("c_nationkey")))
    nodes = graph.node_table(merged, {c: c for c in ("name", "segment", "nation")})
    return nodes.withColumn("nation", F.coalesce("nation", F.lit("-")))
