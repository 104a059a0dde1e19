"""Supply records: orders are supplies, line items their contracts, parts the gazetteer."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterspark import vocabulary as V
from meterspark.catalog import tables as t
from meterspark.catalog.registry import query, table, text
from meterspark.operators import supplies as S
from meterspark.plans import harmonize
from meterspark.schemas import SUPPLY
from meterspark.sources import landing
from meterspark.sources.gazetteer import gazetteer_pattern as places_of_level

NEWEST = ("startDate", "linenumber", "part", "supplier", "quantity", "price", "discount", "tax",
          "flag", "status")


def _contracts(spark, sf_dir):
    """Line items as contracts; where items share a date the remaining columns decide."""
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("cups"), t.iso_day("l_shipdate").alias("startDate"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("marketer"),
        F.col("l_linestatus").alias("tension"),
        F.array("l_quantity", "l_tax").alias("contractedPowerkW"),
        F.col("l_linenumber").alias("linenumber"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"))


LATEST = """
latest AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS cups, strftime(l_shipdate, '%Y-%m-%d') AS "startDate",
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS marketer, l_linestatus AS tension,
    l_linenumber AS linenumber, l_partkey AS part
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
          l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
          l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem)
  WHERE rn = 1)"""


def latest_contracts(spark, sf_dir):
    return S.latest_contract(_contracts(spark, sf_dir), NEWEST)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS cups, c_name AS address, c_mktsegment AS distributor,
  CAST(NULL AS VARCHAR) AS "postalCode", CAST(NULL AS VARCHAR) AS "dateOwner",
  CAST(NULL AS VARCHAR) AS "contractedPowerkW", CAST(NULL AS VARCHAR) AS "pointType",
  CAST(34 AS BIGINT) AS present, CAST(31 AS BIGINT) AS added FROM customer""")
def conform_schema(spark, sf_dir):
    given = table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("cups"), F.col("c_name").alias("address"),
        F.col("c_mktsegment").alias("distributor"))
    full = S.conform_schema(given)
    empty = sum((F.when(F.col(f.name).isNull(), 1).otherwise(0) for f in SUPPLY), F.lit(0))
    return full.select(
        "cups", "address", "distributor", "postalCode",
        *[text(c).alias(c) for c in ("dateOwner", "contractedPowerkW", "pointType")],
        F.lit(len([f for f in SUPPLY if f.name in full.columns])).cast("long").alias("present"),
        empty.cast("long").alias("added"))


@query(f"""WITH {LATEST}
SELECT cups, "startDate", coalesce(marketer, '-') AS marketer, tension,
  CAST(linenumber AS BIGINT) AS linenumber, part FROM latest""")
def latest_contract(spark, sf_dir):
    return latest_contracts(spark, sf_dir).select(
        "cups", "startDate", F.coalesce("marketer", F.lit("-")).alias("marketer"), "tension",
        F.col("linenumber").cast("long").alias("linenumber"), "part")


@query(f"""WITH {LATEST}
SELECT cups, CAST(o_custkey AS VARCHAR) AS username, coalesce(marketer, '-') AS marketer,
  "startDate", tension, part
FROM orders JOIN latest ON cups = CAST(o_orderkey AS VARCHAR)""")
def supply_contract_merge(spark, sf_dir):
    """Orders also carry a marketer, which the contract's replaces, by null too."""
    given = _orders(spark, sf_dir).select(
        text("o_orderkey").alias("cups"), text("o_custkey").alias("username"),
        F.col("o_orderpriority").alias("marketer"))
    return S.supply_contract_merge(given, latest_contracts(spark, sf_dir)).select(
        "cups", "username", F.coalesce("marketer", F.lit("-")).alias("marketer"), "startDate",
        "tension", "part")


@query("""
WITH by_supply AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS key, 'B' || l_partkey AS ens FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC,
                                 l_partkey DESC) AS rn
    FROM lineitem WHERE l_returnflag = 'A') WHERE rn = 1),
by_nif AS (SELECT CAST(c_custkey AS VARCHAR) AS key, 'C' || c_nationkey AS ens FROM customer
           WHERE c_mktsegment <> 'BUILDING')
SELECT CAST(o_orderkey AS VARCHAR) AS cups, CAST(o_custkey AS VARCHAR) AS nif,
  coalesce(s.ens, n.ens, '-') AS ens
FROM orders LEFT JOIN by_supply s ON s.key = CAST(o_orderkey AS VARCHAR)
LEFT JOIN by_nif n ON n.key = CAST(o_custkey AS VARCHAR)""")
def building_lookup(spark, sf_dir):
    given = _orders(spark, sf_dir).select(text("o_orderkey").alias("cups"),
                                          text("o_custkey").alias("nif"))
    by_supply = (table(spark, sf_dir, "lineitem").filter("l_returnflag = 'A'")
                 .select(text("l_orderkey").alias("key"),
                         F.concat(F.lit("B"), "l_partkey").alias("ens"),
                         F.struct("l_linenumber", "l_partkey").alias("seq")))
    by_nif = (table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
              .select(text("c_custkey").alias("key"),
                      F.concat(F.lit("C"), "c_nationkey").alias("ens"),
                      F.col("c_custkey").alias("seq")))
    return S.building_lookup(given, by_supply, by_nif).select(
        "cups", "nif", F.coalesce("ens", F.lit("-")).alias("ens"))


def _owner(start, end):
    return F.struct(start.alias("startDate"), end.alias("endDate"))


def owned_supplies(spark, sf_dir):
    """Orders with an owner history by status: open ones one owner, finished ones two."""
    day = F.col("o_orderdate")
    none = F.lit(None).cast("string")
    status = F.col("o_orderstatus")
    return _orders(spark, sf_dir).select(
        text("o_orderkey").alias("cups"), t.iso_day(day).alias("startDate"),
        F.when(F.col("o_totalprice") > 250000, t.iso_day(F.date_add(day, 100))).alias("endDate"),
        F.when(status == "O", F.array(_owner(t.iso_day(day), none)))
        .when(status == "F", F.array(
            _owner(none, t.iso_day(day)),
            _owner(t.iso_day(F.date_add(day, 400)), F.when(
                F.col("o_totalprice") > 200000, t.iso_day(F.date_add(day, 600)))
                .otherwise(F.lit("unknown"))),
            _owner(t.iso_day(day), t.iso_day(F.date_add(day, 400))))).alias("dateOwner"),
        F.array(F.round(F.col("o_totalprice") / 100000, 1), F.lit(4.6)).alias("contractedPowerkW"),
        F.date_format(day, "yyyy/MM/dd").alias("lastMarketerDate"))


OWNED = """
owned AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cups,
    CASE o_orderstatus WHEN 'O' THEN o_orderdate WHEN 'F' THEN o_orderdate + INTERVAL 400 DAY END AS s,
    CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN o_orderdate + INTERVAL 600 DAY END AS e,
    round(o_totalprice / 100000, 1) AS power, o_orderdate
  FROM orders),
states AS (
  SELECT cups, strftime(s, '%Y-%m-%dT%H:%M:%S') AS "startDate", strftime(e, '%Y-%m-%dT%H:%M:%S') AS "endDate",
    CASE WHEN e > s THEN 'Accepted' END AS "stateCancelled", NOT coalesce(e > s, false) AS "stateEnrolled",
    power || '-4.6' AS "contractedPowerkW", strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "lastMarketerDate"
  FROM owned)"""


@query(f"""WITH {OWNED}
SELECT cups, coalesce("startDate", '-') AS "startDate", coalesce("endDate", '-') AS "endDate",
  coalesce("stateCancelled", '-') AS "stateCancelled", "stateEnrolled",
  coalesce("endDate", 'Alta') AS nif_ab, "contractedPowerkW", "lastMarketerDate" FROM states""")
def owner_state(spark, sf_dir):
    dash = {c: F.coalesce(c, F.lit("-")) for c in ("startDate", "endDate", "stateCancelled")}
    return S.owner_state(owned_supplies(spark, sf_dir), per_row=False).withColumns(dash).select(
        "cups", "startDate", "endDate", "stateCancelled", "stateEnrolled", "nif_ab",
        "contractedPowerkW", "lastMarketerDate")


@query("""
WITH devices AS (SELECT l_orderkey, bool_or(l_linestatus = 'O' AND l_returnflag = 'A') AS e
                 FROM lineitem GROUP BY l_orderkey)
SELECT CAST(o_orderkey AS VARCHAR) AS cups,
  coalesce(e, false) OR o_orderstatus = 'F' AS enrolled
FROM orders LEFT JOIN devices ON l_orderkey = o_orderkey""")
def enrolment_merge(spark, sf_dir):
    given = _orders(spark, sf_dir).select(
        text("o_orderkey").alias("cups"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
        .alias("stateEnrolled"))
    devices = table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("deviceName"),
        ((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A")).alias("enrolled"))
    return S.enrolment_merge(given, devices).select("cups", "enrolled")


def gazetteer(spark, sf_dir):
    """Parts as places: a name and a level each."""
    uri = F.format_string("https://sws.geonames.org/%d/", "p_partkey")
    level = F.when(F.col("p_size") < 25, V.MUNICIPALITY_LEVEL).otherwise(V.PROVINCE_LEVEL)
    facts = F.array(
        F.struct(uri.alias("subject"), F.lit(V.GAZETTEER_NAME).alias("predicate"),
                 F.initcap("p_name").alias("object")),
        F.struct(uri.alias("subject"), F.lit(V.GAZETTEER_LEVEL).alias("predicate"),
                 level.alias("object")))
    return table(spark, sf_dir, "part").select(F.explode(facts).alias("f")).select("f.*")


PLACES = """
places AS (
  SELECT array_to_string([upper(w[1]) || w[2:] FOR w IN string_split(p_name, ' ')], ' ') AS name,
         min(CAST(p_partkey AS VARCHAR)) AS geo_id
  FROM part WHERE p_size < 25 GROUP BY ALL)"""


@query(f"WITH {PLACES} SELECT name, geo_id FROM places")
def gazetteer_pattern(spark, sf_dir):
    return places_of_level(gazetteer(spark, sf_dir), V.MUNICIPALITY_LEVEL)


@query(f"""WITH {PLACES},
probes AS (
  SELECT DISTINCT CASE p_type WHEN 'ECONOMY' THEN upper(p_name)
                              WHEN 'SMALL' THEN 'x' || substring(p_name, 2)
                              ELSE p_name || ', ' || p_brand END AS probe FROM part),
plain AS (
  SELECT probe, trim(regexp_replace(lower(probe), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS p FROM probes),
entries AS (SELECT lower(name) AS g, min(geo_id) AS geo_id FROM places GROUP BY ALL),
scored AS (
  SELECT probe, geo_id, 1.0::DOUBLE - levenshtein(p, g)::DOUBLE / greatest(length(p), length(g), 1) AS score
  FROM plain, entries)
SELECT probe, geo_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY probe ORDER BY score DESC, geo_id) AS rn FROM scored)
WHERE rn = 1""")
def fuzzy_place_match(spark, sf_dir):
    """Names of parts in capitals, with a letter changed or with the brand added."""
    kind = F.col("p_type")
    names = table(spark, sf_dir, "part").select(
        F.when(kind == "ECONOMY", F.upper("p_name"))
        .when(kind == "SMALL", F.concat(F.lit("x"), F.substr("p_name", F.lit(2))))
        .otherwise(F.concat_ws(", ", "p_name", "p_brand")).alias("municipality"))
    places = places_of_level(gazetteer(spark, sf_dir), V.MUNICIPALITY_LEVEL)
    return S.fuzzy_place_match(names, places, "municipality").withColumn(
        "score", F.round("score", 6))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS cups, o_orderpriority AS marketer,
  CAST(o_orderkey AS BIGINT) AS "pointType" FROM orders""")
def supplies_in(spark, sf_dir):
    """Orders as documents of one supply record each, taken apart."""
    record = F.struct(text("o_custkey").alias("cups"), F.col("o_orderpriority").alias("marketer"),
                      F.col("o_orderkey").cast("int").alias("pointType"))
    documents = _orders(spark, sf_dir).select(
        F.to_json(F.struct(F.array(record).alias("supplies"))).alias("value"))
    return landing.supplies_in(documents).select(
        "cups", "marketer", F.col("pointType").cast("long").alias("pointType"))


@query("""WITH docs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c, o_orderstatus AS s,
         o_orderkey % 7 = 0 AS cut FROM orders)
SELECT 'kept' AS kind, k AS key, '-' AS item FROM docs WHERE NOT cut
UNION ALL SELECT 'kept', c, '3' FROM docs WHERE NOT cut AND s = 'O'
UNION ALL SELECT 'rejected', k, CASE s WHEN 'F' THEN '{"cups":"' || k || '","pointType":"large"}' ELSE 'x' END
FROM docs WHERE NOT cut AND s <> 'O'
UNION ALL SELECT 'unreadable', k, '-' FROM docs WHERE cut""")
def landed_items(spark, sf_dir):
    """Orders as documents of two items, one in seven cut off: every item is kept or rejected."""
    key, status = text("o_orderkey"), F.col("o_orderstatus")
    good = F.to_json(F.struct(key.alias("cups")))
    other = (F.when(status == "O", F.to_json(F.struct(text("o_custkey").alias("cups"), F.lit(3).alias("pointType"))))
             .when(status == "F", F.to_json(F.struct(key.alias("cups"), F.lit("large").alias("pointType"))))
             .otherwise(F.lit('"x"')))
    end = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise("]}")
    documents = _orders(spark, sf_dir).select(
        key.alias("key"), F.concat(F.lit('{"supplies": ['), good, F.lit(", "), other, end).alias("value"))
    dash = F.lit("-")
    kept = landing.supplies_in(documents).select(
        F.lit("kept").alias("kind"), F.col("cups").alias("key"),
        F.coalesce(text("pointType"), dash).alias("item"))
    rejected = landing.rejected_documents(documents).select(
        F.when(F.col("item").isNull(), "unreadable").otherwise("rejected").alias("kind"), "key",
        F.coalesce("item", dash).alias("item"))
    return kept.unionByName(rejected)


@query(f"""WITH {PLACES}, {OWNED},
entries AS (SELECT lower(name) AS g, min(geo_id) AS geo_id FROM places GROUP BY ALL),
records AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cups, CAST(o_custkey AS VARCHAR) AS nif, o_orderstatus,
         replace(o_orderpriority, '-', ' ') AS place FROM orders),
matched AS (
  SELECT place, geo_id FROM (
    SELECT place, geo_id, row_number() OVER (PARTITION BY place ORDER BY
      1.0::DOUBLE - levenshtein(lower(place), g)::DOUBLE / greatest(length(place), length(g)) DESC,
      geo_id) AS rn
    FROM (SELECT DISTINCT place FROM records), entries) WHERE rn = 1)
SELECT cups, coalesce(ens, '-') AS ens, m.geo_id AS municipality, coalesce("startDate", '-') AS "startDate",
  coalesce("endDate", 'Alta') AS nif_ab, o_orderstatus = 'P' OR "stateEnrolled" AS enrolled
FROM records JOIN states USING (cups) JOIN matched m USING (place)
LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS nif, 'C' || c_nationkey AS ens FROM customer
           WHERE c_mktsegment <> 'BUILDING') USING (nif)""")
def harmonize_supplies(spark, sf_dir):
    """The whole way of a supply record: owners, building, place and enrolment."""
    orders = _orders(spark, sf_dir)
    records = owned_supplies(spark, sf_dir).join(orders.select(
        text("o_orderkey").alias("cups"), text("o_custkey").alias("nif"),
        F.replace("o_orderpriority", F.lit("-"), F.lit(" ")).alias("municipality")), "cups")
    by_nif = (table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
              .select(text("c_custkey").alias("key"),
                      F.concat(F.lit("C"), "c_nationkey").alias("ens"),
                      F.col("c_custkey").alias("seq")))
    devices = orders.select(text("o_orderkey").alias("deviceName"),
                            (F.col("o_orderstatus") == "P").alias("enrolled"))
    lookups = harmonize.Lookups(by_nif.filter("ens is null"), by_nif,
                                gazetteer(spark, sf_dir), devices)
    return harmonize.harmonize_supplies(records, lookups, "2024-01-31T00:00:00", per_row=False).select(
        "cups", F.coalesce("ens", F.lit("-")).alias("ens"), "municipality",
        F.coalesce("startDate", F.lit("-")).alias("startDate"), "nif_ab", "enrolled")


PROVINCES = PLACES.replace("places AS", "provinces AS").replace("p_size < 25", "p_size >= 25")


def _nearest(found, probe, places):
    """The place most like each distinct `probe` of the records."""
    return f"""
{found} AS (
  SELECT probe, geo_id FROM (
    SELECT probe, geo_id, row_number() OVER (PARTITION BY probe ORDER BY
      1.0::DOUBLE - levenshtein(lower(probe), g)::DOUBLE / greatest(length(probe), length(g)) DESC,
      geo_id) AS rn
    FROM (SELECT DISTINCT {probe} AS probe FROM records),
         (SELECT lower(name) AS g, min(geo_id) AS geo_id FROM {places} GROUP BY ALL)) WHERE rn = 1)"""


@query(f"""WITH {PLACES}, {PROVINCES}, {OWNED},
records AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cups, CAST(o_custkey AS VARCHAR) AS nif, o_orderstatus,
         upper(p_name) AS town, 'x' || substring(p_name, 2) AS land,
         CASE WHEN o_orderstatus = 'F' THEN 'S' || o_orderkey END AS of_supply
  FROM orders JOIN part ON p_partkey = o_custkey), {_nearest('towns', 'town', 'places')},
{_nearest('lands', 'land', 'provinces')}
SELECT cups, coalesce(of_supply, ens, '-') AS ens, t.geo_id AS municipality, l.geo_id AS province,
  coalesce("startDate", '-') AS "startDate", coalesce("endDate", 'Alta') AS nif_ab,
  o_orderstatus = 'P' OR "stateEnrolled" AS enrolled
FROM records JOIN states USING (cups) JOIN towns t ON t.probe = town JOIN lands l ON l.probe = land
LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS nif, 'C' || c_nationkey AS ens FROM customer
           WHERE c_mktsegment <> 'BUILDING') USING (nif)""")
def harmonize_located(spark, sf_dir):
    """Supply records with buildings found by supply and else by owner, and towns and provinces as many
    as there are customers."""
    orders = _orders(spark, sf_dir)
    records = owned_supplies(spark, sf_dir).join(orders.join(
        table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("o_custkey")).select(
        text("o_orderkey").alias("cups"), text("o_custkey").alias("nif"),
        F.upper("p_name").alias("municipality"),
        F.concat(F.lit("x"), F.substr("p_name", F.lit(2))).alias("province")), "cups")
    by_supply = orders.filter("o_orderstatus = 'F'").select(
        text("o_orderkey").alias("key"), F.concat(F.lit("S"), "o_orderkey").alias("ens"),
        F.col("o_orderkey").alias("seq"))
    by_nif = (table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
              .select(text("c_custkey").alias("key"),
                      F.concat(F.lit("C"), "c_nationkey").alias("ens"),
                      F.col("c_custkey").alias("seq")))
    devices = orders.select(text("o_orderkey").alias("deviceName"),
                            (F.col("o_orderstatus") == "P").alias("enrolled"))
    lookups = harmonize.Lookups(by_supply, by_nif, gazetteer(spark, sf_dir), devices)
    return harmonize.harmonize_supplies(records, lookups, "2024-01-31T00:00:00", per_row=False).select(
        "cups", F.coalesce("ens", F.lit("-")).alias("ens"), "municipality", "province",
        F.coalesce("startDate", F.lit("-")).alias("startDate"), "nif_ab", "enrolled")
