"""Triples from customers; paths, enrolment and ownership over regions, nations and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterspark import vocabulary as V
from meterspark.catalog.registry import query, table, text
from meterspark.operators import graph

BIGG = "http://bigg-project.eu/ontology#"
XSD = "http://www.w3.org/2001/XMLSchema#"
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"


def _records(spark, sf_dir):
    """Customers as enriched supply records; several fields are null for some of them."""
    absent = ("timeDiscrimination", "selfConsumptionTypeCode", "selfConsumptionTypeDesc",
              "partitionCoefficient", "cau", "lastMarketerDate")
    ended = "if(c_acctbal < 1000, '2023-06-30T00:00:00', null)"
    return table(spark, sf_dir, "customer").selectExpr(
        "c_acctbal as balance", "concat('ES', c_custkey) as cups",
        "concat('ES', c_custkey) as supply_name",
        "if(c_acctbal > 0, concat('E', c_nationkey), null) as ens",
        "c_mktsegment as distributor", "if(c_acctbal > 2000, c_name, null) as marketer",
        "'BT' as tension", "if(c_acctbal < 4000, '2.0TD', '3.0TD') as accessFare",
        "concat(c_nationkey, '-', c_nationkey) as contractedPowerkW", "'ICP' as modePowerControl",
        "'2020-01-01T00:00:00' as startDate", f"{ended} as endDate", "'2T' as codeFare",
        "if(c_acctbal > 9000, 1.5D, null) as installedCapacity", "'5.75' as maxPowerInstall",
        "concat('N', c_nationkey) as nif",
        "if(c_acctbal > 5000, concat('M', c_nationkey), null) as authorized_nif",
        f"coalesce({ended}, 'Alta') as nif_ab", "c_acctbal >= 1000 as enrolled",
        "if(c_acctbal < 1000, 'Accepted', null) as stateCancelled",
        "'2024-01-31T00:00:00+00:00' as update_date",
        "lpad(cast(c_custkey as string), 5, '0') as postalCode", "c_name as address",
        "if(c_nationkey < 20, cast(c_nationkey as string), null) as municipality",
        "cast(c_nationkey as string) as province",
        *[f"cast(null as string) as {c}" for c in absent])


_RULES_SQL = "[" + ",\n".join(
    f"{{'subject': {s}, 'predicate': {p}, 'object': {o}, 'datatype': {d}, 'object_kind': '{k}'}}"
    for s, p, o, d, k in (
        ("space", f"'{BIGG}isObservedByDevice'", "device", "NULL", "iri"),
        ("space", f"'{BIGG}hasUtilityPointOfDelivery'", "upod", "NULL", "iri"),
        ("device", f"'{TYPE}'", f"'{BIGG}Device'", "NULL", "iri"),
        ("device", f"'{TYPE}'", f"'{BIGG}DataProvider'", "NULL", "iri"),
        ("device", f"'{TYPE}'", f"'{BIGG}Element'", "NULL", "iri"),
        ("device", f"'{TYPE}'", f"'{BIGG}Thing'", "NULL", "iri"),
        ("device", f"'{BIGG}deviceName'", "cups", "NULL", "literal"),
        ("device", f"'{BIGG}distributor'", "c_mktsegment", "NULL", "literal"),
        ("device", f"'{BIGG}marketer'", "CASE WHEN b > 2000 THEN c_name END", "NULL", "literal"),
        ("device", f"'{BIGG}tension'", "'BT'", "NULL", "literal"),
        ("device", f"'{BIGG}accessFare'", "CASE WHEN b < 4000 THEN '2.0TD' ELSE '3.0TD' END",
         "NULL", "literal"),
        ("device", f"'{BIGG}contractedPower'", "n || '-' || n", "NULL", "literal"),
        ("device", f"'{BIGG}modePowerControl'", "'ICP'", "NULL", "literal"),
        ("device", f"'{BIGG}startDate'", "'2020-01-01T00:00:00'", f"'{XSD}dateTime'", "literal"),
        ("device", f"'{BIGG}endDate'", "CASE WHEN b < 1000 THEN '2023-06-30T00:00:00' END",
         f"'{XSD}dateTime'", "literal"),
        ("device", f"'{BIGG}tariff'", "'2T'", "NULL", "literal"),
        ("device", f"'{BIGG}installedCapacity'", "CASE WHEN b > 9000 THEN '1.5' END", "NULL",
         "literal"),
        ("device", f"'{BIGG}maxPowerInstall'", "'5.75'", "NULL", "literal"),
        ("device", f"'{BIGG}hasDeviceType'", f"'{BIGG}Meter.EnergyMeter.Electricity'", "NULL",
         "iri"),
        ("device", f"'{BIGG}hasDeviceLocationInfo'", "loc", "NULL", "iri"),
        ("device", f"'{BIGG}source'", f"'{V.PROVIDER}'", "NULL", "literal"),
        ("device", f"'{BIGG}nif'", "'N' || n", "NULL", "literal"),
        ("device", f"'{BIGG}authorized_nif'", "CASE WHEN b > 5000 THEN 'M' || n END", "NULL",
         "literal"),
        ("device", f"'{BIGG}nif_N' || n",
         "CASE WHEN b < 1000 THEN '2023-06-30T00:00:00' ELSE 'Alta' END", "NULL", "literal"),
        ("device", f"'{BIGG}enrolled'", "CAST(b >= 1000 AS VARCHAR)", f"'{XSD}boolean'",
         "literal"),
        ("upod", f"'{TYPE}'", f"'{BIGG}UtilityPointOfDelivery'", "NULL", "iri"),
        ("upod", f"'{TYPE}'", f"'{BIGG}Thing'", "NULL", "iri"),
        ("upod", f"'{BIGG}startDate'", "'2020-01-01T00:00:00'", f"'{XSD}dateTime'", "literal"),
        ("upod", f"'{BIGG}endDate'", "CASE WHEN b < 1000 THEN '2023-06-30T00:00:00' END",
         f"'{XSD}dateTime'", "literal"),
        ("upod", f"'{BIGG}pointOfDeliveryIDFromOrganization'", "cups", "NULL", "literal"),
        ("upod", f"'{BIGG}stateCancelled'", "CASE WHEN b < 1000 THEN 'Accepted' END", "NULL",
         "literal"),
        ("upod", f"'{BIGG}hasUtilityType'", f"'{BIGG}ElectricUtility'", "NULL", "iri"),
        ("upod", f"'{BIGG}hasDevice'", "device", "NULL", "iri"),
        ("upod", f"'{BIGG}updateSupply'", "'2024-01-31T00:00:00+00:00'", f"'{XSD}dateTime'",
         "literal"),
        ("loc", f"'{TYPE}'", f"'{BIGG}LocationInfo'", "NULL", "iri"),
        ("loc", f"'{BIGG}addressPostalCode'", "lpad(CAST(c_custkey AS VARCHAR), 5, '0')", "NULL",
         "literal"),
        ("loc", f"'{BIGG}addressStreetName'", "c_name", "NULL", "literal"),
        ("loc", f"'{BIGG}hasAddressCity'",
         "CASE WHEN n < 20 THEN 'https://sws.geonames.org/' || n || '/' END", "NULL", "iri"),
        ("loc", f"'{BIGG}hasAddressProvince'", "'https://sws.geonames.org/' || n || '/'", "NULL",
         "iri"),
    )) + "]"

TRIPLES = f"""
named AS (
  SELECT *, c_acctbal AS b, c_nationkey AS n, 'ES' || c_custkey AS cups,
    printf('{V.DEVICE_URI}', 'ES' || c_custkey) AS device,
    'https://icaen.cat#SUPPLY-ES' || c_custkey AS upod,
    printf('https://icaen.cat#LOCATION-DEVICE-{V.PROVIDER}-%s', 'ES' || c_custkey) AS loc,
    CASE WHEN c_acctbal > 0 THEN 'https://icaen.cat#BUILDINGSPACE-E' || c_nationkey END AS space
  FROM customer),
triples AS (
  SELECT t.* FROM (SELECT unnest({_RULES_SQL}) AS t FROM named)
  WHERE t.subject IS NOT NULL AND t.object IS NOT NULL)"""


@query(f"""WITH {TRIPLES}
SELECT subject, predicate, object, coalesce(datatype, '') AS datatype, object_kind FROM triples""")
def supply_triples(spark, sf_dir):
    return graph.supply_triples(_records(spark, sf_dir)).withColumn(
        "datatype", F.coalesce("datatype", F.lit("")))


@query(f"""WITH {TRIPLES},
all_triples AS (
  SELECT subject, predicate, object, object_kind, 1 AS ver FROM triples
  UNION ALL
  SELECT device, '{BIGG}tension', 'AT', 'literal', 2 FROM named WHERE b > 3000)
SELECT 'property' AS kind, subject AS a, replace(predicate, '{BIGG}', 'bigg__') AS b, object AS c FROM (
  SELECT *, row_number() OVER (PARTITION BY subject, predicate ORDER BY ver DESC) AS rn
  FROM all_triples WHERE object_kind = 'literal') WHERE rn = 1
UNION ALL
SELECT DISTINCT 'label', subject, replace(object, '{BIGG}', 'bigg__'), '' FROM all_triples WHERE predicate = '{TYPE}'
UNION ALL
SELECT DISTINCT 'edge', subject, replace(predicate, '{BIGG}', ''), object FROM all_triples
WHERE object_kind = 'iri' AND predicate <> '{TYPE}'""")
def triples_to_graph(spark, sf_dir):
    """A batch of records followed by a later one that changes the tension of some devices."""
    records = _records(spark, sf_dir)
    later = records.filter("balance > 3000").withColumns({"seq": F.lit(2), "tension": F.lit("AT")})
    changed = graph.supply_triples(later, ("seq",)).filter(F.col("predicate") == BIGG + "tension")
    first = graph.supply_triples(records.withColumn("seq", F.lit(1)), ("seq",))
    parts = graph.triples_to_graph(first.unionByName(changed))
    return (parts["properties"].select(F.lit("property").alias("kind"), F.col("uri").alias("a"),
                                       F.col("property").alias("b"), F.col("value").alias("c"))
            .unionByName(parts["labels"].select(
                F.lit("label").alias("kind"), F.col("uri").alias("a"), F.col("label").alias("b"),
                F.lit("").alias("c")))
            .unionByName(parts["edges"].select(
                F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("type").alias("b"),
                F.col("dst").alias("c"))))


def _edges(df, src, edge_type, dst):
    return df.select(F.concat(*src).alias("src"), F.lit(edge_type).alias("type"),
                     F.concat(*dst).alias("dst"))


def _tree(spark, sf_dir):
    """Region - nation - customer - order as organization, sub-organization, building, space."""
    nation, customer, orders = (table(spark, sf_dir, n) for n in ("nation", "customer", "orders"))
    lit = F.lit
    return (_edges(nation, [lit("R"), "n_regionkey"], V.HAS_SUB_ORGANIZATION,
                   [lit("N"), "n_nationkey"])
            .unionByName(_edges(customer, [lit("N"), "c_nationkey"], V.MANAGES_BUILDING,
                                [lit("C"), "c_custkey"]))
            .unionByName(_edges(orders, [lit("C"), "o_custkey"], V.HAS_SPACE,
                                [lit("S"), "o_orderkey"]))
            .unionByName(_edges(orders, [lit("S"), "o_orderkey"], V.HAS_POINT_OF_DELIVERY,
                                [lit("P"), "o_orderkey"])))


@query("SELECT 'P' || o_orderkey AS upod, 'C' || o_custkey AS building FROM orders")
def graph_path_building(spark, sf_dir):
    return graph.graph_path_building(_tree(spark, sf_dir))


@query("""SELECT 'R' || n_regionkey AS org, 'C' || c_custkey AS building
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name <> 'AFRICA'""")
def graph_path_org(spark, sf_dir):
    """Organizations are generic outside one region."""
    generic = (table(spark, sf_dir, "nation")
               .join(table(spark, sf_dir, "region").filter("r_name <> 'AFRICA'"),
                     F.col("n_regionkey") == F.col("r_regionkey"))
               .select(F.concat(F.lit("N"), "n_nationkey").alias("uri")))
    return graph.graph_path_org(_tree(spark, sf_dir), generic)


@query("""
WITH sources AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
SELECT DISTINCT src, 'importedFromSource' AS type, dst FROM (
  SELECT 'D' || o_orderkey AS src, 'S' || o_custkey AS dst FROM orders
  WHERE o_orderstatus <> 'P' AND o_custkey IN (SELECT c_custkey FROM sources)
  UNION ALL
  SELECT 'D' || o_orderkey, 'S' || o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def merge_source_edges(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    devices = orders.select(
        F.concat(F.lit("D"), "o_orderkey").alias("uri"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("U"), "o_custkey")).alias("nif"))
    sources = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.concat(F.lit("S"), "c_custkey").alias("uri"),
        F.concat(F.lit("U"), "c_custkey").alias("username"))
    existing = _edges(orders.filter("o_orderpriority = '1-URGENT'"), [F.lit("D"), "o_orderkey"],
                      V.IMPORTED_FROM, [F.lit("S"), "o_custkey"])
    return graph.merge_source_edges(devices, sources, existing)


@query("""
WITH e AS (
  SELECT 'D' || o_orderkey AS src, 'hasDeviceLocationInfo' AS type, 'L' || o_orderkey AS dst, * FROM orders
  UNION ALL
  SELECT 'L' || o_orderkey, 'hasAddressProvince', 'G' || o_orderpriority, * FROM orders
  WHERE o_orderstatus IN ('O', 'F')
  UNION ALL
  SELECT 'L' || o_orderkey, 'hasAddressCity', 'G' || o_custkey, * FROM orders
  WHERE o_orderstatus IN ('O', 'P'))
SELECT src, type, dst,
  CASE WHEN type <> 'hasDeviceLocationInfo' AND o_orderstatus = 'O' AND o_totalprice > 100000
       THEN 'true' ELSE '-' END AS selected,
  CASE WHEN type <> 'hasDeviceLocationInfo' AND o_orderstatus = 'O' AND o_totalprice > 100000
       THEN '""" + V.LOCATION_SOURCE + """' ELSE '-' END AS source FROM e""")
def mark_location_edges(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lit = F.lit
    edges = (_edges(orders, [lit("D"), "o_orderkey"], V.HAS_LOCATION, [lit("L"), "o_orderkey"])
             .unionByName(_edges(orders.filter("o_orderstatus in ('O', 'F')"),
                                 [lit("L"), "o_orderkey"], V.HAS_PROVINCE,
                                 [lit("G"), "o_orderpriority"]))
             .unionByName(_edges(orders.filter("o_orderstatus in ('O', 'P')"),
                                 [lit("L"), "o_orderkey"], V.HAS_CITY, [lit("G"), "o_custkey"]))
             .withColumns({"selected": lit(None).cast("boolean"),
                           "source": lit(None).cast("string")}))
    marked = graph.mark_location_edges(edges, _devices(spark, sf_dir))
    return marked.select("src", "type", "dst",
                         F.coalesce(text("selected"), lit("-")).alias("selected"),
                         F.coalesce("source", lit("-")).alias("source"))


def _devices(spark, sf_dir):
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("D"), "o_orderkey").alias("uri"),
        F.when(F.col("o_totalprice") > 100000, V.PROVIDER).otherwise("other").alias("source"),
        F.when(status != "P", status == "O").alias("enrolled"),
        F.when(F.col("o_orderpriority") < "3", "Accepted").alias("stateCancelled"),
        F.when(F.col("o_orderpriority") > "4", status == "F").alias("newSupply"))


def _dashed(df, *columns):
    return df.withColumns({c: F.coalesce(text(c), F.lit("-")) for c in columns})


_DEVICE_SQL = f"""
d AS (
  SELECT 'D' || o_orderkey AS uri, o_totalprice > 100000 AS ours, o_orderstatus AS st,
    CASE WHEN o_totalprice > 100000 THEN '{V.PROVIDER}' ELSE 'other' END AS source,
    CASE WHEN o_orderpriority < '3' THEN 'Accepted' END AS cancelled,
    CASE WHEN o_orderpriority > '4' THEN o_orderstatus = 'F' END AS new_supply FROM orders)"""


@query(f"""WITH {_DEVICE_SQL}
SELECT uri, source, CASE WHEN ours OR st <> 'P' THEN CAST(NOT ours AND st = 'O' AS VARCHAR)
                         ELSE '-' END AS enrolled FROM d""")
def enrolment_reset(spark, sf_dir):
    return _dashed(graph.enrolment_reset(_devices(spark, sf_dir)), "enrolled").select(
        "uri", "source", "enrolled")


@query(f"""WITH {_DEVICE_SQL}
SELECT uri, source,
  CASE WHEN ours AND st = 'O' THEN '-' WHEN ours AND st = 'F' THEN 'Accepted'
       ELSE coalesce(cancelled, '-') END AS "stateCancelled",
  CASE WHEN ours OR st = 'P' THEN '-' ELSE CAST(st = 'O' AS VARCHAR) END AS enrolled,
  coalesce(new_supply, true) AS "newSupply" FROM d""")
def finalize_enrolment(spark, sf_dir):
    done = graph.default_new_supply(graph.finalize_enrolment(_devices(spark, sf_dir)))
    return _dashed(done, "stateCancelled", "enrolled")


def _nif_devices(spark, sf_dir):
    """Orders as devices with one owner entry among their properties, but for pending ones."""
    status = F.col("o_orderstatus")
    key = F.when(status == "P", "bigg__tension").otherwise(
        F.concat(F.lit(V.NIF_KEY_PREFIX), "o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("D"), "o_orderkey").alias("uri"),
        F.create_map(key, F.when(status == "O", "Alta").otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")),
            F.lit("bigg__deviceName"), text("o_orderkey")).alias("props"))


def _map_text(column):
    pairs = F.transform(F.map_entries(column), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(F.sort_array(pairs), ";")


@query("""SELECT 'D' || o_orderkey AS dev, 'bigg__nif_' || o_orderpriority || '='
  || CASE WHEN o_orderstatus = 'O' THEN 'Alta' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS nifs
FROM orders WHERE o_orderstatus <> 'P'""")
def nif_props_map(spark, sf_dir):
    return graph.nif_props_map(_nif_devices(spark, sf_dir)).withColumn("nifs", _map_text("nifs"))


@query("""SELECT 'D' || o_orderkey AS uri, 'bigg__deviceName=' || o_orderkey ||
  CASE WHEN o_orderstatus = 'P' THEN ';bigg__tension=' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
       ELSE '' END AS props FROM orders""")
def strip_nif_props(spark, sf_dir):
    return graph.strip_nif_props(_nif_devices(spark, sf_dir)).withColumn(
        "props", _map_text("props"))


def _owners(spark, sf_dir):
    """Customers as devices, order priorities as owners; a customer's last order per owner counts."""
    return (table(spark, sf_dir, "orders")
            .groupBy(F.concat(F.lit("D"), "o_custkey").alias("dev"),
                     F.col("o_orderpriority").alias("nif"))
            .agg(F.max_by(F.when(F.col("o_orderstatus") == "O", "Alta").otherwise(
                F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")), "o_orderkey")
                .alias("value")))


OWNERS = """
owners AS (
  SELECT dev, nif, value FROM (
    SELECT 'D' || o_custkey AS dev, o_orderpriority AS nif,
      CASE WHEN o_orderstatus = 'O' THEN 'Alta' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS value,
      row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
winners AS (
  SELECT dev, nif AS winner, value AS until, n AS owners FROM (
    SELECT *, count(*) OVER (PARTITION BY dev) AS n,
      row_number() OVER (PARTITION BY dev ORDER BY value DESC, nif) AS rn FROM owners)
  WHERE rn = 1 AND n >= 2)"""


def _owner_maps(spark, sf_dir):
    """Owners as devices hold them, one map per device."""
    entry = F.struct(F.concat(F.lit(V.NIF_KEY_PREFIX), "nif"), "value")
    return _owners(spark, sf_dir).groupBy("dev").agg(F.map_from_entries(F.collect_list(entry)).alias("nifs"))


@query(f"WITH {OWNERS} SELECT dev, winner, until, owners FROM winners")
def owner_argmax(spark, sf_dir):
    return graph.owner_winner(_owner_maps(spark, sf_dir)).drop("nifs")


def _ownership_edges(spark, sf_dir):
    """Each device is linked to all it ever had as owner, some also to one not among them; only
    devices of customers not in debt have a point of delivery."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    lit = F.lit
    return (_edges(orders, [lit("D"), "o_custkey"], V.IMPORTED_FROM,
                   [lit("S"), "o_orderpriority"]).distinct()
            .unionByName(_edges(customer.filter("c_mktsegment = 'BUILDING'"),
                                [lit("D"), "c_custkey"], V.IMPORTED_FROM, [lit("SOTHER")]))
            .unionByName(_edges(customer.filter("c_acctbal > 0"), [lit("P"), "c_custkey"],
                                V.HAS_DEVICE, [lit("D"), "c_custkey"])))


def _ended(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    names = orders.select(F.col("o_orderpriority").alias("username")).distinct().unionByName(
        orders.select(F.lit("OTHER").alias("username")).distinct())
    logins = names.select(F.concat(F.lit("S"), "username").alias("uri"), "username")
    return graph.ended_links(_ownership_edges(spark, sf_dir), _owner_maps(spark, sf_dir), logins)


LINKS = """
links AS (
  SELECT DISTINCT 'D' || o_custkey AS src, 'importedFromSource' AS type, 'S' || o_orderpriority AS dst FROM orders
  UNION ALL
  SELECT 'D' || c_custkey, 'importedFromSource', 'SOTHER' FROM customer WHERE c_mktsegment = 'BUILDING'),
devices_of AS (SELECT 'P' || c_custkey AS upod, 'D' || c_custkey AS dev FROM customer WHERE c_acctbal > 0),
gone AS (
  SELECT src, dst, until FROM links JOIN winners ON src = dev
  LEFT JOIN owners o ON o.dev = src AND 'S' || o.nif = dst
  WHERE src IN (SELECT dev FROM devices_of)
    AND (until <> 'Alta' OR (o.nif IS NOT NULL AND o.nif <> winner)))"""


@query(f"""WITH {OWNERS}, {LINKS}
SELECT src, type, dst FROM links ANTI JOIN gone USING (src, dst)
UNION ALL SELECT upod, 'hasDevice', dev FROM devices_of""")
def resolve_ownership(spark, sf_dir):
    return graph.resolve_ownership(_ownership_edges(spark, sf_dir), _ended(spark, sf_dir))


@query(f"""WITH {OWNERS}, {LINKS},
nodes AS (
  SELECT 'D' || c_custkey AS uri, 'D' || c_custkey AS dev,
    CASE WHEN c_acctbal > 4000 THEN '2022-02-02T00:00:00' END AS e FROM customer
  UNION ALL
  SELECT 'P' || c_custkey, CASE WHEN c_acctbal > 0 THEN 'D' || c_custkey END,
    CASE WHEN c_acctbal > 4000 THEN '2022-02-02T00:00:00' END FROM customer),
ends AS (SELECT src, max(until) AS until FROM gone GROUP BY src)
SELECT uri, coalesce(CASE WHEN until IS NULL THEN e WHEN until <> 'Alta' THEN until END, '-') AS "endDate"
FROM nodes LEFT JOIN ends ON src = dev""")
def resolve_enddates(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    kind = F.explode(F.array(F.lit("D"), F.lit("P"))).alias("kind")
    nodes = customer.select(kind, "c_custkey", "c_acctbal").select(
        F.concat("kind", "c_custkey").alias("uri"),
        F.when(F.col("c_acctbal") > 4000, "2022-02-02T00:00:00").alias("endDate"))
    return _dashed(graph.resolve_enddates(nodes, _ended(spark, sf_dir),
                                          _ownership_edges(spark, sf_dir)), "endDate")


@query("""SELECT 'D' || o_orderkey AS uri,
  CASE WHEN c_acctbal > 0 THEN '-' ELSE 'U' || o_custkey END AS nif
FROM orders JOIN customer ON o_custkey = c_custkey""")
def forget_linked_nif(spark, sf_dir):
    """Devices whose owner is a login keep no owner id; customers not in debt are logins."""
    devices = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("D"), "o_orderkey").alias("uri"),
        F.concat(F.lit("U"), "o_custkey").alias("nif"))
    logins = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.concat(F.lit("U"), "c_custkey").alias("username"))
    return _dashed(graph.forget_linked_nif(devices, logins), "nif")


@query(f"""SELECT 'D' || o_orderkey AS uri,
  CASE WHEN o_orderstatus = 'O' THEN '{V.PROVIDER}' ELSE o_orderpriority END AS source,
  CASE WHEN o_orderstatus = 'F' THEN 'other' ELSE '-' END AS bigg__source FROM orders""")
def rename_source(spark, sf_dir):
    status = F.col("o_orderstatus")
    devices = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("D"), "o_orderkey").alias("uri"), F.col("o_orderpriority").alias("source"),
        F.when(status == "O", V.PROVIDER).when(status == "F", "other").alias("bigg__source"))
    return _dashed(graph.rename_source(devices), "bigg__source")
