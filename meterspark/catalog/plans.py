"""Plans and modes where operators meet: graph updates, the end of a run, lookups, quarantine, power."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterspark import vocabulary as V
from meterspark.catalog import graph as G, routing as Q, tables as t
from meterspark.catalog.chunks import RETRY
from meterspark.catalog.readings import WIDE, _max_power_wide
from meterspark.catalog.registry import AS_OF, query, table, text
from meterspark.catalog.streams import SPEC, STATIC
from meterspark.catalog.supplies import owned_supplies
from meterspark.operators import graph, readings as R, supplies as S
from meterspark.plans import finalize, gather, harmonize
from meterspark.session import shared_dir
from meterspark.streaming import envelopes as E


def _sources(spark, sf_dir):
    """Owners N0 to N9 and M0 to M14 log in themselves."""
    nation = table(spark, sf_dir, "nation")
    return (nation.filter("n_nationkey < 10").select(F.concat(F.lit("N"), "n_nationkey").alias("username"))
            .unionByName(nation.filter("n_nationkey < 15").select(
                F.concat(F.lit("M"), "n_nationkey").alias("username")))
            .select(F.concat(F.lit("https://icaen.cat#S"), "username").alias("uri"), "username"))


def _saved(spark, name, df):
    """A table as a run saves it and the end of the run reads it."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _batches(spark, sf_dir):
    """Triples of all customers' records, and of a later batch in which some meters went to an owner that left."""
    records = G._records(spark, sf_dir)
    gone = F.lit("2023-01-01T00:00:00")
    later = records.filter("balance > 5000").withColumns({
        "seq": F.lit(2), "nif": F.col("authorized_nif"), "nif_ab": gone, "endDate": gone,
        "enrolled": F.lit(False)})
    return graph.supply_triples(records.withColumn("seq", F.lit(1)), ("seq",)), graph.supply_triples(later, ("seq",))


def _updated(spark, sf_dir):
    """Both batches at once."""
    first, later = _batches(spark, sf_dir)
    return harmonize.graph_update(_saved(spark, "triples", first.unionByName(later)), _sources(spark, sf_dir))


def _dash(*columns):
    return [F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(as_) for as_, c in zip("bcde", columns)]


UPDATED = G.TRIPLES + f""",
of AS (
  SELECT device, upod, b, n, b > 5000 AS gone, CASE WHEN b > 5000 THEN 'M' ELSE 'N' END || n AS nif,
    CASE WHEN b > 5000 THEN n < 15 ELSE n < 10 END AS linked,
    CASE WHEN b > 5000 THEN '2023-01-01T00:00:00' WHEN b < 1000 THEN '2023-06-30T00:00:00' END AS until
  FROM named),
made AS (
  SELECT DISTINCT subject AS src, replace(predicate, '{G.BIGG}', '') AS type, object AS dst
  FROM triples WHERE object_kind = 'iri' AND predicate <> '{G.TYPE}'),
cities AS (SELECT src FROM made WHERE type = 'hasAddressCity'),
marked AS (
  SELECT src, type, dst, type IN ('hasAddressCity', 'hasAddressProvince')
                         AND src IN (SELECT src FROM cities) AS hit FROM made)"""

_EDGES_SQL = """SELECT 'edge' AS kind, src AS a, type AS b, dst AS c, CASE WHEN hit THEN 'true' ELSE '-' END AS d,
  CASE WHEN hit THEN 'DATADIS' ELSE '-' END AS e FROM marked
UNION ALL
SELECT 'edge', device, 'importedFromSource', 'https://icaen.cat#S' || nif, '-', '-' FROM of WHERE linked"""


def _edges(edges):
    return edges.select(F.lit("edge").alias("kind"), F.col("src").alias("a"),
                        *_dash("type", "dst", "selected", "source"))


def _nodes_and_edges(after):
    return _edges(after.edges).unionByName(after.devices.select(
        F.lit("device").alias("kind"), F.col("uri").alias("a"), *_dash("source", "nif", "enrolled", "endDate")))


UPDATED_ROWS = f"""WITH {UPDATED}
{_EDGES_SQL}
UNION ALL
SELECT 'device', device, '{V.PROVIDER}', CASE WHEN linked THEN '-' ELSE nif END,
  CASE WHEN NOT gone AND b >= 1000 THEN 'true' ELSE 'false' END, coalesce(until, '-') FROM of"""


@query(UPDATED_ROWS)
def graph_update(spark, sf_dir):
    """Records to triples to nodes and edges, and all updates that follow a save."""
    return _nodes_and_edges(_updated(spark, sf_dir))


@query(UPDATED_ROWS)
def graph_saved(spark, sf_dir):
    """The same with the later batch merged into the graph that the first one left on record."""
    path, staging = shared_dir(spark, "graph"), shared_dir(spark, "staging")
    for batch in _batches(spark, sf_dir):
        harmonize.save_graph(spark, batch, path, staging, slots=32)
    return _nodes_and_edges(harmonize.update_graph(harmonize.read_graph(spark, path), _sources(spark, sf_dir)))


@query(f"""WITH {UPDATED}
{_EDGES_SQL} AND NOT gone
UNION ALL
SELECT 'device', device, '{V.PROVIDER}', CASE WHEN NOT gone AND b >= 1000 THEN '-' ELSE 'Accepted' END, '-',
  CASE WHEN gone AND linked THEN '-' ELSE coalesce(until, '-') END FROM of
UNION ALL
SELECT 'upod', upod, CASE WHEN gone AND linked THEN '-' ELSE coalesce(until, '-') END, 'true', '-', '-' FROM of""")
def end_run(spark, sf_dir):
    """The same tables settled: links to owners that left end, and the dates that went with them."""
    after = _updated(spark, sf_dir)
    devices, upods, edges = (_saved(spark, n, getattr(after, n)) for n in ("devices", "upods", "edges"))
    settled = finalize.end_run(devices, upods, edges, _sources(spark, sf_dir),
                               keep=lambda df: _saved(spark, "ended", df))
    return (_edges(settled.edges)
            .unionByName(settled.devices.select(
                F.lit("device").alias("kind"), F.col("uri").alias("a"),
                *_dash("source", "stateCancelled", "enrolled", "endDate")))
            .unionByName(settled.upods.select(
                F.lit("upod").alias("kind"), F.col("uri").alias("a"), *_dash("endDate", "newSupply"),
                F.lit("-").alias("d"), F.lit("-").alias("e"))))


@query("""SELECT 'supply' AS kind, 'p' || o_orderkey AS key, 'B' || o_custkey AS ens FROM orders
UNION ALL
SELECT 'owner', r_name, 'B' || c_custkey
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name <> 'AFRICA'""")
def building_tables(spark, sf_dir):
    """Paths over nodes, keys and buildings by the ids that organizations gave them."""
    def ids(df, uri, prop, value):
        return df.select(F.concat(*uri).alias("uri"), F.lit(prop).alias("property"), value.alias("value"))

    orders, customer, region = (table(spark, sf_dir, n) for n in ("orders", "customer", "region"))
    properties = (ids(orders, [F.lit("P"), "o_orderkey"], V.POINT_OF_DELIVERY_ID,
                      F.concat(F.lit("p"), "o_orderkey"))
                  .unionByName(ids(customer, [F.lit("C"), "c_custkey"], V.BUILDING_ID,
                                   F.concat(F.lit("B"), "c_custkey")))
                  .unionByName(ids(region, [F.lit("R"), "r_regionkey"], V.ORGANIZATION_ID, F.col("r_name"))))
    generic = (table(spark, sf_dir, "nation").join(region.filter("r_name <> 'AFRICA'"),
                                                   F.col("n_regionkey") == F.col("r_regionkey"))
               .select(F.concat(F.lit("N"), "n_nationkey").alias("uri")))
    by_supply, by_owner = harmonize.building_tables(G._tree(spark, sf_dir), generic, properties)
    return by_supply.select(F.lit("supply").alias("kind"), "key", "ens").unionByName(
        by_owner.select(F.lit("owner").alias("kind"), "key", "ens"))


@query("""WITH own AS (
  SELECT *, o_orderstatus IN ('O', 'F') AS h,
    CASE o_orderstatus WHEN 'O' THEN o_orderdate WHEN 'F' THEN o_orderdate + INTERVAL 400 DAY END AS s,
    CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN o_orderdate + INTERVAL 600 DAY END AS e
  FROM orders),
states AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cups,
    CASE WHEN h THEN strftime(s, '%Y-%m-%dT%H:%M:%S') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start,
    CASE WHEN h THEN strftime(e, '%Y-%m-%dT%H:%M:%S')
         WHEN o_totalprice > 250000 THEN strftime(o_orderdate + INTERVAL 100 DAY, '%Y-%m-%d') END AS until,
    h AND NOT coalesce(e > s, false) AS enrolled FROM own)
SELECT cups, start AS "startDate", coalesce(until, '-') AS "endDate", enrolled AS "stateEnrolled",
  coalesce(until, 'Alta') AS nif_ab FROM states""")
def owner_state_per_supply(spark, sf_dir):
    """Each supply by itself, whatever else is in the batch."""
    return S.owner_state(owned_supplies(spark, sf_dir)).select(
        "cups", "startDate", F.coalesce("endDate", F.lit("-")).alias("endDate"), "stateEnrolled", "nif_ab")


@query("""SELECT CAST(event_id AS VARCHAR) AS key FROM events
WHERE event_type IN ('view', 'purchase', 'error')""")
def quarantine(spark, sf_dir):
    """Views hold text where a number belongs, purchases a reading without an instant that can be
    read, errors are cut off; sign-ups and clicks are as they should be."""
    kind, who = F.col("event_type"), F.col("user_id")
    series = '"kwargs": {"collection_type": "timeseries", "property": "%s"}}' % t.CONSUMPTION
    value = (F.when(kind == "view", F.format_string(
                 '{"data": {"cups": "%s", "pointType": "large"}, "kwargs": {}}', who.cast("string")))
             .when(kind == "signup", F.format_string(
                 '{"data": {"cups": "%s", "pointType": 4, "contractedPowerkW": 5.75}, "kwargs": {}}',
                 who.cast("string")))
             .when(kind == "click", F.concat(F.format_string(
                 '{"data": [{"cups": "%s", "timestamp": 1}], ', who.cast("string")), F.lit(series)))
             .when(kind == "purchase", F.concat(F.format_string(
                 '{"data": [{"cups": "%s", "timestamp": "soon"}], ', who.cast("string")), F.lit(series)))
             .otherwise(F.lit('{"data": [')))
    messages = table(spark, sf_dir, "events").select(
        F.when(kind.isin("view", "signup"), STATIC).otherwise("alpha.readings").alias("topic"),
        text("event_id").alias("key"), value.alias("value"))
    return E.quarantine(E.decode_envelopes(messages, STATIC)).select("key")


@query(f"""WITH {WIDE}
SELECT CAST(user_id AS VARCHAR) AS cups, epoch_us(day) // 1000000 AS "timestamp",
  CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
       WHEN 'signup' THEN 4 ELSE 5 END AS BIGINT) AS period,
  epoch_us(ts) // 1000000 AS period_ts, value AS max_power FROM best WHERE rn = 1""")
def publish_power(spark, sf_dir):
    """Maximum power with its period, instant and value, as messages, taken apart again."""
    sent = E.decode_envelopes(E.publish_envelope(
        R.power_messages(_max_power_wide(spark, sf_dir)), SPEC), STATIC)
    rows = F.from_json("data", "array<struct<cups:string,timestamp:bigint,period:bigint,"
                               "period_ts:bigint,max_power:double>>")
    return sent.filter("kind = 'timeseries'").select(F.explode(rows).alias("r")).select("r.*")


def _requests(spark, sf_dir):
    return gather.plan_requests(Q._subscriptions(spark, sf_dir), t.supplies(spark, sf_dir),
                                t.stored_state(spark, sf_dir), AS_OF)


OPEN = """"values" < total AND retries > 0 AND date_ini > TIMESTAMP '2022-02-01'"""

REQUESTS = Q.ROUTED + t.CALENDAR.removeprefix(t.SUPPLIES) + "," + t.STATE + """,
taken AS MATERIALIZED (SELECT DISTINCT cups FROM routed WHERE db_list <> ''),
asked AS MATERIALIZED (SELECT * FROM state SEMI JOIN taken USING (cups))"""


@query(f"""WITH {REQUESTS}
SELECT r.username, cups, data_type, chunk_key,
  CASE WHEN data_type = 'Power_P1M' THEN 'max_power' ELSE 'consumption' END AS endpoint,
  "distributorCode" AS distributor_code, strftime(date_ini, '%Y-%m-%d') AS start_date,
  strftime(date_end, '%Y-%m-%d') AS end_date,
  CASE data_type WHEN 'EnergyConsumptionGridElectricity_PT1H' THEN '0'
                 WHEN 'EnergyConsumptionGridElectricity_PT15M' THEN '1' END AS measurement_type,
  CASE WHEN data_type <> 'Power_P1M' THEN CAST("pointType" AS VARCHAR) END AS point_type,
  r.authorized_nif
FROM asked JOIN routed r USING (cups) JOIN supplies USING (cups) WHERE {OPEN}""")
def gather_requests(spark, sf_dir):
    """What a run asks for: customers' open chunks, once for each login that reaches them."""
    return _requests(spark, sf_dir).plan


@query(f"""WITH {t.READINGS}, {REQUESTS},
given AS (
  SELECT * FROM readings UNION ALL
  SELECT * REPLACE (seq + 1000000000000 AS seq, "consumptionKWh" + 1000 AS "consumptionKWh")
  FROM readings WHERE seq % 3 = 0),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY cups, prop, freq, "timestamp" ORDER BY seq DESC) AS rn
    FROM given) WHERE rn = 1),
{t.OBSERVED.replace('FROM readings', 'FROM latest')},
{RETRY.replace('FROM state s', 'FROM asked s')},
wanted AS (
  SELECT DISTINCT cups, unnest(string_split(db_list, ',')) AS source FROM routed WHERE db_list <> ''),
contract AS (
  SELECT CAST(o_custkey AS VARCHAR) AS cups, o_orderdate AS since, o_orderpriority AS marketer FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
measured AS (SELECT cups, count(DISTINCT data_type) AS n FROM asked WHERE {OPEN} GROUP BY cups)
SELECT 'state' AS kind, cups AS a, data_type AS b, chunk_key AS c, CAST("values" AS BIGINT) AS n,
  CAST(retries AS DOUBLE) AS v FROM retried
UNION ALL
SELECT 'timeseries', source || '.readings', cups, prop || '_' || freq, count(*), max("consumptionKWh")
FROM latest JOIN wanted USING (cups) GROUP BY source, cups, prop, freq, "timestamp" // 86400
UNION ALL
SELECT 'static', cups, db_list, strftime(since, '%Y-%m-%d') || '/' || marketer, coalesce(n, 0), 0
FROM routed JOIN contract USING (cups) LEFT JOIN measured USING (cups)""")
def gather_delivery(spark, sf_dir):
    """What a run makes of all readings, a third of which come again with another value: the state of
    the chunks asked for, and the messages, taken apart. Many readings are of meters that go to
    several sources or to none."""
    readings = t.readings(spark, sf_dir).withColumn(
        "datetime", F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss"))
    given = readings.unionByName(readings.filter("seq % 3 = 0").withColumns({
        "seq": F.col("seq") + 1_000_000_000_000, "consumptionKWh": F.col("consumptionKWh") + 1000}))
    contracts = table(spark, sf_dir, "orders").select(
        text("o_custkey").alias("cups"), t.iso_day("o_orderdate").alias("startDate"),
        F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("marketer"))
    made = gather.deliver(_requests(spark, sf_dir), given, contracts, Q.specs(sf_dir), AS_OF, STATIC)
    state = made.state.select(
        F.lit("state").alias("kind"), F.col("cups").alias("a"), F.col("data_type").alias("b"),
        F.col("chunk_key").alias("c"), F.col("values").cast("long").alias("n"),
        F.col("retries").cast("double").alias("v"))
    values = F.from_json("data", "array<struct<consumptionKWh:double>>")["consumptionKWh"]
    series = E.decode_envelopes(made.timeseries, STATIC).select(
        "kind", "topic", "key", F.concat_ws("_", "kwargs.property", "kwargs.freq"),
        F.size(values).cast("long"), F.array_max(values))
    asked = F.from_json(F.get_json_object("data", "$.measurements"), "array<string>")
    static = E.decode_envelopes(made.static, STATIC).select(
        "kind", "key", F.array_join("kwargs.dblist", ","),
        F.concat_ws("/", F.get_json_object("data", "$.startDate"), F.get_json_object("data", "$.marketer")),
        F.coalesce(F.size(asked), F.lit(0)).cast("long"), F.lit(0.0))
    return state.union(series).union(static)
