"""From supply records and readings to triples and points."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from meterspark import vocabulary as V
from meterspark.functions import keyed
from meterspark.functions.text import similarity
from meterspark.operators import graph, supplies as S, timeseries
from meterspark.sources.gazetteer import gazetteer_pattern


@dataclass(frozen=True)
class Lookups:
    """Tables a supply record is enriched from. Building tables are `(key, ens, seq)`."""

    building_by_supply: DataFrame
    building_by_nif: DataFrame
    gazetteer: DataFrame
    devices: DataFrame


def building_tables(edges: DataFrame, generic: DataFrame,
                    properties: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Building lookups out of the graph, by supply and by owning organization.

    Paths lead over nodes; keys and buildings are the ids that organizations gave them, which is
    what supply records know. Nodes without such an id are left out.
    """
    def ids(prop: str, node: str, into: str) -> DataFrame:
        return properties.filter(F.col("property") == prop).select(
            F.col("uri").alias(node), F.col("value").alias(into))

    building = ids(V.BUILDING_ID, "building", "ens")
    by_supply = (graph.graph_path_building(edges).join(ids(V.POINT_OF_DELIVERY_ID, "upod", "key"), "upod")
                 .join(building, "building"))
    by_org = (graph.graph_path_org(edges, generic).join(ids(V.ORGANIZATION_ID, "org", "key"), "org")
              .join(building, "building"))
    return tuple(df.select("key", "ens", F.col("building").alias("seq")) for df in (by_supply, by_org))


def harmonize_supplies(records: DataFrame, lookups: Lookups, update_date: str,
                       per_row: bool = True,
                       score: Callable[[Column, Column], Column] = similarity) -> DataFrame:
    """Enriched supply records. `update_date` is the run's ISO time; `score` compares places.

    What depends on the record alone comes first, and everything that has to look at all records
    beforehand (flags, distinct names, hot keys) reads `records`, not the joined rows.
    """
    given = S.conform_schema(records)
    df = S.owner_state(given.withColumn("update_date", F.lit(update_date)), per_row)
    df = S.building_lookup(df, lookups.building_by_supply, lookups.building_by_nif, given)
    for column, level in (("municipality", V.MUNICIPALITY_LEVEL), ("province", V.PROVINCE_LEVEL)):
        if column not in records.columns:
            continue  # all null, nothing to match
        places = gazetteer_pattern(lookups.gazetteer, level)
        df = S.replace_place(df, S.fuzzy_place_match(
            given, places, column, score=score), column, given)
    return S.enrolment_merge(df, lookups.devices)


def supply_graph(records: DataFrame, lookups: Lookups, update_date: str,
                 per_row: bool = True) -> DataFrame:
    """Triples of a batch of supply records."""
    return graph.supply_triples(harmonize_supplies(records, lookups, update_date, per_row))


@dataclass(frozen=True)
class Graph:
    devices: DataFrame
    upods: DataFrame
    edges: DataFrame


def graph_update(triples: DataFrame, sources: DataFrame, seq: str = "seq") -> Graph:
    """The tables that a run's triples make, after the updates that follow a save: the provider's
    mark moves, its locations' places are marked, devices are tied to the source (`uri, username`)
    their owner logs in as, and the owner is forgotten where that was done."""
    return update_graph(graph.triples_to_graph(triples, seq), sources)


#: Tables of the stored graph: their keys, and whether a row that comes again replaces the one on record.
TABLES = {"labels": (["uri", "label"], False), "properties": (["uri", "property"], True),
          "edges": (["src", "type", "dst"], False)}
LAYOUTS = {name: T.StructType([T.StructField(c, T.StringType()) for c in [*keys, *more]]) for name, (keys, _), more in zip(
    TABLES, TABLES.values(), ([], ["value", "datatype"], []))}


def save_graph(spark: SparkSession, triples: DataFrame, path: str, staging: str, seq: str = "seq",
               slots: int = keyed.SLOTS) -> None:
    """Merge a batch of triples into the graph stored below `path`.

    The rules behind `triples` are expanded once: they are written to `staging` by the table they go to,
    and each table reads its part of that. Just the slots of nodes that the batch names are rewritten. A
    save that is repeated leaves the same graph.
    """
    triples.withColumn("kind", graph.triple_kind()).write.mode("overwrite").partitionBy("kind").parquet(staging)
    staged = spark.read.schema(T.StructType([*triples.schema, T.StructField("kind", T.StringType())])).parquet(staging)
    parts = {name: graph.triples_to_graph(staged.filter(F.col("kind") == name), seq)[name] for name in TABLES}
    for name, (keys, replace) in TABLES.items():
        keyed.create_keyed(spark, f"{path}/{name}", LAYOUTS[name])
        keyed.update_keyed(spark, f"{path}/{name}", parts[name].select(LAYOUTS[name].fieldNames()), keys, keys[:1],
                           slots, replace)


def read_graph(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Labels, properties and edges of the stored graph."""
    return {name: keyed.read_keyed(spark, f"{path}/{name}", layout).drop(keyed.SLOT) for name, layout in LAYOUTS.items()}


def update_graph(parts: dict[str, DataFrame], sources: DataFrame) -> Graph:
    """The updates that follow a save, over the labels, properties and edges of a batch (`triples_to_graph`)
    or of the stored graph (`read_graph`)."""
    devices = graph.rename_source(graph.devices_of(parts["properties"]))
    edges = parts["edges"].withColumns({"selected": F.lit(None).cast("boolean"),
                                        "source": F.lit(None).cast("string")})
    edges = graph.merge_source_edges(devices, sources, graph.mark_location_edges(edges, devices))
    return Graph(graph.forget_linked_nif(devices, sources), graph.upods_of(parts["properties"]), edges)


@dataclass(frozen=True)
class Series:
    points: DataFrame
    sensors: DataFrame
    triples: DataFrame


def harmonize_series(readings: DataFrame, sensors: DataFrame) -> Series:
    """Points of a batch of readings and the sensors they belong to."""
    covered = timeseries.sensor_coverage(readings, sensors)
    return Series(timeseries.harmonize_timeseries(readings), covered,
                  graph.sensor_triples(covered))
