"""Triples, node and edge tables, and the end-of-run reconciliation over them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from meterspark import vocabulary as V
from meterspark.functions.skew import last_by, salted_join, spread, upsert

RDF_TYPE = V.PREFIXES["rdf"] + "type"
EDGE = ["src", "type", "dst"]


# -- triples ---------------------------------------------------------------------------------

def expand(name: str) -> str:
    """Full IRI of a prefixed name."""
    prefix, _, local = name.partition(":")
    return V.PREFIXES[prefix] + local if prefix in V.PREFIXES else name


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def filled(template: str) -> str:
    """SQL of a template with `$(field)` replaced; null as soon as one field is."""
    parts = [f"cast(`{part}` as string)" if i % 2 else quoted(part)
             for i, part in enumerate(re.split(r"\$\((\w+)\)", template)) if part]
    return f"concat({', '.join(parts)})"


def _object(template: str) -> tuple[str, str]:
    """Kind and SQL of a rule's object."""
    if template.startswith('"'):
        return "literal", quoted(template.strip('"'))
    if template.startswith("<"):
        return "iri", filled(template.strip("<>"))
    if template.partition(":")[0] in V.PREFIXES:
        return "iri", filled(expand(template))
    return "literal", filled(template)


def apply_rules(records: DataFrame, rules: tuple, keep: tuple[str, ...] = ()) -> DataFrame:
    """Triples of every record under declarative rules, in one pass without a shuffle.

    Any null in a subject, predicate or object means no triple. `keep` carries columns along.
    """
    triples = []
    for subject, properties in rules:
        for predicate, obj, datatype in properties:
            kind, value = _object(obj)
            verb = quoted(RDF_TYPE) if predicate == "a" else filled(expand(predicate))
            of_type = quoted(expand(datatype)) if datatype else "cast(null as string)"
            triples.append(f"named_struct('subject', {filled(expand(subject))}, "
                           f"'predicate', {verb}, 'object', {value}, 'datatype', {of_type}, "
                           f"'object_kind', '{kind}')")
    return (records.selectExpr(*keep, f"inline(array({', '.join(triples)}))")
            .filter("subject is not null and predicate is not null and object is not null"))


def supply_triples(supplies: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Triples of supply records. A record makes some 40 of them, so records are spread before."""
    return apply_rules(spread(supplies, "cups"), V.SUPPLY_RULES, keep)


def sensor_triples(sensors: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Triples of sensors as `sensor_coverage` returns them."""
    at = {f"series_{end}": F.date_format(F.timestamp_seconds(f"{which}_ts"),
                                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
          for end, which in (("start", "first"), ("end", "last"))}
    return apply_rules(sensors.withColumns(at), V.SENSOR_RULES, keep)


def stored_name(iri: Column) -> Column:
    """`prefix__local` of an IRI in a known namespace: how labels and properties are stored."""
    name = iri
    for prefix, space in V.PREFIXES.items():
        name = F.when(F.startswith(iri, F.lit(space)), F.concat(
            F.lit(f"{prefix}__"), F.substr(iri, F.lit(len(space) + 1)))).otherwise(name)
    return name


def edge_name(iri: Column) -> Column:
    """What follows the namespace: how edge types are stored (see `vocabulary`)."""
    return F.regexp_replace(iri, "^.*[#/]", "")


def node_labels(triples: DataFrame) -> DataFrame:
    return (triples.filter(F.col("predicate") == RDF_TYPE)
            .select(F.col("subject").alias("uri"), stored_name(F.col("object")).alias("label"))
            .distinct())


def node_properties(triples: DataFrame, seq: str = "seq") -> DataFrame:
    """Literals as one row per node and property; the last value by `seq` stays.

    Long rows let a node have any number of properties; `node_table` makes columns of them.
    """
    literals = (triples.filter(F.col("object_kind") == "literal")
                .select(F.col("subject").alias("uri"),
                        stored_name(F.col("predicate")).alias("property"), F.col("object").alias("value"), "datatype", seq))
    return last_by(literals, ["uri", "property"], [seq, "value"]).drop(seq)


def triple_edges(triples: DataFrame) -> DataFrame:
    return (triples.filter((F.col("object_kind") == "iri") & (F.col("predicate") != RDF_TYPE))
            .select(F.col("subject").alias("src"), edge_name(F.col("predicate")).alias("type"),
                    F.col("object").alias("dst")).distinct())


def triple_kind() -> Column:
    """Which of the graph's tables a triple goes to."""
    return (F.when(F.col("predicate") == RDF_TYPE, "labels").when(F.col("object_kind") == "literal", "properties")
            .otherwise("edges"))


def triples_to_graph(triples: DataFrame, seq: str = "seq") -> dict[str, DataFrame]:
    """Labels, properties and edges of a batch of triples."""
    return {"labels": node_labels(triples), "properties": node_properties(triples, seq),
            "edges": triple_edges(triples)}


def upsert_properties(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Replace whole rows by key; both sides are read once."""
    return upsert(stored, new, ["uri", "property"])


def devices_of(properties: DataFrame) -> DataFrame:
    """Devices as the updates below take them, out of stored properties: one row per node that has a
    device name, its owner entries in `props`."""
    def value(name: str) -> Column:
        return F.max(F.when(F.col("property") == name, F.col("value")))

    owner = F.col("property").rlike(f"^{V.NIF_KEY_PATTERN}$")
    return (properties.groupBy("uri").agg(
        value("bigg__deviceName").alias("deviceName"), F.lit(None).cast("string").alias("source"),
        value("bigg__source").alias("bigg__source"), value("bigg__nif").alias("nif"),
        value("bigg__enrolled").cast("boolean").alias("enrolled"),
        value("bigg__stateCancelled").alias("stateCancelled"), value("bigg__endDate").alias("endDate"),
        F.map_from_entries(F.collect_list(F.when(owner, F.struct("property", "value")))).alias("props"))
        .filter(F.col("deviceName").isNotNull()))


def upods_of(properties: DataFrame) -> DataFrame:
    """Points of delivery: nodes with an id from their organization."""
    return node_table(properties, {
        "id": V.POINT_OF_DELIVERY_ID, "endDate": "bigg__endDate", "newSupply": "bigg__newSupply"}
    ).filter(F.col("id").isNotNull()).drop("id").withColumn("newSupply", F.col("newSupply").cast("boolean"))


def node_table(properties: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Nodes with the named properties (column -> property) as columns."""
    return properties.groupBy("uri").agg(*[
        F.max(F.when(F.col("property") == prop, F.col("value"))).alias(name)
        for name, prop in columns.items()])


# -- paths -----------------------------------------------------------------------------------

def edges_of(edges: DataFrame, edge_type: str, src: str, dst: str) -> DataFrame:
    return edges.filter(F.col("type") == edge_type).select(
        F.col("src").alias(src), F.col("dst").alias(dst))


def graph_path_building(edges: DataFrame) -> DataFrame:
    """(upod, building) over point of delivery <- space <- building."""
    upods = edges_of(edges, V.HAS_POINT_OF_DELIVERY, "space", "upod")
    spaces = edges_of(edges, V.HAS_SPACE, "building", "space")
    return (salted_join(upods, spaces, ["space"], ["upod"], how="inner")
            .select("upod", "building").distinct())


def graph_path_org(edges: DataFrame, generic: DataFrame) -> DataFrame:
    """(org, building) over an organization and its generic sub-organizations.

    `generic` holds the `uri` of every generic organization. A sub-organization that manages a
    large share of all buildings is split over several tasks.
    """
    subs = edges_of(edges, V.HAS_SUB_ORGANIZATION, "org", "sub").join(
        generic.select(F.col("uri").alias("sub")), "sub", "left_semi")
    managed = edges_of(edges, V.MANAGES_BUILDING, "sub", "building")
    return (salted_join(managed, subs, ["sub"], ["building"], how="inner")
            .select("org", "building"))


def merge_source_edges(devices: DataFrame, sources: DataFrame, edges: DataFrame) -> DataFrame:
    """All edges plus one from each device to the source its owner logs in as, where there is
    none yet. Edges keep all their columns; those of other types are not moved."""
    logins = sources.select(F.col("username").alias("nif"), F.col("uri").alias("dst")).distinct()
    owned = devices.filter(F.col("nif").isNotNull()).select(F.col("uri").alias("src"), "nif")
    made = (salted_join(owned, logins, ["nif"], ["src"], how="inner")
            .select("src", F.lit(V.IMPORTED_FROM).alias("type"), "dst").distinct())
    known = edges.filter(F.col("type") == V.IMPORTED_FROM).select(*EDGE)
    return edges.unionByName(made.join(known, EDGE, "left_anti"), allowMissingColumns=True)


def forget_linked_nif(devices: DataFrame, sources: DataFrame) -> DataFrame:
    """Drop `nif` where `merge_source_edges` has made an edge of it."""
    linked = sources.select(F.col("username").alias("nif"),
                            F.lit(True).alias("_linked")).distinct()
    return (salted_join(devices, linked, ["nif"], ["uri"])
            .withColumn("nif", F.when(F.col("_linked").isNull(), F.col("nif"))).drop("_linked"))


def rename_source(devices: DataFrame) -> DataFrame:
    """Move the provider mark from the imported property to `source`."""
    ours = F.col("bigg__source").eqNullSafe(V.PROVIDER)
    return (devices
            .withColumn("source", F.when(ours, V.PROVIDER).otherwise(F.col("source")))
            .withColumn("bigg__source", F.when(~ours, F.col("bigg__source"))))


def mark_location_edges(edges: DataFrame, devices: DataFrame) -> DataFrame:
    """Mark province and city edges of the provider's device locations that have both. Only
    edges of those two types are joined; every edge has a type."""
    ours = devices.filter(F.col("source") == V.PROVIDER).select(F.col("uri").alias("src"))
    places = (edges.filter(F.col("type") == V.HAS_LOCATION)
              .join(ours, "src", "left_semi").select(F.col("dst").alias("src")).distinct())
    is_place = F.col("type").isin(V.HAS_PROVINCE, V.HAS_CITY)
    complete = (edges.filter(is_place).groupBy("src")
                .agg(F.bool_or(F.col("type") == V.HAS_PROVINCE).alias("p"),
                     F.bool_or(F.col("type") == V.HAS_CITY).alias("c"))
                .filter("p and c").select("src"))
    marked = complete.join(places, "src", "left_semi").withColumn("_marked", F.lit(True))
    hit = F.col("_marked").isNotNull()
    return (salted_join(edges.filter(is_place), marked, ["src"], ["dst"])
            .withColumn("selected", F.when(hit, True).otherwise(F.col("selected")))
            .withColumn("source", F.when(hit, V.LOCATION_SOURCE).otherwise(F.col("source")))
            .drop("_marked")
            .unionByName(edges.filter(~is_place)))


# -- enrolment -------------------------------------------------------------------------------

def enrolment_reset(devices: DataFrame) -> DataFrame:
    """At the start of a run no device of the provider is enrolled."""
    return devices.withColumn("enrolled", F.when(F.col("source") == V.PROVIDER, False)
                              .otherwise(F.col("enrolled")))


def finalize_enrolment(devices: DataFrame) -> DataFrame:
    """At its end, enrolled devices lose `stateCancelled`, the others get it; running it again
    changes nothing, since `enrolled` is gone."""
    ours = F.col("source") == V.PROVIDER
    return (devices
            .withColumn("stateCancelled",
                        F.when(ours & F.col("enrolled"), None)
                        .when(ours & ~F.col("enrolled"), V.CANCELLED)
                        .otherwise(F.col("stateCancelled")))
            .withColumn("enrolled", F.when(ours, None).otherwise(F.col("enrolled"))))


def default_new_supply(upods: DataFrame) -> DataFrame:
    return upods.withColumn("newSupply", F.coalesce("newSupply", F.lit(True)))


# -- ownership -------------------------------------------------------------------------------

def nif_props(props: Column) -> Column:
    """The owner entries among a node's properties."""
    return F.map_filter(props, lambda key, _: key.rlike(f"^{V.NIF_KEY_PATTERN}$"))


def nif_props_map(devices: DataFrame) -> DataFrame:
    """Devices with at least one owner entry, and those entries."""
    return (devices.select(F.col("uri").alias("dev"), nif_props(F.col("props")).alias("nifs"))
            .filter(F.size("nifs") > 0))


def strip_nif_props(devices: DataFrame) -> DataFrame:
    return devices.withColumn("props", F.map_filter(
        "props", lambda key, _: ~key.rlike(f"^{V.NIF_KEY_PATTERN}$")))


def device_nifs(nifs: DataFrame) -> DataFrame:
    """One row `(dev, nif, value)` per owner entry of `nif_props_map`."""
    return (nifs.select("dev", F.explode("nifs").alias("key", "value"))
            .select("dev", F.substr("key", F.lit(len(V.NIF_KEY_PREFIX) + 1)).alias("nif"),
                    "value"))


def owner_argmax(owners: DataFrame) -> DataFrame:
    """The winning owner of each device with two or more: largest value, then smallest nif.

    "Alta" sorts after every ISO date, so an active owner beats all that ended.
    """
    return (owners.groupBy("dev", "value")
            .agg(F.min("nif").alias("nif"), F.count(F.lit(1)).alias("n"))
            .groupBy("dev")
            .agg(F.max_by("nif", "value").alias("winner"), F.max("value").alias("until"),
                 F.sum("n").alias("owners"))
            .filter(F.col("owners") >= 2))


def owner_winner(nifs: DataFrame) -> DataFrame:
    """The same of devices as `nif_props_map` gives them, decided within the row: no owner is moved."""
    entries = F.filter(F.transform(F.map_entries("nifs"), lambda e: F.struct(
        e["value"].alias("value"), F.substr(e["key"], F.lit(len(V.NIF_KEY_PREFIX) + 1)).alias("nif"))),
        lambda e: e["value"].isNotNull())
    last = F.array_max(F.transform("_entries", lambda e: e["value"]))
    return (nifs.filter(F.size("nifs") >= 2).withColumn("_entries", entries).withColumn("until", last)
            .select("dev", F.array_min(F.transform(
                F.filter("_entries", lambda e: e["value"] == F.col("until")), lambda e: e["nif"])).alias("winner"),
                "until", F.size("nifs").cast("long").alias("owners"), "nifs"))


def ended_links(edges: DataFrame, nifs: DataFrame, logins: DataFrame) -> DataFrame:
    """Import links that end, `(src, dst, until)`; only for devices a point of delivery has.

    An active winner ends the links to the device's other owners; otherwise all its links end.
    `nifs` is `(dev, nifs)`, a row per device with its owner entries; they stay one map, in which a link's
    owner is looked up. `logins` is `(uri, username)`.
    """
    decided = owner_winner(nifs).withColumnRenamed("dev", "src")
    supplied = edges_of(edges, V.HAS_DEVICE, "upod", "src").select("src").distinct()
    links = edges_of(edges, V.IMPORTED_FROM, "src", "dst")
    named = salted_join(links.join(supplied, "src", "left_semi"),
                        logins.select(F.col("uri").alias("dst"), "username"), ["dst"], ["src"],
                        how="inner", counted=links)
    active = F.col("until") == V.ACTIVE
    listed = F.map_contains_key("nifs", F.concat(F.lit(V.NIF_KEY_PREFIX), F.coalesce("username", F.lit(""))))
    return (named.join(decided, "src")
            .filter(~active | (listed & (F.col("username") != F.col("winner"))))
            .select("src", "dst", "until").distinct())


def resolve_ownership(edges: DataFrame, ended: DataFrame) -> DataFrame:
    """Edges without the import links that ended. Only import links are joined."""
    is_link = F.col("type") == V.IMPORTED_FROM
    left = edges.filter(is_link).join(ended.select("src", "dst"), ["src", "dst"], "left_anti")
    return edges.filter(~is_link).unionByName(left)


def resolve_enddates(nodes: DataFrame, ended: DataFrame, edges: DataFrame) -> DataFrame:
    """End dates of devices and their points of delivery (`uri, endDate`) after links ended:
    cleared under an active owner, else the last owner's end."""
    devices = ended.groupBy("src").agg(F.max("until").alias("until"))
    upods = (edges_of(edges, V.HAS_DEVICE, "uri", "src").join(devices, "src")
             .select("uri", "until"))
    decided = (devices.select(F.col("src").alias("uri"), "until").unionByName(upods)
               .groupBy("uri").agg(F.max("until").alias("_until")))
    return (nodes.join(decided, "uri", "left")
            .withColumn("endDate", F.when(F.col("_until").isNull(), F.col("endDate"))
                        .when(F.col("_until") != V.ACTIVE, F.col("_until")))
            .drop("_until"))
