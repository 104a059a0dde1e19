from pyspark.sql import functions as F

from meterspark import vocabulary as V
from meterspark.operators import graph, supplies as S
from meterspark.plans.finalize import end_run
from meterspark.schemas import SUPPLY

BIGG = V.PREFIXES["bigg"]


def record(spark, **values):
    empty = spark.createDataFrame([(None,) * len(SUPPLY)], SUPPLY)
    extra = {c: F.lit(None).cast("string") for c in
             ("ens", "supply_name", "stateCancelled", "nif_ab", "update_date")}
    return empty.withColumns({
        **extra, "enrolled": F.lit(None).cast("boolean"),
        "contractedPowerkW": F.lit(None).cast("string"),
        **{k: F.lit(v) for k, v in values.items()}})


def test_rules_are_complete():
    assert [len(rules) for _, rules in V.SUPPLY_RULES] == [2, 29, 9, 5]
    assert sum(len(rules) for _, rules in V.SENSOR_RULES) == 17


def test_null_fields_give_no_triple(spark):
    rows = graph.supply_triples(record(spark, cups="ES1", supply_name="ES1")).collect()
    subjects = {r.subject for r in rows}
    assert not any("BUILDINGSPACE" in s for s in subjects)
    device = [r for r in rows if r.subject == V.DEVICE_URI % "ES1"]
    # Four types, name, device type, location and source are all that does not need a field.
    assert len(device) == 8


def test_typed_dynamic_and_constant_objects(spark):
    rows = graph.supply_triples(record(
        spark, cups="ES1", supply_name="ES1", ens="E'1", nif="N1", nif_ab="Alta", enrolled=True,
        startDate="2024-01-01T00:00:00", municipality="77")).collect()
    by = {(r.subject.split("#")[-1], r.predicate): r for r in rows}
    device = (V.DEVICE_URI % "ES1").split("#")[1]
    assert by[device, BIGG + "nif_N1"].object == "Alta"
    assert by[device, BIGG + "enrolled"][2:4] == ("true", V.PREFIXES["xsd"] + "boolean")
    assert by[device, BIGG + "startDate"].datatype == V.PREFIXES["xsd"] + "dateTime"
    assert by[device, BIGG + "source"][2:] == (V.PROVIDER, None, "literal")
    assert by["LOCATION-" + device, BIGG + "hasAddressCity"][2:] == (
        "https://sws.geonames.org/77/", None, "iri")
    assert by["BUILDINGSPACE-E'1", BIGG + "isObservedByDevice"].object_kind == "iri"


def test_last_literal_stays(spark):
    rows = [("s", "p", "old", None, "literal", 1), ("s", "p", "new", None, "literal", 2),
            ("s", "q", "x", None, "iri", 1), ("s", "q", "x", None, "iri", 2),
            ("s", graph.RDF_TYPE, "T", None, "iri", 1)]
    parts = graph.triples_to_graph(spark.createDataFrame(
        rows, "subject string, predicate string, object string, datatype string, "
              "object_kind string, seq int"))
    assert [tuple(r) for r in parts["properties"].select("uri", "property", "value").collect()] == [
        ("s", "p", "new")]
    assert [tuple(r) for r in parts["edges"].collect()] == [("s", "q", "x")]
    assert [tuple(r) for r in parts["labels"].collect()] == [("s", "T")]
    table = graph.node_table(parts["properties"], {"name": "p", "other": "z"}).first()
    assert (table.uri, table.name, table.other) == ("s", "new", None)


def test_upsert_properties(spark):
    cols = "uri string, property string, value string"
    old = spark.createDataFrame([("a", "p", "1"), ("a", "q", "2")], cols)
    new = spark.createDataFrame([("a", "q", "3"), ("b", "p", "4")], cols)
    assert sorted(map(tuple, graph.upsert_properties(old, new).collect())) == [
        ("a", "p", "1"), ("a", "q", "3"), ("b", "p", "4")]


def edges(spark, *rows):
    return spark.createDataFrame(list(rows), "src string, type string, dst string")


def test_merge_source_edges_is_repeatable(spark):
    devices = spark.createDataFrame([("d1", "u1"), ("d2", "u9"), ("d3", None)], "uri string, nif string")
    sources = spark.createDataFrame([("s1", "u1")], "uri string, username string")
    once = graph.merge_source_edges(devices, sources, edges(spark, ("x", "y", "z")))
    twice = graph.merge_source_edges(devices, sources, once)
    want = [("d1", V.IMPORTED_FROM, "s1"), ("x", "y", "z")]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == want
    left = {r.uri: r.nif for r in graph.forget_linked_nif(devices, sources).collect()}
    assert left == {"d1": None, "d2": "u9", "d3": None}


def test_rename_source(spark):
    df = spark.createDataFrame([("a", V.PROVIDER, None), ("b", "x", "y"), ("c", None, V.PROVIDER)],
                               "uri string, bigg__source string, source string")
    got = {r.uri: (r.bigg__source, r.source) for r in graph.rename_source(df).collect()}
    assert got == {"a": (None, V.PROVIDER), "b": ("x", "y"), "c": (None, V.PROVIDER)}


def test_places_are_marked_when_both_are_known(spark):
    rows = [("d1", V.HAS_LOCATION, "l1"), ("l1", V.HAS_PROVINCE, "p"), ("l1", V.HAS_CITY, "c"),
            ("d2", V.HAS_LOCATION, "l2"), ("l2", V.HAS_CITY, "c"),
            ("d3", V.HAS_LOCATION, "l3"), ("l3", V.HAS_PROVINCE, "p"), ("l3", V.HAS_CITY, "c")]
    df = edges(spark, *rows).withColumns({"selected": F.lit(None).cast("boolean"),
                                          "source": F.lit(None).cast("string")})
    devices = spark.createDataFrame([("d1", V.PROVIDER), ("d2", V.PROVIDER), ("d3", "else")],
                                    "uri string, source string")
    marked = graph.mark_location_edges(df, devices).filter("selected").collect()
    assert sorted((r.src, r.type, r.source) for r in marked) == [
        ("l1", V.HAS_CITY, V.LOCATION_SOURCE), ("l1", V.HAS_PROVINCE, V.LOCATION_SOURCE)]


DEVICE = ("uri string, source string, enrolled boolean, stateCancelled string, endDate string, "
          "props map<string,string>")


def run(spark, owners, links, upods=("p",)):
    """End a run over one device `d` with the given owner entries and linked logins."""
    props = {V.NIF_KEY_PREFIX + n: v for n, v in owners.items()} | {"name": "x"}
    devices = spark.createDataFrame(
        [("d", V.PROVIDER, True, "Accepted", "old", props)], DEVICE)
    nodes = spark.createDataFrame([("p", "old", None)], "uri string, endDate string, newSupply boolean")
    rows = [(p, V.HAS_DEVICE, "d") for p in upods] + [("d", V.IMPORTED_FROM, f"s-{n}") for n in links]
    logins = spark.createDataFrame([(f"s-{n}", n) for n in ("n1", "n2", "n3")],
                                   "uri string, username string")
    return end_run(devices, nodes, edges(spark, *rows, ("z", "t", "z")), logins)


def outcome(settled):
    links = sorted(r.dst for r in settled.edges.collect() if r.type == V.IMPORTED_FROM)
    return settled.devices.first().endDate, settled.upods.first().endDate, links


def test_active_owner_ends_the_other_links(spark):
    active = {"n1": "Alta", "n2": "2024-01-01T00:00:00"}
    assert outcome(run(spark, active, ["n1", "n2", "n3"])) == (None, None, ["s-n1", "s-n3"])
    # Nothing linked but the active owner: there is no link to end, and no date changes.
    assert outcome(run(spark, active, ["n1"])) == ("old", "old", ["s-n1"])


def test_ended_owners_end_all_links(spark):
    ended = {"n1": "2023-05-01T00:00:00", "n2": "2024-01-01T00:00:00"}
    assert outcome(run(spark, ended, ["n1", "n2", "n3"])) == (
        "2024-01-01T00:00:00", "2024-01-01T00:00:00", [])


def test_single_owner_and_missing_point_of_delivery_change_nothing(spark):
    assert outcome(run(spark, {"n1": "Alta"}, ["n1", "n2"])) == ("old", "old", ["s-n1", "s-n2"])
    ended = {"n1": "2023-05-01T00:00:00", "n2": "2024-01-01T00:00:00"}
    assert outcome(run(spark, ended, ["n1"], upods=()))[2] == ["s-n1"]


def test_tie_goes_to_the_smallest_nif(spark):
    owners = spark.createDataFrame([("d", "n2", "Alta"), ("d", "n1", "Alta"), ("d", "n3", "2024")],
                                   "dev string, nif string, value string")
    row = graph.owner_argmax(owners).first()
    assert (row.winner, row.until, row.owners) == ("n1", "Alta", 3)


def test_ending_a_run_twice_changes_nothing(spark):
    first = run(spark, {"n1": "Alta", "n2": "2024-01-01T00:00:00"}, ["n1", "n2"])
    logins = spark.createDataFrame([("s-n1", "n1"), ("s-n2", "n2")], "uri string, username string")
    again = end_run(first.devices, first.upods, first.edges, logins)
    for table in ("devices", "upods", "edges"):
        assert sorted(map(repr, getattr(first, table).collect())) == sorted(
            map(repr, getattr(again, table).collect()))
    device = first.devices.first()
    assert (device.stateCancelled, device.enrolled, device.props) == (None, None, {"name": "x"})
    assert first.upods.first().newSupply is True


def test_enrolment_start_and_end(spark):
    rows = [("a", V.PROVIDER, True, "Accepted"), ("b", V.PROVIDER, False, None),
            ("c", V.PROVIDER, None, "kept"), ("d", "else", True, "kept")]
    df = spark.createDataFrame(rows, "uri string, source string, enrolled boolean, stateCancelled string")
    got = {r.uri: (r.enrolled, r.stateCancelled) for r in graph.finalize_enrolment(df).collect()}
    assert got == {"a": (None, None), "b": (None, "Accepted"), "c": (None, "kept"), "d": (True, "kept")}
    reset = {r.uri: r.enrolled for r in graph.enrolment_reset(df).collect()}
    assert reset == {"a": False, "b": False, "c": False, "d": True}


def test_owner_entries_of_devices(spark):
    df = spark.createDataFrame([("a", {"bigg__nif_X1": "Alta", "bigg__nif": "no", "z": "1"}),
                                ("b", {"z": "1"})], "uri string, props map<string,string>")
    rows = graph.device_nifs(graph.nif_props_map(df)).collect()
    assert [tuple(r) for r in rows] == [("a", "X1", "Alta")]
    assert graph.strip_nif_props(df).filter("uri = 'a'").first().props == {"bigg__nif": "no", "z": "1"}


def test_winner_in_the_row_is_that_of_grouped_owners(spark):
    maps = [("d1", {"n2": "Alta", "n1": "Alta", "n3": "2024"}), ("d2", {"n1": "2024"}), ("d3", {"b": "2023", "a": "2024"}),
            ("d4", {"b": None, "a": None}), ("d5", {"b": None, "a": "2020"}), ("d6", {})]
    nifs = spark.createDataFrame([(d, {V.NIF_KEY_PREFIX + k: v for k, v in m.items()}) for d, m in maps],
                                 "dev string, nifs map<string,string>")
    rows = graph.device_nifs(nifs)
    grouped = {r.dev: (r.winner, r.until, r.owners) for r in graph.owner_argmax(rows).collect()}
    own = graph.owner_winner(nifs)
    assert {r.dev: (r.winner, r.until, r.owners) for r in own.collect()} == grouped
    assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString()


def test_links_are_settled_without_moving_owners(spark):
    """One join brings links to the owners of their device, which stay a map."""
    nifs = spark.createDataFrame([("d", {"bigg__nif_a": "Alta"})], "dev string, nifs map<string,string>")
    edges = spark.createDataFrame([], "src string, type string, dst string")
    logins = spark.createDataFrame([], "uri string, username string")
    plan = graph.ended_links(edges, nifs, logins)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(nifs" not in plan and "map_keys(nifs" in plan


def test_a_run_from_start_to_end(spark):
    from meterspark.plans.finalize import start_run
    devices = spark.createDataFrame(
        [("a", V.PROVIDER, True, None), ("b", V.PROVIDER, True, None), ("c", "else", True, "kept")],
        "uri string, source string, enrolled boolean, stateCancelled string")
    started = start_run(devices)
    seen = started.withColumn("enrolled", (F.col("uri") == "a") | F.col("enrolled"))
    got = {r.uri: r.stateCancelled for r in graph.finalize_enrolment(seen).collect()}
    assert got == {"a": None, "b": V.CANCELLED, "c": "kept"}


def triple(subject, predicate, obj, kind, seq=1):
    return (subject, predicate, obj, None, kind, seq)


def test_a_batch_is_merged_into_the_stored_graph(spark, tmp_path):
    from meterspark.plans import harmonize
    schema = "subject string, predicate string, object string, datatype string, object_kind string, seq long"
    ns = next(iter(V.PREFIXES.values()))
    prefix = next(iter(V.PREFIXES))
    first = [triple("a", graph.RDF_TYPE, ns + "Device", "iri"), triple("a", ns + "p", "1", "literal"),
             triple("a", ns + "q", "old", "literal"), triple("a", ns + "has", "b", "iri"), triple("z", ns + "p", "9", "literal")]
    later = [triple("a", graph.RDF_TYPE, ns + "Device", "iri", 2), triple("a", ns + "q", "new", "literal", 2),
             triple("a", ns + "q", "newest", "literal", 3), triple("a", ns + "has", "b", "iri", 2),
             triple("c", ns + "has", "b", "iri", 2)]
    path, staging = str(tmp_path / "graph"), str(tmp_path / "staging")
    for batch in (first, later, later):
        harmonize.save_graph(spark, spark.createDataFrame(batch, schema), path, staging, slots=4)
    stored = {name: sorted(tuple(r) for r in df.drop("datatype").collect())
              for name, df in harmonize.read_graph(spark, path).items()}
    assert stored == {
        "labels": [("a", f"{prefix}__Device")],
        "properties": [("a", f"{prefix}__p", "1"), ("a", f"{prefix}__q", "newest"), ("z", f"{prefix}__p", "9")],
        "edges": [("a", "has", "b"), ("c", "has", "b")]}
    harmonize.save_graph(spark, spark.createDataFrame([], schema), path, staging, slots=4)
    assert harmonize.read_graph(spark, path)["edges"].count() == 2


def test_records_of_one_task_are_spread_before_they_make_triples(spark):
    records = record(spark, cups="ES1").coalesce(1)
    assert graph.supply_triples(records).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
