"""Whole runs on a few rows, and batch against stream."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from meterspark import vocabulary as V
from meterspark.operators import legacy, timeseries as TS
from meterspark.plans import gather, harmonize
from meterspark.plans.legacy import export_tables, import_rows, merge_legacy
from meterspark.schemas import (CHUNK_STATE, CONTRACT, LANDED_SUPPLY, LEGACY_ROW, READING,
                                SUBSCRIPTION)
from meterspark.sources.subscriptions import SourceSpec
from meterspark.streaming import envelopes as E, jobs

PROP = "EnergyConsumptionGridElectricity"
AS_OF = date(2024, 1, 31)
STATIC = "static"


@pytest.fixture(scope="module")
def run(spark):
    subs = spark.createDataFrame(
        [(1, "A", "u", None, None, None, ["t"], [["cups", "timestamp"]]),
         (2, "B", "u", None, None, ["c2"], ["t"], [["cups", "timestamp"]])], SUBSCRIPTION)
    rest = (None,) * (len(LANDED_SUPPLY) - 4)
    supplies = spark.createDataFrame([(1, "u", "", "c1", *rest), (2, "u", "", "c2", *rest)],
                                     LANDED_SUPPLY)
    requests = gather.plan_requests(subs, supplies, spark.createDataFrame([], CHUNK_STATE), AS_OF)
    t0 = 1704067200
    readings = spark.createDataFrame(
        [("c1", t0 + 3600 * i, None, 1.0 * i, "Real", "PT1H", PROP) for i in range(30)]
        + [("c2", t0, None, 5.0, "Real", "PT1H", PROP)], READING)
    # The first reading comes twice; the later delivery has another value.
    delivered = readings.withColumn("seq", F.lit(1)).unionByName(
        readings.limit(0).unionByName(spark.createDataFrame(
            [("c1", t0, None, 99.0, "Real", "PT1H", PROP)], READING)).withColumn("seq", F.lit(2)))
    contract = (None,) * (len(CONTRACT) - 3)
    contracts = spark.createDataFrame([(1, "c1", "2023-01-01", *contract)], CONTRACT)
    specs = [SourceSpec("A", lambda s: None, topic="A.ts"), SourceSpec("B", lambda s: None, topic="B.ts")]
    return requests, gather.deliver(requests, delivered, contracts, specs, AS_OF, STATIC, "run1")


def test_requests_cover_every_open_chunk(run):
    requests, _ = run
    per = {r.cups: r["count"] for r in requests.plan.groupBy("cups").count().collect()}
    assert per == {"c1": 49, "c2": 49}
    assert {r.username for r in requests.plan.collect()} == {"u"}


def test_state_after_delivery(run):
    _, delivery = run
    rows = {(r.cups, r.chunk_key): r for r in delivery.state.collect()
            if r.data_type == f"{PROP}_PT1H"}
    got = rows["c1", "2024-01-01~2024-01-31"]
    # A reading that came twice counts once.
    assert (got["values"], got.retries, got.total) == (30, 6, 744)
    assert rows["c1", "2023-12-01~2023-12-31"].retries == 5
    assert rows["c1", "2022-02-01~2022-02-28"].retries == 6


def test_each_source_gets_its_supplies(run):
    _, delivery = run
    keys = {(r.topic, r.key) for r in delivery.timeseries.collect()}
    assert keys == {("A.ts", "c1"), ("A.ts", "c2"), ("B.ts", "c2")}
    message = json.loads(delivery.timeseries.filter("topic = 'B.ts'").first().value)
    assert message["kwargs"] == {"collection_type": "timeseries", "property": PROP, "freq": "PT1H",
                                 "dblist": ["B"], "run_id": "run1"}
    assert message["tables"] == [f"raw_ts_{PROP}_PT1H"] and message["row_keys"] == [["cups", "timestamp"]]


def test_only_contracted_supplies_are_published(run):
    _, delivery = run
    rows = delivery.static.collect()
    assert [r.key for r in rows] == ["c1"]
    message = json.loads(rows[0].value)
    assert message["kwargs"]["dblist"] == ["A"] and message["data"]["nif"] == "u"
    assert {(m["property"], m["freq"]) for m in message["data"]["measurements"]} == {
        (PROP, "PT1H"), (PROP, "PT15M"), ("Power", "P1M")}


def test_stream_equals_batch(spark, run, tmp_path):
    """Messages of a run through the streaming job, in several batches and with junk and markers."""
    _, delivery = run
    at = lambda name: str(tmp_path / name)
    ends = E.final_markers(spark.createDataFrame([("run1",)], "run_id string"), STATIC)
    junk = spark.createDataFrame(
        [(STATIC, "k", "{bad"), (STATIC, "k", '{"kwargs": {}}'), ("A.ts", "k", None)],
        "topic string, key string, value string")
    everything = (delivery.timeseries.unionByName(delivery.static).unionByName(ends)
                  .unionByName(ends).unionByName(junk))
    everything.repartition(4).write.parquet(at("in"))
    ends.write.mode("append").parquet(at("in"))
    finished = []
    job = jobs.start_harmonizer(
        jobs.file_messages(spark, at("in"), 1), at("out"), at("state"), "A", STATIC,
        on_supplies=lambda df: df.select("cups", "nif"),
        on_final=lambda s, runs: finished.extend(r.run_id for r in runs.collect()),
        trigger={"availableNow": True})
    job.awaitTermination()

    batch = E.message_readings(E.timeseries_select(
        E.decode_envelopes(delivery.timeseries, STATIC), "A"))
    points = TS.harmonize_timeseries(batch)
    cols = points.columns
    streamed = spark.read.parquet(at("out/points")).select(cols)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, points.collect()))
    assert streamed.count() == 31 and 99.0 in {r.value for r in streamed.collect()}
    assert finished == ["run1"]
    assert spark.read.parquet(at("out/quarantine")).count() == 2
    assert [r.cups for r in spark.read.parquet(at("out/triples")).collect()] == ["c1"]
    covered = jobs.read_coverage(spark, at("out/coverage"))
    assert {r.cups: r.last_ts for r in covered.collect()} == {
        "c1": 1704067200 + 29 * 3600, "c2": 1704067200}


def test_selection_by_source_and_property(spark):
    def message(**kwargs):
        return ("ts", "k", json.dumps({"data": [], "kwargs": kwargs}))
    raw = spark.createDataFrame(
        [message(dblist=["A"], property=PROP), message(dblist=["B"], property=PROP),
         message(dblist=["A", "B"], property="Power"), message(property=PROP), ("ts", "k", "{}")],
        "topic string, key string, value string")
    decoded = E.decode_envelopes(raw, STATIC)
    assert {r.kind for r in decoded.collect()} == {"timeseries"}
    assert E.timeseries_select(decoded, "A").count() == 1


def test_supplies_become_triples(spark):
    edges = spark.createDataFrame(
        [("sp", V.HAS_POINT_OF_DELIVERY, "u:c1"), ("u:b1", V.HAS_SPACE, "sp"),
         ("u:org", V.HAS_SUB_ORGANIZATION, "sub"), ("sub", V.MANAGES_BUILDING, "u:b2")],
        "src string, type string, dst string")
    ids = spark.createDataFrame(
        [("u:c1", V.POINT_OF_DELIVERY_ID, "c1"), ("u:b1", V.BUILDING_ID, "b1"),
         ("u:b2", V.BUILDING_ID, "b2"), ("u:org", V.ORGANIZATION_ID, "org")],
        "uri string, property string, value string")
    by_supply, by_nif = harmonize.building_tables(
        edges, spark.createDataFrame([("sub",)], "uri string"), ids)
    at = "https://sws.geonames.org/{}/".format
    gazetteer = spark.createDataFrame(
        [(at(1), V.GAZETTEER_NAME, "Reus"), (at(1), V.GAZETTEER_LEVEL, V.MUNICIPALITY_LEVEL),
         (at(2), V.GAZETTEER_NAME, "Tarragona"), (at(2), V.GAZETTEER_LEVEL, V.PROVINCE_LEVEL)],
        "subject string, predicate string, object string")
    records = spark.createDataFrame(
        [("c1", "org", "REUS", "TARAGONA"), ("c2", "org", "Reus", None)],
        "cups string, nif string, municipality string, province string")
    lookups = harmonize.Lookups(by_supply, by_nif, gazetteer, spark.createDataFrame(
        [("c2", True)], "deviceName string, enrolled boolean"))
    rows = harmonize.harmonize_supplies(records, lookups, "2024-01-31T00:00:00+00:00").collect()
    got = {r.cups: (r.ens, r.municipality, r.province, r.enrolled) for r in rows}
    assert got == {"c1": ("b1", "1", "2", False), "c2": ("b2", "1", None, True)}
    triples = harmonize.supply_graph(records, lookups, "2024-01-31T00:00:00+00:00")
    assert triples.filter("object = 'https://sws.geonames.org/2/'").count() == 1


def test_legacy_merge_prefers_the_later_table(spark):
    old = spark.createDataFrame([("h~1", 1.0, "Real", "a"), ("h~2", 2.0, "Real", "a")], LEGACY_ROW)
    new = spark.createDataFrame([("h~2", 3.0, None, "b"), ("g~x", 4.0, None, "b")], LEGACY_ROW)
    got = {(r.hash, r.start_time): (r.consumptionKWh, r.obtainMethod)
           for r in merge_legacy([old, new], ["datetime"]).collect()}
    assert got == {("h", 1): (1.0, "Real"), ("h", 2): (3.0, None), ("g", None): (4.0, None)}


def test_legacy_export_and_import(spark, tmp_path):
    old = spark.createDataFrame([("h~1", 1.0, "Real", "a"), ("h~2", 2.0, None, "a")], LEGACY_ROW)
    new = spark.createDataFrame([("h~2", 3.0, "Real", "b"), ("h~1", 4.0, "Real", "0")], LEGACY_ROW)
    export_tables([old, new], str(tmp_path / "x"))
    got = import_rows(spark, str(tmp_path / "x"), ["datetime"])
    assert sorted(map(tuple, got.select("hash", "start_time", "consumptionKWh", "datetime",
                                        "obtainMethod").collect())) == [
        ("h", 1, 4.0, "0", "Real"), ("h", 2, 3.0, "b", "Real")]


def test_tsv_marks_nulls_and_keeps_quotes(spark, tmp_path):
    """Nulls are marked in the files; an empty text cannot be told from a null when read."""
    df = spark.createDataFrame([("a", None, 'say "x"'), ("b", "", None), ("c", "y z", "1")],
                               "k string, a string, b string")
    legacy.write_tsv(df, str(tmp_path / "t"))
    text = "".join(p.read_text() for p in (tmp_path / "t").glob("part-*"))
    assert "a\t\\N\tsay \"x\"" in text
    back = legacy.read_tsv(spark, str(tmp_path / "t"), df.schema)
    assert sorted(map(tuple, back.collect())) == [
        ("a", None, 'say "x"'), ("b", None, None), ("c", "y z", "1")]


def test_groups_come_in_bounded_parts(spark):
    df = spark.range(2500).select(F.lit("k").alias("key"), "id", (F.col("id") * 2).alias("v"))
    parts = legacy.group_values(df, "key", "v", "id").orderBy("part").collect()
    assert [len(p["values"]) for p in parts] == [1000, 1000, 500]
    assert [v for p in parts for v in p["values"]] == [2 * i for i in range(2500)]


def test_run_ends_with_the_last_partition(spark, tmp_path):
    """Markers of two partitions in different micro-batches: nothing is settled in between."""
    ends = E.final_markers(spark.createDataFrame([("run1",)], "run_id string"), STATIC, partitions=2)
    at = lambda name: str(tmp_path / name)
    finished = []

    def drain():
        jobs.start_harmonizer(
            jobs.file_messages(spark, at("in"), 1), at("out"), at("state"), "A", STATIC,
            on_final=lambda s, runs: finished.extend(r.run_id for r in runs.collect()),
            trigger={"availableNow": True}).awaitTermination()

    for key, want in (("1", []), ("1", []), ("0", ["run1"]), ("0", ["run1"])):
        ends.filter(F.col("key") == key).coalesce(1).write.mode("append").parquet(at("in"))
        drain()
        assert finished == want


def test_later_delivery_stays(spark, tmp_path):
    for batch, value in ((2, 5.0), (10, 6.0)):
        points = spark.createDataFrame([("h", 1, value)], "hash string, start long, value double")
        points.write.parquet(str(tmp_path / f"batch_id={batch}"))
    assert [r.value for r in jobs.read_points(spark, str(tmp_path)).collect()] == [6.0]


def test_folded_ranges_are_those_of_all_batches(spark, tmp_path):
    log, folded = str(tmp_path / "log"), str(tmp_path / "folded")
    for batch, (first, last) in enumerate([(5, 9), (3, 4), (8, 20)]):
        spark.createDataFrame([("m", "p", "PT1H", first, last)],
                              "cups string, prop string, freq string, first_ts long, last_ts long"
                              ).write.parquet(f"{log}/batch_id={batch}")
    jobs.fold_coverage(spark, log, folded, 0)
    jobs.fold_coverage(spark, log, folded, 1, since=0)
    for upto, want in ((0, (3, 20)), (1, (3, 20)), (None, (3, 20))):
        got = jobs.read_coverage(spark, log, folded, upto).collect()
        assert [(r.first_ts, r.last_ts) for r in got] == [want]
    assert spark.read.parquet(f"{folded}/upto=1").first().asDict()["first_ts"] == 3


def test_tracked_chunks_keep_their_number_of_tasks(spark):
    """Adaptive execution does not fold them by the size of the supplies they are made of."""
    subs = spark.createDataFrame([(1, "A", "u", None, None, None, ["t"], [["cups", "timestamp"]])], SUBSCRIPTION)
    supplies = spark.createDataFrame([(1, "u", "", "c1", *(None,) * (len(LANDED_SUPPLY) - 4))], LANDED_SUPPLY)
    state = gather.plan_requests(subs, supplies, spark.createDataFrame([], CHUNK_STATE), AS_OF).state
    assert "REPARTITION_BY_NUM" in state._jdf.queryExecution().executedPlan().toString()
    assert state.count() == 52
