"""Stream state: ends of runs, ranges and repeated readings over several batches and restarts."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from meterspark.functions import keyed
from meterspark.plans import gather
from meterspark.sources import landing
from meterspark.streaming import envelopes as E, jobs

NOW = {"availableNow": True}
STATIC = "static"


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def markers(spark, run, keys, partitions):
    ends = E.final_markers(spark.createDataFrame([(run,)], "run_id string"), STATIC, partitions=partitions)
    return ends.filter(F.col("key").isin([str(k) for k in keys])).coalesce(1)


def test_runs_end_once_over_late_markers_and_restarts(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    finished = []

    def drain():
        jobs.start_harmonizer(
            jobs.file_messages(spark, at("in"), 1), at("out"), at("state"), "A", STATIC,
            on_final=lambda s, runs: finished.extend(sorted(r.run_id for r in runs.collect())),
            trigger=NOW).awaitTermination()

    steps = [([("r1", [0], 3), ("r2", [0], 1)], ["r2"]), ([("r1", [0, 1], 3)], []), ([("r2", [0], 1)], []),
             ([("r1", [2], 3), ("r3", [0, 1], 2)], ["r1", "r3"]), ([("r1", [0, 1, 2], 3), ("r3", [1], 2)], [])]
    want = []
    for sent, ended in steps:
        for run, keys, partitions in sent:
            markers(spark, run, keys, partitions).write.mode("append").parquet(at("in"))
        drain()
        want += ended
        assert sorted(finished) == sorted(want)
    assert sorted(r.run_id for r in spark.read.parquet(at("out/runs")).collect()) == ["r1", "r2", "r3"]


def test_a_failed_end_is_tried_again(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    calls = []

    def fail_once(session, runs):
        calls.append([r.run_id for r in runs.collect()])
        if len(calls) == 1:
            raise RuntimeError("the store is away")

    def drain():
        jobs.start_harmonizer(jobs.file_messages(spark, at("in"), 1), at("out"), at("state"), "A", STATIC,
                              on_final=fail_once, trigger=NOW).awaitTermination()

    markers(spark, "r1", [0], 1).write.parquet(at("in"))
    with pytest.raises(Exception, match="the store is away"):
        drain()
    drain()
    assert calls == [["r1"], ["r1"]]
    markers(spark, "r1", [0], 1).write.mode("append").parquet(at("in"))
    drain()
    assert len(calls) == 2


def test_ranges_grow_in_place(spark, tmp_path):
    """Each batch rewrites the slots of its sensors alone; the table never has more files than slots."""
    at = lambda name: str(tmp_path / name)
    schema = "cups string, prop string, freq string, timestamp long"
    batches = [[(f"c{i}", "p", "PT1H", 100 + i) for i in range(300)], [("c1", "p", "PT1H", 5)], [("c1", "p", "PT1H", 50)],
               [("c1", "p", "PT1H", 900), ("new", "p", "PT1H", 7)], []]
    want, counts = {}, []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(at("in"))
        before = files(at("out"))
        jobs.start_coverage(spark.readStream.schema(schema).parquet(at("in")), at("out"), at("state"),
                            trigger=NOW).awaitTermination()
        for cups, _, _, ts in rows:
            lo, hi = want.get(cups, (ts, ts))
            want[cups] = (min(lo, ts), max(hi, ts))
        assert {r.cups: (r.first_ts, r.last_ts) for r in jobs.read_ranges(spark, at("out")).collect()} == want
        after = files(at("out"))
        if before:
            assert len(set(before.items()) - set(after.items())) <= len({r[0] for r in rows})
        counts.append(len(after))
    assert max(counts) <= jobs.RANGE_SLOTS


def test_logged_ranges_fold_to_the_same_table(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    schema = "cups string, prop string, freq string, first_ts long, last_ts long"
    for rows in ([("a", "p", "f", 5, 9), ("b", "p", "f", 1, 1)], [("a", "p", "f", 2, 3), ("a", "q", "f", 4, 4)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(at("log"))
        jobs.start_ranges(spark.readStream.schema(schema).parquet(at("log")), at("out"), at("state"), NOW).awaitTermination()
    assert sorted(tuple(r) for r in jobs.read_ranges(spark, at("out")).collect()) == [
        ("a", "p", "f", 2, 9), ("a", "q", "f", 4, 4), ("b", "p", "f", 1, 1)]


def test_repeated_readings_are_dropped_within_the_watermark(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    schema = "cups string, timestamp long, consumptionKWh double"
    late, counted = [], []
    for rows in ([("a", 1000, 1.0), ("a", 2000, 1.0), ("a", 2000, 1.0)],
                 [("a", 2000, 1.0), ("a", 2000, 2.0), ("a", 1950, 1.0), ("a", 1000, 1.0), ("b", 3, None)],
                 [("a", 5000, 1.0), ("a", 2000, 2.0)], [("a", 2000, 2.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(at("in"))
        job = jobs.start_unique(spark.readStream.schema(schema).parquet(at("in")), at("out"), at("state"), "100 seconds", NOW)
        job.awaitTermination()
        late.append(jobs.late_rows(job))
        counted += [(a["rows"], a["without_value"], a["last_ts"]) for a in jobs.audits(job).values()]
    got = spark.read.schema(schema).parquet(at("out")).collect()
    assert sorted((r.cups, r.timestamp, r.consumptionKWh) for r in got) == [
        ("a", 1000, 1.0), ("a", 1950, 1.0), ("a", 2000, 1.0), ("a", 2000, 2.0), ("a", 5000, 1.0)]
    assert late == [0, 2, 0, 1]
    assert counted == [(2, 0, 2000), (2, 0, 2000), (1, 0, 5000)]


def test_a_run_sends_its_end_last(spark, tmp_path):
    sent = []
    frame = lambda *keys: spark.createDataFrame([("t", k, "{}") for k in keys], "topic string, key string, value string")
    gather.send(gather.Delivery(None, frame("a", "b"), frame("c")), "r1", STATIC, lambda df: sent.append(df.collect()), 2)
    assert [sorted(r.key for r in part) for part in sent] == [["a", "b"], ["c"], ["0", "1"]]
    last = E.markers(E.decode_envelopes(spark.createDataFrame(sent[-1]), STATIC)).collect()
    assert sorted((r.run_id, r.partition, r.partitions) for r in last) == [("r1", 0, 2), ("r1", 1, 2)]


def test_an_update_leaves_untouched_files(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "k long, part string, v long"
    old = [(i, f"p{i % 7}", i) for i in range(500)]
    keyed.write_keyed(spark.createDataFrame(old, schema), path, ["k"], 16)
    before = files(path)
    assert len(before) <= 16
    new = [(3, "p3", -3), (3, "other", 1), (1000, "p6", None)]
    touched = {r[0] for r in spark.createDataFrame(new, schema).select(keyed.slot(["k"], 16)).collect()}
    want = {(k, p): v for k, p, v in old} | {(k, p): v for k, p, v in new}
    for _ in range(2):  # an update that is repeated leaves the same rows
        keyed.update_keyed(spark, path, spark.createDataFrame(new, schema), ["k", "part"], ["k"], 16)
        after = files(path)
        kept = {f: t for f, t in before.items() if int(f.split("slot=")[1].split("/")[0]) not in touched}
        assert kept.items() <= after.items() and len(after) <= 16 + 2
        got = spark.read.schema(schema).parquet(path).collect()
        assert len(got) == len(want) and {(r.k, r.part): r.v for r in got} == want
    keyed.update_keyed(spark, path, spark.createDataFrame([], schema), ["k", "part"], ["k"], 16)
    assert files(path) == after


def test_an_update_reads_its_slots_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = spark.createDataFrame([], "k long, v long").schema
    keyed.write_keyed(spark.range(100).selectExpr("id as k", "id as v"), path, ["k"], 8)
    plan = keyed.read_keyed(spark, path, schema).filter(F.col("slot").isin([2, 5]))._jdf.queryExecution()
    assert "PartitionFilters: [slot" in plan.executedPlan().toString()


def test_chunk_state_table(spark, tmp_path):
    path = str(tmp_path / "state")
    row = ("m", "d", "c1", None, None, 1, 4, 6, None, None)
    state = spark.createDataFrame([row, ("n", *row[1:])], landing.S.CHUNK_STATE)
    landing.write_chunk_state(state, path, 8)
    new = spark.createDataFrame([("m", "d", "c1", None, None, 4, 4, 5, None, None),
                                 ("m", "d", "c2", None, None, 0, 4, 6, None, None)], landing.S.CHUNK_STATE)
    landing.update_chunk_state(spark, path, new, 8)
    got = landing.read_chunk_state(spark, path)
    assert got.columns == landing.S.CHUNK_STATE.fieldNames()
    assert sorted((r.cups, r.chunk_key, r["values"], r.retries) for r in got.collect()) == [
        ("m", "c1", 4, 5), ("m", "c2", 0, 6), ("n", "c1", 1, 6)]


def test_an_update_cut_off_is_carried_on(spark, tmp_path, monkeypatch):
    """The driver is lost after the new contents were written, when a slot's folder has gone already."""
    path = str(tmp_path / "table")
    schema = "k long, v long"
    keyed.write_keyed(spark.createDataFrame([(i, i) for i in range(200)], schema), path, ["k"], 4)
    real, calls = keyed._write, []

    def cut_off(placed, to, *rest):
        calls.append(to)
        if to == path:
            raise RuntimeError("lost")
        real(placed, to, *rest)

    monkeypatch.setattr(keyed, "_write", cut_off)
    with pytest.raises(RuntimeError, match="lost"):
        keyed.update_keyed(spark, path, spark.createDataFrame([(3, -3)], schema), ["k"], slots=4)
    monkeypatch.setattr(keyed, "_write", real)
    slot = spark.createDataFrame([(3, 0)], schema).select(keyed.slot(["k"], 4)).first()[0]
    gone = glob.glob(f"{path}/slot={slot}/*.parquet")
    assert calls[-1] == path and gone
    for f in gone:
        os.unlink(f)
    keyed.update_keyed(spark, path, spark.createDataFrame([(500, 1)], schema), ["k"], slots=4)
    got = {r.k: r.v for r in spark.read.schema(schema).parquet(path).collect()}
    assert got == {i: i for i in range(200)} | {3: -3, 500: 1}


def test_a_large_slot_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "table"), "k long, v long"
    keyed.write_keyed(spark.createDataFrame([(i, i) for i in range(400)], schema), path, ["k"], 2)
    monkeypatch.setattr(keyed, "WRITE_ROWS", 20)
    keyed.update_keyed(spark, path, spark.createDataFrame([(i, -i) for i in range(200, 600)], schema), ["k"], slots=2)
    assert len(files(path)) > 6
    got = spark.read.schema(schema).parquet(path).collect()
    assert sorted((r.k, r.v) for r in got) == [(i, i if i < 200 else -i) for i in range(600)]


def test_messages_of_one_file_are_taken_apart_by_several_tasks(spark, tmp_path):
    sent = spark.createDataFrame([(STATIC, f"{i}", '{"data": {"cups": "%d"}, "kwargs": {}}' % i) for i in range(50)],
                                 "topic string, key string, value string")
    sent.coalesce(1).write.parquet(str(tmp_path / "in"))
    seen = []

    def on_supplies(records):
        seen.append(records.rdd.getNumPartitions())
        return records.select("cups")

    jobs.start_harmonizer(jobs.file_messages(spark, str(tmp_path / "in")), str(tmp_path / "out"),
                          str(tmp_path / "state"), "alpha", STATIC, on_supplies=on_supplies, trigger=NOW).awaitTermination()
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    assert spark.read.parquet(str(tmp_path / "out/triples")).distinct().count() == 50
