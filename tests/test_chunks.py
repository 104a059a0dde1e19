from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterspark.catalog import tables
from meterspark.functions import clock
from meterspark.operators import chunks
from meterspark.schemas import CHUNK_STATE, SERIES

AS_OF = date(2026, 2, 17)
HOURLY, QUARTERLY, POWER = (s.name for s in SERIES)


def calendar_of(spark, valid_to, as_of=AS_OF, **kw):
    supplies = spark.createDataFrame([("c1", valid_to)], "cups string, validDateTo string")
    rows = chunks.chunk_calendar(supplies, as_of, **kw).collect()
    out = {s.name: [] for s in SERIES}
    for r in rows:
        out[r.data_type].append(r)
    return {k: sorted(v, key=lambda r: r.chunk_key) for k, v in out.items()}


def test_calendar_of_an_active_supply(spark):
    cal = calendar_of(spark, None)
    for name in (HOURLY, QUARTERLY):
        keys = [r.chunk_key for r in cal[name]]
        assert (len(keys), keys[0], keys[-1]) == (
            24, "2024-03-01~2024-03-31", "2026-02-01~2026-02-28")
    power = [r.chunk_key for r in cal[POWER]]
    assert (len(power), power[0], power[-1]) == (
        4, "2024-03-01~2024-08-31", "2025-09-01~2026-02-28")


def test_calendar_has_no_gaps_and_no_overlaps(spark):
    for rows in calendar_of(spark, None).values():
        for before, after in zip(rows, rows[1:]):
            assert (after.date_ini - before.date_end).total_seconds() == 1


@pytest.mark.parametrize("as_of", [date(2024, 2, 29), date(2025, 12, 31), date(2026, 1, 1)])
def test_any_day_gives_24_months(spark, as_of):
    cal = calendar_of(spark, None, as_of)
    assert [len(cal[n]) for n in (HOURLY, QUARTERLY, POWER)] == [24, 24, 4]


def test_valid_to_cuts_the_calendar(spark):
    assert [len(v) for v in calendar_of(spark, "2025/03/09").values()] == [13, 13, 3]
    assert [len(v) for v in calendar_of(spark, "2031/12/31").values()] == [24, 24, 4]
    assert [len(v) for v in calendar_of(spark, "unknown").values()] == [24, 24, 4]
    assert [len(v) for v in calendar_of(spark, "2019/1/1").values()] == [0, 0, 0]


def test_strict_valid_to_reads_one_digit_days_only(spark):
    assert len(calendar_of(spark, "2025/03/09", strict_valid_to=True)[HOURLY]) == 24
    assert len(calendar_of(spark, "2025/3/9", strict_valid_to=True)[HOURLY]) == 13


@pytest.mark.parametrize("first, last, hours, quarters", [
    ("2024-01-01", "2024-01-31", 744, 2976), ("2024-02-01", "2024-02-29", 696, 2784),
    ("2024-03-01", "2024-03-31", 743, 2972), ("2024-10-01", "2024-10-31", 745, 2980)])
def test_expected_elements_follow_the_clock_change(spark, first, last, hours, quarters):
    df = spark.range(1).select(
        F.lit(first).cast("timestamp_ntz").alias("a"),
        F.lit(f"{last} 23:59:59").cast("timestamp_ntz").alias("b"))
    step = lambda n: F.lit(n).cast("int")
    row = df.select(clock.expected_elements(F.col("a"), F.col("b"), step(3600)).alias("h"),
                    clock.expected_elements(F.col("a"), F.col("b"), step(900)).alias("q")).first()
    assert (row.h, row.q) == (hours, quarters)
    days = date.fromisoformat(first), date.fromisoformat(last)
    assert (clock.expected_count(*days, 3600), clock.expected_count(*days, 900)) == (hours, quarters)


def test_six_months_of_power_have_six_elements(spark):
    df = spark.range(1).select(clock.expected_elements(
        F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-06-30 23:59:59").cast("timestamp_ntz"),
        F.lit(None).cast("int")).alias("n"))
    assert df.first().n == 6
    assert clock.expected_count(date(2024, 1, 1), date(2024, 6, 30), None) == 6


def test_observed_uses_the_local_month(spark):
    # 22:30 UTC on 31 January is 23:30 in winter Madrid; 23:30 UTC is already February there.
    def epoch(text):
        return int(datetime.fromisoformat(text + "+00:00").timestamp())
    prop, freq = HOURLY.split("_")
    rows = [("c1", prop, freq, epoch("2026-01-31T22:30:00")),
            ("c1", prop, freq, epoch("2026-01-31T23:30:00")),
            ("c1", "Power", "P1M", epoch("2025-12-31T23:30:00")),
            ("c1", prop, freq, epoch("2020-01-01T00:00:00")),
            ("c1", "Other", "PT1H", epoch("2026-01-01T12:00:00"))]
    readings = spark.createDataFrame(rows, "cups string, prop string, freq string, timestamp long")
    got = {(r.data_type, r.chunk_key): r.observed
           for r in chunks.chunk_observed(readings, AS_OF).collect()}
    assert got == {(HOURLY, "2026-01-01~2026-01-31"): 1, (HOURLY, "2026-02-01~2026-02-28"): 1,
                   (POWER, "2025-09-01~2026-02-28"): 1}


def state_of(spark, *rows):
    """Rows of (chunk month, values, total, retries)."""
    full = [("c1", HOURLY, f"{m}-01~{m}-xx", datetime.fromisoformat(f"{m}-01"),
             datetime.fromisoformat(f"{m}-28T23:59:59"), v, t, r, None, None)
            for m, v, t, r in rows]
    return spark.createDataFrame(full, CHUNK_STATE)


def test_eligible_chunks(spark):
    state = chunks.chunk_state_init(
        chunks.chunk_calendar(spark.createDataFrame(
            [("c1", None)], "cups string, validDateTo string"), AS_OF),
        spark.createDataFrame([], CHUNK_STATE))
    per = {r.data_type: r["count"] for r in
           chunks.incomplete_chunks(state, AS_OF).groupBy("data_type").count().collect()}
    assert per == {HOURLY: 23, QUARTERLY: 23, POWER: 3}


@pytest.mark.parametrize("before, seen, after, retries", [
    (0, 0, 0, 5), (0, 700, 700, 6), (700, 700, 700, 5), (700, 650, 650, 6)])
def test_retry_state(spark, before, seen, after, retries):
    state = state_of(spark, ("2025-05", before, 744, 6))
    observed = spark.createDataFrame(
        [("c1", HOURLY, "2025-05-01~2025-05-xx", seen, 1000, 2000)] if seen else [],
        "cups string, data_type string, chunk_key string, observed long, first_ts long, last_ts long")
    row = chunks.retry_state(state, observed, AS_OF).first()
    assert (row["values"], row.retries) == (after, retries)
    assert (row.date_min is not None) == (seen > 0)


def test_chunks_not_attempted_stay(spark):
    state = state_of(spark, ("2025-05", 744, 744, 6), ("2025-06", 3, 720, 0),
                     ("2024-03", 3, 743, 6))
    observed = spark.createDataFrame(
        [("c1", HOURLY, f"{m}-01~{m}-xx", 9, 1, 2) for m in ("2025-05", "2025-06", "2024-03")],
        "cups string, data_type string, chunk_key string, observed long, first_ts long, last_ts long")
    assert sorted(chunks.retry_state(state, observed, AS_OF).collect()) == sorted(state.collect())


def test_retries_never_grow(spark):
    state = state_of(spark, *[(f"2025-{m:02}", v, 700, r) for m, (v, r) in enumerate(
        [(0, 6), (5, 1), (700, 3), (9, 0)], 1)])
    seen = state.select("cups", "data_type", "chunk_key", F.lit(5).cast("long").alias("observed"),
                        F.lit(1).cast("long").alias("first_ts"), F.lit(2).cast("long").alias("last_ts"))
    old = {r.chunk_key: r.retries for r in state.collect()}
    for r in chunks.retry_state(state, seen, AS_OF).collect():
        assert r.retries <= old[r.chunk_key]


def test_state_init_keeps_known_and_old_chunks(spark):
    known = spark.createDataFrame(
        [("c1", HOURLY, "2026-02-01~2026-02-28", datetime(2026, 2, 1), datetime(2026, 2, 28), 7,
          672, 2, None, None),
         ("c1", HOURLY, "2019-01-01~2019-01-31", datetime(2019, 1, 1), datetime(2019, 1, 31), 1,
          744, 1, None, None)], CHUNK_STATE)
    supplies = spark.createDataFrame([("c1", None)], "cups string, validDateTo string")
    calendar = chunks.chunk_calendar(supplies, AS_OF)
    full = {r.chunk_key: r for r in chunks.chunk_state_init(calendar, known)
            .filter(F.col("data_type") == HOURLY).collect()}
    assert len(full) == 25 and full["2026-02-01~2026-02-28"].retries == 2
    assert full["2026-01-01~2026-01-31"].retries == 6
    tracked = chunks.tracked_state(calendar, known).filter(F.col("data_type") == HOURLY)
    assert tracked.count() == 24


def test_upsert_replaces_whole_rows(spark):
    old = state_of(spark, ("2025-05", 10, 744, 6), ("2025-06", 10, 720, 6)).withColumn(
        "date_min", F.timestamp_seconds(F.lit(5)))
    new = state_of(spark, ("2025-05", 20, 744, 5), ("2025-07", 0, 744, 6))
    got = {r.chunk_key[:7]: (r["values"], r.date_min is None)
           for r in chunks.chunk_state_upsert(old, new).collect()}
    assert got == {"2025-05": (20, True), "2025-06": (10, False), "2025-07": (0, True)}


def test_prune_flat_and_nested(spark):
    cutoff = "2026-02-01~2026-02-28"
    flat = state_of(spark, ("2026-01", 1, 1, 1), ("2026-02", 1, 1, 1), ("2026-03", 1, 1, 1))
    # An "xx" end sorts after a number, so February itself goes.
    assert [r.chunk_key[:7] for r in chunks.chunk_prune(flat, cutoff).collect()] == ["2026-01"]
    nested = spark.createDataFrame(
        [({"2026-01-01~2026-01-31": 1, cutoff: 2},)], "data_1h map<string,int>")
    assert chunks.chunk_prune_nested(nested, cutoff, ["data_1h"]).first().data_1h == {
        "2026-01-01~2026-01-31": 1}


def test_request_parameters_by_series(spark):
    supplies = spark.createDataFrame(
        [("c1", "u1", "n1", "2", 5, None)],
        "cups string, username string, authorized_nif string, distributorCode string, "
        "pointType int, validDateTo string")
    state = chunks.tracked_state(chunks.chunk_calendar(supplies, AS_OF),
                                 spark.createDataFrame([], CHUNK_STATE))
    plan = chunks.request_plan(state, supplies, AS_OF)
    first = {r.data_type: r for r in plan.orderBy("chunk_key").collect()[::-1]}
    hourly, quarterly, power = (first[n] for n in (HOURLY, QUARTERLY, POWER))
    assert (hourly.measurement_type, quarterly.measurement_type, power.measurement_type) == (
        "0", "1", None)
    assert (hourly.point_type, power.point_type) == ("5", None)
    assert (hourly.start_date, hourly.end_date) == ("2024-04-01", "2024-04-30")
    assert (power.endpoint, power.distributor_code, power.authorized_nif) == ("max_power", "2", "n1")


def test_month_request_window(spark):
    start, end = chunks.month_request_window(F.lit("2024-05-17").cast("date"))
    row = spark.range(1).select(start.alias("a"), end.alias("b")).first()
    assert (str(row.a), str(row.b)) == ("2024-05-01", "2024-05-31")


def test_chunks_need_a_session_in_utc(spark):
    import pytest
    supplies = spark.createDataFrame([("c", None)], "cups string, validDateTo string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        with pytest.raises(ValueError, match="Europe/Madrid"):
            chunks.chunk_calendar(supplies, AS_OF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_supplies_of_one_row_group_make_chunks_in_several_tasks(spark, tmp_path):
    spark.createDataFrame([(i, f"c{i}", 1, 100.0 * i, "BUILDING") for i in range(20)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
                          ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    several = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for made in (tables.calendar, tables.stored_state):
        assert made(spark, str(tmp_path)).rdd.getNumPartitions() == several
