import hashlib
from datetime import datetime, timezone

from pyspark.sql import functions as F

from meterspark.operators import readings as R, timeseries as TS
from meterspark.schemas import CONSUMPTION, READING
from meterspark.sources import landing

PROP = "EnergyConsumptionGridElectricity"
IDENTITY = "273aa2702b032abd9fc2abe80c140cb227d40aca95ac32da6692738edb965901"


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def reading(spark, *rows):
    """Rows of (cups, timestamp, kWh, method, freq, prop)."""
    return spark.createDataFrame(
        [(c, t, None, k, m, f, p) for c, t, k, m, f, p in rows], READING)


def test_parse_consumption(spark):
    raw = spark.createDataFrame([("c1", utc("2024-01-01T00:00:00"), 1.5, "Real")], CONSUMPTION)
    row = R.parse_consumption(raw, PROP, "PT1H").first()
    assert (row.timestamp, row.prop, row.freq) == (1704067200, PROP, "PT1H")


def test_readings_without_instant_are_set_apart(spark):
    raw = spark.createDataFrame([("c1", None, 1.0, "Real"), ("c1", utc("2024-01-01T00:00:00"),
                                                            1.0, "Real")], CONSUMPTION)
    assert R.rejected_readings(raw).count() == 1


def test_max_power_drops_empty_periods(spark):
    at = utc("2024-01-01T00:00:00")
    wide = spark.createDataFrame(
        [("c1", at, at, 3.5, None, 9.9)],
        "cups_period_ string, datetime timestamp, datetime_period_1 timestamp, "
        "maxPower_period_1 double, datetime_period_2 timestamp, maxPower_period_2 double")
    rows = R.max_power_long(wide).collect()
    assert [tuple(r) for r in rows] == [("c1", 1704067200, 1, 1704067200, 3.5)]


def test_power_rows_count_once_per_delivery(spark):
    at = utc("2024-01-01T00:00:00")
    wide = spark.createDataFrame([("c1", at, at, 3.5, at, 9.9)],
        "cups_period_ string, datetime timestamp, datetime_period_1 timestamp, "
        "maxPower_period_1 double, datetime_period_2 timestamp, maxPower_period_2 double")
    assert [tuple(r) for r in R.power_readings(wide).collect()] == [
        ("c1", 1704067200, "Power", "P1M")]


def test_max_power_takes_any_number_of_periods(spark):
    at = utc("2024-01-01T00:00:00")
    names = "".join(f", datetime_period_{n} timestamp, maxPower_period_{n} double"
                    for n in (1, 2, 6))
    wide = spark.createDataFrame([("c1", at, at, 1.0, at, 2.0, at, 6.0)],
                                 "cups_period_ string, datetime timestamp" + names)
    assert sorted((r.period, r.max_power) for r in R.max_power_long(wide).collect()) == [
        (1, 1.0), (2, 2.0), (6, 6.0)]


def test_redelivered_reading_overwrites(spark):
    rows = spark.createDataFrame(
        [("c", PROP, "PT1H", 1, 1.0, 1), ("c", PROP, "PT1H", 1, 2.0, 2), ("c", PROP, "PT1H", 2, 3.0, 1)],
        "cups string, prop string, freq string, timestamp long, v double, seq long")
    assert sorted(r.v for r in R.latest_readings(rows, ["seq"]).collect()) == [2.0, 3.0]


def test_harmonized_point(spark):
    df = reading(spark, ("ES1", 1704067200, 1.5, "Real", "PT1H", PROP),
                 ("ES1", 1704067200, 0.5, "Estimated", "PT15M", PROP))
    hour, quarter = sorted(TS.harmonize_timeseries(df).collect(), key=lambda r: -r.end)
    assert (hour.bucket, hour.start, hour.end, hour.value, hour.isReal, hour.hash) == (
        10, 1704067200, 1704070799, 1.5, True, IDENTITY)
    assert (quarter.end, quarter.isReal) == (1704068099, False)
    old = TS.harmonize_timeseries(df, constant_is_real=True).collect()
    assert {r.isReal for r in old} == {"True"}


def test_bucket_floors_before_1970(spark):
    df = spark.createDataFrame([(-1,), (0,), (199_999_999,), (200_000_000,)], "t long")
    assert [r.b for r in df.select(TS.bucket(F.col("t")).alias("b")).collect()] == [19, 0, 19, 0]


def test_sensor_identity(spark):
    row = TS.sensor_identity(spark.createDataFrame(
        [("ES1", PROP, "PT1H")], "cups string, prop string, freq string")).first()
    assert row.hash == IDENTITY == hashlib.sha256(row.sensor_uri.encode()).hexdigest()


def test_power_and_empty_input_give_no_points(spark):
    assert TS.harmonize_timeseries(reading(spark, ("c", 1, 1.0, "Real", "P1M", "Power"))).count() == 0
    assert TS.harmonize_timeseries(reading(spark)).count() == 0


def test_coverage_widens_the_stored_range(spark):
    df = reading(spark, ("c", 1000, 1.0, "Real", "PT1H", PROP), ("c", 5000, 1.0, "Real", "PT1H", PROP),
                 ("d", 7, 1.0, "Real", "PT1H", PROP))
    uri = TS.sensor_uri(F.lit("c"), F.lit(PROP), F.lit("PT1H"))
    stored = spark.range(1).select(uri.alias("uri"), F.timestamp_seconds(F.lit(2000)).alias("timeSeriesStart"),
                                   F.timestamp_seconds(F.lit(9000)).alias("timeSeriesEnd"))
    got = {r.cups: (r.first_ts, r.last_ts) for r in TS.sensor_coverage(df, stored).collect()}
    assert got == {"c": (1000, 9000), "d": (7, 7)}


def test_points_are_written_by_bucket(spark, tmp_path):
    df = reading(spark, *[("c", t, 1.0, "Real", "PT1H", PROP) for t in (0, 10_000_000, 20_000_000)])
    TS.write_points(TS.harmonize_timeseries(df), str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert sorted(r.bucket for r in back.collect()) == [0, 1, 2]
    assert (tmp_path / "p" / f"property={PROP}" / "freq=PT1H" / "bucket=1").is_dir()


def test_requested_readings_prunes_and_bounds(spark, tmp_path):
    path = str(tmp_path / "landing")
    hours = [1706738400, 1706742000, 1709247600, 1709247599]  # 31 Jan 23h, 1 Feb 0h, 1 Mar 0h local
    landing.write_readings(reading(
        spark, *[("c", t, 1.0, "Real", "PT1H", PROP) for t in hours],
        ("d", hours[1], 1.0, "Real", "PT1H", PROP)).drop("datetime"), path)
    requests = spark.createDataFrame(
        [("c", f"{PROP}_PT1H", "2024-02-01", "2024-02-29")],
        "cups string, data_type string, start_date string, end_date string")
    got = landing.requested_readings(spark.read.parquet(path), requests)
    assert sorted(r.timestamp for r in got.collect()) == [1706742000, 1709247599]
