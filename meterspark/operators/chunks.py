"""History chunks of a meter: calendar, coverage and the state that drives re-requests."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from meterspark.functions import clock
from meterspark.functions.skew import spread, upsert
from meterspark.schemas import CHUNK_KEY, CHUNK_STATE, RETRIES, SERIES, SeriesType


def history_end(valid_to: Column, as_of: date, strict_valid_to: bool = False) -> Column:
    """Last second of the month a supply's history ends in.

    A supply that ended (`yyyy/M/d` before this month's end) stops there; an unreadable or later
    date means it is still active. `strict_valid_to` reads only dates whose day has one digit, as
    older runs did.
    """
    month_end = F.last_day(F.lit(as_of))
    readable = valid_to
    if strict_valid_to:
        # Older runs cut the last two characters and read the rest as year/month, which only
        # works for a one-digit day.
        readable = F.when(valid_to.rlike(r"^\d{4}/\d{1,2}/\d$"), valid_to)
    ended = F.last_day(F.to_date(F.try_to_timestamp(readable, F.lit("yyyy/M/d"))))
    return clock.end_of_day(F.when(ended <= month_end, ended).otherwise(month_end))


def calendar_blocks(as_of: date, series: tuple[SeriesType, ...] = SERIES) -> Column:
    """Every chunk of the tracked history, 52 for all series, as one constant array."""
    stop = clock.shift_month(as_of.replace(day=1), 1)
    blocks = []
    for s in series:
        start = clock.window_start(as_of)
        while start < stop:
            after = clock.shift_month(start, s.months)
            end = after - timedelta(days=1)
            blocks.append(
                f"named_struct('data_type', '{s.name}', 'chunk_key', '{start}~{end}', "
                f"'date_ini', timestamp_ntz'{start} 00:00:00', "
                f"'date_end', timestamp_ntz'{end} 23:59:59', "
                f"'total', {clock.expected_count(start, end, s.step_seconds)}L)")
            start = after
    return F.expr(f"array({', '.join(blocks)})")


def chunk_calendar(supplies: DataFrame, as_of: date, strict_valid_to: bool = False,
                   series: tuple[SeriesType, ...] = SERIES,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """The chunks each supply (`cups`, `validDateTo`) should have. No shuffle. `keep` carries
    columns of the supply along.

    Supplies partitioned by `cups` give a calendar partitioned by `cups`, so that what follows
    can join on it without moving the calendar's many rows (see `by_meter`).
    """
    end = history_end(F.col("validDateTo"), as_of, strict_valid_to)
    # The end of the history is computed before, not along with, the explosion into chunks.
    return (clock.in_utc(supplies)
            .select("cups", *keep, end.alias("history_end"))
            .withColumn("c", F.explode(calendar_blocks(as_of, series)))
            .filter(F.col("c.date_ini") < F.col("history_end"))
            .select("cups", *keep, "c.*"))


def by_meter(df: DataFrame) -> DataFrame:
    """Partition by meter. Chunk tables hold at most 52 rows per meter, so this is even, and all
    joins between them, on the chunk or on the meter, then share one shuffle per table.

    The number of partitions is the session's, given outright: adaptive execution would size
    them by the supplies moved, which turn into 52 times as many chunks afterwards. Rows that are
    grouped by meter are partitioned before: Spark leaves out a repartitioning that an
    aggregation's own shuffle makes needless, and sizes that one by what is moved.
    """
    return spread(df, "cups")


def chunk_observed(readings: DataFrame, as_of: date,
                   series: tuple[SeriesType, ...] = SERIES) -> DataFrame:
    """Readings seen per chunk, with the first and last instant.

    A reading's chunk follows from its local month, so there is no range join; readings before
    the tracked history are left out. Counts combine before the shuffle, so that a meter with a
    large share of all readings brings a few rows per task. Names are made per chunk, not per
    reading.
    """
    first = F.lit(clock.window_start(as_of))
    months, tracked = F.lit(1), F.lit(False)
    for s in series:
        of_series = (F.col("prop") == s.prop) & (F.col("freq") == s.freq)
        tracked = tracked | of_series
        if s.months > 1:
            months = F.when(of_series, F.lit(s.months)).otherwise(months)
    since = F.months_between("month", first).cast("int")
    ini = F.when(months == 1, F.col("month")).otherwise(
        F.add_months(first, since - since % months))
    return (clock.in_utc(readings)
            .filter(tracked)
            .select("cups", "prop", "freq", "timestamp",
                    F.trunc(clock.local_date(F.col("timestamp")), "month").alias("month"))
            .filter(F.col("month") >= first)
            .groupBy("cups", "prop", "freq", ini.alias("ini"))
            .agg(F.count(F.lit(1)).alias("observed"), F.min("timestamp").alias("first_ts"),
                 F.max("timestamp").alias("last_ts"))
            .select("cups", F.concat_ws("_", "prop", "freq").alias("data_type"),
                    clock.chunk_name(F.col("ini"), F.last_day(F.add_months("ini", months - 1)))
                    .alias("chunk_key"),
                    "observed", "first_ts", "last_ts"))


def chunk_coverage(calendar: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected against observed readings of every chunk in the calendar."""
    return (calendar.join(observed, CHUNK_KEY, "left")
            .withColumn("observed", F.coalesce("observed", F.lit(0)))
            .withColumn("missing", F.greatest(F.col("total") - F.col("observed"), F.lit(0)))
            .withColumn("complete", F.col("observed") >= F.col("total")))


def _as_new(calendar: DataFrame) -> DataFrame:
    """Chunks of the calendar in their first state."""
    return calendar.select(
        *CHUNK_KEY, "date_ini", "date_end", F.lit(0).cast("long").alias("values"), "total",
        F.lit(RETRIES).alias("retries"), F.lit(None).cast("timestamp").alias("date_min"),
        F.lit(None).cast("timestamp").alias("date_max"))


def _packed(state: DataFrame, name: str) -> DataFrame:
    return state.select(*CHUNK_KEY, F.struct(
        *[f.name for f in CHUNK_STATE if f.name not in CHUNK_KEY]).alias(name))


def chunk_state_init(calendar: DataFrame, state: DataFrame) -> DataFrame:
    """All chunks on record, also those older than the calendar, plus the calendar's chunks not
    yet known, as new."""
    return (_packed(state, "known").join(_packed(_as_new(calendar), "new"), CHUNK_KEY, "full")
            .select(*CHUNK_KEY, F.coalesce("known", "new").alias("row"))
            .select(*CHUNK_KEY, "row.*"))


def tracked_state(calendar: DataFrame, state: DataFrame) -> DataFrame:
    """The calendar's chunks with their state; all that a run needs. Unlike the full table, it
    stays partitioned as the calendar is. State has up to 52 rows per meter, more than an
    estimate before the join may say, so it is merged and never broadcast."""
    known = _packed(state, "known").hint("merge")
    return (_packed(_as_new(calendar), "new").join(known, CHUNK_KEY, "left")
            .select(*CHUNK_KEY, F.coalesce("known", "new").alias("row"))
            .select(*CHUNK_KEY, "row.*"))


def to_request(as_of: date) -> Column:
    """A chunk still worth asking for: incomplete, retries left, younger than the window start.

    The comparison is strict, so the oldest chunk of the window is never asked for.
    """
    first = F.lit(clock.window_start(as_of)).cast("timestamp_ntz")
    return ((F.col("values") < F.col("total")) & (F.col("retries") > 0)
            & (F.col("date_ini") > first))


def incomplete_chunks(state: DataFrame, as_of: date) -> DataFrame:
    return state.filter(to_request(as_of))


def request_plan(state: DataFrame, supplies: DataFrame, as_of: date,
                 series: tuple[SeriesType, ...] = SERIES) -> DataFrame:
    """One row per request, holding just the parameters its series type takes."""
    wanted = F.lit(None).cast("array<string>")
    endpoint = measurement = F.lit(None).cast("string")
    for s in series:
        of_type = F.col("data_type") == s.name
        wanted = F.when(of_type, F.array(*map(F.lit, s.params))).otherwise(wanted)
        endpoint = F.when(of_type, F.lit(s.endpoint)).otherwise(endpoint)
        measurement = F.when(of_type, F.lit(s.measurement_type)).otherwise(measurement)
    values = {
        "distributor_code": F.col("distributorCode"),
        "start_date": F.to_date("date_ini").cast("string"),
        "end_date": F.to_date("date_end").cast("string"),
        "measurement_type": measurement,
        "point_type": F.col("pointType").cast("string"),
        "authorized_nif": F.col("authorized_nif"),
    }
    who = supplies.select("cups", "username", "authorized_nif", "distributorCode", "pointType")
    return (incomplete_chunks(state, as_of)
            .select("cups", "data_type", "chunk_key", "date_ini", "date_end")
            .join(who, "cups")
            .withColumn("params", wanted)
            .select("username", "cups", "data_type", "chunk_key", endpoint.alias("endpoint"),
                    *[F.when(F.array_contains("params", p), v).alias(p)
                      for p, v in values.items()]))


def retry_state(state: DataFrame, observed: DataFrame, as_of: date) -> DataFrame:
    """State after one round of requests.

    An attempted chunk takes over the observed count and, when anything came, its range; a count
    that did not change costs one retry. Chunks not attempted stay as they are.
    """
    attempted, seen = F.col("attempted"), F.col("seen")
    return (state.join(observed, CHUNK_KEY, "left")
            .withColumn("attempted", to_request(as_of))
            .withColumn("seen", F.coalesce("observed", F.lit(0)))
            .select(
                *CHUNK_KEY, "date_ini", "date_end",
                F.when(attempted, seen).otherwise(F.col("values")).alias("values"), "total",
                F.when(attempted & (seen == F.col("values")), F.col("retries") - 1)
                .otherwise(F.col("retries")).cast("int").alias("retries"),
                F.when(attempted & (seen > 0), F.timestamp_seconds("first_ts"))
                .otherwise(F.col("date_min")).alias("date_min"),
                F.when(attempted & (seen > 0), F.timestamp_seconds("last_ts"))
                .otherwise(F.col("date_max")).alias("date_max")))


def chunk_state_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Replace whole rows by key: a null in the new row is a null, not a gap to fill."""
    return upsert(old, new, CHUNK_KEY)


def chunk_prune(state: DataFrame, cutoff_key: str) -> DataFrame:
    """Forget chunks from `cutoff_key` on (keys compare as text), so they are asked for anew."""
    return state.filter(F.col("chunk_key") < cutoff_key)


def chunk_prune_nested(documents: DataFrame, cutoff_key: str, columns: list[str]) -> DataFrame:
    """The same for documents holding one map of chunks per series."""
    return documents.withColumns({
        c: F.map_filter(c, lambda key, _: key < F.lit(cutoff_key)) for c in columns})


def supply_measurements(state: DataFrame, as_of: date,
                        series: tuple[SeriesType, ...] = SERIES) -> DataFrame:
    """The (property, freq) pairs attempted per supply, with or without readings."""
    name = F.split("data_type", "_")
    return (incomplete_chunks(state, as_of)
            .groupBy("cups")
            .agg(F.sort_array(F.collect_set(F.struct(
                name[0].alias("property"), name[1].alias("freq")))).alias("measurements")))


def month_request_window(day: Column) -> tuple[Column, Column]:
    """First and last day of the month a request covers."""
    return F.trunc(day, "month"), F.last_day(day)
