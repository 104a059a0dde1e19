"""Calendar arithmetic. Local wall-clock time is `ZONE`; the session runs in UTC."""

from __future__ import annotations

from datetime import date, datetime, time
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

from meterspark.schemas import HISTORY_MONTHS, ZONE


def window_start(as_of: date) -> date:
    """First day of the history that is tracked: the month of `as_of` and 23 before it."""
    return shift_month(as_of.replace(day=1), -HISTORY_MONTHS)


def shift_month(first: date, months: int) -> date:
    at = first.year * 12 + first.month - 1 + months
    return date(at // 12, at % 12 + 1, 1)


def in_utc(df: DataFrame) -> DataFrame:
    """`df`, if its session's wall-clock arithmetic goes through UTC, which chunks of local months need."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"the session's time zone is {zone}; see session.configure")
    return df


def end_of_day(day: Column) -> Column:
    """Last second of a day as local wall-clock time."""
    return day.cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")


def local_epoch(wall: Column, zone: str = ZONE) -> Column:
    """Epoch seconds of a wall-clock time in `zone`."""
    return F.unix_seconds(F.to_utc_timestamp(wall.cast("timestamp"), zone))


def local_date(epoch: Column, zone: str = ZONE) -> Column:
    """Calendar day, in `zone`, of an instant given in epoch seconds."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_seconds(epoch), zone))


def expected_count(first: date, last: date, step_seconds: int | None, zone: str = ZONE) -> int:
    """`expected_elements` of a chunk known beforehand, from its first to its last day."""
    if step_seconds is None:
        return (last.year - first.year) * 12 + last.month - first.month + 1
    tz = ZoneInfo(zone)
    span = (datetime.combine(last, time(23, 59, 59), tz).timestamp()
            - datetime.combine(first, time(), tz).timestamp())
    return int(span // step_seconds) + 1


def expected_elements(ini: Column, end: Column, step_seconds: Column) -> Column:
    """Readings a complete chunk has; days of 23 and 25 hours count as such.

    A fixed step counts the steps between both instants; without a step there is one reading per
    month end inside the chunk.
    """
    span = local_epoch(end) - local_epoch(ini)
    months = F.months_between(F.last_day(end), F.last_day(ini))
    return F.when(step_seconds.isNull(), F.floor(months) + 1).otherwise(
        F.floor(span / step_seconds) + 1).cast("long")


def chunk_name(ini: Column, end: Column) -> Column:
    return F.concat_ws("~", F.date_format(ini, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
