"""Projects that subscribe to meter data."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

log = logging.getLogger(__name__)

USER_COLUMNS = ["seq", "username", "authorized_nif", "self", "cups"]


def identity(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class SourceSpec:
    """A project: who it reads for (`load`), where its rows go and how they are prepared.

    `load` returns `seq, username, authorized_nif, self, cups`; `cups` null asks for every supply.
    Credentials are not part of it and never enter a table. `tables` may hold `{prop}` and `{freq}`.
    """

    source: str
    load: Callable[[SparkSession], DataFrame]
    topic: str = ""
    tables: tuple[str, ...] = ("raw_ts_{prop}_{freq}",)
    row_keys: tuple[tuple[str, ...], ...] = (("cups", "timestamp"),)
    prepare: Callable[[DataFrame], DataFrame] = identity

    def table_names(self, prop: str, freq: str) -> list[str]:
        return [t.format(prop=prop, freq=freq) for t in self.tables]


def subscription_scan(nodes: DataFrame) -> DataFrame:
    """The columns of a user node table that are needed; its password is never read."""
    return nodes.select(*USER_COLUMNS)


def sources_union(spark: SparkSession, specs: Iterable[SourceSpec],
                  skip_failing: bool = False) -> DataFrame:
    """Users of every source, tagged with the source and where its rows go.

    A source that cannot be read ends the run; with `skip_failing` it is logged and left out, which
    means fewer subscribers. `seq` keeps the order of sources, then that of their users.
    """
    frames = []
    for position, spec in enumerate(specs):
        try:
            users = spec.load(spark)
            frames.append(users.select(
                F.struct(F.lit(position).alias("source_seq"), "seq").alias("seq"),
                F.lit(spec.source).alias("source"),
                *[c for c in USER_COLUMNS if c != "seq"],
                F.array(*map(F.lit, spec.tables)).alias("tables"),
                F.array(*[F.array(*map(F.lit, k)) for k in spec.row_keys]).alias("row_keys")))
        except PySparkException:
            if not skip_failing:
                raise
            log.exception("source %s cannot be read", spec.source)
    if not frames:
        raise ValueError("no source could be read")
    return reduce(DataFrame.unionByName, frames)


def plugin_transform(readings: DataFrame, specs: Iterable[SourceSpec]) -> dict[str, DataFrame]:
    """Readings as each source wants them; every transform starts from the original rows."""
    return {s.source: readings.transform(s.prepare) for s in specs}
