"""Keyed JSON messages: writing, decoding and sorting them by kind."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from meterspark import vocabulary as V
from meterspark.schemas import ENVELOPE, HARMONIZED, POWER_FIELDS, READING, SUPPLY
from meterspark.sources.subscriptions import SourceSpec

SLICE_SECONDS = 86_400
_RAW = ["topic", "key", "value"]


def _message(topic: Column, key: Column, **fields: Column) -> list[Column]:
    body = F.struct(*[c.alias(n) for n, c in fields.items()])
    return [topic.alias("topic"), key.alias("key"), F.to_json(body).alias("value")]


def _by_source(specs: list[SourceSpec], value: Callable[[SourceSpec], Column]) -> Column:
    """The value belonging to the row's `source`."""
    out = F.lit(None)
    for spec in specs:
        out = F.when(F.col("source") == spec.source, value(spec)).otherwise(out)
    return out


def _row_keys(spec: SourceSpec) -> Column:
    return F.array(*[F.array(*map(F.lit, k)) for k in spec.row_keys])


def _tables(spec: SourceSpec) -> Column:
    """A source's table names, with the row's series put in."""
    return F.array(*[
        F.replace(F.replace(F.lit(t), F.lit("{prop}"), F.col("prop")), F.lit("{freq}"),
                  F.col("freq")) for t in spec.tables])


def publish_envelopes(readings: DataFrame, specs: list[SourceSpec],
                      run_id: str = "") -> DataFrame:
    """Messages for every source: the readings of a meter, series and day, keyed by meter.

    `readings` holds in `sources` the names of those that want the row. Sources that prepare
    readings in the same way share one pass; their messages differ in the envelope alone.
    Readings are unique per meter, series and instant (see `latest_readings`; maximum power has a few
    tariff periods per instant, see `power_messages`), so a message has a bounded size however large the meter's share of all rows is.
    """
    alike: dict[Callable, list[SourceSpec]] = {}
    for spec in specs:
        alike.setdefault(spec.prepare, []).append(spec)
    return reduce(DataFrame.unionByName, [
        _publish(readings.transform(prepare), group, run_id) for prepare, group in alike.items()])


def _publish(prepared: DataFrame, specs: list[SourceSpec], run_id: str) -> DataFrame:
    record = F.struct(*[c for c in (*READING.fieldNames(), *POWER_FIELDS) if c in prepared.columns])
    takers = F.array_intersect("sources", F.array(*[F.lit(s.source) for s in specs]))
    return (prepared
            .withColumn("sources", takers)
            .filter(F.size("sources") > 0)
            .groupBy("cups", "prop", "freq", "sources",
                     F.floor(F.col("timestamp") / SLICE_SECONDS).alias("slice"))
            .agg(F.sort_array(F.collect_list(F.struct("timestamp", record.alias("r"))))
                 .alias("rows"))
            .withColumn("source", F.explode("sources"))
            .select(*_message(
                _by_source(specs, lambda s: F.lit(s.topic)), F.col("cups"),
                data=F.col("rows.r"), tables=_by_source(specs, _tables),
                row_keys=_by_source(specs, _row_keys),
                kwargs=F.struct(
                    F.lit("timeseries").alias("collection_type"), F.col("prop").alias("property"),
                    "freq", F.array("source").alias("dblist"), F.lit(run_id).alias("run_id")))))


def publish_envelope(readings: DataFrame, spec: SourceSpec, run_id: str = "") -> DataFrame:
    """The messages of one source that wants all of `readings`."""
    return publish_envelopes(
        readings.withColumn("sources", F.array(F.lit(spec.source))), [spec], run_id)


def publish_points(points: DataFrame, topic: str) -> DataFrame:
    """Harmonized points as messages, one each, keyed by the series they belong to."""
    return points.select(*_message(
        F.lit(topic), F.col("hash"),
        **{c: F.col(c) for c in ("start", "end", "value", "isReal", "hash")}))


def publish_static(supplies: DataFrame, topic: str, run_id: str = "", specs: list[SourceSpec] = ()) -> DataFrame:
    """One message per supply record, for all its sources (`db_list`) at once; with the row keys of each,
    by source, of those that `specs` knows."""
    record = F.struct(*[f.name for f in SUPPLY if f.name in supplies.columns])
    return supplies.select(*_message(
        F.lit(topic), F.col("cups"), data=record, tables=F.array(F.lit("")),
        **({"row_keys": F.map_filter(F.create_map(*[c for s in specs for c in (F.lit(s.source), _row_keys(s))]),
                                     lambda source, _: F.array_contains("db_list", source))} if specs else {}),
        kwargs=F.struct(F.lit("supplies").alias("collection_type"),
                        F.col("db_list").alias("dblist"), F.lit(run_id).alias("run_id"))))


def final_markers(runs: DataFrame, topic: str, partitions: int = 1) -> DataFrame:
    """The end-of-run messages of every run in `runs` (`run_id`): one for each partition of the
    topic, keyed by it, which says how many there are."""
    each = F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))).alias("partition")
    return runs.select("run_id", each).select(*_message(
        F.lit(topic), F.col("partition").cast("string"),
        kwargs=F.struct(F.lit(V.FINAL_MESSAGE).alias("collection_type"), "run_id", "partition",
                        F.lit(partitions).alias("partitions"))))


def parsed(data: Column, layout: T.StructType) -> Column:
    """`data` as the fields of `layout`, with `_bad` set where it is no JSON object or a field has another
    type (see `is_good`)."""
    marked = T.StructType([*layout.fields, T.StructField("_bad", T.StringType())])
    return F.from_json(data, marked, {"columnNameOfCorruptRecord": "_bad"})


def is_good(data: Column, fields: Column) -> Column:
    return F.coalesce(F.startswith(F.ltrim(data), F.lit("{")) & fields["_bad"].isNull(), F.lit(False))


def fits(data: Column, layout: T.StructType) -> Column:
    """Whether `data` is a JSON object whose fields have the types that `layout` gives them."""
    return is_good(data, parsed(data, layout))


def _readings_fit(data: Column) -> Column:
    items = F.from_json(data, "array<string>")
    return F.coalesce(F.forall(items, lambda item: fits(item, READING)), F.lit(False))


def decode_envelopes(raw: DataFrame, static_topic: str) -> DataFrame:
    """Parse messages (`topic, key, value`) and name the kind of each.

    Kinds: `final` and `static` on the static topic, `timeseries` on others, `malformed` for text
    that is not a JSON object, for static records without data, and for data that is not what its
    kind holds (see `quarantine`). Empty messages are dropped.
    """
    parsed = F.from_json("value", ENVELOPE, {"mode": "PERMISSIVE",
                                             "columnNameOfCorruptRecord": "_bad"})
    is_static = F.col("topic") == static_topic
    is_final = F.col("e.kwargs.collection_type").eqNullSafe(V.FINAL_MESSAGE)
    kind = (F.when(F.col("e._bad").isNotNull(), "malformed")
            .when(is_static & is_final, "final")
            .when(is_static & F.col("e.data").isNull(), "malformed")
            .when(is_static, F.when(fits(F.col("e.data"), SUPPLY), "static").otherwise("malformed"))
            .when(F.col("e.data").isNotNull() & ~_readings_fit(F.col("e.data")), "malformed")
            .otherwise("timeseries"))
    return (raw.filter(F.col("value").isNotNull())
            .withColumn("e", parsed)
            .select(*_RAW, kind.alias("kind"), "e.data", "e.tables", "e.row_keys", "e.kwargs"))


def quarantine(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("kind") == "malformed").select(*_RAW)


def markers(decoded: DataFrame) -> DataFrame:
    """End markers, `(run_id, partition, partitions)`; one without partitions stands for all."""
    return (decoded.filter(F.col("kind") == "final")
            .select(F.coalesce("kwargs.run_id", F.lit("")).alias("run_id"),
                    F.coalesce("kwargs.partition", F.lit(0)).alias("partition"),
                    F.coalesce("kwargs.partitions", F.lit(1)).alias("partitions")).distinct())


def static_records(decoded: DataFrame) -> DataFrame:
    """Supply records of all static messages; they are not filtered by source."""
    return (decoded.filter(F.col("kind") == "static")
            .select(F.from_json("data", SUPPLY).alias("r")).select("r.*"))


def timeseries_select(decoded: DataFrame, source: str,
                      properties: tuple[str, ...] | None = None) -> DataFrame:
    """Time-series messages meant for `source`, of the properties that are harmonized."""
    allowed = properties or tuple(sorted({s.prop for s in HARMONIZED}))
    return decoded.filter(
        (F.col("kind") == "timeseries")
        & F.array_contains(F.coalesce("kwargs.dblist", F.array().cast("array<string>")), source)
        & F.col("kwargs.property").isin(*allowed))


def message_readings(selected: DataFrame) -> DataFrame:
    """The readings inside time-series messages, tagged by the message's series."""
    return (selected
            .select(F.explode(F.from_json("data", T.ArrayType(READING))).alias("r"),
                    F.col("kwargs.property").alias("prop"), F.col("kwargs.freq").alias("freq"))
            .select("r.cups", "r.timestamp", "r.datetime", "r.consumptionKWh", "r.obtainMethod",
                    "freq", "prop"))
