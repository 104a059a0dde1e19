"""Streaming jobs. Each micro-batch goes through the same operators as a batch run.

Every batch writes to its own folder in overwrite mode, so that a batch repeated after a failure
replaces its earlier output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterspark.functions import keyed
from meterspark.functions.skew import last_by, spread
from meterspark.operators import graph, timeseries
from meterspark.operators.readings import audit_counters
from meterspark.streaming import envelopes as E


SENSOR = ["cups", "prop", "freq"]
SENSOR_RANGE = T.StructType([*[T.StructField(c, T.StringType()) for c in SENSOR],
                             T.StructField("first_ts", T.LongType()), T.StructField("last_ts", T.LongType())])
RANGE_SLOTS = 64


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
           trigger: dict | None, mode: str = "append") -> StreamingQuery:
    return (stream.writeStream.foreachBatch(handle).outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def start_harmonizer(messages: DataFrame, out: str, checkpoint: str, source: str,
                     static_topic: str,
                     on_supplies: Callable[[DataFrame], DataFrame] | None = None,
                     on_final: Callable[[SparkSession, DataFrame], None] | None = None,
                     trigger: dict | None = None) -> StreamingQuery:
    """Decode messages and harmonize them.

    Writes `points`, `coverage`, `quarantine` and `markers` below `out`, and `triples` when
    `on_supplies` turns supply records into triples. After a batch with end markers is written, the
    stream of `start_finalizer` takes them up, so a run is settled after all that came before its end;
    its state lies beside `checkpoint`. A failure in `on_final` fails the batch, which is then repeated.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # A landed file may be one row group, which one task would take apart.
        messages = spread(batch, "topic", "key", "value")
        decoded = E.decode_envelopes(messages, static_topic).persist(StorageLevel.MEMORY_AND_DISK)
        readings = E.message_readings(E.timeseries_select(decoded, source))
        timeseries.write_points(timeseries.harmonize_timeseries(readings),
                                f"{out}/points/batch_id={batch_id}", mode="overwrite")
        _write(timeseries.batch_coverage(readings), f"{out}/coverage", batch_id)
        _write(E.quarantine(decoded), f"{out}/quarantine", batch_id)
        if on_supplies:
            _write(on_supplies(E.static_records(decoded)), f"{out}/triples", batch_id)
        ends = E.markers(decoded)
        _write(ends, f"{out}/markers", batch_id)
        if on_final and not ends.isEmpty():
            start_finalizer(spark, out, f"{checkpoint}-runs", on_final, {"availableNow": True}).awaitTermination()
        decoded.unpersist()

    return _start(messages, handle, checkpoint, trigger)


def start_finalizer(spark: SparkSession, out: str, checkpoint: str,
                    on_final: Callable[[SparkSession, DataFrame], None],
                    trigger: dict | None = None) -> StreamingQuery:
    """Call `on_final` with the runs that ended: once per run, with the marker of its last partition.

    Reads the markers that a harmonizer has written below `out`, each file once. What was seen of a run
    is the state of this stream: a marker that came before is dropped, so the count of a run's markers
    reaches the number of its partitions just once, however late or often markers come. The runs that
    ended go to `runs`, for the record; nothing reads them here. A failure in `on_final` leads to a
    second call with the same runs.
    """
    markers = (spark.readStream.schema("run_id string, partition int, partitions int")
               .option("ignoreMissingFiles", True).parquet(f"{out}/markers"))
    seen = (markers.select("run_id", "partition", "partitions").dropDuplicates(["run_id", "partition"])
            .groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.max("partitions").alias("partitions")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        ended = batch.filter("n = partitions").select("run_id").persist(StorageLevel.MEMORY_AND_DISK)
        if ended.count():
            on_final(batch.sparkSession, ended)
            _write(ended, f"{out}/runs", batch_id)
        ended.unpersist()

    return _start(seen, handle, checkpoint, trigger, mode="update")


def start_coverage(readings: DataFrame, out: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Keep the range of every sensor as a table; see `start_ranges`."""
    return start_ranges(readings.withColumns({"first_ts": F.col("timestamp"), "last_ts": F.col("timestamp")}),
                        out, checkpoint, trigger)


def start_ranges(ranges: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Fold a stream of ranges (cups, prop, freq, first_ts, last_ts), such as those that a harmonizer
    logs below `coverage`, into a table of one row per sensor.

    The ranges so far are the state of the stream. A batch gives the whole range of each sensor that
    it widens or repeats, which replaces that sensor's row: just the slots of those sensors are rewritten,
    and no batch reads what earlier ones have logged. A repeated batch leaves the same rows.
    """
    keyed.create_keyed(ranges.sparkSession, out, SENSOR_RANGE)
    folded = ranges.groupBy(*SENSOR).agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist(StorageLevel.MEMORY_AND_DISK)
        keyed.update_keyed(batch.sparkSession, out, changed, SENSOR, slots=RANGE_SLOTS)
        changed.unpersist()

    return _start(folded, handle, checkpoint, trigger, mode="update")


def read_ranges(spark: SparkSession, out: str) -> DataFrame:
    """The table that `start_ranges` keeps."""
    return keyed.read_keyed(spark, out, SENSOR_RANGE).drop(keyed.SLOT)


def unique_readings(readings: DataFrame, delay: str) -> DataFrame:
    """A stream of readings without those delivered before.

    A reading is known by all its columns, so one that comes with another value is a new one, and stays (see
    `read_points`). What was delivered is remembered for `delay` of event time, the readings' instants,
    which bounds the state; readings older than the newest instant less `delay` are late, and left out.
    """
    return (readings.withColumn("_at", F.timestamp_seconds("timestamp")).withWatermark("_at", delay)
            .dropDuplicatesWithinWatermark(readings.columns).drop("_at"))


def start_unique(readings: DataFrame, out: str, checkpoint: str, delay: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Write a stream's readings to `out`, a folder per batch, without repeated and late ones. What is
    written is counted on the same pass; see `audits`."""
    kept = unique_readings(readings, delay).observe("ingest", *audit_counters())
    return _start(kept, lambda batch, batch_id: _write(batch, out, batch_id), checkpoint, trigger)


def audits(job: StreamingQuery) -> dict[int, dict]:
    """The counters of each batch with rows, by batch, over the batches whose progress Spark keeps."""
    return {p["batchId"]: p["observedMetrics"]["ingest"].asDict() for p in job.recentProgress
            if "ingest" in p["observedMetrics"] and p["observedMetrics"]["ingest"]["rows"]}


def late_rows(job: StreamingQuery) -> int:
    """How many rows a job has left out as late, over the batches whose progress Spark keeps
    (`spark.sql.streaming.numRecentProgressUpdates`)."""
    return sum(op["numRowsDroppedByWatermark"] for progress in job.recentProgress for op in progress["stateOperators"])


POINTS = ("hash string, start bigint, end bigint, value double, isReal boolean, batch_id bigint, "
          "property string, freq string, bucket bigint")
RANGES = "cups string, prop string, freq string, first_ts bigint, last_ts bigint, batch_id bigint"


def _written(spark: SparkSession, schema: str, path: str, folded: str | None, upto: int | None) -> DataFrame:
    """Rows of all batches: those up to `upto` out of what was folded, the later ones as written."""
    rows = spark.read.schema(schema).parquet(path)
    if upto is None:
        return rows
    before = spark.read.schema(schema).parquet(f"{folded}/upto={upto}")
    return before.unionByName(rows.filter(F.col("batch_id") > upto))


def read_coverage(spark: SparkSession, out: str, folded: str | None = None,
                  upto: int | None = None) -> DataFrame:
    return (_written(spark, RANGES, out, folded, upto).groupBy("cups", "prop", "freq")
            .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")))


def read_points(spark: SparkSession, points: str, folded: str | None = None,
                upto: int | None = None) -> DataFrame:
    """The points that a harmonizer has written: of readings delivered again in a later batch, the
    later one. Each task keeps one row per point before the shuffle."""
    return last_by(_written(spark, POINTS, points, folded, upto), ["hash", "start"],
                   ["batch_id"]).drop("batch_id")


def fold_points(spark: SparkSession, points: str, folded: str, upto: int, since: int | None = None) -> None:
    """Write the points of all batches up to `upto` as one table below `folded`.

    `since` is the batch up to which an earlier call folded: its table and the batches after it are
    read then. Once this has returned, `read_points(..., folded, upto)` gives the same points as
    before, the folders of those batches are no longer read, and they and the earlier table may go. A
    call that fails is repeated: it replaces what it left.
    """
    done = _written(spark, POINTS, points, folded, since).filter(F.col("batch_id") <= upto)
    timeseries.write_points(last_by(done, ["hash", "start"], ["batch_id"]), f"{folded}/upto={upto}", mode="overwrite")


def fold_coverage(spark: SparkSession, out: str, folded: str, upto: int, since: int | None = None) -> None:
    """The same for logged ranges: one row per sensor."""
    logged = _written(spark, RANGES, out, folded, since).filter(F.col("batch_id") <= upto)
    (logged.groupBy("cups", "prop", "freq")
     .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
          F.max("batch_id").alias("batch_id"))
     .write.mode("overwrite").parquet(f"{folded}/upto={upto}"))


def read_sensor_triples(spark: SparkSession, coverage: str) -> DataFrame:
    """Triples of all sensors whose ranges a harmonizer has logged."""
    sensors = timeseries.harmonized_only(read_coverage(spark, coverage))
    return graph.sensor_triples(timeseries.sensor_identity(sensors))


def kafka_messages(spark: SparkSession, servers: str, topics: list[str],
                   per_trigger: int = 1_000_000) -> DataFrame:
    """Messages from Kafka; the connector package has to be on the class path."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics)).option("maxOffsetsPerTrigger", per_trigger)
            .load()
            .select("topic", F.col("key").cast("string"), F.col("value").cast("string")))


def send(messages: DataFrame, servers: str) -> None:
    """Write messages (`topic, key, value`) to Kafka; needs the same package."""
    (messages.select("topic", "key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).save())


def file_messages(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Messages landed as parquet files of `topic, key, value`."""
    return (spark.readStream.schema("topic string, key string, value string")
            .option("maxFilesPerTrigger", files_per_trigger).parquet(path))
