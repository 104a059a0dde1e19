"""Messages and streaming jobs over events. Streams run on all data available, then stop."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterspark.catalog import tables as t
from meterspark.catalog.readings import HARMONIZED_SQL, POINTS, URI_SQL
from meterspark.catalog.registry import query, table
from meterspark.operators import readings as R, timeseries as TS
from meterspark.session import shared_dir
from meterspark.sources.subscriptions import SourceSpec
from meterspark.streaming import envelopes as E, jobs

STATIC = "static"
SPEC = SourceSpec("alpha", lambda spark: None, topic="alpha.readings")
NOW = {"availableNow": True}


def _unique(spark, sf_dir):
    return R.latest_readings(t.readings(spark, sf_dir).withColumn(
        "datetime", F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss")), ["seq"])


UNIQUE = t.READINGS + """,
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cups, prop, freq, "timestamp"
                                              ORDER BY seq DESC) AS rn FROM readings) WHERE rn = 1)"""


@query(f"""WITH {UNIQUE}
SELECT 'alpha.readings' AS topic, cups AS key, prop AS property, freq, 'alpha' AS dblist,
  '["raw_ts_' || prop || '_' || freq || '"]' AS tables, '[["cups","timestamp"]]' AS row_keys,
  string_agg("timestamp", ',' ORDER BY "timestamp") AS times, count(*) AS n
FROM latest GROUP BY cups, prop, freq, "timestamp" // 86400""")
def publish_envelope(spark, sf_dir):
    """The messages, taken apart again so that their content can be compared."""
    sent = E.decode_envelopes(E.publish_envelope(_unique(spark, sf_dir), SPEC), STATIC)
    times = F.from_json("data", "array<struct<timestamp:bigint>>")["timestamp"]
    return sent.select("topic", "key", F.col("kwargs.property").alias("property"),
                       F.col("kwargs.freq").alias("freq"),
                       F.array_join("kwargs.dblist", ",").alias("dblist"),
                       "tables", "row_keys",
                       F.array_join(times.cast("array<string>"), ",").alias("times"),
                       F.size(times).cast("long").alias("n"))


@query(f"""WITH {t.READINGS}
SELECT 'points' AS topic, hash AS key, "start", "end", value, "isReal" FROM ({POINTS})""")
def publish_points(spark, sf_dir):
    """Points as messages, taken apart again."""
    sent = E.publish_points(TS.harmonize_timeseries(t.readings(spark, sf_dir)), "points")
    body = F.from_json("value", "start bigint, end bigint, value double, isReal boolean")
    return sent.select("topic", "key", body.alias("b")).select("topic", "key", "b.*")


@query("""SELECT 'static' AS topic, CAST(c_custkey AS VARCHAR) AS key, c_name AS address,
  CASE WHEN c_acctbal > 0 THEN 'alpha,beta' ELSE 'beta' END AS dblist, 'supplies' AS collection_type,
  CASE WHEN c_acctbal > 0 THEN '{"alpha":[["cups","timestamp"]]}' ELSE '{}' END AS row_keys
FROM customer""")
def publish_static(spark, sf_dir):
    """Supply records as messages for several sources at once, taken apart again."""
    records = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("cups"), F.col("c_name").alias("address"),
        F.when(F.col("c_acctbal") > 0, F.array(F.lit("alpha"), F.lit("beta")))
        .otherwise(F.array(F.lit("beta"))).alias("db_list"))
    decoded = E.decode_envelopes(E.publish_static(records, STATIC, specs=[SPEC]), STATIC)
    return decoded.select("topic", "key", F.get_json_object("data", "$.address").alias("address"),
                          F.array_join("kwargs.dblist", ",").alias("dblist"),
                          F.col("kwargs.collection_type").alias("collection_type"), "row_keys")


def _messages(spark, sf_dir):
    """One message per event: views are static records, sign-ups end the day's run, errors are
    cut off, purchases go to another source, clicks are readings."""
    kind = F.col("event_type")
    reading = F.array(F.struct(
        F.col("user_id").cast("string").alias("cups"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("value").alias("consumptionKWh"), F.lit("Real").alias("obtainMethod")))
    run = F.date_format("ts", "yyyy-MM-dd")
    series = F.struct(F.lit("timeseries").alias("collection_type"),
                      F.lit(t.CONSUMPTION).alias("property"), F.lit("PT1H").alias("freq"),
                      F.array(F.when(kind == "purchase", "beta").otherwise("alpha"))
                      .alias("dblist"))
    value = (F.when(kind == "view", F.to_json(F.struct(
                F.struct(F.col("user_id").cast("string").alias("cups"),
                         F.col("props").alias("address")).alias("data"),
                F.struct(F.lit("supplies").alias("collection_type")).alias("kwargs"))))
             .when(kind == "signup", F.to_json(F.struct(F.struct(
                 F.lit("FINAL_MESSAGE").alias("collection_type"), run.alias("run_id"))
                 .alias("kwargs"))))
             .when(kind == "error", F.concat(F.lit('{"data": ['), "event_id"))
             .otherwise(F.to_json(F.struct(reading.alias("data"), series.alias("kwargs")))))
    topic = F.when(kind.isin("view", "signup"), STATIC).otherwise("alpha.readings")
    return table(spark, sf_dir, "events").select(
        topic.alias("topic"), F.col("event_id").cast("string").alias("key"), value.alias("value"))


@query("""SELECT CAST(event_id AS VARCHAR) AS key,
  CASE event_type WHEN 'view' THEN 'static' WHEN 'signup' THEN 'final' WHEN 'error' THEN 'malformed'
       ELSE 'timeseries' END AS kind,
  CASE WHEN event_type IN ('view', 'click', 'purchase') THEN CAST(user_id AS VARCHAR) ELSE '-' END AS cups,
  CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d') ELSE '-' END AS run_id
FROM events""")
def decode_envelopes(spark, sf_dir):
    decoded = E.decode_envelopes(_messages(spark, sf_dir), STATIC)
    cups = F.coalesce(F.get_json_object("data", "$.cups"), F.get_json_object("data", "$[0].cups"),
                      F.lit("-"))
    return decoded.select(
        "key", "kind", F.when(F.col("kind") == "malformed", "-").otherwise(cups).alias("cups"),
        F.coalesce("kwargs.run_id", F.lit("-")).alias("run_id"))


@query("""SELECT CAST(event_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS cups,
  epoch_us(ts) // 1000000 AS "timestamp", value FROM events WHERE event_type = 'click'""")
def timeseries_select(spark, sf_dir):
    selected = E.timeseries_select(E.decode_envelopes(_messages(spark, sf_dir), STATIC), "alpha")
    reading = F.from_json(
        "data", "array<struct<cups:string,timestamp:bigint,consumptionKWh:double>>")[0]
    return selected.withColumn("r", reading).select(
        "key", "r.cups", "r.timestamp", F.col("r.consumptionKWh").alias("value"))


def _drain(spark, messages, name, files_per_trigger=1000, **handlers):
    """Run the harmonizer over all messages; the folder it wrote to."""
    landed, out, state = (shared_dir(spark, f"{name}-{part}") for part in ("in", "out", "state"))
    messages.write.parquet(landed)
    job = jobs.start_harmonizer(jobs.file_messages(spark, landed, files_per_trigger), out, state,
                                SPEC.source, STATIC, trigger=NOW, **handlers)
    job.awaitTermination()
    return out


@query(f"WITH {UNIQUE} {POINTS.replace('FROM readings', 'FROM latest')}")
def stream_harmonize(spark, sf_dir):
    """Readings published as messages, streamed and harmonized to points."""
    out = _drain(spark, E.publish_envelope(_unique(spark, sf_dir), SPEC), "harmonize")
    return (spark.read.parquet(f"{out}/points")
            .select("property", "freq", F.col("bucket").cast("long").alias("bucket"), "hash",
                    "start", "end", "value", "isReal"))


def _redelivered(spark, name, deliveries):
    """Publish and stream each delivery before the next, on one checkpoint: its messages are batches of
    their own however many files they fill. The folder written to, and the last batch of each."""
    landed, out, state = (shared_dir(spark, f"{name}-{part}") for part in ("in", "out", "state"))
    last = []
    for delivered in deliveries:
        E.publish_envelope(delivered, SPEC).write.mode("append").parquet(landed)
        job = jobs.start_harmonizer(jobs.file_messages(spark, landed), out, state, SPEC.source, STATIC,
                                    trigger=NOW)
        job.awaitTermination()
        last.append(job.lastProgress["batchId"] if job.lastProgress else last[-1] if last else 0)
    return out, last


@query(f"""WITH {UNIQUE}
SELECT property, freq, bucket, hash, "start", "end", value + 1 AS value, "isReal"
FROM ({POINTS.replace('FROM readings', 'FROM latest')})""")
def stream_redelivery(spark, sf_dir):
    """All readings published, then published again with other values: the later ones stay."""
    readings = _unique(spark, sf_dir)
    out, _ = _redelivered(spark, "redelivery", [
        readings, readings.withColumn("consumptionKWh", F.col("consumptionKWh") + 1)])
    return (jobs.read_points(spark, f"{out}/points")
            .select("property", "freq", F.col("bucket").cast("long").alias("bucket"), "hash",
                    "start", "end", "value", "isReal"))


@query(f"""WITH {UNIQUE}
SELECT property, freq, bucket, hash, "start", "end", value + 2 AS value, "isReal"
FROM ({POINTS.replace('FROM readings', 'FROM latest')})""")
def stream_folded(spark, sf_dir):
    """All readings published three times; the first batches are folded, then folded on."""
    readings, folded = _unique(spark, sf_dir), shared_dir(spark, "folded-old")
    out, (first, second, _) = _redelivered(spark, "folded", [
        readings.withColumn("consumptionKWh", F.col("consumptionKWh") + more) for more in range(3)])
    jobs.fold_points(spark, f"{out}/points", folded, first)
    jobs.fold_points(spark, f"{out}/points", folded, second, since=first)
    return (jobs.read_points(spark, f"{out}/points", folded, second)
            .select("property", "freq", F.col("bucket").cast("long").alias("bucket"), "hash",
                    "start", "end", "value", "isReal"))


@query(f"""WITH {UNIQUE},
ranges AS (
  SELECT {URI_SQL} AS subject, min("timestamp") AS lo, max("timestamp") AS hi
  FROM latest WHERE {HARMONIZED_SQL} GROUP BY ALL)
SELECT subject, 'Start' AS which, strftime(make_timestamp(lo * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS at FROM ranges
UNION ALL
SELECT subject, 'End', strftime(make_timestamp(hi * 1000000), '%Y-%m-%dT%H:%M:%SZ') FROM ranges""")
def stream_sensor_triples(spark, sf_dir):
    """The ranges of all sensors, as triples, after a stream has seen all readings."""
    out = _drain(spark, E.publish_envelope(_unique(spark, sf_dir), SPEC), "sensors", files_per_trigger=4)
    triples = jobs.read_sensor_triples(spark, f"{out}/coverage")
    which = F.regexp_extract("predicate", "#timeSeries(Start|End)$", 1)
    return triples.filter(which != "").select("subject", which.alias("which"), F.col("object").alias("at"))


@query(f"""WITH {t.READINGS}
SELECT cups, prop, freq, min("timestamp") AS first_ts, max("timestamp") AS last_ts
FROM readings WHERE {HARMONIZED_SQL} GROUP BY cups, prop, freq""")
def stream_sensor_coverage(spark, sf_dir):
    """The range of every sensor, grown over four batches of the table read as a stream."""
    schema = table(spark, sf_dir, "events").schema
    landed = shared_dir(spark, "coverage-in")
    table(spark, sf_dir, "events").repartition(4, "event_id").write.parquet(landed)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    kind = F.col("event_type")
    stream = events.filter(kind != "error").select(
        F.col("user_id").cast("string").alias("cups"), F.lit(t.CONSUMPTION).alias("prop"),
        F.when(kind == "signup", "PT15M").otherwise("PT1H").alias("freq"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"))
    out, state = shared_dir(spark, "coverage-out"), shared_dir(spark, "coverage-state")
    jobs.start_coverage(stream, out, state, trigger=NOW).awaitTermination()
    return jobs.read_ranges(spark, out)


LATE = f"""WITH {t.READINGS},
days AS (SELECT *, strftime(make_timestamp("timestamp" * 1000000), '%d') AS day FROM readings),
first AS (SELECT * FROM days WHERE day < '20' AND seq % 5 <> 0),
mark AS (SELECT max("timestamp") - 5 * 86400 AS w FROM first),
again AS (SELECT * FROM days WHERE day < '20')"""


@query(f"""{LATE}
SELECT 'kept' AS kind, seq, CAST(1 AS BIGINT) AS n FROM first
UNION ALL SELECT 'kept', seq, 1 FROM again, mark WHERE "timestamp" > w AND seq % 5 = 0
UNION ALL SELECT 'kept', seq, 1 FROM days WHERE day >= '20'
UNION ALL SELECT 'late', -1, count(*) FROM again, mark WHERE "timestamp" <= w""")
def stream_late(spark, sf_dir):
    """Readings in three deliveries on one checkpoint. The second brings the first again with what that
    left out: rows within the watermark are kept once, older ones are left out and counted."""
    rows = t.readings(spark, sf_dir).select("seq", "cups", "prop", "freq", "timestamp", "consumptionKWh")
    day = F.date_format(F.timestamp_seconds("timestamp"), "dd")
    landed, out, state = (shared_dir(spark, f"late-{part}") for part in ("in", "out", "state"))
    late = 0
    for delivered in (rows.filter((day < "20") & (F.col("seq") % 5 != 0)), rows.filter(day < "20"),
                      rows.filter(day >= "20")):
        delivered.write.mode("append").parquet(landed)
        job = jobs.start_unique(spark.readStream.schema(rows.schema).parquet(landed), out, state, "5 days", trigger=NOW)
        job.awaitTermination()
        late += jobs.late_rows(job)
    kept = spark.read.schema(rows.schema).parquet(out).select(
        F.lit("kept").alias("kind"), "seq", F.lit(1).cast("long").alias("n"))
    return kept.unionByName(spark.range(1).select(
        F.lit("late").alias("kind"), F.lit(-1).cast("long").alias("seq"), F.lit(late).cast("long").alias("n")))


@query("""SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS run_id, CAST(1 AS BIGINT) AS times
FROM events WHERE event_type = 'signup'""")
def stream_finalize(spark, sf_dir):
    """Every run is finalized once, although its end is announced by many messages in several
    micro-batches."""
    calls = shared_dir(spark, "finalize-calls")

    def finalize(session, runs):
        runs.write.mode("append").parquet(calls)

    _drain(spark, _messages(spark, sf_dir).repartition(2, "key"), "finalize",
           files_per_trigger=1, on_final=finalize)
    return (spark.read.schema("run_id string").parquet(calls).groupBy("run_id")
            .agg(F.count(F.lit(1)).alias("times")))
