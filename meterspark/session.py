"""Session settings the operators rely on, and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Used unless the session says otherwise. Rows go to Python and come from Parquet in batches by number: of
#: whole texts, thousands are tens of MB that each task holds several times, in the JVM and in Python.
DEFAULTS = {ADVISORY: "16m", "spark.sql.execution.arrow.maxBytesPerBatch": "2m",
            "spark.sql.parquet.columnarReaderBatchSize": "1024"}


def configure(spark: SparkSession) -> SparkSession:
    """Wall-clock arithmetic goes through UTC; adaptive execution splits skewed joins; tables
    partitioned by meter join on (meter, chunk) as they are. Unless the session says otherwise, a task
    after a shuffle takes 16 MB: identifiers compress well, so that is some hundred MB of rows; and what a
    task reads or sends to Python at once is bounded (`DEFAULTS`)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    for key, value in DEFAULTS.items():
        if not spark.conf.get(key, None):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a session without that setting (a local test) gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="meterspark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
