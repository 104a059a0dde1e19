"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterspark.session import shared_dir


def kept(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept in the checkpoint folder, so a lost executor costs no rerun."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint()


#: Whether Spark removes an execution's shuffle files once it has ended (since 4.1; older ones pass over it).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def released(df: DataFrame) -> DataFrame:
    """`kept`, and the shuffle files it took are removed at once rather than when the driver collects garbage."""
    conf = df.sparkSession.conf
    was = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        # The setting is read when a plan is made.
        return kept(df.select("*"))
    finally:
        if was is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, was)


def sized(df: DataFrame, name: str) -> DataFrame:
    """`df` written as a table, so that Spark knows its size before it plans a join: it broadcasts
    the table only if that is below the session's own threshold, and shuffles otherwise."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
