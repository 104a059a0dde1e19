"""Every query against its SQL on the smallest tables, and the shape of its plan."""

import pytest
from oracle import differences

from meterspark import catalog

SF = "/root/testdata/sf0.001"


def check_plan(df):
    """Work stays in the JVM, nothing is joined pair by pair, no rows meet in one task."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
                "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, bad
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        # Only partial results of a global count or flag may.
        assert "SinglePartition" not in line or "partial_" in below


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_agrees_with_sql(spark, name):
    df = catalog.queries()[name](spark, SF)
    check_plan(df)
    assert differences(df, SF, name) is None


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry_has_rows(spark):
    import __spark_entry__ as entries
    assert entries.entry(spark).count() > 0


def test_a_delivery_fills_several_files(spark, monkeypatch):
    """Messages are not pushed through one task, and a batch still holds one delivery only."""
    from pathlib import Path
    from meterspark.streaming import jobs
    folders, messages = [], jobs.file_messages

    def watched(session, path, *args):
        folders.append((path, len(list(Path(path).glob("*.parquet")))))
        return messages(session, path, *args)

    monkeypatch.setattr(jobs, "file_messages", watched)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name in ("stream_redelivery", "stream_folded"):
            folders.clear()
            assert differences(catalog.queries()[name](spark, SF), SF, name) is None
            seen = [files for _, files in folders]
            assert seen[0] > 1 and seen == sorted(set(seen)) and len({path for path, _ in folders}) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
