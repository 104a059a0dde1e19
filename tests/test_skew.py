"""Helpers against plain joins and windows, with keys hot enough to be split."""

import pytest
from pyspark.sql import Window as W, functions as F

from meterspark.functions.skew import last_by, numbered, salted, salted_join


@pytest.fixture(scope="module")
def big(spark):
    # One key holds two thirds of the rows, another none of the small side's, some are null.
    return spark.range(3000).select(
        "id", F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2400, None)
        .when(F.col("id") < 2800, "lost").otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("k"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, big, how):
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("other", 5)],
                                "k string, v int")
    got = salted_join(big, dim, ["k"], ["id"], how=how, hot_rows=100)
    want = big.join(dim, ["k"], how)
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(want.columns)
    assert sorted(map(repr, got.select(cols).collect())) == sorted(
        map(repr, want.select(cols).collect()))


def test_hot_keys_are_spread_evenly(spark, big):
    dim = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    left, right = salted(big, dim, ["k"], ["id"], hot_rows=100)
    for key, salts in (("k = 'hot'", 20), ("k is null", 4), ("k = 'k1'", 1)):
        counts = [r["count"] for r in left.filter(key).groupBy("_salt").count().collect()]
        assert len(counts) == salts and max(counts) < 200
    assert right.groupBy("k").count().orderBy("k").collect() == [("hot", 20), ("k1", 1)]


@pytest.mark.parametrize("block", [1, 7, 100, 10_000])
def test_numbered_equals_row_number(spark, big, block):
    keyed = big.withColumn("k", F.coalesce("k", F.lit("")))
    got = numbered(keyed, ["k"], "id", block_rows=block)
    want = keyed.withColumn("rn", F.row_number().over(W.partitionBy("k").orderBy("id")))
    assert sorted((r.id, r.rn) for r in got.collect()) == sorted(
        (r.id, r.rn) for r in want.collect())


def test_last_by_limits_before_the_shuffle(spark, big):
    last = last_by(big, ["k"], ["id"])
    assert {r.k: r.id for r in last.collect()}["hot"] == 1999
    plan = last._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below
