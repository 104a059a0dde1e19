"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window as W, functions as F


#: Of the hot keys, so many are salted.
HOT_KEYS = 4096


def salted(big: DataFrame, dim: DataFrame, on: list[str], spread_by: list[str],
           hot_rows: int, counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a column `_salt`; see `salted_join`."""
    hot = ((big if counted is None else counted).groupBy(*[F.col(c).alias(f"_hot_{c}") for c in on]).count()
           .filter(F.col("count") > hot_rows)
           .orderBy(F.desc("count"), *[f"_hot_{c}" for c in on]).limit(HOT_KEYS)
           .select(*[f"_hot_{c}" for c in on],
                   F.ceil(F.col("count") / hot_rows).cast("int").alias("_salts")))

    def with_salts(df: DataFrame) -> DataFrame:
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in on])
        return (df.join(F.broadcast(hot), same, "left")
                .withColumn("_salts", F.coalesce("_salts", F.lit(1)))
                .drop(*[f"_hot_{c}" for c in on]))

    left = with_salts(big).withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int")).drop("_salts")
    right = with_salts(dim).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return left, right


def salted_join(big: DataFrame, dim: DataFrame, on: list[str], spread_by: list[str],
                how: str = "left", hot_rows: int = 1_000_000,
                counted: DataFrame | None = None) -> DataFrame:
    """Join `big` to `dim` on `on`, splitting keys that hold over `hot_rows` rows of `big`.

    Rows of a hot key are spread by a hash of `spread_by` over enough salts that each holds
    about `hot_rows` rows; only that key's rows of `dim` are repeated, once per salt. The hash
    depends on the row alone, so a recomputed task places its rows as before. The broadcast list
    holds the `HOT_KEYS` largest keys at most, so its size is bounded whatever the data; any other
    key is left to adaptive execution. Null keys spread like any other.
    `how` is one of inner, left, left_semi, left_anti.

    Finding hot keys takes one more pass over the key columns of `big`. Where `big` is the outcome
    of costly steps, hand in as `counted` a frame with about the same keys that is cheap to read;
    counts decide on balance alone, never on the result.
    """
    left, right = salted(big, dim, on, spread_by, hot_rows, counted)
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def numbered(df: DataFrame, keys: list[str], seq: str, into: str = "rn",
             block_rows: int = 65_536) -> DataFrame:
    """Number the rows of each key from 1 in the order of `seq`, without one task per key.

    `seq` is an integer, unique within a key and reasonably dense (a snapshot position). Rows are
    sorted inside blocks of `seq`, each of at most `block_rows` rows, and every block starts
    counting where the blocks before it ended; just the block counts meet per key. Keys are not
    null. `df` is read twice, so a costly one is better stored first.
    """
    blocked = df.withColumn("_block", F.floor(F.col(seq) / block_rows))
    starts = (blocked.groupBy(*keys, "_block").count()
              .withColumn("_before", F.coalesce(
                  F.sum("count").over(W.partitionBy(*keys).orderBy("_block")
                                      .rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .drop("count"))
    position = F.row_number().over(W.partitionBy(*keys, "_block").orderBy(seq))
    return (blocked.withColumn("_pos", position)
            .join(starts, [*keys, "_block"])
            .withColumn(into, F.col("_before") + F.col("_pos"))
            .drop("_block", "_pos", "_before"))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """`df` by a hash of `by` in as many partitions as the session shuffles to, for steps that make much
    of each row.

    A file of few row groups is read by few tasks, whatever its rows turn into. The number is given
    outright: adaptive execution would size partitions by the rows moved, not by what comes of them.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def last_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in `order`.

    Spark limits each task to one row per key before the shuffle (the window group limit), so a
    key that occurs very often sends one row per task.
    """
    newest_first = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (df.withColumn("_rn", F.row_number().over(newest_first))
            .filter(F.col("_rn") == 1).drop("_rn"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """`old` with the rows of `new` in place of those with the same keys. One full join, so neither
    side is computed twice; a null in a new row is a null, not a gap to fill. Keys are unique."""
    rest = [c for c in old.columns if c not in keys]
    was = old.select(*keys, F.struct(*rest).alias("_old"))
    now = new.select(*keys, F.struct(*rest).alias("_new"))
    row = F.when(F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
    return was.join(now, keys, "full").withColumn("_row", row).select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in old.columns])
