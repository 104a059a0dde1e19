"""Mixing sources by temperature, realised as budgeted block permutations.

A source with share p of all tokens gets a weight in proportion to p ** exponent. The exponent is
found by bisection: towards 1 weights follow the sources' sizes, towards 0 they become even. The
target is an entropy of the weights (as part of the largest possible) or a limit on how often a
source may be repeated. Sources get weight * budget tokens; the budget is such that the source with
the smallest weight per token is passed through once, so no document is lost.

A source's documents lie in blocks of about `block_tokens`. Each pass orders blocks, and documents
within a block, by hashes of the pass: a permutation that needs no sort of a whole source. Full
passes take everything; the last one takes blocks in order until the budget is spent and cuts the
block in which that happens after the document that reaches it.

A null source is a source of its own, sources without tokens get one pass. A null or empty text has
no tokens and comes with the full passes alone. Equal rows (same id) are placed alike. No documents
give no rows. Extra columns pass through, but for those named like a column of the result, which
are replaced; names starting with `_mix` are reserved.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterspark.llm.storage import kept, sized

BLOCK_TOKENS = 1 << 20
#: Values of the exponent tried per round; a round narrows the interval that many times.
TRIES = 32
ROUNDS = 6
MADE = ("weight", "pass", "block", "block_order", "place")


@dataclass(frozen=True)
class Target:
    """Exactly one of: entropy, as part of log(number of sources); most passes of any source."""
    entropy: float | None = None
    repeats: float | None = None


def tokens(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(text_col, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def _share(name: str = "_mix_tokens") -> Column:
    return F.col(name) / F.sum(name).over(W.partitionBy())


def _exponent(sources: DataFrame, target: Target) -> float:
    """Bisection `TRIES` ways at once: the measure at each exponent is one small aggregate."""
    total, largest, n = sources.filter("_mix_tokens > 0").agg(
        F.sum("_mix_tokens"), F.max("_mix_tokens"), F.count(F.lit(1))).first()
    if not n or n == 1:
        return 1.0
    shares = sources.filter("_mix_tokens > 0").select((F.col("_mix_tokens") / total).alias("p"))
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / TRIES
        at = F.explode(F.array(*[F.lit(low + step * i) for i in range(TRIES + 1)])).alias("a")
        power = F.pow("p", "a")
        rows = (shares.select("p", at).groupBy("a").agg(
            F.sum(power).alias("z"), F.sum(power * F.log(power)).alias("zl"),
            F.max(power / F.col("p")).alias("most"), F.min(power / F.col("p")).alias("least"))
            .orderBy("a").collect())
        # Both measures fall as the exponent grows: keep the last step in which they cross.
        if target.repeats is not None:
            over = [r["most"] / r["least"] > target.repeats for r in rows]
        else:
            over = [log(r["z"]) - r["zl"] / r["z"] > target.entropy * log(n) for r in rows]
        first = next((i for i, o in enumerate(over) if not o), len(over) - 1)
        low, high = rows[max(0, first - 1)]["a"], rows[first]["a"]
        if high <= low:
            break
    return high


def weights(sources: DataFrame, target: Target) -> DataFrame:
    """`sources` (source, _mix_tokens) with weight, budget and the passes that it makes."""
    exponent = _exponent(sources, target)
    total = sources.agg(F.coalesce(F.sum("_mix_tokens"), F.lit(0))).first()[0] or 1
    raised = sources.withColumn("_mix_raised", F.when(
        F.col("_mix_tokens") > 0, F.pow(F.col("_mix_tokens") / total, F.lit(exponent)))
        .otherwise(0.0))
    z, least = raised.filter("_mix_tokens > 0").agg(
        F.sum("_mix_raised"), F.min(F.col("_mix_raised") / F.col("_mix_tokens"))).first()
    if not z:
        return raised.select("*", F.lit(0.0).alias("weight"), F.lit(1.0).alias("_mix_passes"))
    return raised.select("*", (F.col("_mix_raised") / z).alias("weight"), F.when(
        F.col("_mix_tokens") > 0, F.round(F.col("_mix_raised") / F.col("_mix_tokens") / least, 9))
        .otherwise(1.0).alias("_mix_passes"))


def mixture(docs: DataFrame, target: Target, seed: int = 0, block_tokens: int = BLOCK_TOKENS,
            id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """`docs` once per pass that takes them, with weight, pass (from 1), block, and two numbers that
    order a pass of a source: block_order and place."""
    narrow = kept(docs.select(F.col(id_col).alias("_mix_id"), F.col(source_col).alias("_mix_source"),
                              tokens(text_col).alias("_mix_tokens")))
    sources = kept(narrow.groupBy("_mix_source").agg(F.sum("_mix_tokens").alias("_mix_tokens")))
    chosen = weights(sources, target).withColumn(
        "_mix_blocks", F.greatest(F.lit(1), F.ceil(F.col("_mix_tokens") / block_tokens)).cast("long")
    ).withColumn("_mix_full", F.floor("_mix_passes").cast("long")).withColumn(
        "_mix_left", F.round((F.col("_mix_passes") - F.col("_mix_full")) * F.col("_mix_tokens"))
        .cast("long")).select("_mix_source", "weight", "_mix_blocks", "_mix_full", "_mix_left")
    chosen = kept(chosen)

    def placed(df: DataFrame, pass_: Column) -> DataFrame:
        block = F.pmod(F.xxhash64(F.lit(seed), "_mix_id"), F.col("_mix_blocks"))
        return df.withColumn("block", block).withColumns({
            "block_order": F.xxhash64(F.lit(seed), pass_, "_mix_source", "block"),
            "place": F.xxhash64(F.lit(seed), pass_, "_mix_id")})

    # The last pass: the block in which each source's budget ends, and the place in that block.
    last = placed(narrow.join(chosen.filter("_mix_left > 0"), narrow["_mix_source"].eqNullSafe(
        chosen["_mix_source"])).drop(chosen["_mix_source"]), F.col("_mix_full") + 1)
    sums = last.groupBy("_mix_source", "_mix_left", "block", "block_order").agg(
        F.sum("_mix_tokens").alias("_mix_sum"))
    before = F.sum("_mix_sum").over(W.partitionBy("_mix_source").orderBy("block_order", "block")
                                    .rowsBetween(W.unboundedPreceding, 0)) - F.col("_mix_sum")
    end = sums.withColumn("_mix_before", before).filter(
        "_mix_before < _mix_left and _mix_before + _mix_sum >= _mix_left").select(
        F.col("_mix_source").alias("_mix_s"), F.col("block").alias("_mix_end"),
        F.col("block_order").alias("_mix_end_order"), "_mix_before")
    inside = last.join(end, last["_mix_source"].eqNullSafe(end["_mix_s"])
                       & (last["block"] == end["_mix_end"]))
    run = F.sum("_mix_tokens").over(W.partitionBy("_mix_s").orderBy("place", "_mix_id")
                                    .rowsBetween(W.unboundedPreceding, 0))
    cut = (inside.withColumn("_mix_run", F.col("_mix_before") + run)
           .filter("_mix_run - _mix_tokens < _mix_left").groupBy("_mix_s", "_mix_end", "_mix_end_order")
           .agg(F.max("place").alias("_mix_place")))

    plan = sized(chosen.join(cut, chosen["_mix_source"].eqNullSafe(cut["_mix_s"]), "left")
                 .drop("_mix_s"), "mixture")
    base = docs.drop(*MADE).withColumn("_mix_id", F.col(id_col))
    joined = base.join(plan, base[source_col].eqNullSafe(plan["_mix_source"]))
    passes = joined.withColumn("pass", F.explode(F.sequence(
        F.lit(1), F.col("_mix_full") + F.when(F.col("_mix_place").isNotNull(), 1).otherwise(0))))
    in_last = (
        (F.col("block_order") < F.col("_mix_end_order"))
        | ((F.col("block_order") == F.col("_mix_end_order")) & (
            (F.col("block") < F.col("_mix_end"))
            | ((F.col("block") == F.col("_mix_end")) & (F.col("place") <= F.col("_mix_place"))))))
    return (placed(passes, F.col("pass")).filter((F.col("pass") <= F.col("_mix_full")) | in_last)
            .select(*[docs[c] for c in docs.columns if c not in MADE], *MADE))
