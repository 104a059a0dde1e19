"""Supply records: conformance, contracts, buildings, places, owners and enrolment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from meterspark import vocabulary as V
from meterspark.functions import clock
from meterspark.functions.skew import last_by, salted_join
from meterspark.functions.text import fewest_edits, lacking, letter_sketch, pair_sketch, plain_name, similarity
from meterspark.schemas import SUPPLY

SUPPLY_NAME_LENGTH = 20
#: How far the length of a guess may be from that of the name.
GUESS_LENGTHS = 3


def conform_schema(df: DataFrame, schema: T.StructType = SUPPLY) -> DataFrame:
    """Add every expected column that is absent, as null; other columns stay."""
    have = set(df.columns)
    return df.withColumns({f.name: F.lit(None).cast(f.dataType)
                           for f in schema if f.name not in have})


def latest_contract(contracts: DataFrame,
                    order: tuple[str, ...] = ("startDate", "seq")) -> DataFrame:
    """The newest contract of each supply; the position as delivered breaks ties."""
    return last_by(contracts, ["cups"], list(order))


def supply_contract_merge(supplies: DataFrame, contracts: DataFrame,
                          keep_uncontracted: bool = False) -> DataFrame:
    """Supplies with their contract; a contract's field replaces the supply's of that name,
    even by null. A supply without contract is not published unless asked for."""
    shared = [c for c in supplies.columns if c in contracts.columns and c != "cups"]
    extra = [c for c in contracts.columns if c not in supplies.columns]
    offered = contracts.select("cups", F.struct(*shared, *extra).alias("k"),
                               F.lit(True).alias("contracted"))
    joined = supplies.join(offered, "cups", "left" if keep_uncontracted else "inner")
    own = [F.when(F.col("contracted"), F.col(f"k.{c}")).otherwise(F.col(c)).alias(c)
           if c in shared else F.col(c) for c in supplies.columns]
    return joined.select(*own, *[F.col(f"k.{c}") for c in extra])


def building_lookup(supplies: DataFrame, by_supply: DataFrame, by_nif: DataFrame,
                    counted: DataFrame | None = None) -> DataFrame:
    """The building (`ens`) of each supply: by the first 20 characters of its id, else by owner.

    Both lookups are `(key, ens, seq)`; a key given twice keeps the last. Owners with a large
    share of all supplies are split over several tasks.
    """
    of_supply = last_by(by_supply, ["key"], ["seq"]).select(
        F.col("key").alias("supply_name"), F.col("ens").alias("ens_supply"))
    of_nif = last_by(by_nif, ["key"], ["seq"]).select(
        F.col("key").alias("nif"), F.col("ens").alias("ens_nif"))
    named = supplies.withColumn("supply_name", F.substring("cups", 1, SUPPLY_NAME_LENGTH))
    return (salted_join(named, of_nif, ["nif"], ["cups"], counted=counted)
            .join(of_supply, "supply_name", "left")
            .withColumn("ens", F.coalesce("ens_supply", "ens_nif"))
            .drop("ens_supply", "ens_nif"))


def fuzzy_place_match(names: DataFrame, gazetteer: DataFrame, column: str, guess_lengths: int = GUESS_LENGTHS,
                      score: Callable[[Column, Column], Column] = similarity) -> DataFrame:
    """The most similar gazetteer entry for each distinct name; there is always one.

    Names equal to an entry once case and punctuation are set aside are settled by an equi-join. Each
    other name first gets a guess, the entry of about its length (two thirds, or `guess_lengths` letters, more or less) whose
    pairs of letters are nearest; how similar that is bounds how far the best may be. Then just the entries within that bound, by length and by
    letters, are compared with the name. So the result is exact. Ties go to the smallest id. `score` is 1
    for equal names and at most 1 - `fewest_edits` / longer length for others.
    """
    entries = (gazetteer.withColumn("plain", plain_name(F.col("name")))
               .groupBy("plain").agg(F.min("geo_id").alias("geo_id")))
    probes = (names.select(F.col(column).alias("probe")).filter(F.col("probe").isNotNull())
              .distinct().withColumn("plain", plain_name(F.col("probe"))))
    tried = probes.join(entries, "plain", "left")
    exact = tried.filter(F.col("geo_id").isNotNull()).select(
        "probe", "geo_id", F.lit(1.0).alias("score"))
    best = (place_candidates(tried.filter(F.col("geo_id").isNull()).select("probe", "plain"), entries, guess_lengths, score)
            .groupBy("probe").agg(F.min(F.struct((-score(F.col("plain"), F.col("entry"))).alias("cost"), "geo_id")).alias("b"))
            .select("probe", "b.geo_id", (-F.col("b.cost")).alias("score")))
    return exact.unionByName(best)


def place_candidates(open_names: DataFrame, entries: DataFrame, guess_lengths: int = GUESS_LENGTHS,
                     score: Callable[[Column, Column], Column] = similarity) -> DataFrame:
    """(probe, plain, entry, geo_id): of each name (probe, plain), the entries (plain, geo_id) that may be the
    most similar, the best one and all that are as good among them.

    Joins are by length, on which names visit just the lengths in reach. Pairs out of reach are told by a few
    bit operations in the join itself and never become rows.
    """
    known = entries.select(F.col("plain").alias("entry"), "geo_id", F.length("plain").alias("length"),
                           letter_sketch(F.col("plain")).alias("entry_letters"), pair_sketch(F.col("plain")).alias("entry_pairs"))
    named = open_names.select("probe", "plain", F.length("plain").alias("own"), letter_sketch(F.col("plain")).alias("letters"),
                              pair_sketch(F.col("plain")).alias("pairs"))
    longest = entries.agg(F.max(F.length("plain"))).scalar()
    apart = fewest_edits(F.col("letters"), F.col("entry_letters"), F.col("own"), F.col("length"))
    unlike = lacking(F.col("pairs"), F.col("entry_pairs")) + lacking(F.col("entry_pairs"), F.col("pairs"))
    longer = F.greatest("own", "length", F.lit(1))

    def of_lengths(least: Column, most: Column) -> Column:
        return F.explode(F.sequence(least.cast("int"), F.greatest(least, most).cast("int"))).alias("length")

    window = F.greatest(F.lit(guess_lengths), F.floor(F.col("own") * 2 / 3))
    near = named.select("*", of_lengths(F.greatest(F.col("own") - window, F.lit(0)), F.col("own") + window)).join(known, "length")
    guess = near.groupBy("probe").agg(F.min(F.struct((unlike / longer).alias("far"), "entry")).alias("guess"))
    reach = named.join(guess, "probe", "left").withColumn("reach", F.coalesce(
        F.lit(1.0) - score(F.col("plain"), F.col("guess.entry")), F.lit(1.0)) + 1e-9)
    # A length further off than `reach` of the longer name takes too many edits by itself.
    least = F.floor(F.col("own") * (1 - F.least("reach", F.lit(1.0))))
    most = F.least(F.ceil(F.col("own") / F.greatest(1 - F.col("reach"), F.lit(1e-9))), longest)
    return (reach.select("probe", "plain", "own", "letters", "reach", of_lengths(least, most))
            .join(known, "length").filter(apart <= F.col("reach") * longer)
            .select("probe", "plain", "entry", "geo_id"))


def replace_place(supplies: DataFrame, matches: DataFrame, column: str,
                  counted: DataFrame | None = None) -> DataFrame:
    """Put the matched id in place of the name; a big city's supplies are split over tasks."""
    found = matches.select(F.col("probe").alias(column), F.col("geo_id").alias("_geo"))
    return (salted_join(supplies, found, [column], ["cups"], counted=counted)
            .withColumn(column, F.col("_geo")).drop("_geo"))


def newest_owner(owners: Column) -> Column:
    """The owner with the latest start (a missing start sorts first), earliest listed on ties."""
    ranked = F.transform(owners, lambda o, i: F.struct(
        F.coalesce(o["startDate"], F.lit("")).alias("start"), (-i).alias("pos"),
        o["startDate"].alias("startDate"), o["endDate"].alias("endDate")))
    return F.array_max(ranked)


def powers(supplies: DataFrame) -> Column:
    """Contracted powers as given, joined by dashes; one that came by itself stays as it is."""
    power = F.col("contractedPowerkW")
    if isinstance(supplies.schema["contractedPowerkW"].dataType, T.ArrayType):
        return F.array_join(power.cast("array<string>"), "-")
    return F.when(F.startswith(power, F.lit("[")), F.array_join(
        F.from_json(power, "array<string>"), "-")).otherwise(power)


def owner_state(supplies: DataFrame, per_row: bool = True) -> DataFrame:
    """Start, end and standing of each supply, from its owner history.

    A supply with a history gets its dates from it; one without keeps its contract's dates and is
    not enrolled by it. Each supply is decided by itself, so results do not depend on the batch.

    With `per_row` off, as older runs did, one history in the frame decides for all: dates come from
    histories alone, and a supply without one counts as enrolled.
    """
    has_history = F.col("dateOwner").isNotNull()
    if per_row:
        use_history = has_history
    else:
        use_history = supplies.agg(F.coalesce(F.bool_or(has_history), F.lit(False))).scalar()
    owner = newest_owner(F.col("dateOwner"))
    start = F.try_to_timestamp(F.col("_owner.startDate"), F.lit("yyyy-MM-dd"))
    end = F.try_to_timestamp(F.col("_owner.endDate"), F.lit("yyyy-MM-dd"))
    market = F.try_to_timestamp(F.col("lastMarketerDate"), F.lit("yyyy/MM/dd"))
    return (supplies
            .withColumn("_by_history", use_history)
            .withColumn("_owner", owner)
            .withColumns({
                "startDate": F.when(F.col("_by_history"), clock.iso(start))
                .otherwise(F.col("startDate")),
                "endDate": F.when(F.col("_by_history"), clock.iso(end))
                .otherwise(F.col("endDate")),
                "stateCancelled": F.when(F.col("_by_history") & (end > start), V.CANCELLED),
            })
            .withColumns({
                "stateEnrolled": F.col("_by_history") & F.col("stateCancelled").isNull(),
                "nif_ab": F.coalesce("endDate", F.lit(V.ACTIVE)),
                "contractedPowerkW": powers(supplies),
                "lastMarketerDate": clock.iso(market),
            })
            .drop("_by_history", "_owner"))


def enrolment_merge(supplies: DataFrame, devices: DataFrame) -> DataFrame:
    """`enrolled` = on record for the device or by its owner history. Devices may repeat; where they
    name a `source`, only the provider's count."""
    if "source" in devices.columns:
        devices = devices.filter(F.col("source") == V.PROVIDER)
    on_record = (devices.groupBy(F.col("deviceName").alias("cups"))
                 .agg(F.bool_or("enrolled").alias("_enrolled")))
    return (supplies.join(on_record, "cups", "left")
            .withColumn("enrolled", F.coalesce("_enrolled", F.lit(False))
                        | F.coalesce("stateEnrolled", F.lit(False)))
            .drop("_enrolled"))
