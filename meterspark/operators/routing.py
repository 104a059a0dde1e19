"""Which supply goes to which project: subscriptions merged per login, supplies routed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterspark.functions.skew import numbered, salted_join

# A login is read once per authorized id and per wish for its own supplies. The wish is kept as
# text ("true", "false", "" for unknown), so that it joins and groups without null handling.
LOGIN = ["username", "authorized_nif", "self_wish"]


def explode_authorized(subscriptions: DataFrame) -> DataFrame:
    """One row per id a login may read, plus '' for the login's own supplies."""
    own = F.array(F.lit(""))
    return subscriptions.withColumn("authorized_nif", F.explode(
        F.concat(F.coalesce("authorized_nif", F.array().cast("array<string>")), own)))


def wanted_logins(exploded: DataFrame) -> DataFrame:
    """Leave out a login's own supplies where it does not want them; unknown means it does."""
    return exploded.filter(~(F.col("self").eqNullSafe(False) & (F.col("authorized_nif") == "")))


def login_sources(subscriptions: DataFrame) -> DataFrame:
    """One row per login and source: the last list it gave and when it first appeared.

    The row is the unit everything else here is built on; a list of thousands of supplies stays
    one value of one row.
    """
    rows = (wanted_logins(explode_authorized(subscriptions))
            .withColumn("self_wish", F.coalesce(F.col("self").cast("string"), F.lit("")))
            .select(*LOGIN, "source", "seq", "tables", "row_keys", "cups"))
    return rows.groupBy(*LOGIN, "source").agg(
        F.min("seq").alias("first_seq"),
        F.max_by(F.struct("tables", "row_keys", "cups"), "seq").alias("last")
    ).select(*LOGIN, "source", "first_seq", "last.*")


def user_aggregate(subscriptions: DataFrame) -> DataFrame:
    """One row per login: its sources in order of appearance, and their settings by source.

    The lists collected here have one entry per source, since repeats are merged before.
    """
    entry = F.sort_array(F.collect_list(F.struct(
        "first_seq", "source", "tables", "row_keys", "cups")))
    return (login_sources(subscriptions)
            .groupBy(*LOGIN).agg(entry.alias("e"))
            .select(*LOGIN, F.col("e.source").alias("source"),
                    F.map_from_arrays("e.source", "e.tables").alias("tables"),
                    F.map_from_arrays("e.source", "e.row_keys").alias("row_keys"),
                    F.map_from_arrays("e.source", "e.cups").alias("dict_cups")))


def explicit_lists(logins: DataFrame) -> DataFrame:
    """(login, source, cups) for every supply a source names; `logins` is `login_sources`."""
    return (logins.filter(F.col("cups").isNotNull())
            .select(*LOGIN, "source", F.explode("cups").alias("cups")))


def membership_partition(lists: DataFrame, keys: list[str], element: str,
                         owner: str) -> DataFrame:
    """Each element with the exact set of owners that list it.

    Elements of one set share `owners`; sets come longest name first, then by name, which the
    columns `owners_length` and `owners` let a report sort by. Rows stay one per element, so a
    set holding most elements is never gathered in one place.
    """
    return (lists.groupBy(*keys, element)
            .agg(F.sort_array(F.collect_set(owner)).alias("owner_list"))
            .withColumn("owners", F.array_join("owner_list", ","))
            .withColumn("owners_length", F.length("owners")))


def route_supplies(logins: DataFrame, supplies: DataFrame) -> DataFrame:
    """Each supply with the sources it goes to: those that want all, then those that name it.

    `logins` is `login_sources`; `supplies` has `seq, username, authorized_nif, cups`. A supply no
    source names goes to the former alone, and stays with an empty list if there are none.
    """
    readers = logins.groupBy(*LOGIN).agg(F.sort_array(F.collect_list(F.when(
        F.col("cups").isNull(), F.struct("first_seq", "source")))).alias("w")).select(
        *LOGIN, F.col("w.source").alias("wildcards"))
    named = membership_partition(explicit_lists(logins), LOGIN, "cups", "source").select(
        *LOGIN, "cups", F.col("owner_list").alias("named"), F.col("owners").alias("route"))
    return (salted_join(supplies, readers, ["username", "authorized_nif"], ["cups", "seq"],
                        how="inner")
            .join(named, [*LOGIN, "cups"], "left")
            .withColumn("route", F.coalesce("route", F.lit("")))
            .withColumn("db_list", F.concat(
                "wildcards", F.coalesce("named", F.array().cast("array<string>"))))
            .drop("wildcards", "named"))


def unrouted_supplies(logins: DataFrame, supplies: DataFrame) -> DataFrame:
    """Supplies of known logins that no source of the login names."""
    named = explicit_lists(logins).select(*LOGIN, "cups").distinct()
    known = logins.select(*LOGIN).distinct()
    return (salted_join(supplies, known, ["username", "authorized_nif"], ["cups", "seq"],
                        how="inner")
            .join(named, [*LOGIN, "cups"], "left_anti"))


def work_batches(routed: DataFrame, size: int = 10) -> DataFrame:
    """Number the supplies of each login and route in snapshot order, `size` to a batch."""
    keys = [*LOGIN, "route"]
    return (numbered(routed, keys, "seq")
            .withColumn("batch_id", F.floor((F.col("rn") - 1) / size))
            .withColumnRenamed("rn", "position"))


def snapshot_gate(supplies: DataFrame, thresholds: DataFrame, logins: DataFrame) -> DataFrame:
    """Whether each login's snapshot is whole: it must hold more supplies than its threshold.

    `thresholds` is `(username, min_supplies)` for the logins known to be large; others need one
    supply. Supplies are counted before they meet the logins.
    """
    counted = supplies.groupBy("username").agg(F.count(F.lit(1)).alias("supplies"))
    return (logins.select("username").distinct()
            .join(counted, "username", "left")
            .join(thresholds, "username", "left")
            .select("username", F.coalesce("supplies", F.lit(0)).alias("supplies"),
                    F.coalesce("min_supplies", F.lit(0)).cast("long").alias("min_supplies"))
            .withColumn("status", F.when(F.col("supplies") > F.col("min_supplies"), "complete")
                        .otherwise("too_few")))
