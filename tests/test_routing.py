import pytest
from pyspark.sql import functions as F

from meterspark.operators import routing
from meterspark.schemas import SUBSCRIPTION
from meterspark.sources import subscriptions as sub


def subs(spark, *rows):
    """Rows of (seq, source, username, authorized_nif, self, cups)."""
    full = [(*r, [f"{r[1]}_table"], [["cups", "timestamp"]]) for r in rows]
    return spark.createDataFrame(full, SUBSCRIPTION)


def supplies(spark, *rows):
    return spark.createDataFrame(list(rows),
                                 "seq long, username string, authorized_nif string, cups string")


def routes(spark, subscriptions, snapshot):
    return {r.cups: r.db_list for r in routing.route_supplies(
        routing.login_sources(subscriptions), snapshot).collect()}


SNAPSHOT = [(1, "u", "", "c1"), (2, "u", "", "c2"), (3, "u", "", "c3")]
LISTED = [(2, "B", "u", None, None, ["c1", "c2"]), (3, "C", "u", None, None, ["c2"])]


def test_route_by_wildcard_and_list(spark):
    everyone = subs(spark, (1, "A", "u", None, None, None), *LISTED)
    assert routes(spark, everyone, supplies(spark, *SNAPSHOT)) == {
        "c1": ["A", "B"], "c2": ["A", "B", "C"], "c3": ["A"]}


def test_unlisted_supply_without_wildcard_keeps_an_empty_list(spark):
    listed = subs(spark, *LISTED)
    assert routes(spark, listed, supplies(spark, *SNAPSHOT))["c3"] == []
    rest = routing.unrouted_supplies(routing.login_sources(listed), supplies(spark, *SNAPSHOT))
    assert [r.cups for r in rest.collect()] == ["c3"]


def test_membership_groups_longest_first(spark):
    lists = routing.explicit_lists(routing.login_sources(subs(spark, *LISTED)))
    got = routing.membership_partition(lists, routing.LOGIN, "cups", "source").orderBy(
        F.desc("owners_length"), "owners").collect()
    assert [(r.owners, r.cups) for r in got] == [("B,C", "c2"), ("B", "c1")]


@pytest.mark.parametrize("nifs, own, expected", [
    (["n1"], False, ["n1"]), (["n1"], True, ["", "n1"]), (None, False, []), (None, None, [""])])
def test_explode_and_own_supplies(spark, nifs, own, expected):
    df = routing.wanted_logins(routing.explode_authorized(
        subs(spark, (1, "A", "u", nifs, own, None))))
    assert sorted(r.authorized_nif for r in df.collect()) == expected


def test_repeated_subscription_keeps_last_list_and_first_place(spark):
    df = subs(spark, (1, "B", "u", None, None, ["c9"]), (2, "A", "u", None, None, ["c1"]),
              (3, "B", "u", None, None, None))
    row = routing.user_aggregate(df).first()
    assert row.source == ["B", "A"] and row.dict_cups == {"B": None, "A": ["c1"]}
    assert row.tables == {"A": ["A_table"], "B": ["B_table"]}
    assert row.row_keys["A"] == [["cups", "timestamp"]]


def test_logins_differ_by_own_wish(spark):
    df = subs(spark, (1, "A", "u", ["n"], True, None), (2, "B", "u", ["n"], False, None),
              (3, "C", "u", ["n"], None, None))
    users = {(r.authorized_nif, r.self_wish): r.source
             for r in routing.user_aggregate(df).collect()}
    assert users == {("n", "true"): ["A"], ("", "true"): ["A"], ("n", "false"): ["B"],
                     ("n", ""): ["C"], ("", ""): ["C"]}


def test_routing_conserves_supplies(spark):
    df = subs(spark, (1, "A", "u", None, None, None), *LISTED, (4, "D", "v", ["n"], False, ["x1"]))
    snapshot = supplies(spark, *SNAPSHOT, (1, "v", "n", "x1"), (2, "v", "n", "x2"))
    out = routing.route_supplies(routing.login_sources(df), snapshot)
    assert out.count() == snapshot.count()


def test_batches_of_ten_in_snapshot_order(spark):
    df = subs(spark, (1, "A", "u", None, None, None), (2, "B", "u", None, None, ["c3", "c5"]))
    snapshot = supplies(spark, *[(i * 7, "u", "", f"c{i}") for i in range(25)])
    out = routing.work_batches(routing.route_supplies(routing.login_sources(df), snapshot))
    rows = out.collect()
    rest = sorted((r.seq, r.batch_id) for r in rows if r.route == "")
    assert [b for _, b in rest] == [0] * 10 + [1] * 10 + [2] * 3
    assert [r.batch_id for r in rows if r.route == "B"] == [0, 0]


def test_snapshot_gate(spark):
    logins = spark.createDataFrame([("big",), ("ok",), ("none",)], "username string")
    thresholds = spark.createDataFrame([("big", 3)], "username string, min_supplies long")
    snapshot = supplies(spark, *[(i, "big", "", str(i)) for i in range(3)], (1, "ok", "", "c"))
    got = {r.username: r.status for r in
           routing.snapshot_gate(snapshot, thresholds, logins).collect()}
    assert got == {"big": "too_few", "ok": "complete", "none": "too_few"}


def users(spark, *rows):
    return spark.createDataFrame(list(rows), "seq long, username string, "
                                 "authorized_nif array<string>, self boolean, cups array<string>")


def test_failing_source_is_left_out(spark):
    good = sub.SourceSpec("A", lambda s: users(s, (1, "u", None, None, None)))
    bad = sub.SourceSpec("B", lambda s: s.read.parquet("/nowhere/at/all"))
    got = sub.sources_union(spark, [bad, good], skip_failing=True)
    assert [r.source for r in got.collect()] == ["A"]
    with pytest.raises(Exception):
        sub.sources_union(spark, [bad, good])


def test_password_is_not_read(spark):
    nodes = users(spark, (1, "u", None, None, None)).withColumn("password", F.lit("secret"))
    assert "password" not in sub.subscription_scan(nodes).columns


def test_transforms_start_from_the_original_rows(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    double = lambda d: d.withColumn("v", F.col("v") * 2)
    specs = [sub.SourceSpec(n, lambda s: None, prepare=double) for n in "AB"]
    assert [d.first().v for d in sub.plugin_transform(df, specs).values()] == [2.0, 2.0]


def test_table_names():
    assert sub.SourceSpec("A", lambda s: None).table_names("P", "PT1H") == ["raw_ts_P_PT1H"]
