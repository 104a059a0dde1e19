import random

import pytest
from pyspark.sql import functions as F

from meterspark.functions.text import any_order_similarity, fewest_edits, letter_sketch, plain_name
from meterspark.operators import supplies as S
from meterspark.schemas import CONTRACT, SUPPLY
from meterspark.sources import landing
from meterspark.sources.gazetteer import gazetteer_pattern
from meterspark import vocabulary as V


def test_conform_adds_what_is_missing(spark):
    df = S.conform_schema(spark.createDataFrame([("c", "x")], "cups string, other string"))
    assert set(SUPPLY.fieldNames()) | {"other"} == set(df.columns) and len(SUPPLY) == 34
    assert df.schema["dateOwner"].dataType == SUPPLY["dateOwner"].dataType


def contract(spark, *rows):
    """Rows of (seq, cups, startDate, endDate, marketer)."""
    rest = (None,) * (len(CONTRACT) - 5)
    return spark.createDataFrame([(*r, *rest) for r in rows], CONTRACT)


def test_latest_contract_by_start_then_position(spark):
    df = contract(spark, (1, "a", "2022-01-01", None, "m1"), (2, "a", "2023-01-01", None, "m2"),
                  (3, "a", "2023-01-01", None, "m3"), (9, "b", "2020-01-01", None, None))
    got = {r.cups: r.marketer for r in S.latest_contract(df).collect()}
    assert got == {"a": "m3", "b": None}


def test_contract_fields_replace_supply_fields(spark):
    given = spark.createDataFrame([("a", "own", 1), ("b", "own", 2), ("z", "own", 3)],
                                  "cups string, marketer string, n int")
    offers = spark.createDataFrame([("a", "new", "t"), ("b", None, "t")],
                                   "cups string, marketer string, tension string")
    got = {r.cups: (r.marketer, r.tension) for r in S.supply_contract_merge(given, offers).collect()}
    assert got == {"a": ("new", "t"), "b": (None, "t")}
    kept = S.supply_contract_merge(given, offers, keep_uncontracted=True).collect()
    assert {r.cups: r.marketer for r in kept} == {"a": "new", "b": None, "z": "own"}


def test_building_by_supply_then_by_owner(spark):
    long_id = "ES0031000000000001AB0F"
    given = spark.createDataFrame([(long_id, "n1"), ("c2", "n1"), ("c3", "n9"), ("c4", None)],
                                  "cups string, nif string")
    key = "key string, ens string, seq int"
    by_supply = spark.createDataFrame([(long_id[:20], "old", 1), (long_id[:20], "b1", 2)], key)
    by_nif = spark.createDataFrame([("n1", "b2", 1)], key)
    got = {r.cups: r.ens for r in S.building_lookup(given, by_supply, by_nif).collect()}
    assert got == {long_id: "b1", "c2": "b2", "c3": None, "c4": None}


OWNED = ("cups string, dateOwner array<struct<startDate:string,endDate:string>>, startDate string, "
         "endDate string, contractedPowerkW array<double>, lastMarketerDate string")


def owned(spark, *rows):
    return spark.createDataFrame(list(rows), OWNED)


def test_owner_state_from_history(spark):
    df = owned(spark,
               ("two", [("2020-01-01", "2021-01-01"), ("2023-01-01", None)], "x", "y", [3.45, 10.0], "2024/01/31"),
               ("ended", [("2023-01-01", "2024-01-01")], None, None, None, "31-01-2024"),
               ("none", None, "2019-01-01", "2020-01-01", None, None),
               ("empty", [], None, None, None, None))
    got = {r.cups: r for r in S.owner_state(df, per_row=False).collect()}
    pick = lambda c: (got[c].startDate, got[c].endDate, got[c].stateCancelled,
                      got[c].stateEnrolled, got[c].nif_ab)
    assert pick("two") == ("2023-01-01T00:00:00", None, None, True, "Alta")
    assert pick("ended") == ("2023-01-01T00:00:00", "2024-01-01T00:00:00", "Accepted", False,
                             "2024-01-01T00:00:00")
    assert pick("none") == pick("empty") == (None, None, None, True, "Alta")
    assert (got["two"].contractedPowerkW, got["two"].lastMarketerDate) == (
        "3.45-10.0", "2024-01-31T00:00:00")
    assert got["ended"].lastMarketerDate is None


def test_owner_state_without_any_history(spark):
    df = owned(spark, ("a", None, "2019-01-01", "2020-01-01", None, None),
               ("b", None, "2019-01-01", None, None, None))
    got = {r.cups: (r.startDate, r.endDate, r.stateCancelled, r.stateEnrolled, r.nif_ab)
           for r in S.owner_state(df, per_row=False).collect()}
    assert got == {"a": ("2019-01-01", "2020-01-01", None, False, "2020-01-01"),
                   "b": ("2019-01-01", None, None, False, "Alta")}
    assert S.owner_state(df.limit(0)).count() == 0


def test_owner_state_per_row(spark):
    df = owned(spark, ("a", [("2023-01-01", None)], None, None, None, None),
               ("b", None, "2019-01-01", None, None, None))
    got = {r.cups: (r.startDate, r.stateEnrolled) for r in S.owner_state(df).collect()}
    assert got == {"a": ("2023-01-01T00:00:00", True), "b": ("2019-01-01", False)}


def test_first_of_equal_owners_wins(spark):
    df = owned(spark, ("a", [("2023-01-01", "2023-05-05"), ("2023-01-01", None), (None, None)],
                       None, None, None, None))
    assert S.owner_state(df).first().endDate == "2023-05-05T00:00:00"


def test_enrolment(spark):
    given = spark.createDataFrame([("a", None), ("b", False), ("c", True), ("d", None)],
                                  "cups string, stateEnrolled boolean")
    devices = spark.createDataFrame([("a", False), ("a", True), ("b", None)],
                                    "deviceName string, enrolled boolean")
    got = sorted((r.cups, r.enrolled) for r in S.enrolment_merge(given, devices).collect())
    assert got == [("a", True), ("b", False), ("c", True), ("d", False)]
    assert S.enrolment_merge(given, devices.limit(0)).count() == 4


def test_gazetteer_pattern(spark):
    at = "https://sws.geonames.org/{}/".format
    rows = [(at(n), V.GAZETTEER_NAME, name) for n, name in ((3, "Lleida"), (1, "Lleida"), (2, "Girona"), (4, "Reus"))]
    rows += [(at(n), V.GAZETTEER_LEVEL, V.PROVINCE_LEVEL) for n in (1, 2, 3)]
    rows += [(at(4), V.GAZETTEER_LEVEL, V.MUNICIPALITY_LEVEL)]
    df = spark.createDataFrame(rows, "subject string, predicate string, object string")
    got = {r.name: r.geo_id for r in gazetteer_pattern(df, V.PROVINCE_LEVEL).collect()}
    assert got == {"Lleida": "1", "Girona": "2"}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_place_match_equals_brute_force(spark, block):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
    places = {word(): str(i) for i in range(60)}
    probes = sorted({word() for _ in range(80)} | set(list(places)[:5]) | {"A-B", "zzz"})
    plain = lambda s: "".join(c if c.isalnum() else " " for c in s.lower()).strip()
    want = {}
    for p in probes:
        score = lambda g: 1.0 - edits(plain(p), g) / max(len(plain(p)), len(g), 1)
        want[p] = min((-score(g), i) for g, i in places.items())[1]
    got = S.fuzzy_place_match(
        spark.createDataFrame([(p,) for p in probes + [None]], "m string"),
        spark.createDataFrame(list(places.items()), "name string, geo_id string"), "m", block)
    assert {r.probe: r.geo_id for r in got.collect()} == want


def test_few_places_are_compared(spark):
    """Of all pairs of an open name and one of 64 places, about one in sixteen is compared."""
    from meterspark.catalog import queries
    from meterspark.catalog.supplies import gazetteer, places_of_level
    path = "/root/testdata/sf0.01"
    places = places_of_level(gazetteer(spark, path), V.MUNICIPALITY_LEVEL)
    entries = places.select(F.lower("name").alias("plain"), "geo_id")
    matched = queries()["fuzzy_place_match"](spark, path).filter("score < 1")
    names = matched.select("probe", plain_name(F.col("probe")).alias("plain"))
    pairs = S.place_candidates(names, entries)
    found, every = pairs.count(), names.count() * entries.count()
    assert names.count() <= found < 0.07 * every
    best = {r.probe: r.geo_id for r in matched.collect()}
    assert {(r.probe, r.geo_id) for r in pairs.collect()} >= set(best.items())
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fewest_edits_never_exceeds_the_distance(spark):
    rng = random.Random(4)
    letters = "aab cé1日𠀀"
    rows = [tuple("".join(rng.choice(letters) for _ in range(rng.randrange(0, 14))) for _ in "ab") for _ in range(800)]
    rows += [("", ""), ("a" * 300, "a" * 290), ("𠀀𠀀", "𠀀"), ("abc", "cab")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", F.levenshtein("a", "b").alias("edits"), fewest_edits(
        letter_sketch(F.col("a")), letter_sketch(F.col("b")), F.length("a"), F.length("b")).alias("least")).collect()
    assert all(r.least <= r.edits for r in got)
    assert sum(r.least for r in got) > 0.4 * sum(r.edits for r in got)


def test_replace_place(spark):
    df = spark.createDataFrame([("c1", "BARCELONA"), ("c2", "Barcelone"), ("c3", None)],
                               "cups string, municipality string")
    places = spark.createDataFrame([("Barcelona", "7"), ("Girona", "8")], "name string, geo_id string")
    matched = S.replace_place(df, S.fuzzy_place_match(df, places, "municipality"), "municipality")
    assert {r.cups: r.municipality for r in matched.collect()} == {"c1": "7", "c2": "7", "c3": None}


def test_words_in_another_order(spark):
    names = spark.createDataFrame([("HOSPITALET DE LLOBREGAT (L')",), ("Reuss",)], "m string")
    places = spark.createDataFrame([("L'Hospitalet de Llobregat", "1"), ("Hospital de Orbigo", "2"),
                                    ("Reus", "3")], "name string, geo_id string")
    got = S.fuzzy_place_match(names, places, "m", score=any_order_similarity).collect()
    assert {r.geo_id: round(r.score, 2) for r in got} == {"1": 0.95, "3": 0.8}


def test_items_that_are_no_supply_records_are_rejected(spark):
    documents = spark.createDataFrame([
        (1, '{"supplies": [{"cups": "x", "pointType": "large"}, {"cups": "a", "pointType": 2}]}'),
        (2, '{"supplies": ["x", null, 5]}'), (3, '{"supplies": [{"cups": "b"}'), (4, '{"supplies": []}'),
        (5, '{"other": 1}'), (6, None)], "n int, value string")
    assert [(r.cups, r.pointType) for r in landing.supplies_in(documents).collect()] == [("a", 2)]
    assert sorted((r.n, r.item or "-") for r in landing.rejected_documents(documents).collect()) == [
        (1, '{"cups":"x","pointType":"large"}'), (2, "5"), (2, "null"), (2, "x"), (3, "-"), (5, "-")]
