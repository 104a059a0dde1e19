"""MinHash groups against brute force, and the steps behind them."""

import random
from math import comb

import brute
import numpy as np
import pytest

from meterspark.llm import minhash, stars
from test_llm_edges import empty, odd, table  # noqa: F401


def families(seed, count=12, members=14):
    """Texts made from bases by more and more edits, some of a family alike only to its base."""
    rng, docs = random.Random(seed), []
    for f in range(count):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([4, 30, 120]))]
        for _ in range(members):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 8)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            docs.append((0, " ".join(own)))
    rng.shuffle(docs)
    return [(i, text) for i, (_, text) in enumerate(docs)]


@pytest.mark.parametrize("part_rows, part_grams", [(1 << 10, 1 << 20), (3, 64)])
def test_groups_are_those_of_all_links(spark, monkeypatch, part_rows, part_grams):
    monkeypatch.setattr(minhash, "PART_ROWS", part_rows)
    monkeypatch.setattr(minhash, "PART_GRAMS", part_grams)
    docs = families(5) + [(900, "a b"), (901, "A B"), (902, "a"), (903, "b a")]
    want = brute.near_groups(docs, 3, 85)
    got = minhash.near_copies(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, c in want.values()}) < len(docs) - 30


def test_copies_of_a_base_link_through_it_only(spark):
    """No two copies link with each other, and the base has neither the least id nor the least hash."""
    base = [f"w{i}" for i in range(300)]
    docs = [(50, " ".join(base))]
    for i in range(40):
        own = list(base)
        for k in range(5):
            own[i * 7 + 3 * k] = f"x{i}_{k}"
        docs.append((i, " ".join(own)))
    want = brute.near_groups(docs, 3, 85)
    got = minhash.near_copies(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_odd_rows(odd, empty):  # noqa: F811
    got = minhash.near_copies(odd, 4, 85).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert [by_id[i].component_id for i in (1, 2, 3, 4, 8, 10)] == [1, 2, 3, 4, 8, 10]
    assert by_id[5].component_id == by_id[6].component_id == by_id[7].component_id == 5
    assert (by_id[5].kept, by_id[6].kept, by_id[9].kept) == (True, False, True)
    assert (by_id[None].component_id, by_id[None].kept) == (None, True)
    assert minhash.near_copies(empty).collect() == []


def test_different_texts_under_one_id(spark):
    rows = [(3, "a b c d e f"), (3, "p q r s t u"), (1, "p q r s t u"), (2, "a b c d e f")]
    got = minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [
        (1, 1, True), (2, 2, True), (3, 1, False), (3, 2, False)]


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_few_linked_pairs_are_missed(percent):
    bands, rows = minhash.banding(percent)
    assert bands * rows <= minhash.HASHES
    assert rows == 1 or (1 - (percent / 100) ** rows) ** bands <= minhash.MISSED
    k, like = minhash.least_agreement(percent), percent / 100
    below = sum(comb(128, i) * like ** i * (1 - like) ** (128 - i) for i in range(k))
    assert below <= minhash.MISJUDGED < below + comb(128, k) * like ** k * (1 - like) ** (128 - k)


def test_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (4000, 1000, 1000))
    one, two = minhash.minima([np.concatenate([shared, a]), np.concatenate([shared, b])], minhash.universal(1024))
    assert abs((one == two).mean() - 4000 / 6000) < 0.05


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)], [(999, i) for i in range(300)],
    [(5, 5), (None, 3), (7, None)], [], [(1, 2), (2, 1), (1, 2), (4, 3), (3, 9), (9, 8)]])
def test_stars(spark, links):
    low = {x: x for e in links if None not in e and e[0] != e[1] for x in e}

    def find(x):
        return x if low[x] == x else find(low[x])

    for a, b in links:
        if None not in (a, b) and a != b:
            a, b = find(a), find(b)
            low[max(a, b)] = min(a, b)
    got = stars.star_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(tuple(r) for r in got) == sorted((x, find(x)) for x in low)


def test_signatures_of_lone_nodes_go_no_further(spark):
    rng = np.random.default_rng(5)
    rows = [rng.integers(0, 1 << 32, minhash.HASHES).astype("<u4") for _ in range(30)]
    rows += [rows[7].copy(), rows[8].copy()]
    nodes = spark.createDataFrame([(i, r.tobytes()) for i, r in enumerate(rows)], "node long, signature binary")
    near, others, signatures = minhash.agreeing(nodes, 85)
    assert sorted(r.node for r in signatures.collect()) == [7, 8, 30, 31]
    assert sorted(tuple(sorted(r)) for r in near.unionByName(others).collect()) == [(7, 30), (8, 31)]


def test_links_of_a_group_are_its_star(spark):
    """Labels start from stars that are already found, and not from all pairs of members and hubs."""
    rows = [(i, f"some words that all of these texts have in common but one w{i % 3} and more of them " * 3)
            for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = minhash.signed(docs, 3).filter("n > 0").dropDuplicates(["digest"])
    nodes = signed.withColumn("node", signed["doc_id"])
    got = {tuple(r) for r in minhash.links(docs, nodes, 3, 50).filter("a <> b").collect()}
    members = sorted({x for e in got for x in e})
    assert got == {(x, members[0]) for x in members[1:]} and len(members) == 3
