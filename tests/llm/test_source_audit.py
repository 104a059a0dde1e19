"""The divergence of sources against plain integers."""

import re
from collections import Counter, defaultdict

import brute
import pytest

from meterspark.llm import source_audit
from test_llm_edges import empty, odd  # noqa: F401

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def expected(rows, min_docs=3, top=200):
    """rows: list of (text, lang, source)."""
    rows = [[x or "" for x in r] for r in rows]
    held, counts = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(lang, source) for _, lang, source in rows})
    for text, lang, source in rows:
        own = Counter(TERM.findall(brute.lower(text)))
        held[lang].update(own.keys())
        counts[lang, source].update(own)
        counts[lang,].update(own)
    out = []
    for lang, source in groups:
        terms = [t for t, n in held[lang].items() if n >= min_docs]

        def chances(group):
            n = counts[group]
            total = sum(n[t] for t in terms)
            return {t: 1 + 10**9 * (n[t] + 1) // (total + len(terms)) for t in terms}

        own, whole = chances((lang, source)), chances((lang,))
        pairs = []
        for _, other in (g for g in groups if g[0] == lang and g[1] != source):
            q = chances((lang, other))
            pairs.append((-sum((own[t] - q[t]) ** 2 // q[t] for t in terms), other.encode(), other))
        told = [(-((own[t] - whole[t]) ** 2 // whole[t]), t.encode(), t) for t in terms
                if counts[lang, source][t] and own[t] > whole[t]]
        for part, found, most in (("pair", pairs, None), ("term", told, top)):
            out += [(lang, source, part, item, -value, rank)
                    for rank, (value, _, item) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_terms, slice_bytes", [(1 << 21, 1 << 24), (40, 500)])
def test_agrees_with_plain_integers(spark, monkeypatch, block_terms, slice_bytes):
    monkeypatch.setattr(source_audit, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(source_audit, "SLICE_BYTES", slice_bytes)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang", "source")
    rows = [tuple(r) for r in docs.collect()]
    got = source_audit.divergence(docs, top=7).collect()
    assert sorted(tuple(r) for r in got) == expected(rows, top=7)


def test_odd_rows(odd, empty):  # noqa: F811
    rows = [tuple(r) for r in odd.select("text", "lang", "source").collect()]
    for least in (1, 2, 9):
        got = source_audit.divergence(odd, least).collect()
        assert sorted(tuple(r) for r in got) == expected(rows, least)
    assert source_audit.divergence(empty).collect() == []


def test_groups_without_terms_and_odd_names(spark):
    rows = [(None, None, "a"), ("", "x y", "b"), ("Zoë é1É Ω_ω", "x y", None), ("zoë zoË", "x y", "b"), ("ZOë", "x y", "c"),
            ("12 34", "x y", "d"), ("\x7f\x80 😀a😀", "x y", "b"), ("😀a😀", "x y", "c"), ("😀A😀", "x y", "c")]
    got = source_audit.divergence(spark.createDataFrame(rows, "text string, lang string, source string")).collect()
    assert sorted(tuple(r) for r in got) == expected(rows)


def test_ties_go_by_bytes(spark):
    rows = [(f"{t} " * 2 + "base", "l", s) for s in ("s1", "s2") for t in ("zz", "ä", "𐀀", "￮") for _ in range(3)
            if s == "s1"] + [("base", "l", "s2")] * 30
    got = source_audit.divergence(spark.createDataFrame(rows, "text string, lang string, source string")).collect()
    assert sorted(tuple(r) for r in got) == expected(rows)
