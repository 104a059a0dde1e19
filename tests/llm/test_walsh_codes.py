"""Codes against brute force in plain integers."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from meterspark.llm import walsh_codes as codes

SCHEMA = "vec_id long, embedding array<double>, code string, error long, `_vector` int, label int"


def brute(rows, parts, entries, rounds, scale):
    """rows: list of (id, vector) in the order of ids; codebooks and [(id, code, error)]."""
    width = -(-len(rows[0][1]) // parts)
    whole = [[Fraction(x) * scale // 1 for x in v] + [0] * (width * parts - len(v)) for _, v in rows]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for v in cut:
                own[best(v[p], books[p])[1]].append(v[p])
            books[p] = [[sum(col) // len(of) for col in zip(*of)] if of else books[p][i] for i, of in enumerate(own)]
    found = [[best(v[p], books[p]) for p in range(parts)] for v in cut]
    return books, [(i, [e for _, e in f], min(sum(d for d, _ in f), codes.LARGEST)) for (i, _), f in zip(rows, found)]


def agree(spark, rows, parts=4, entries=256, rounds=4, scale=1024):
    table = spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in rows], SCHEMA).repartition(5)
    books = codes.train(table, parts=parts, entries=entries, rounds=rounds, scale=scale)
    got = codes.encode(table, books).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want, told = brute(sorted(rows, key=key), parts, entries, rounds, scale)
    assert books.entries == want
    assert sorted((tuple(r) for r in got), key=key) == sorted(told, key=key)


def vectors(seed, n, length, spread=1.0, step=None):
    rng = random.Random(seed)
    return [(i, [round(rng.uniform(-spread, spread), 1 if step else 9) for _ in range(length)]) for i in range(n)]


@pytest.mark.parametrize("length, entries", [(64, 16), (7, 16), (4, 300), (1, 3), (12, 1)])
def test_agrees_with_brute_force(spark, length, entries):
    agree(spark, vectors(length, 150, length), entries=entries)


def test_ties_repeated_rows_and_no_id(spark):
    rows = vectors(3, 60, 8, step=1) * 2 + [(None, [0.5] * 8)] * 3
    agree(spark, rows, entries=20, scale=2)


def test_huge_components_stay_exact(spark):
    rows = [(i, [x * 3e30 + 1 for x in v]) for i, v in vectors(9, 40, 8)] + [(i + 40, v) for i, v in vectors(8, 40, 8)]
    agree(spark, rows, entries=8)
    agree(spark, [(i, [x * 2.0 ** 40 for x in v]) for i, v in vectors(9, 60, 16)], entries=8)


def test_rows_that_take_no_part(spark):
    good = vectors(1, 30, 8)
    nan, inf = float("nan"), float("inf")
    bad = [(-9, None), (-8, []), (-7, [nan] * 8), (-6, [inf] + [0.0] * 7), (-5, [None] + [0.0] * 7), (99, [1.0] * 6)]
    table = spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in good + bad], SCHEMA)
    books = codes.train(table)
    assert len(books.entries[0]) == 30
    assert {r.vec_id for r in codes.encode(table, books).collect()} == {i for i, _ in good}
    none = table.filter("vec_id < 0 and vec_id <> -100")
    assert codes.train(none) is None
    assert codes.encode(none, None).collect() == []
    assert codes.encode(table.limit(0), books).collect() == []


@pytest.mark.parametrize("size", [1, 2, 8, 32])
def test_transform_is_scaled_and_in_sequency_order(size):
    matrix = codes.transformed(np.eye(size, dtype=np.int64)).T
    assert (matrix @ matrix.T == size * np.eye(size)).all()
    assert [(np.diff(row) != 0).sum() for row in matrix] == list(range(size))


def test_digits():
    for x in (0, 1, -1, 1 << 31, -(1 << 40), 3 ** 200, -(3 ** 199)):
        assert sum(d << (32 * i) for i, d in enumerate(codes.digits(x))) == x
        assert all(abs(d) < 1 << 33 for d in codes.digits(x))


def test_codebook_digest(spark):
    table = spark.createDataFrame([(0, [1.0, -0.5, 0.0, 2.0], "x", 1, 2, 3)], SCHEMA)
    books = codes.train(table, scale=4)
    assert books.digits() == "4,-2,0,8"
    code = codes.encode(table, books).select(codes.hexadecimal(codes.F.col("code"))).first()[0]
    assert code == "00000000" and hashlib.sha256(books.digits().encode()).hexdigest()
