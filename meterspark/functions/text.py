"""Comparing place names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def plain_name(name: Column) -> Column:
    """Lower case, with everything but letters and digits turned into single blanks."""
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))


#: 64-bit words of a sketch.
SKETCH_WORDS = 4


def _sketch(items: Column) -> Column:
    """Four words of bits, one bit for each item and how often it has come so far ("a" once, "a" twice).

    Items may share a bit, which only makes two sketches look closer than they are.
    """
    def places(ordered: Column) -> Column:
        return F.array_distinct(F.transform(ordered, lambda c, i: F.pmod(F.xxhash64(
            c, i - F.array_position(ordered, c).cast("int")), F.lit(64 * SKETCH_WORDS)).cast("int")))

    def of_word(w: int) -> Callable[[Column], Column]:
        return lambda p: F.floor(p / 64) == w

    def words(bits: Column) -> Column:
        return F.struct(*[F.aggregate(
            F.filter(bits, of_word(w)), F.lit(0).cast("long"),
            lambda word, p: word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), p % 64))).alias(f"w{w}")
            for w in range(SKETCH_WORDS)])

    return _once(_once(F.array_sort(items), places), words)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, where `value` is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def letter_sketch(name: Column) -> Column:
    """The letters of a name, in any order."""
    return _sketch(F.regexp_extract_all(name, F.lit("(?s)."), F.lit(0)))


def pair_sketch(name: Column) -> Column:
    """The pairs of letters that follow each other in a name."""
    return _sketch(F.regexp_extract_all(name, F.lit("(?s)(?=(..))"), F.lit(1)))


def lacking(x: Column, y: Column) -> Column:
    """How many bits of one sketch the other lacks."""
    return sum((F.bit_count(x[f"w{w}"].bitwiseAND(F.bitwise_not(y[f"w{w}"]))) for w in range(1, SKETCH_WORDS)),
               F.bit_count(x["w0"].bitwiseAND(F.bitwise_not(y["w0"]))))


def fewest_edits(a: Column, b: Column, length_a: Column, length_b: Column) -> Column:
    """No more edits than it takes to turn one name into the other, from their letter sketches: every letter
    that one has and the other lacks takes an edit. Bit operations alone."""
    return F.greatest(lacking(a, b), lacking(b, a), F.abs(length_a - length_b))


def similarity(a: Column, b: Column) -> Column:
    """1 for equal strings, falling with each edit relative to the longer one."""
    longest = F.greatest(F.length(a), F.length(b), F.lit(1))
    return F.lit(1.0) - F.levenshtein(a, b) / longest


def any_order_similarity(a: Column, b: Column) -> Column:
    """`similarity`, or nearly that of both names with their words sorted, if greater; so
    "hospitalet l" finds "l hospitalet"."""
    def ordered(name: Column) -> Column:
        return F.array_join(F.array_sort(F.split(name, " ")), " ")

    return F.greatest(similarity(a, b), F.lit(0.95) * similarity(ordered(a), ordered(b)))
