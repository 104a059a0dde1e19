"""How far the sources of each language part from each other, and by which terms.

1. Documents are count-vectorized per language: a block of documents numbers the terms of each language
   as they come and holds an exact sparse vector (term, count) per document. Its column counts
   (documents that hold a term) and its sums per source go on, a row per term. Rows of one term meet in
   its slice, where terms of fewer than `min_docs` documents are left out. No vocabulary size is set, and
   no vocabulary passes through the driver: kept terms are a table.
2. Sums of vectors per language and source are integers from start to end.
3. Pairs of sources are evaluated from nonzero sums alone: terms that a source lacks all have the same
   probability there, so they are counted, not visited. Terms that just one of a pair has come from
   a histogram of its counts.

A kept term's probability in a group is p = 1 + floor(unit * (n + 1) / (N + V)) with its count n, all
counts N of kept terms, and V kept terms of the language; the divergence of p from q at a term is
floor((p - q)^2 / q). Integers are wide enough at every step (a divergence is below 2**60, and is summed
in two parts), so all of it is exact.

Null text, language or source is the empty string; a text without terms still makes its group occur.
Without kept terms (V = 0) all pairs have 0. Repeated rows are documents of their own. An empty table
gives no rows. Only the three named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterspark.llm.blocks import texts_of
from meterspark.llm.shingles import LOWER, Places
from meterspark.llm.storage import kept, sized

#: Bytes of a text as a term has them: A-Z become a-z, other ASCII characters that are no letters a space.
#: Bytes of all other characters stay, so a term is a run of what is left.
TERM_BYTES = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in LOWER)

#: Terms (with repetitions) after which a block ends, and bytes of text for each slice of the terms.
BLOCK_TERMS, SLICE_BYTES = 1 << 21, 1 << 24

UNIT = 1_000_000_000

SUMMED = "lang string, term string, docs long, sources array<string>, counts array<long>"
KEPT = "lang string, term string, n long, sources array<string>, counts array<long>"


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text in order, A-Z lower-cased."""
    return (text or "").encode().translate(TERM_BYTES).split()


class _Block:
    """Documents of one language: a number for each term, and the terms and source of each document."""

    def __init__(self) -> None:
        self.places, self.sources = Places(), Places()
        self.documents, self.owners = [], []

    def add(self, source: str, terms: list[bytes]) -> None:
        self.documents.append(np.fromiter(map(self.places.__getitem__, terms), np.int64, len(terms)))
        self.owners.append(self.sources[source])

    def vectors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sparse vectors: document, term and count of each entry that is not 0."""
        document = np.repeat(np.arange(len(self.documents)), [len(d) for d in self.documents])
        entry, count = np.unique(document * max(1, len(self.places)) + np.concatenate(self.documents),
                                 return_counts=True)
        return *np.divmod(entry, max(1, len(self.places))), count

    def summed(self, lang: str) -> pa.RecordBatch:
        """Per term: how many documents hold it, and its sum for each source that has it."""
        document, term, count = self.vectors()
        docs = np.bincount(term, minlength=len(self.places))
        key = term * len(self.sources) + np.array(self.owners)[document]
        terms, sources, sums = _sums(key, count, len(self.sources))
        return _lists(pa.array([lang] * len(self.places), pa.string()),
                      pa.array(list(self.places), pa.binary()).cast(pa.string()), docs,
                      pa.array(list(self.sources), pa.string()), terms, sources, sums, "docs")


def _sums(key: np.ndarray, count: np.ndarray, sources: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term, source and sum of each key (term * sources + source), in that order."""
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    sums = np.add.reduceat(count, starts) if len(starts) else count
    return *np.divmod(key[starts], sources), sums


def _lists(langs: pa.Array, words: pa.Array, per_term: np.ndarray, names: pa.Array, terms: np.ndarray,
           sources: np.ndarray, sums: np.ndarray, called: str) -> pa.RecordBatch:
    """A row per term, with its sources and sums as lists. `terms` ascend and miss none of them."""
    offsets = pa.array(np.searchsorted(terms, np.arange(len(words) + 1)).astype(np.int32))
    return pa.record_batch(
        [langs, words, pa.array(per_term, pa.int64()), pa.ListArray.from_arrays(offsets, names.take(pa.array(sources))),
         pa.ListArray.from_arrays(offsets, pa.array(sums, pa.int64()))],
        names=["lang", "term", called, "sources", "counts"])


def _vectorized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[str, _Block] = {}
    held = 0
    for batch in texts_of(batches):
        for lang, source, text in zip(*(batch[c].to_pylist() for c in ("lang", "source", "text"))):
            terms = terms_of(text)
            blocks.setdefault(lang, _Block()).add(source, terms)
            held += len(terms) + 1
        if held >= BLOCK_TERMS:
            for lang, block in blocks.items():
                yield from texts_of([block.summed(lang)], 1 << 16)
            blocks, held = {}, 0
    for lang, block in blocks.items():
        yield from texts_of([block.summed(lang)], 1 << 16)


def _kept(min_docs: int):
    """Of one slice: the terms that enough documents hold, with their sums over all blocks."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        # A term holds no space, so what stands before the last one is its language.
        marked = compute.binary_join_element_wise(table["lang"], table["term"], " ").combine_chunks() \
            .dictionary_encode()
        code = marked.indices.to_numpy().astype(np.int64)
        docs = np.zeros(len(marked.dictionary), np.int64)
        np.add.at(docs, code, table["docs"].to_numpy())
        counts = table["counts"].combine_chunks()
        names = table["sources"].combine_chunks().flatten().dictionary_encode()
        each = np.repeat(code, counts.value_lengths().to_numpy())
        enough = docs >= min_docs
        take = enough[each]
        number = np.cumsum(enough) - 1
        terms, sources, sums = _sums(
            number[each[take]] * max(1, len(names.dictionary)) + names.indices.to_numpy()[take],
            counts.flatten().to_numpy()[take], max(1, len(names.dictionary)))
        words = [w.rpartition(" ") for w in marked.dictionary.filter(pa.array(enough)).to_pylist()]
        n = np.add.reduceat(sums, np.searchsorted(terms, np.arange(len(words)))) if words else sums
        return pa.Table.from_batches([_lists(
            pa.array([w[0] for w in words], pa.string()), pa.array([w[2] for w in words], pa.string()), n,
            names.dictionary, terms, sources, sums, "n")])
    return run


def kept_terms(docs: DataFrame, min_docs: int = 3, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """(lang, term, n, sources, counts), stored: each term that `min_docs` documents of its language hold,
    how often it occurs in the language, and in which sources how often."""
    named = _named(docs, (lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    size = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    summed = named.mapInArrow(_vectorized, SUMMED)
    slices = F.pmod(F.xxhash64("lang", "term"), F.lit(-(-size // SLICE_BYTES) or 1)).alias("slice")
    return kept(summed.select("*", slices).groupBy("slice").applyInArrow(_kept(min_docs), KEPT))


def _named(docs: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to) for c, to in columns])


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + terms)), in integers; `total + terms` is not 0."""
    def wide(x: Column) -> Column:
        return x.cast("decimal(20,0)")

    top = wide(n + 1) * F.lit(UNIT).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, wide(total + terms))


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q). Probabilities are 10^9 + 1 at most, so 64 bits do."""
    return F.call_function("div", (p - q) * (p - q), q)


def total(value: Column) -> Column:
    """The sum of 64-bit values as a decimal: their upper and lower parts are summed as integers."""
    upper, lower = F.sum(F.shiftright(value, 30)), F.sum(value.bitwiseAND(F.lit((1 << 30) - 1).cast("long")))
    return upper.cast("decimal(28,0)") * F.lit(1 << 30).cast("decimal(10,0)") + lower.cast("decimal(28,0)")


def divergence(docs: DataFrame, min_docs: int = 3, top: int = 200, text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) of every language and source that occurs.

    Part `pair`: item is each other source of the language, value its divergence over all kept terms.
    Part `term`: item is each kept term that the source uses more than its language, value its
    divergence from the language; the first `top` of them. Ranked by value, then item.
    """
    terms = kept_terms(docs, min_docs, text_col, lang_col, source_col)
    sums = terms.select("lang", "term", F.col("n").alias("all"), F.explode(F.arrays_zip("sources", "counts")).alias("e")) \
        .select("lang", F.col("e.sources").alias("source"), "term", F.col("e.counts").alias("n"), "all")
    groups = _named(docs, (lang_col, "lang"), (source_col, "source")).distinct()
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total"))
    counted = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
    zero = F.lit(0).cast("long")
    stats = sized(groups.join(counted, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "own", "v", "lang_total")]).withColumn(
        "absent", F.when(F.col("v") > 0, probability(zero, F.col("total"), F.col("v")))), "groups")
    chances = sums.join(stats, ["lang", "source"]).select(
        "lang", "source", "term", "absent", probability(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        probability(F.col("all"), F.col("lang_total"), F.col("v")).alias("q"))
    return _pairs(chances, stats).unionByName(_terms(chances, top))


def _pairs(chances: DataFrame, stats: DataFrame) -> DataFrame:
    """Each source against each other of its language."""
    a = stats.select("lang", F.col("source").alias("x"), F.col("absent").alias("absent_x"),
                     F.col("own").alias("own_x"), "v")
    b = stats.select("lang", F.col("source").alias("y"), F.col("absent").alias("absent_y"),
                     F.col("own").alias("own_y"))

    # All terms of x against their absence in y, and the other way; a count's terms are alike.
    alike = sized(chances.groupBy("lang", "source", "p").agg(
        F.count(F.lit(1)).cast("decimal(19,0)").alias("terms")), "alike")

    def alone(value: Column) -> Column:
        return F.sum(value.cast("decimal(19,0)") * F.col("terms")).alias("value")

    x_only = alike.withColumnRenamed("source", "x").join(b, "lang").filter("x <> y").groupBy("lang", "x", "y").agg(
        alone(distance(F.col("p"), F.col("absent_y"))))
    y_only = alike.withColumnRenamed("source", "y").join(a, "lang").filter("x <> y").groupBy("lang", "x", "y").agg(
        alone(distance(F.col("absent_x"), F.col("p"))))

    # Terms that both have, in place of what was added for them above.
    one, two = ([F.col(c).alias(f"{c}_{to}") for c in ("source", "p", "absent")] for to in ("1", "2"))
    met = chances.select("lang", "term", *one).join(chances.select("lang", "term", *two), ["lang", "term"]).filter(
        "source_1 < source_2")

    def instead(x: str, y: str) -> Column:
        return (distance(F.col(f"p_{x}"), F.col(f"p_{y}")) - distance(F.col(f"p_{x}"), F.col(f"absent_{y}"))
                - distance(F.col(f"absent_{x}"), F.col(f"p_{y}")))

    shared = kept(met.groupBy("lang", "source_1", "source_2").agg(
        total(instead("1", "2")).alias("there"), total(instead("2", "1")).alias("back"),
        F.count(F.lit(1)).alias("both")))
    both = shared.select("lang", F.col("source_1").alias("x"), F.col("source_2").alias("y"),
                         F.col("there").alias("value"), "both").unionByName(
        shared.select("lang", F.col("source_2").alias("x"), F.col("source_1").alias("y"),
                      F.col("back").alias("value"), "both"))
    added = x_only.unionByName(y_only).withColumn("both", F.lit(0).cast("long")).unionByName(both) \
        .groupBy("lang", "x", "y").agg(F.sum("value").alias("value"), F.sum("both").alias("both"))
    neither = (F.col("v") - F.col("own_x") - F.col("own_y") + F.coalesce("both", F.lit(0))).cast("decimal(19,0)")
    none = F.lit(0).cast("decimal(38,0)")
    value = F.coalesce("value", none) + F.when(F.col("v") > 0, distance(
        F.col("absent_x"), F.col("absent_y")).cast("decimal(19,0)") * neither).otherwise(none)
    told = a.join(b, "lang").filter("x <> y").join(added, ["lang", "x", "y"], "left").select(
        "lang", F.col("x").alias("source"), F.lit("pair").alias("part"), F.col("y").alias("item"),
        value.cast("long").alias("value"))
    return told.withColumn("rank", _rank())


def _terms(chances: DataFrame, top: int) -> DataFrame:
    """The terms that set a source apart from its language."""
    more = chances.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        distance(F.col("p"), F.col("q")).alias("value"))
    # Each task passes on no more than `top` of a group before they meet.
    return more.withColumn("rank", _rank()).filter(F.col("rank") <= top)


def _rank() -> Column:
    return F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
