"""Merkle trees over the paragraphs and sections of texts.

A paragraph is a line, cut further after a sentence's end or, in long runs, after a word whose hash
says so; cuts depend on the words around them alone, so an edit moves no later cut. A section is a
run of paragraphs that ends where a paragraph's hash says so (one in eight) or before an empty line.
A section's hash is made of its paragraphs' hashes, the root's of its sections'. Equal roots mean
equal texts; where roots differ, only branches that differ are opened to find what was edited.

The fingerprint is the tree as text: `root|section:paragraph,paragraph;section:...`, where a paragraph
is its hash and its length in code points, `hash.length`. All hashes have 128 bits, in hex: a section's is
that of the text behind its colon, the root's that of its sections' hashes joined by semicolons. A null or empty text has
the root of the empty tree and no sections. Likeness compares paragraphs by length: twice what both
trees hold, divided by what they hold together (1 for two empty texts).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from xxhash import xxh3_128_hexdigest, xxh3_128_intdigest, xxh32_intdigest

from meterspark.llm import blocks

RANGE_BYTES = 16 << 20
#: A section ends after a paragraph whose hash is 0 modulo this.
FAN_OUT = 8
#: Least length of a paragraph that a sentence's end closes; a run of this many characters without
#: one is cut at words.
LEAST, RUN = 32, 400
_PIECE = re.compile(r"[^\n]*?[.!?](?=\s)[^\S\n]*\n?|[^\n]*\n|[^\n]+")

RESULT = ("doc_id long, text string, edited string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def paragraphs(text: str) -> list[str]:
    """Consecutive pieces that make up the text."""
    out, open_ = [], ""
    for piece in _PIECE.findall(text):
        open_ += piece
        if len(open_) < LEAST and not open_.endswith("\n"):
            continue
        out.extend(_at_words(open_) if len(open_) > RUN else (open_,))
        open_ = ""
    if open_:
        out.append(open_)
    return out


def _at_words(run: str) -> list[str]:
    out, start = [], 0
    for m in re.finditer(r"\S+\s*", run):
        if m.end() - start >= LEAST and xxh32_intdigest(m.group().encode()) % 16 == 0:
            out.append(run[start:m.end()])
            start = m.end()
    return [*out, run[start:]] if start < len(run) else out


class Tree:
    """Sections as (hash, [(paragraph hash, length)])."""

    def __init__(self, text: str):
        self.sections: list[tuple[str, list[tuple[str, int]]]] = []
        leaves: list[tuple[str, int]] = []
        for piece in paragraphs(text):
            raw = piece.encode()
            h = xxh3_128_intdigest(raw)
            if leaves and piece == "\n":
                self._close(leaves)
                leaves = []
            leaves.append((f"{h:032x}", len(piece)))
            if h % FAN_OUT == 0:
                self._close(leaves)
                leaves = []
        if leaves:
            self._close(leaves)
        self.root = xxh3_128_hexdigest(";".join(h for h, _ in self.sections).encode())

    def _close(self, leaves: list[tuple[str, int]]) -> None:
        own = ",".join(f"{h}.{n}" for h, n in leaves)
        self.sections.append((xxh3_128_hexdigest(own.encode()), leaves))

    def __str__(self) -> str:
        return self.root + "|" + ";".join(
            f"{h}:" + ",".join(f"{p}.{n}" for p, n in leaves) for h, leaves in self.sections)


def likeness(a: Tree, b: Tree) -> float:
    """Equal roots and equal sections are not opened."""
    if a.root == b.root:
        return 1.0
    other = Counter(h for h, _ in b.sections)
    same, left_a = 0, []
    for h, leaves in a.sections:
        if other[h] > 0:
            other[h] -= 1
            same += sum(n for _, n in leaves)
        else:
            left_a.extend(leaves)
    left_b: Counter = Counter()
    taken = Counter(h for h, _ in b.sections) - other
    for h, leaves in b.sections:
        if taken[h] > 0:
            taken[h] -= 1
        else:
            left_b.update(leaves)
    for leaf in left_a:
        if left_b[leaf] > 0:
            left_b[leaf] -= 1
            same += leaf[1]
    size = sum(n for t in (a, b) for _, leaves in t.sections for _, n in leaves)
    return 2 * same / size if size else 1.0


def changes(a: str, b: str) -> list[tuple[int, int]]:
    """Spans of `b` (code points) that lie in branches which `a` does not have."""
    known = Counter(leaf for _, leaves in Tree(a).sections for leaf in leaves)
    spans, at = [], 0
    for _, leaves in Tree(b).sections:
        for leaf in leaves:
            if known[leaf] > 0:
                known[leaf] -= 1
            elif spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + leaf[1])
            else:
                spans.append((at, at + leaf[1]))
            at += leaf[1]
    return spans


def _ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """docs (doc_id, text) with the range of ids that each belongs to, ids ascending; how many."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // RANGE_BYTES))
    cuts = docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) \
        if parts > 1 else []
    bounds = np.unique(np.array(cuts or [], np.float64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, ids.to_numpy(np.float64, na_value=-np.inf), side="right")
        return pd.Series(at.astype(np.int32))

    return docs.withColumn("_range", range_of("doc_id")), parts


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with the next in its range; rows come in order, and a range ends with the first
    document of the one after it, marked `_after`."""
    last, tree = None, None
    for batch in blocks.texts_of(batches, 256):
        out = []
        for doc_id, text, after in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(),
                                       batch["_after"].to_pylist()):
            text = text or ""
            own = Tree(text)
            if last is not None:
                n = len(last[1])
                half = n // 2
                edited = last[1][:n - half] + text[:half]
                changed = Tree(edited)
                out.append((last[0], last[1], edited, str(tree), str(changed),
                            likeness(tree, changed), likeness(tree, own)))
            last, tree = (None, None) if after else ((doc_id, text), own)
        if out:
            yield blocks.batch_of(out, RESULT)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its text (null: empty), the text with its second half replaced by the head of
    the next document, the fingerprints of both, and the likeness to the edited text and to the next
    document.

    The next document is the one with the next id (equal ids: by text; a null id comes first); after
    the last comes the first. Texts are shuffled once, by ranges of ids; a range learns the first
    document of the range after it, so no task sees more than a range. A single document is its own
    next. Equal rows follow each other. Extra columns play no part.
    """
    ranged, parts = _ranges(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    # One row per range, so the broadcast is as small as the number of ranges.
    firsts = ranged.groupBy("_range").agg(F.min("doc_id").alias("_first"),
                                          F.max(F.col("doc_id").isNull()).alias("_null"))
    one = W.orderBy("_range")
    firsts = firsts.select(F.when(F.col("_null"), F.lit(None)).otherwise(F.col("_first")).alias("_first"),
                           F.coalesce(F.lag("_range").over(one),
                                      F.max("_range").over(W.partitionBy())).alias("_before"))
    heads = (ranged.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
             .join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("_first")))
             .groupBy("doc_id", "_before").agg(F.min("text").alias("text"))
             .select("doc_id", "text", F.col("_before").alias("_range"), F.lit(True).alias("_after")))
    rows = (ranged.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "_range",
                          F.lit(False).alias("_after")).unionByName(heads))
    return (rows.repartitionById(parts, "_range").sortWithinPartitions("_range", "_after", "doc_id", "text")
            .select("doc_id", "text", "_after").mapInArrow(_pairs, RESULT))
