"""Near copies by MinHash: documents whose sets of word shingles are alike, and the groups they make.

1. A document's set is its distinct word shingles; its signature the minima of `HASHES` universal hash
   functions over it. Equal sets are one node, however many rows have them.
2. Signatures are cut into bands; nodes that agree in all rows of a band share a bucket. `banding`
   takes the longest bands that miss a pair just at the threshold once in 10^7 at most.
3. Each bucket has a hub: the member whose buckets hold the most members in all, which is how the text
   looks that others were made from. The signatures of each other member and its hubs must agree as often
   as those of a linked pair do (but for one pair in 10^9). Only in buckets with a member unlike the
   hub, members are compared with each other. What agrees makes families, by alternating large-star and
   small-star steps.
4. Full sets are made for members of families alone. They decide on each member and its hubs; parts of a
   family that this leaves apart are compared with each other, the sizes and the shingles that no
   other member has ruling out most pairs. A task returns links that connect, not all pairs that link.
   Large buckets and families go in parts, each pair of parts in its own task.

Documents link when 100 * |A and B| >= percent * |A or B|. A-Z are lower-cased, words are runs of
anything but space and \\x09-\\x0D. With fewer than `words` words the whole sequence is the set; without
words, or with null text, it is empty and links with nothing. Ids are integers. A row without id links
with nothing, and is kept without a component. Different texts under one id are documents of their own
that share an id: each row gets the component of its own set. Repeated rows belong together. An empty
table gives no rows. Shingles are told apart by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from meterspark.llm import blocks
from meterspark.llm.shingles import rolling, whole_windows, word_codes, words_of
from meterspark.llm.stars import star_components
from meterspark.llm.storage import kept, sized

HASHES = 128

#: How often a pair just at the threshold shares no band, and how often its signatures agree too seldom.
MISSED, MISJUDGED = 1e-7, 1e-9

#: Members of a bucket in a part of it, and shingles of all members in a part of a family.
PART_ROWS, PART_GRAMS = 1 << 10, 1 << 20

SIGNED = "doc_id long, n long, digest binary, signature binary"
WHOLE = "digest binary, grams binary"
PAIRS = "x long, y long"


def banding(percent: int, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows of each."""
    like = percent / 100
    rows = max((r for r in range(1, hashes + 1) if (1 - like ** r) ** (hashes // r) <= MISSED), default=1)
    return hashes // rows, rows


def least_agreement(percent: int, hashes: int = HASHES) -> int:
    """The most k for which a pair just at the threshold agrees in less than k minima with a chance of
    `MISJUDGED` at most."""
    like, below, k = percent / 100, 0.0, 0
    while k < hashes:
        below += comb(hashes, k) * like ** k * (1 - like) ** (hashes - k)
        if below > MISJUDGED:
            break
        k += 1
    return k


def universal(hashes: int = HASHES, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of hash functions (a * x + b) mod 2**64 >> 32."""
    drawn = np.random.default_rng(seed).integers(0, 1 << 64, (2, hashes), np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = [words_of(t, lower=True) for t in texts]
    codes, starts = word_codes(split)
    hashes, whole = rolling(codes, words), whole_windows(starts, words)
    out = []
    for own, a, b in zip(split, starts[:-1].tolist(), starts[1:].tolist()):
        if len(own) >= words:
            out.append(np.unique(hashes[a:b][whole[a:b]]))
        else:
            out.append(np.array([xxh3_64_intdigest(b" ".join(own), seed=words)] if own else [], np.uint64))
    return out


def minima(sets: list[np.ndarray], functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of each (not empty) set: the least 32-bit value of each function."""
    every = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[:-1]], dtype=np.int64)])
    out = np.empty((len(sets), len(functions[0])), "<u4")
    for i, (a, b) in enumerate(zip(*functions)):
        values = every * a
        values += b
        out[:, i] = np.minimum.reduceat(values, starts) >> np.uint64(32)
    return out


def _signed(words: int):
    functions = universal()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks.texts_of(batches, 128):
            sets = shingle_sets(batch["text"].to_pylist(), words)
            some = [s for s in sets if len(s)]
            signatures = iter(minima(some, functions)) if some else iter(())
            yield blocks.batch_of([
                (doc_id, len(s), xxh3_128_digest(s.tobytes()), next(signatures).tobytes() if len(s) else None)
                for doc_id, s in zip(batch["doc_id"].to_pylist(), sets)], SIGNED)
    return run


def _whole(words: int):
    """Full sets by their digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks.texts_of(batches, 128):
            yield blocks.batch_of([(xxh3_128_digest(s.tobytes()), s.tobytes())
                                   for s in shingle_sets(batch["text"].to_pylist(), words) if len(s)], WHOLE)
    return run


def _agreeing(least: int):
    """Pairs whose signatures agree at least so often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks.texts_of(batches, 4096):
            a, b = (_stacked(batch[c]) for c in ("signature_x", "signature_y"))
            near = (a == b).sum(axis=1) >= least
            yield batch.select(["x", "y"]).filter(pa.array(near))
    return run


def _stacked(signatures: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), "<u4").reshape(len(signatures), HASHES)


def _linked(percent: int):
    """Pairs whose full sets link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks.texts_of(batches):
            a, b = ([np.frombuffer(g, np.uint64) for g in batch[c].to_pylist()] for c in ("grams_x", "grams_y"))
            near = [links_to(x, y, percent) for x, y in zip(a, b)]
            yield batch.select(["x", "y"]).filter(pa.array(near, pa.bool_()))
    return run


def links_to(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _alike(least: int):
    """Of the members of one or two parts of a bucket: pairs whose signatures agree, as many as connect
    all that such pairs connect."""
    def run(table: pa.Table) -> pa.Table:
        node, signatures = table["node"].to_numpy(), _stacked(table["signature"].combine_chunks())
        left, queue, pairs = np.arange(len(node)), [], []
        while len(left):
            if not queue:
                queue, left = [left[0]], left[1:]
            i = queue.pop()
            near = (signatures[left] == signatures[i]).sum(axis=1) >= least
            pairs += [(node[i], node[j]) for j in left[near].tolist()]
            queue += left[near].tolist()
            left = left[~near]
        return blocks.table_of(pairs, PAIRS)
    return run


def _bridges(percent: int, least: int):
    """Of the members of one or two parts of a family: links between what is not connected yet, as many
    as connect all that links connect."""
    def run(table: pa.Table) -> pa.Table:
        node, n = table["node"].to_numpy(), table["n"].to_numpy()
        sets = [np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist()]
        signatures = _stacked(table["signature"].combine_chunks())
        _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        held = np.add.reduceat((counts[inverse] > 1).astype(np.int64), starts)
        _, label = np.unique(table["label"].to_numpy(), return_inverse=True)
        able = np.flatnonzero(100 * held >= percent * n)
        members: dict[int, list[int]] = {}
        for i in able.tolist():
            members.setdefault(int(label[i]), []).append(i)
        left, queue, pairs = able, [], []
        while len(left):
            if not queue:
                queue = members[int(label[left[0]])]
                left = left[label[left] != label[left[0]]]
            i = queue.pop()
            may = left[(100 + percent) * np.minimum(held[left], held[i]) >= percent * (n[left] + n[i])]
            may = may[(signatures[may] == signatures[i]).sum(axis=1) >= least]
            joined = set()
            for j in may.tolist():
                if label[j] not in joined and links_to(sets[i], sets[j], percent):
                    pairs.append((node[i], node[j]))
                    joined.add(label[j])
                    queue = queue + members[int(label[j])]
            if joined:
                left = left[~np.isin(label[left], list(joined))]
        return blocks.table_of(pairs, PAIRS)
    return run


def signed(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: set size, digest of the whole set, and signature, which is null for an empty set."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(_signed(words), SIGNED)


def _with(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
    """`pairs` (x, y) with columns of both nodes."""
    for end in ("x", "y"):
        pairs = pairs.join(of.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
    return pairs


def _in_parts(rows: DataFrame, key: str, parts: DataFrame) -> DataFrame:
    """Rows of the keys in `parts` (key, parts), once for each pair of parts that they are to be in."""
    return (rows.join(parts, key).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
            .drop("part", "other", "parts"))


def _parts(size: Column, each: int) -> Column:
    return F.ceil(size / F.lit(each)).cast("int").alias("parts")


def agreeing(nodes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (x, y) of `nodes` (node, signature) whose signatures agree as those of linked pairs do: each
    member of a bucket with its hub, and such pairs as connect the others. The signatures of all nodes that
    share a bucket: most share none, so what follows is read from these."""
    bands, rows = banding(percent)
    least = least_agreement(percent)
    band = F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")
    keyed = nodes.select("node", "signature", band).select("node", F.xxhash64(
        "band", F.expr(f"substring(signature, band * {4 * rows} + 1, {4 * rows})")).alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = kept(keyed.join(shared, "bucket"))
    weighed = met.join(met.groupBy("node").agg(F.sum("members").alias("weight")), "node")
    hubs = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("h")).select(
        "bucket", F.col("h.node").alias("hub"))
    to_hub = kept(met.join(hubs, "bucket").filter("node <> hub").select(
        "bucket", "members", F.col("node").alias("x"), F.col("hub").alias("y")))
    signatures = sized(nodes.select("node", "signature").join(met.select("node").distinct(), "node", "left_semi"),
                       "signatures")
    near = kept(_with(to_hub.select("x", "y").distinct(), signatures, "signature")
                .mapInArrow(_agreeing(least), PAIRS))
    unlike = to_hub.filter("members > 2").join(near, ["x", "y"], "left_anti").groupBy("bucket").agg(
        _parts(F.max("members"), PART_ROWS))
    mixed = _in_parts(met.select("bucket", "node"), "bucket", unlike).join(signatures, "node")
    return near, mixed.groupBy("bucket", "low", "high").applyInArrow(_alike(least), PAIRS), signatures


def links(docs: DataFrame, nodes: DataFrame, words: int, percent: int, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Links (a, b) between `nodes` (node, digest, doc_id, n, signature) that connect them as all links do."""
    near, others, signatures = agreeing(nodes, percent)
    families = kept(star_components(near.unionByName(others).select(
        F.col("x").alias("a"), F.col("y").alias("b"))).withColumnRenamed("label", "family"))
    grams = full_sets(docs, nodes.join(families, "node", "left_semi"), words, id_col, text_col)
    first = kept(_ends(_with(near, grams, "grams").select("x", "y", "grams_x", "grams_y").mapInArrow(
        _linked(percent), PAIRS)))

    joined = star_components(first)
    told = kept(families.join(joined, "node", "left").join(nodes.select("node", "n"), "node")
                .select("family", "node", "n", F.coalesce("label", "node").alias("label")))
    several = told.groupBy("family").agg(F.min("label").alias("l"), F.max("label").alias("h"), _parts(
        F.sum("n"), PART_GRAMS)).filter("l < h").select("family", "parts")
    rest = (_in_parts(told, "family", several).join(grams.select("node", "grams"), "node")
            .join(signatures, "node")
            .groupBy("family", "low", "high").applyInArrow(_bridges(percent, least_agreement(percent)), PAIRS))
    # The stars of the first links connect what those do, so labels start from them and not from the links.
    return joined.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(_ends(rest))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("a"), F.col("y").alias("b"))


def full_sets(docs: DataFrame, nodes: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(node, grams), stored, of the nodes named. Texts are dealt by id at every size (no switch to a
    broadcast), and just those that stand for a node are taken apart once more."""
    wanted = nodes.select("doc_id").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = texts.join(wanted.hint("merge"), "doc_id").select("text").mapInArrow(_whole(words), WHOLE)
    return kept(found.groupBy("digest").agg(F.first("grams").alias("grams"))
                .join(nodes.select("node", "digest"), "digest").select("node", "grams"))


def near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per document: n_shingles, component_id (the smallest id that links reach, its own included) and
    kept, whether that is its own."""
    rows = kept(signed(docs, words, id_col, text_col))
    # Numbers are given to stored rows, so they stay the same whenever a row is read again.
    nodes = kept(rows.filter("n > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("signature").alias("signature"))) \
        .withColumn("node", F.monotonically_increasing_id())
    labels = star_components(links(docs, nodes, words, percent, id_col, text_col))
    named = labels.join(nodes.select("node", "digest", "doc_id"), "node")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component"))
    linked = named.join(least, "label").select("digest", "component")
    owners = nodes.select("digest", F.col("doc_id").alias("own")).join(linked, "digest", "left").select(
        "digest", F.coalesce("component", "own").alias("component"))
    found = rows.select("doc_id", "n", "digest").join(owners, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
