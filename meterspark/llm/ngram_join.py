"""Documents whose sets of word n-grams are alike, and the groups that such links make.

Two documents link when 100 * |A and B| >= percent * |A or B|. The join is a product of the sparse
document by n-gram incidence matrix with its transpose, cut down exactly:

1. The number of documents that hold each n-gram is found with `blocks.key_totals`. An n-gram of one
   document cannot be shared, so a document needs `percent` of its n-grams shared to link at all;
   most documents drop out here. Truncated hashes only make a count too large, never too small.
2. Documents with equal sets are one row of the matrix, named by their smallest id.
3. Rows that link share one of their rarest n - ceil(percent * n / 100) + 1 n-grams. For each such
   column, the row with the fewest unshared n-grams (per size class) is the column's hub, and the
   product of the column's rows with their hub is taken in blocks: overlaps accumulate per row, and
   those below the bound that the sizes give are discarded.
4. Rows of one column that are still apart are multiplied with each other, but for pairs that their
   sizes, their position in the order of n-grams, or their distances from one hub rule out (Jaccard
   distance is a metric). So no link between groups is lost, and a group of many near copies costs
   one product per member, not one per pair.

Ids are integers. A document without words or with null text has the empty set and links with
nothing; one with fewer than `words` words has its whole sequence as its set. Equal rows belong
together like any copies. A row without id never links, and its component is null. Extra columns
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from meterspark.llm import blocks
from meterspark.llm.components import components
from meterspark.llm.shingles import rolling, whole_windows, word_codes, words_of
from meterspark.llm.storage import kept

#: Rows of one column that are compared with each other in one task.
REST_ROWS = 1 << 14

SETS = "doc_id long, n long, signature binary, shared int, grams binary"
POSTINGS = "gram long, node long, n int, alone int, at int"
PAIRS = "x long, hub long"
LINKS = "x long, hub long, overlap long, size_x long, size_hub long"


def _sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    split = [words_of(t, lower=True) for t in texts]
    codes, starts = word_codes(split)
    hashes, inside = rolling(codes, words), whole_windows(starts, words)
    out = []
    for i, own in enumerate(split):
        a, b = int(starts[i]), int(starts[i + 1])
        if len(own) >= words:
            out.append(np.unique(hashes[a:b][inside[a:b]]))
        else:
            out.append(np.array([xxh3_64_intdigest(b" ".join(own), seed=words)] if own else [],
                                np.uint64))
    return out


def _least_overlap(n, percent: int):
    """The overlap that a set of `n` needs with any set it links to."""
    return -(-n * percent // 100)


def gram_sets(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str,
              digest: Column | None = None) -> DataFrame:
    """Per document: set size, signature of the set, and, where enough n-grams are shared with other
    documents to link at all, how many are, and those n-grams, rarest first. A `digest` of the row,
    if given, comes along."""
    blocked, size = blocks.in_blocks(docs, id_col, text_col,
                                     more=() if digest is None else (digest.alias("digest"),))
    carried = digest is not None
    layout = SETS + ", digest binary" if carried else SETS
    expected = max(1, size // 6)
    bits = min(64, max(32, expected.bit_length() + 10))
    low = np.uint64(64 - bits)

    def columns(table: pa.Table):
        sets = _sets(table["text"].to_pylist(), words)
        every = np.concatenate([np.zeros(0, np.uint64), *sets])
        return sets, every, np.unique((every >> low) << low, return_inverse=True, return_counts=True)

    def keys_of(table: pa.Table) -> blocks.Keys:
        _, _, (keys, _, counts) = columns(table)
        return keys, None, counts.astype(np.uint64)

    def doubled(total: np.ndarray) -> np.ndarray:
        """0 for one document, then one more whenever the number doubles."""
        return np.frexp(total.astype(np.float64))[1].astype(np.uint64) - np.uint64(1)

    def rows(table: pa.Table, answers: pa.Table) -> pa.Table:
        sets, every, (_, inverse, _) = columns(table)
        rank = blocks.answers_of(answers)[inverse]
        out, at = [], 0
        more = zip(table["digest"].to_pylist()) if carried else repeat(())
        for doc_id, grams, kept_along in zip(table["doc_id"].to_pylist(), sets, more):
            own, n = rank[at:at + len(grams)], len(grams)
            at += n
            shared = int((own > 0).sum())
            near = n > 0 and shared >= _least_overlap(n, percent)
            order = np.argsort(own, kind="stable")[n - shared:] if near else None
            out.append((doc_id, n, xxh3_128_digest(grams.tobytes()), shared if near else None,
                        grams[order].tobytes() if near else None, *kept_along))
        return blocks.table_of(out, layout)

    totals = blocks.key_totals(blocked, keys_of, doubled,
                               blocks.doubling(expected, blocks.RANGE_KEYS), bits)
    return blocked.groupBy("_block").cogroup(totals.groupBy("_block")).applyInArrow(
        lambda t, a: rows(t, a) if t.num_rows else blocks.table_of([], layout), layout)


def _postings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in blocks.texts_of(batches):
        grams, nodes, sizes, alone, at = [], [], [], [], []
        for r in batch.to_pylist():
            single = r["n"] - r["shared"]
            take = r["n"] - _least_overlap(r["n"], percent) + 1 - single
            grams.append(np.frombuffer(r["grams"], np.int64)[:take])
            nodes.append(np.full(take, r["node"], np.int64))
            sizes.append(np.full(take, r["n"], np.int32))
            alone.append(np.full(take, single, np.int32))
            at.append(np.arange(single, single + take, dtype=np.int32))
        if grams:
            yield pa.record_batch([np.concatenate(c) for c in (grams, nodes, sizes, alone, at)],
                                  schema=blocks.arrow_schema(POSTINGS))


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlaps of the rows of a block with their hubs, a run of rows with one hub at a time."""
    for batch in blocks.texts_of(batches):
        hubs = batch["hub"].to_numpy()
        grams, own = batch["grams"], batch["hub_grams"]
        overlaps = np.zeros(len(hubs), np.int64)
        edges = np.flatnonzero(np.diff(hubs, prepend=hubs[:1] - 1, append=hubs[-1:] + 1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            column = np.sort(np.frombuffer(own[a].as_py(), np.uint64))
            rows = [np.frombuffer(grams[i].as_py(), np.uint64) for i in range(a, b)]
            entries = np.concatenate(rows)
            where = np.minimum(np.searchsorted(column, entries), len(column) - 1)
            ends = np.cumsum([len(r) for r in rows])
            hits = np.concatenate([[0], np.cumsum(column[where] == entries)])
            overlaps[a:b] = np.diff(hits[np.concatenate([[0], ends])])
        yield pa.record_batch([batch["x"], batch["hub"], pa.array(overlaps), batch["n"],
                               batch["hub_n"]], schema=blocks.arrow_schema(LINKS))


def _overlaps(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The overlap of each pair (x, hub), with both sizes."""
    rows = pairs.join(nodes.select(F.col("node").alias("x"), "n", "grams"), "x")
    hubs = nodes.select(F.col("node").alias("hub"), F.col("n").alias("hub_n"),
                        F.col("grams").alias("hub_grams"))
    return rows.join(hubs, "hub").select("x", "hub", "n", "hub_n", "grams", "hub_grams") \
        .mapInArrow(_products, LINKS)


def _rest(percent: int):
    """Pairs of one column whose rows are still apart and may link; of a column in parts, those of
    one part, or those between two."""
    def pairs(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "ascending"), ("node", "ascending")])
        node, n, at, label = (table[c].to_numpy() for c in ("node", "n", "at", "label"))
        n, at = n.astype(np.int64), at.astype(np.int64)
        hub, far, part = (table[c].to_numpy() for c in ("hub", "far", "part"))
        alike = table["low"][0].as_py() == table["high"][0].as_py()
        ends = np.searchsorted(n, n * 100 // percent, side="right")
        xs, ys = [], []
        for i in range(len(node)):
            j = slice(i + 1, int(ends[i]))
            left = np.minimum(n[i] - at[i], n[j] - at[j])
            may = ((label[j] != label[i]) & (alike | (part[j] != part[i])) & ((100 + percent) * left >= percent * (n[i] + n[j]))
                   & ((hub[j] != hub[i]) | (np.abs(far[j] - far[i]) <= 1 - percent / 100 + 1e-9)))
            found = node[j][may]
            xs.append(np.full(len(found), node[i], np.int64))
            ys.append(found)
        return pa.table([np.concatenate(ys), np.concatenate(xs)],
                        schema=blocks.arrow_schema(PAIRS))
    return pairs


def linked(nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect rows of the matrix just as all links do."""
    enough = F.expr(f"{100 + percent} * overlap >= {percent} * (size_x + size_hub)")
    links = [F.least("x", "hub").alias("a"), F.greatest("x", "hub").alias("b")]
    postings = nodes.select("node", "n", "shared", "grams").mapInArrow(
        lambda batches: _postings(batches, percent), POSTINGS)
    # Columns with one row are of no use; the size class keeps hubs near their rows in size.
    postings = kept(postings.withColumn(
        "class", F.floor(F.log("n") / F.lit(np.log(100 / percent)) / 2).cast("int")))
    hubs = postings.groupBy("gram", "class").agg(
        F.min(F.struct((F.col("alone") / F.col("n")).alias("part"), "node", "n")).alias("hub"),
        F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(
        "gram", "class", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    pairs = (postings.join(hubs, ["gram", "class"])
             .filter(f"node <> hub and 100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)")
             .select(F.col("node").alias("x"), "hub").distinct())
    tested = kept(_overlaps(pairs, nodes))
    first = tested.filter(enough).select(*links)
    labels = components(first)

    near = tested.groupBy(F.col("x").alias("node")).agg(F.min(F.struct(
        (1 - F.col("overlap") / (F.col("size_x") + F.col("size_hub") - F.col("overlap"))).alias("far"),
        "hub")).alias("h")).select("node", "h.hub", "h.far")
    told = (postings.join(labels, "node", "left").join(near, "node", "left")
            .select("gram", "node", "n", "at", F.coalesce("label", "node").alias("label"),
                    F.coalesce("hub", "node").alias("hub"), F.coalesce("far", F.lit(0.0)).alias("far")))
    # A column of many rows goes in parts, each of which meets each other one in a task of its own.
    apart = told.groupBy("gram").agg(
        F.min("label").alias("l"), F.max("label").alias("h"),
        F.ceil(F.count(F.lit(1)) / REST_ROWS).cast("int").alias("parts")).filter("l < h").select("gram", "parts")
    met = (told.join(apart, "gram").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
           .withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
           .drop("parts", "other"))
    rest = met.groupBy("gram", "low", "high").applyInArrow(_rest(percent), PAIRS).distinct()
    return first.union(_overlaps(rest, nodes).filter(enough).select(*links))


def _classes(full: DataFrame, node: Column, percent: int) -> DataFrame:
    """(signature, label): the sets of `full`, each named by `node` of its rows, and the least name
    that links reach."""
    nodes = kept(full.filter("grams is not null").groupBy("signature").agg(
        node.alias("node"), F.first("n").cast("int").alias("n"),
        F.first("shared").alias("shared"), F.min_by("grams", "signature").alias("grams")).drop("signature"))
    labels = components(linked(nodes, percent))
    return (full.groupBy("signature").agg(node.alias("node")).join(labels, "node", "left")
            .select("signature", F.coalesce("label", "node").alias("label")))


def near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per document: n_shingles, and component_id, the smallest id that links reach (its own too)."""
    sets = kept(gram_sets(docs, words, percent, id_col, text_col))
    classes = _classes(sets.filter("n > 0 and doc_id is not null"), F.min("doc_id"), percent)
    return (sets.select("doc_id", "n", "signature").join(classes, "signature", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(
                F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("label"))
            ).otherwise(F.col("doc_id")).alias("component_id")))


def text_digest(text_col: str = "text") -> Column:
    return F.unhex(F.md5(text_col))


def surplus(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, digest, group): the ids and `text_digest`s of rows that must go for one row to stay of
    those that links join. Without `group` a row goes; of the rows of one `group` and id, one stays.

    Links join sets, not ids: rows without id link, and different texts under one id do not stand for
    each other. The smallest id stays; no id comes last. Documents without words link with nothing,
    but several rows of one id and text are one document whatever it holds.
    """
    sets = kept(gram_sets(docs, words, percent, id_col, text_col, text_digest(text_col)))
    # Sets are named by a hash, as an id may be missing or stand for several sets.
    classes = _classes(sets.filter("n > 0"), F.min(F.xxhash64("signature")), percent)
    texts = sets.groupBy("signature", "doc_id", "digest").agg(
        F.first("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    held = texts.filter("n > 0").join(classes, "signature").select(
        "label", "doc_id", "digest", "rows")
    stays = (held.groupBy("label", "doc_id").agg(F.sum("rows").alias("rows"))
             .groupBy("label").agg(F.min(F.struct(
                 F.col("doc_id").isNull().alias("none"), "doc_id", "rows")).alias("s"))
             .select("label", F.col("s.doc_id").alias("own_id"), F.col("s.rows").alias("own_rows")))
    own = F.col("doc_id").eqNullSafe(F.col("own_id"))
    told = held.join(stays, "label").filter(~own | (F.col("own_rows") > 1)).select(
        "doc_id", "digest", F.when(own, F.col("label")).alias("group"))
    wordless = texts.filter("n = 0 and rows > 1 and doc_id is not null")
    return told.union(wordless.select("doc_id", "digest", F.xxhash64("digest").alias("group")))
