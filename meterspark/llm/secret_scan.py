"""Secrets in texts, told apart by who owns them across the corpus.

Patterns find candidates in every text. Each candidate's hash is counted over the whole corpus:
in how many repositories and by how many owners it occurs. A value that more repositories or more
owners hold than `limits` allows a corpus of that size is a copied example; any other whose characters
look drawn at random is a live-looking credential. Equal texts are one repository, so a credential
that was copied along with its document stays one. Ownership also adds spans that no pattern alone
could claim: long mixed tokens (kind `token`) count only when they are live-looking. Counts cannot tell
a hash that occurs once from a credential that does; both are live-looking.

Spans are in code points, end exclusive; patterns are matched leftmost and without overlap, each kind
by itself. A null or empty text has none. Equal rows are one repository and owner, not two. A null
owner or repository counts as one of its own. Extra columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from xxhash import xxh3_64_intdigest

from meterspark.llm import blocks
from meterspark.llm.storage import kept

#: Fixed patterns: kind, pattern, group that holds the value, least length of the value.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Greedy runs, so asking for the least length at once drops what a filter would.
HEX = re.compile(r"[0-9a-f]{16,}")
BASE = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16))
KINDS = ("assign", "access", "hex", "token")

#: Added by ownership: runs of 20+ characters with lower case, upper case and a digit.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIXED = (re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"))
#: A live-looking value has at least so many different characters.
DISTINCT_CHARS = 8
#: So many times fewer owners than repositories may hold a live-looking value.
OWNER_SHARE = 4

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("value", T.LongType()),
                     T.StructField("varied", T.BooleanType())])
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("value", pa.int64()), ("varied", pa.bool_())]))


def candidates(text: str | None) -> list[tuple]:
    """(kind, start, end, hash of the value, varied) by start, then kind as in `KINDS`."""
    if not text:
        return []
    found = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), rank, m.end(), m.group(group)))
    taken = sorted((start, end) for start, _, end, _ in found)
    for m in TOKEN.finditer(text):
        value = m.group()
        if all(p.search(value) for p in MIXED) and not any(
                a < m.end() and m.start() < b for a, b in taken):
            found.append((m.start(), 3, m.end(), value))
    found.sort()
    return [(KINDS[rank], start, end, xxh3_64_intdigest(value.encode()) - (1 << 63),
             len(set(value)) >= DISTINCT_CHARS) for start, rank, end, value in found]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks.texts_of(batches):
        texts = batch["text"].to_pylist()
        spans = [[dict(zip(SPAN.names, c)) for c in candidates(t)] for t in texts]
        own = [xxh3_64_intdigest((t or "").encode()) - (1 << 63) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in batch.schema.names if c != "text"), pa.array(own, pa.int64()),
             pa.array(spans, _ARROW_SPAN)],
            names=[*(c for c in batch.schema.names if c != "text"), "text", "spans"])


def ownership(spans: DataFrame) -> DataFrame:
    """(value, repos, owners) of candidates (value, text, repo, owner): distinct ones of each, where a
    text counts for the least repository that holds it.

    Counted in steps, each combined before its shuffle, so a value that a third of all documents
    hold is spread over its texts, repositories and owners.
    """
    repos = (spans.groupBy("value", "text").agg(F.min("repo").alias("repo"))
             .groupBy("value", "repo").agg(F.lit(1).alias("one"))
             .groupBy("value").agg(F.count(F.lit(1)).alias("repos")))
    owners = (spans.groupBy("value", "owner").agg(F.lit(1).alias("one"))
              .groupBy("value").agg(F.count(F.lit(1)).alias("owners")))
    return repos.join(owners, "value")


def limits(texts: int, max_owners: int = 1) -> tuple[int, int]:
    """(repositories, owners) that may hold a live-looking value in a corpus of `texts` different texts.

    The repositories are the binary logarithm of the texts, rounded up; the owners are a quarter
    of that, and at least `max_owners`. A credential slips into a few places however large the corpus; what
    is quoted as an example grows with it.
    """
    repos = max(1, (max(1, texts) - 1).bit_length())
    return repos, max(max_owners, -(-repos // OWNER_SHARE))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repo_col: str = "doc_id", max_owners: int = 1) -> DataFrame:
    """(doc_id, spans): per document its spans (kind, start, end, repos, owners, live), in order.

    `live`: no more repositories and owners hold the value than `limits` says, and it is varied enough.
    """
    fields = docs.schema
    schema = T.StructType([T.StructField("doc_id", fields[id_col].dataType),
                           T.StructField("owner", fields[owner_col].dataType),
                           T.StructField("repo", fields[repo_col].dataType),
                           T.StructField("text", T.LongType()),
                           T.StructField("spans", T.ArrayType(SPAN))])
    found = kept(docs.select(
        F.col(id_col).alias("doc_id"), F.col(owner_col).alias("owner"), F.col(repo_col).alias("repo"),
        F.col(text_col).alias("text")).mapInArrow(_scan, schema)
        .withColumn("_row", F.monotonically_increasing_id()))
    each = found.filter("size(spans) > 0").select("_row", "doc_id", "owner", "repo", "text",
                                                  F.explode("spans").alias("s"))
    owned = ownership(each.select(F.col("s.value").alias("value"), "owner", "repo", "text"))
    most_repos, most_owners = limits(found.select("text").distinct().count(), max_owners)
    told = (each.withColumn("value", F.col("s.value")).join(owned, "value")
            .withColumn("live", (F.col("repos") <= most_repos) & (F.col("owners") <= most_owners)
                        & F.col("s.varied"))
            .filter("live or s.kind <> 'token'"))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("s.kind"))
    spans = F.transform(F.sort_array(F.collect_list(F.struct(
        F.col("s.start").alias("start"), rank.alias("rank"), F.col("s.kind").alias("kind"),
        F.col("s.end").alias("end"), "repos", "owners", "live"))), lambda x: F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            x["repos"].alias("repos"), x["owners"].alias("owners"), x["live"].alias("live")))
    with_spans = told.groupBy("_row").agg(spans.alias("spans"))
    return (found.select("_row", "doc_id").join(with_spans, "_row", "left")
            .select("doc_id", F.coalesce("spans", F.array().cast(with_spans.schema["spans"].dataType))
                    .alias("spans")))


def masked(docs: DataFrame, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text",
           owner_col: str = "source", repo_col: str = "doc_id", max_owners: int = 1) -> DataFrame:
    """`docs` with `mark` in place of every live-looking span; all other text stays as it is."""
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.withColumn("_key", key)
    live = (scan(rows, "_key", text_col, owner_col, repo_col, max_owners)
            .select(F.col("doc_id").alias("_key"), F.filter("spans", lambda s: s["live"]).alias("_live"))
            .filter("size(_live) > 0").groupBy("_key").agg(F.first("_live").alias("_live")))
    # From the last span to the first, so earlier offsets stay right; overlapping spans merge.
    merged = F.aggregate(
        F.reverse(F.array_sort(F.transform("_live", lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"))))),
        F.struct(F.col(text_col).alias("text"), F.lit(1 << 62).alias("from")),
        lambda acc, s: F.struct(
            F.concat(F.substr(acc["text"], F.lit(1), s["start"].cast("int")),
                     F.when(s["end"] <= acc["from"], F.lit(mark)).otherwise(F.lit("")),
                     F.substr(acc["text"], (F.when(s["end"] <= acc["from"], s["end"])
                                            .otherwise(acc["from"]) + 1).cast("int"))).alias("text"),
            s["start"].alias("from")),
        lambda acc: acc["text"])
    return (rows.join(live, "_key", "left")
            .withColumn(text_col, F.when(F.col("_live").isNull(), F.col(text_col)).otherwise(merged))
            .select(docs.columns))
