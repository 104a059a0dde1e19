"""A corpus made ready for training, in five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; `run` writes
what a stage returns as Parquet and reads it again for the next. All stages but the last return the
columns of `documents`, and any other column that came along, unchanged and whatever its name; `n_chars`
may be missing. An empty table stays empty. Rows without id, text, language or source go through like
others; a stage's docstring says what it makes of them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterspark.llm import language_id, mixing, ngram_join, piece_tokenizer, secret_scan
from meterspark.llm.storage import sized
from meterspark.session import configure, shared_dir

#: Columns that stages read or write by name; all others travel under names that no operator uses.
READ = ("doc_id", "text", "lang", "source", "n_chars")

#: A language must be at least so much likelier than chance, as part of what is between chance and certainty.
LEAST_MARGIN = 0.05

#: Bits of the filter that tells most rows that stay from those that may go: 16 MB, whatever the corpus.
FILTER_BITS = 1 << 27


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def configured(stage: Stage) -> Stage:
    """`stage` under the settings that operators rely on, whoever calls it."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(configure(spark), docs, sf_dir)
    return run_stage


def aside(docs: DataFrame) -> DataFrame:
    """`docs` with the columns that no stage knows under numbered names."""
    return docs.toDF(*[c if c in READ else f"along_{i}" for i, c in enumerate(docs.columns)])


def as_before(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, from what an operator made of `aside(docs)`."""
    return found.select(*aside(docs).columns).toDF(*docs.columns)


@configured
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (or text) go, and those whose likeliest language is hardly likelier
    than chance. Where no document has a language there is nothing to tell by, and all stay."""
    rows = aside(docs)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    langs, weights = language_id.train(rows, F.coalesce(~held_out, F.lit(False)))
    if not langs:
        return docs
    chance = 1 / len(langs)
    found = language_id.predict(rows, langs, weights).filter(
        (F.col("lang_pred") != "und") & (F.col("score") >= chance + LEAST_MARGIN * (1 - chance)))
    return as_before(found, docs)


@configured
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows that links join, one stays: that with the smallest id (none comes last), then the
    least text, then the least of its other columns; rows alike in all columns are interchangeable.

    Rows that must go are found by id and text digest. A filter of fixed size tells nearly all rows that
    stay at once, so just the others take their texts through a join, at every size of the corpus.
    """
    told = sized(ngram_join.surplus(docs, words=5, percent=80)
                 .withColumnsRenamed({"doc_id": "_id", "digest": "_digest", "group": "_group"}), "copies")
    rows = aside(docs).withColumn("_text", ngram_join.text_digest())
    known = sized(_bits(told, F.col("_id"), F.col("_digest")), "bits")
    bit = _bit(F.col("doc_id"), F.col("_text"))
    # Two tables of at most FILTER_BITS / 32768 rows of 4 KB: bounded, so they are broadcast.
    marked = rows.withColumn("_bit", bit).join(
        F.broadcast(known), F.bitmap_bucket_number("_bit") == F.col("_bucket"), "left")
    may_go = F.coalesce(_is_set(F.col("_bits"), F.bitmap_bit_position("_bit")), F.lit(False))
    stays = marked.filter(~may_go)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_text").eqNullSafe(F.col("_digest"))
    looked_up = marked.filter(may_go).drop("_bit", "_bucket", "_bits").join(
        told.withColumn("_told", F.lit(True)), same, "left")
    one = looked_up.filter("_group is not null").groupBy("_group", "doc_id").agg(F.min(F.struct(
        "text", *[c for c in aside(docs).columns if c != "text"])).alias("_least"))
    parts = [as_before(part, docs) for part in (stays, looked_up.filter("_told is null"), one.select("_least.*"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _bit(doc_id: Column, digest: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, digest), F.lit(FILTER_BITS))


def _bits(told: DataFrame, doc_id: Column, digest: Column) -> DataFrame:
    """(_bucket, _bits): the bits of all rows in `told`, by buckets of 32,768."""
    return told.select(_bit(doc_id, digest).alias("_bit")).groupBy(
        F.bitmap_bucket_number("_bit").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits"))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


@configured
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked; n_chars follows the text."""
    found = secret_scan.masked(aside(docs))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return as_before(found, docs)


@configured
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources come up to twice; every document stays at least once."""
    return as_before(mixing.mixture(aside(docs), mixing.Target(repeats=2.0)), docs)


@configured
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it. Columns that came along stay, but for those named
    like what is made here."""
    rows = aside(docs)
    coded = piece_tokenizer.encode(rows.withColumn("_before", F.xxhash64(F.coalesce("text", F.lit("")))),
                                   public_tokenizers.path("piece_bpe_32k.model"))
    made = {"n_tokens": F.size("ids").cast("long"), "ids": F.col("ids"),
            "round_trip": F.xxhash64("decoded") == F.col("_before")}
    return coded.select(
        *[F.col(to).alias(c) for to, c in zip(rows.columns, docs.columns) if c != "text" and c not in made],
        *[column.alias(name) for name, column in made.items()])


STAGES = [("language_id", known_language), ("ngram_jaccard", one_of_each),
          ("secret_scan", without_secrets), ("mixing", mixed), ("sentencepiece", encoded)]

#: A trained network decides in the first stage, so SQL cannot give these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
