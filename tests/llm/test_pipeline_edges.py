"""Stages of the pipeline over tables with odd rows and clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterspark import session
from test_llm_edges import empty, odd  # noqa: F401

SF = "/root/testdata/sf0.001"
CLASHING = ("weight", "pass", "score", "lang_pred", "_text", "_id", "_key", "_live", "block", "place", "_told", "_bits",
            "_digest", "_group", "_mix_id", "along_0", "ids", "decoded", "_before", "label", "n", "grams", "_nth")


@pytest.fixture(scope="module")
def clashing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").drop("n_chars")
    return docs.select(*[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                  F.coalesce("source", F.lit(""))).alias(c) for c in CLASHING], "*")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_columns_of_any_name_come_through(spark, clashing, name, stage):
    after = stage(spark, clashing, SF)
    assert not [c for c in clashing.columns if c not in after.columns and c != "text"]
    made = ("ids",) if name == "sentencepiece" else ()
    if name != "sentencepiece":
        assert after.columns == clashing.columns
    rows = after.select("doc_id", "source", *[c for c in CLASHING if c not in made]).collect()
    assert len(rows) > 100
    for r in rows:
        assert all(r[c] == f"{c}:{r.doc_id}{r.source or ''}" for c in CLASHING if c not in made)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_and_empty_tables(spark, odd, empty, name, stage):  # noqa: F811
    rows = stage(spark, odd, SF).collect()
    ids = {r.doc_id for r in rows}
    if name == "language_id":
        assert ids >= {5, 6, 7, None} and not ids & {1, 2, 3, 12}
    elif name == "ngram_jaccard":
        assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, (1, 2, 3, 4, 5, 8, 9, 10, 11, 12)))
    else:
        assert ids == {r.doc_id for r in odd.collect()}
    assert stage(spark, empty, SF).collect() == []


def test_without_labels_all_stay(spark, odd):  # noqa: F811
    blank = odd.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.known_language(spark, blank, SF).count() == odd.count()


def test_the_filter_never_misses_a_row(spark):
    told = spark.range(5000).select(F.col("id").alias("_id"), F.unhex(F.md5(F.col("id").cast("string"))).alias("_digest"))
    bits = corpus_pipeline._bits(told, F.col("_id"), F.col("_digest"))
    rows = spark.range(20000).select("id", corpus_pipeline._bit(
        F.col("id"), F.unhex(F.md5(F.col("id").cast("string")))).alias("_bit"))
    hit = rows.join(bits, F.bitmap_bucket_number("_bit") == F.col("_bucket"), "left").filter(
        corpus_pipeline._is_set(F.col("_bits"), F.bitmap_bit_position("_bit")))
    found = {r.id for r in hit.collect()}
    assert found >= set(range(5000)) and len(found) < 5020


def test_stages_bound_what_goes_to_python(spark):
    """Whoever calls a stage: without the settings a batch was up to 64 MB, held several times by each task."""
    bounded = session.DEFAULTS
    before = {key: spark.conf.get(key, None) for key in bounded}
    docs = spark.createDataFrame([(1, "one two", "en", "a")], "doc_id long, text string, lang string, source string")
    try:
        for _, stage in corpus_pipeline.STAGES:
            for key in bounded:
                spark.conf.unset(key)
            stage(spark, docs, SF)
            assert {key: spark.conf.get(key, None) for key in bounded} == bounded
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
