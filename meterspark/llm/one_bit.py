"""Approximate nearest neighbours by cosine, from randomly rotated one-bit codes.

Vectors are scaled to length 1, padded and rotated at random to `bits` coordinates, of which just the
signs are kept, together with one scalar: the inner product of the rotated vector with its code. The
inner product with a query is estimated from code and scalar, with the bound `spread` / sqrt(bits) on
its error (for a random rotation it is exceeded with a chance that falls as exp(-spread**2 / 2); the
queries of the tests find all of the exact nearest).
A candidate whose upper bound is below the k-th best lower bound of a query cannot be among its k
nearest; all others are reranked by the exact cosine in double precision.

Every row is indexed: equal vectors are one entry, which knows their smallest ids, so a vector that
a third of the rows share costs no more than another. Queries and entries are dealt into blocks of
bounded size, and blocks of queries meet blocks of codes twice: first for the best lower bounds, which
give each query its threshold, then for the candidates whose upper bounds reach it.

Vectors that are null, zero, hold null or non-finite components, or differ in length from most rows
take no part. Rows with a null id take none either. Equal ids with equal vectors count once. Extra
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterspark.llm import blocks
from meterspark.llm.storage import kept

BITS_PER_DIM = 16
SPREAD = 2.5
CODE_BLOCK = 4096
QUERY_BLOCK = 512

CODES = "ids binary, codes binary, scales binary"
QUERIES = "_part int, queries binary, turned binary, least binary"
LOWS = "query long, low double"
NEAR = "query long, node long"


def rotation(dim: int, bits: int, seed: int = 0) -> np.ndarray:
    """`bits` x `dim` with orthonormal columns, uniformly at random."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _turned(vectors: pa.ChunkedArray, turn: np.ndarray) -> np.ndarray:
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(vectors), -1)
    v = v / np.abs(v).max(1, keepdims=True)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32) @ turn.T


def _estimates(batches: Iterator[pa.RecordBatch], bits: int):
    """Per row (a block of queries with a block of codes): both ids, lower and upper bounds, and the
    queries' thresholds."""
    for batch in batches:
        for r in batch.to_pylist():
            ids = np.frombuffer(r["ids"], np.int64)
            signs = np.unpackbits(np.frombuffer(r["codes"], np.uint8).reshape(len(ids), -1), axis=1,
                                  count=bits).astype(np.float32) * 2 - 1
            scales = np.frombuffer(r["scales"], np.float32)
            queries = np.frombuffer(r["queries"], np.int64)
            turned = np.frombuffer(r["turned"], np.float32).reshape(len(queries), bits)
            estimate = (turned @ signs.T) / np.float32(np.sqrt(bits)) / scales
            error = np.sqrt(np.maximum(0, 1 - scales * scales)) / scales * (SPREAD / np.sqrt(bits - 1))
            yield queries, ids, estimate - error, estimate + error, np.frombuffer(r["least"], np.float64)


def _best_lows(batches: Iterator[pa.RecordBatch], k: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The k best lower bounds of each query in each block of codes."""
    for queries, _, low, _, _ in _estimates(batches, bits):
        k_here = min(k, low.shape[1])
        best = np.partition(low, low.shape[1] - k_here, axis=1)[:, -k_here:].astype(np.float64)
        yield pa.record_batch([pa.array(np.repeat(queries, k_here)), pa.array(best.ravel())],
                              schema=blocks.arrow_schema(LOWS))


def _may_be_near(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose upper bound reaches the query's threshold."""
    for queries, ids, _, high, least in _estimates(batches, bits):
        q, c = np.nonzero(high >= least[:, None])
        yield pa.record_batch([pa.array(queries[q]), pa.array(ids[c])], schema=blocks.arrow_schema(NEAR))


def _cosine(a: str, b: str) -> Column:
    def dot(x: str, y: str) -> str:
        return (f"aggregate(zip_with({x}, {y}, (p, q) -> cast(p as double) * cast(q as double)), "
                f"0D, (s, v) -> s + v)")
    return F.expr(f"{dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)}))")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query row but itself,
    nearest first, ties to the smaller id."""
    rows = vectors.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"))
    usable = rows.filter("v is not null and forall(v, x -> x is not null and not isnan(x) and "
                         "abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    common = usable.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 1
    bits = -(-dim * BITS_PER_DIM // 8) * 8
    usable = usable.filter(F.size("v") == dim)

    # Equal vectors are one node; k + 1 ids of it are enough, as one may be the query's own.
    nth = F.dense_rank().over(W.partitionBy("v").orderBy("vec_id"))
    nodes = kept(usable.select("vec_id", "v").distinct().withColumn("nth", nth)
                 .filter(F.col("nth") <= k + 1).groupBy("v")
                 .agg(F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = kept(usable.filter("is_query").select(F.col("vec_id").alias("query_id"), "v").distinct()
                 .join(nodes.select("v", "node"), "v").select("query_id", F.col("node").alias("query")))
    seeds = asked.select(F.col("query").alias("node")).distinct().join(nodes, "node")

    turn = rotation(dim, bits)

    def codes(table: pa.Table) -> pa.Table:
        x = _turned(table["v"], turn)
        scales = np.abs(x).sum(1) / np.float32(np.sqrt(bits))
        return blocks.table_of([(table["node"].to_numpy().astype(np.int64).tobytes(),
                                 np.packbits(x > 0, axis=1).tobytes(),
                                 scales.astype(np.float32).tobytes())], CODES)

    def queries(table: pa.Table) -> pa.Table:
        return blocks.table_of([(table["_part"][0].as_py(),
                                 table["node"].to_numpy().astype(np.int64).tobytes(),
                                 _turned(table["v"], turn).tobytes(),
                                 table["least"].to_numpy().astype(np.float64).tobytes())], QUERIES)

    n_codes = max(1, -(-nodes.count() // CODE_BLOCK))
    n_queries = max(1, -(-seeds.count() // QUERY_BLOCK))
    coded = nodes.withColumn("_block", F.pmod(F.xxhash64("node"), F.lit(n_codes)).cast("int")) \
        .select("_block", "node", "v").groupBy("_block").applyInArrow(codes, CODES)
    coded = kept(coded)

    def met(least: DataFrame) -> DataFrame:
        """Every block of queries, with their thresholds, next to every block of codes."""
        parts = (seeds.join(least, seeds["node"] == least["query"], "left")
                 .withColumn("_part", F.pmod(F.xxhash64("node"), F.lit(n_queries)).cast("int"))
                 .select("_part", "node", "v", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
                 .groupBy("_part").applyInArrow(queries, QUERIES))
        return coded.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))) \
            .join(parts, "_part")

    nowhere = seeds.select(F.col("node").alias("query"), F.lit(float("-inf")).alias("least"))
    lows = met(nowhere).mapInArrow(lambda b: _best_lows(b, k + 1, bits), LOWS)
    nth_low = F.row_number().over(W.partitionBy("query").orderBy(F.desc("low")))
    least = kept(lows.withColumn("nth", nth_low).filter(F.col("nth") == k + 1)
                 .select("query", F.col("low").alias("least")))
    near = met(least).mapInArrow(lambda b: _may_be_near(b, bits), NEAR)
    exact = (near.select("query", "node")
             .join(nodes.select("node", F.col("v").alias("b"), "ids"), "node")
             .join(nodes.select(F.col("node").alias("query"), F.col("v").alias("a")), "query")
             .select("query", "node", "ids", _cosine("a", "b").alias("score")))
    first = W.partitionBy("query").orderBy(F.desc("score"), "node")
    top = exact.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1).drop("nth")
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.join(top, "query").select("query_id", F.explode("ids").alias("vec_id"), "score")
            .filter("query_id <> vec_id").withColumn("rank", F.row_number().over(ranked))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
