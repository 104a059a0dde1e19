"""Each operator as a query over the synthetic tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterspark.llm import blocks, chat, language_id, lm_score, merkle, minhash, mixing, \
    ngram_join, one_bit, piece_tokenizer, secret_scan, source_audit, substring_dedup, walsh_codes
from meterspark.llm.storage import kept, sized
from meterspark.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


CHAT_DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
               "formatted_chars long, n_tokens long, n_loss_tokens long")


def _chat_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks.texts_of(batches):
        rows = []
        for r in range(batch.num_rows):
            conv_id, n_turns, formatted = (batch[c][r].as_py() for c in ("conv_id", "n_turns", "formatted"))
            starts, ends, loss = (np.asarray(batch[c][r].values) if c != "loss"
                                  else batch[c][r].values.to_numpy(zero_copy_only=False)
                                  for c in ("starts", "ends", "loss"))
            turns = "".join(f"{role}\n{text}\n" for role, text in chat.parse(formatted))
            learnt = chat.masked_text(formatted, starts, ends, loss)
            rows.append((conv_id, n_turns, hashlib.sha256(turns.encode()).hexdigest(), len(learnt),
                         hashlib.sha256(learnt.encode()).hexdigest(), len(formatted), len(starts),
                         int(loss.sum())))
        yield blocks.batch_of(rows, CHAT_DIGEST)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("</s>[INST] ok [/INST]")
    for turn, role in ((0, "user"), (1, "assistant")):
        turns = turns.unionByName(spark.range(1).select(
            F.lit(-7).cast("long").alias("conv_id"), F.lit(turn).cast(turns.schema["turn"].dataType)
            .alias("turn"), F.lit(role).alias("role"), text.alias("text")))
    chats = chat.format_chats(turns, public_tokenizers.path("byte_bpe_50k.json"))
    return chats.mapInArrow(_chat_digest, CHAT_DIGEST)


def op2_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_bit.nearest(_table(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"), k=5)


OP2 = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))
        / (sqrt(list_sum(list_transform(q.e, lambda x: x * x)))
           * sqrt(list_sum(list_transform(c.e, lambda x: x * x)))) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
      FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP3 = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS ws
    FROM documents),
win AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
hit AS (SELECT doc_id, i FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM hit),
words AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
    SELECT k.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY k.p) AS t
    FROM words k LEFT JOIN gone g ON g.doc_id = k.doc_id AND g.p = k.p WHERE g.p IS NULL GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    found = lm_score.score(docs, ~held_out)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte", "others_score")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = F.filter("spans", lambda s: s["kind"] != "token")
    live = F.filter("spans", lambda s: s["live"])
    return found.select(
        "doc_id", *[count(kind) for kind in secret_scan.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        F.size(live).cast("long").alias("n_live"), listed(live).alias("live_spans"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_tokenizer.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
                        .alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(_table(spark, sf_dir, "documents"), words=4, percent=85)


OP7 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS ws
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
    FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
    SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
    WHERE 100 * o >= 85 * (p.n + q.n - o)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.y) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.x = w.doc_id GROUP BY 1, 2"""


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    langs, weights = language_id.train(docs, ~held_out)
    found = language_id.predict(docs.select("doc_id", "text"), langs, weights)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixture(_table(spark, sf_dir, "documents"), mixing.Target(repeats=2.0))
    return mixed.select("doc_id", "source", "weight", "pass", "block", "block_order", "place",
                        mixing.tokens("text").alias("n_tokens"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = merkle.fingerprints(_table(spark, sf_dir, "documents"))
    return tree.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       "edited_fingerprint", "near_edited", "near_next")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(_table(spark, sf_dir, "documents"), words=3, percent=85)


OP11 = r"""
WITH RECURSIVE w AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS ws
    FROM documents),
s AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 1))) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS MATERIALIZED (
    SELECT x, y
    FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
          FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2)
    JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
    WHERE 100 * o >= 85 * (p.n + q.n - o)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.x = w.doc_id"""


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(_table(spark, sf_dir, "documents"))


OP12 = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
    FROM documents),
t AS MATERIALIZED (
    SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(ts) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM t GROUP BY ALL HAVING count(*) >= 3),
l AS MATERIALIZED (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY ALL),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (
    SELECT lang, source, term, CAST(sum(t.n) AS HUGEINT) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
gt AS MATERIALIZED (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (
    SELECT gt.lang, gt.source, k.term, coalesce(c.n, 0) AS n,
        1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (gt.total + l.v) AS p,
        1 + (CAST(1000000000 AS HUGEINT) * (k.n + 1)) // (l.total + l.v) AS q
    FROM gt JOIN k USING (lang) JOIN l USING (lang)
    LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = k.term),
f AS MATERIALIZED (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
    FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200"""


def op13_walsh_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    books = walsh_codes.train(vectors)
    coded = kept(walsh_codes.encode(vectors, books, more=(F.col("label"),)))
    sums = sized(coded.groupBy(F.col("label").alias("_label")).agg(F.least(
        F.sum(F.col("error").cast("decimal(38,0)")), F.lit(walsh_codes.LARGEST)).cast("long")
        .alias("label_error")), "label_errors")
    digest = hashlib.sha256((books.digits() if books else "").encode()).hexdigest()
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", walsh_codes.hexadecimal(F.col("code")).alias("code"), "error", "label_error",
        F.lit(digest).alias("codebooks_sha256"))


def _op13_sql(rounds: int = 4) -> str:
    steps = [r"""
v AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, len(embedding) // 4 AS w,
        list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
p AS MATERIALIZED (
    SELECT r, part, e[part * w + 1:(part + 1) * w] AS x, w
    FROM (SELECT r, e, w, unnest(range(4)) AS part FROM v)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= 256)"""]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
    SELECT r, p.part, min(256 * list_sum(list_transform(range(1, w + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))
        + entry) AS best
    FROM p JOIN c{k} USING (part) GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""
m{k} AS MATERIALIZED (
    SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
    FROM (SELECT part, CAST(best % 256 AS BIGINT) AS entry, i, sum(x[i]) AS s, count(*) AS n
          FROM (SELECT a.part, best, x, unnest(range(1, w + 1)) AS i
                FROM a{k} a JOIN p ON p.r = a.r AND p.part = a.part) GROUP BY ALL) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (
    SELECT c.part, c.entry, coalesce(m.c, c.c) AS c
    FROM c{k} c LEFT JOIN m{k} m ON m.part = c.part AND m.entry = c.entry)""")
    return f"""WITH {",".join(steps)},
coded AS (
    SELECT r, string_agg(printf('%02x', CAST(best % 256 AS INTEGER)), '' ORDER BY part) AS code,
        CAST(sum(best // 256) AS BIGINT) AS error
    FROM a{rounds} GROUP BY r),
told AS (SELECT vec_id, label, code, error FROM v JOIN coded USING (r))
SELECT vec_id, code, error,
    CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM told"""


_QUERIES = (op1_chat_formatting, op2_one_bit_neighbours, op3_substring_dedup, op4_lm_scoring,
            op5_secret_scan, op6_sentencepiece, op7_ngram_jaccard, op8_language_id, op9_mixing, op10_fingerprints,
            op11_minhash, op12_source_audit, op13_walsh_codes)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op2_one_bit_neighbours": OP2, "op3_substring_dedup": OP3, "op7_ngram_jaccard": OP7,
            "op11_minhash": OP11, "op12_source_audit": OP12, "op13_walsh_codes": _op13_sql()}
