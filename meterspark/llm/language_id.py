"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes between two spaces in both directions and labels every position
with a distribution over languages; a document's distribution is the mean over its letter positions.
State starts anew at white space, so a word's labels depend on the word alone and each task runs the
network once per distinct word of its batches (words longer than `PIECE` bytes in pieces), and each way
once for what words of a batch begin or end with alike. Texts are read whole and never shuffled.

Training is numpy backpropagation through time on a bounded sample: at most `DOCS_PER_LANG`
documents per language, those with the smallest hash of their id, and at most `WORDS_PER_DOC` words
of each, evenly spaced. Nothing but text and label is learnt from.

A null text, or one without any letter, is `und` with score 0; so is everything if nothing could be
learnt. Ties go to the first language by name. Equal rows are predicted alike. Extra columns play no
part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from meterspark.llm import blocks

DOCS_PER_LANG = 300
TASK_GROUPS = 32
WORDS_PER_DOC = 100
HIDDEN = 16
PIECE = 30
BATCH = 512
EPOCHS = 3
RATE = 0.01
#: A task keeps so many words' sums, or so many numbers if that is more words.
TABLE_WORDS, TABLE_CELLS = 1 << 17, 1 << 21
#: So many words are labelled at once.
LABELLED = 1 << 14

_LETTER = regex.compile(r"\p{L}")
_LETTER_BYTES = np.zeros(256, bool)
_LETTER_BYTES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

Weights = dict[str, np.ndarray]


def _cell(p: Weights, way: str):
    """One step of one direction: from rows' bytes and states, the gates, what is proposed, and new states."""
    # Each gate has arrays of its own, which lie in one piece. Its sigmoid is 0.5 * tanh(0.5 * x) + 0.5, whose
    # inner half is taken of the weights: halves are exact.
    half, parts = np.float32(0.5), (slice(0, HIDDEN), slice(HIDDEN, 2 * HIDDEN), slice(2 * HIDDEN, None))
    *of_gates, of_new = (np.ascontiguousarray(p["x" + way][:, own]) for own in parts)
    gates = [(t * half, np.ascontiguousarray(p["g" + way][:, own]) * half) for t, own in zip(of_gates, parts)]
    inner = p["c" + way]

    def step(at: np.ndarray, h: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z, r = ((h @ weights) + table.take(at, 0) for table, weights in gates)
        for gate in (z, r):
            np.tanh(gate, gate)
            gate *= half
            gate += half
        c = (r * h) @ inner
        c += of_new.take(at, 0)
        np.tanh(c, c)
        np.subtract(c, h, out)
        out *= z
        out += h
        return z, r, c
    return step


def _run(x: np.ndarray, p: Weights, way: str):
    """States (time, row, hidden) of one direction over the byte rows `x`; what backward needs."""
    n, steps = x.shape
    h = np.zeros((n, HIDDEN), np.float32)
    states, saved, step = np.empty((steps, n, HIDDEN), np.float32), [], _cell(p, way)
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        saved.append((t, h, *step(x[:, t], h, states[t])))
        h = states[t]
    return states, saved


def _shared(raw: np.ndarray, lengths: np.ndarray, p: Weights, way: str) -> tuple[np.ndarray, np.ndarray]:
    """States of one direction over strings laid end to end, read from the first byte on, and which of them
    each byte has. What strings begin with alike, as neighbours in order, is run once."""
    n, steps = len(lengths), max(9, int(lengths.max()))
    inside = np.arange(steps) < lengths[:, None]
    x = np.zeros((n, steps), np.uint8)
    x[inside] = raw
    # The first byte is a space nearly always.
    order = np.argsort(np.ascontiguousarray(x[:, 1:9]).view(">u8").ravel())
    x, held = x[order], inside[order]
    new = np.ones((n, steps), bool)
    new[1:] = np.logical_or.accumulate((x[1:] != x[:-1]) | ~held[:-1], axis=1)
    new &= held
    new = np.ascontiguousarray(new.T)
    place = np.cumsum(new, dtype=np.int32).reshape(steps, n) - 1
    states, step = np.empty((int(place[-1, -1]) + 1, HIDDEN), np.float32), _cell(p, way)
    done = 0
    for t, starts in enumerate(new):
        rows = np.flatnonzero(starts)
        h = states.take(place[t - 1].take(rows), 0) if t else np.zeros((len(rows), HIDDEN), np.float32)
        step(x[:, t].take(rows), h, states[done:done + len(rows)])
        done += len(rows)
    of_string = np.empty((n, steps), np.int32)
    of_string[order] = place.T
    return states, of_string[inside]


def _back(d_states: np.ndarray, x: np.ndarray, p: Weights, way: str, saved: list, g: Weights) -> None:
    """Backpropagation through time of one direction."""
    gates, inner = p["g" + way], p["c" + way]
    dh = np.zeros(d_states.shape[1:], np.float32)
    for t, h, z, r, c in reversed(saved):
        dh = dh + d_states[t]
        dc = dh * z * (1 - c * c)
        dz = dh * (c - h) * z * (1 - z)
        drh = dc @ inner.T
        dr = drh * h * r * (1 - r)
        dzr = np.concatenate([dz, dr], 1)
        g["c" + way] += (r * h).T @ dc
        g["g" + way] += h.T @ dzr
        np.add.at(g["x" + way], x[:, t], np.concatenate([dzr, dc], 1))
        dh = dh * (1 - z) + drh * r + dzr @ gates.T


def _probabilities(both: np.ndarray, p: Weights) -> np.ndarray:
    e = np.exp(np.clip(both @ p["out"] + p["bias"], -40, 40))
    return e / e.sum(-1, keepdims=True)


def label(x: np.ndarray, p: Weights):
    """Probabilities (time, row, language) of every position, and what backward needs."""
    forward, saved_f = _run(x, p, "f")
    backward, saved_b = _run(x, p, "b")
    both = np.concatenate([forward, backward], 2)
    return _probabilities(both, p), both, saved_f, saved_b


def letter_sums(strings: list[bytes], p: Weights) -> np.ndarray:
    """Per string, the sum over its letter positions of the probabilities of each language."""
    raw = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    forward, at = _shared(raw, lengths, p, "f")
    backward, back = _shared(raw[::-1], lengths[::-1], p, "b")
    both = np.concatenate([forward.take(at, 0), backward.take(back[::-1], 0)], 1)
    probs = _probabilities(both, p) * _LETTER_BYTES[raw][:, None]
    sums, first = np.zeros((len(strings), probs.shape[1]), np.float32), np.cumsum(lengths) - lengths
    live = np.arange(len(strings))
    for t in range(int(lengths.max())):
        live = live[lengths[live] > t]
        sums[live] += probs.take(first[live] + t, 0)
    return sums


def pieces(word: bytes) -> list[bytes]:
    word = b" " + word + b" "
    if len(word) <= PIECE + 2:
        return [word]
    return [word[i:i + PIECE] for i in range(0, len(word), PIECE)]


def fit(words: list[bytes], labels: np.ndarray, langs: int, seed: int = 0) -> Weights:
    """Weights after `EPOCHS` passes of Adam over batches of words of one length."""
    rng = np.random.default_rng(seed)

    def init(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0] if shape[0] < 256 else 4)).astype(np.float32)

    p = {"out": init(2 * HIDDEN, langs), "bias": np.zeros(langs, np.float32)}
    for way in "fb":
        p |= {"x" + way: init(256, 3 * HIDDEN), "g" + way: init(HIDDEN, 2 * HIDDEN),
              "c" + way: init(HIDDEN, HIDDEN)}
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    step = 0
    for epoch in range(EPOCHS):
        batches = [own[a:a + BATCH] for rows in by_length.values()
                   for own in [rng.permutation(rows)] for a in range(0, len(own), BATCH)]
        for b in rng.permutation(len(batches)).tolist():
            rows = batches[b]
            x = np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), -1)
            probs, both, saved_f, saved_b = label(x, p)
            d = probs
            d[:, np.arange(len(rows)), labels[rows]] -= 1
            d /= x.size
            g = {k: np.zeros_like(v) for k, v in p.items()}
            g["out"] = np.einsum("tnh,tnl->hl", both, d)
            g["bias"] = d.sum((0, 1))
            d_both = d @ p["out"].T
            _back(d_both[:, :, :HIDDEN], x, p, "f", saved_f, g)
            _back(d_both[:, :, HIDDEN:], x, p, "b", saved_b, g)
            step += 1
            rate = RATE * 0.5 ** epoch
            for k in p:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.001 * (g[k] * g[k] - second[k])
                p[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return p


def first_rows(known: DataFrame, keys: list[Column], by: list[Column]) -> DataFrame:
    """The DOCS_PER_LANG rows of each key that come first."""
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*by))
    return known.withColumn("_nth", nth).filter(F.col("_nth") <= DOCS_PER_LANG).drop("_nth")


def first_docs(known: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    """Ids of the DOCS_PER_LANG documents of each language whose hashed ids come first.

    A language may hold most rows, so it is cut in steps that keep the same ids: in each task, in
    each of TASK_GROUPS groups of tasks, then at last among TASK_GROUPS * DOCS_PER_LANG at most.
    """
    by = [F.xxhash64("_id"), F.col("_id")]
    rows = known.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"),
                        (F.spark_partition_id() % TASK_GROUPS).alias("_group"))
    groups = first_rows(rows, [F.col("_lang"), F.col("_group")], by)
    return first_rows(groups, [F.col("_lang")], by).select(F.col("_id").alias(id_col)).distinct()


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> tuple[list[str], Weights | None]:
    """Languages and weights, from the documents that `usable` holds for."""
    known = docs.filter(usable & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    picked = first_docs(known, id_col, lang_col)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                words = [w for w in text.encode().split()
                         if _LETTER_BYTES[np.frombuffer(w, np.uint8)].any()]
                few = words[::max(1, -(-len(words) // WORDS_PER_DOC))]
                rows += [(lang, piece) for w in few for piece in pieces(w)]
            yield blocks.batch_of(rows, "lang string, word binary")

    # At most DOCS_PER_LANG ids per language: a bound that does not grow with the documents. An id may stand
    # for any number of rows, so rows are cut to as many once more, each task sending no more than that.
    taken = known.join(F.broadcast(picked), id_col, "left_semi").select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("_id"))
    taken = first_rows(taken, [F.col("lang")], [F.xxhash64("_id"), F.col("_id"), F.xxhash64("text"), F.col("text")])
    rows = sorted(tuple(r) for r in taken.drop("_id").mapInArrow(sample, "lang string, word binary").collect())
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return [], None
    code = {lang: i for i, lang in enumerate(langs)}
    return langs, fit([bytes(w) for _, w in rows], np.array([code[lang] for lang, _ in rows]), len(langs))


class WordTable:
    """Sum over a word's letter positions of the probabilities of each language, and their number."""

    def __init__(self, weights: Weights, langs: int):
        self.weights, self.langs = weights, langs
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.sums = np.zeros((0, self.langs + 1))

    def add(self, words: dict[bytes, None]) -> None:
        if len(self.place) > max(TABLE_WORDS, TABLE_CELLS // (self.langs + 1)):
            self.clear()
        new = [w for w in words if w not in self.place]
        known = len(self.place)
        self.place.update(zip(new, range(known, known + len(new))))
        sums = np.zeros((len(new), self.langs + 1))
        cut = [pieces(w) for w in new]
        strings = [piece for own in cut for piece in own]
        at = np.repeat(np.arange(len(new)), np.fromiter(map(len, cut), np.int64, len(cut)))
        for a in range(0, len(strings), LABELLED):
            part = strings[a:a + LABELLED]
            np.add.at(sums[:, :-1], at[a:a + LABELLED], letter_sums(part, self.weights))
        letters = _LETTER_BYTES[np.frombuffer(b"".join(new), np.uint8)]
        if new:
            sums[:, -1] = np.add.reduceat(letters, np.append(0, np.cumsum([*map(len, new)])[:-1]), dtype=np.int64)
        self.sums = np.concatenate([self.sums, sums])


def _predicted(texts: list[str | None], table: WordTable) -> np.ndarray:
    """Probabilities per text; zeros where there is no letter."""
    split = [t.encode().split() if t and _LETTER.search(t) else [] for t in texts]
    table.add(dict.fromkeys(chain.from_iterable(split)))
    place, out = table.place, np.zeros((len(texts), table.langs))
    for i, words in enumerate(split):
        if words:
            total = table.sums.take(itemgetter(*words, words[0])(place)[:-1], 0).sum(0)
            # A text whose only letters are beyond the letter bytes has none counted.
            out[i] = total[:-1] / total[-1] if total[-1] else 1 / table.langs
    return out


def predict(docs: DataFrame, langs: list[str], weights: Weights | None,
            text_col: str = "text") -> DataFrame:
    """`docs` without its text column's content read twice: all columns, lang_pred and score."""
    made = ("lang_pred", "score")
    rest = [f for f in docs.schema.fields if f.name not in made]
    schema = T.StructType([*rest, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(weights, len(langs)) if weights is not None else None
        for batch in blocks.texts_of(batches, 1024):
            texts = batch[text_col].to_pylist()
            probs = (_predicted(texts, table) if table is not None
                     else np.zeros((len(texts), 1)))
            best = probs.argmax(1)
            score = probs[np.arange(len(texts)), best]
            names = [langs[b] if s > 0 else "und" for b, s in zip(best.tolist(), score.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch[f.name] for f in rest), pa.array(names, pa.string()), pa.array(score)],
                names=[f.name for f in schema.fields])

    return docs.select(*[f.name for f in rest]).mapInArrow(run, schema)
