"""Removal of passages that occur more than once.

Every window of `window` words gets a Rabin-Karp hash. `blocks.key_totals` counts the windows of the
whole corpus, and neighbouring repeated windows merge into maximal intervals of words to remove.

Windows are told apart by 80 hash bits. A null or empty text has no words; it stays, with none
removed. Equal rows are occurrences of their own, so their windows repeat. A text shorter than a
window loses nothing. Rows without id stay too. Extra columns of the input play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterspark.llm import blocks
from meterspark.llm.shingles import BASE_2, rolling, whole_windows, word_codes, words_of

KEPT = "doc_id long, n_words long, n_removed long, kept string, intervals string"


def _windows(texts: list[list[bytes]], window: int):
    codes, starts = word_codes(texts)
    inside = whole_windows(starts, window)
    hashes = rolling(codes, window)
    keys, first, inverse, counts = np.unique(
        hashes[inside], return_index=True, return_inverse=True, return_counts=True)
    return codes, starts, inside, keys, first, inverse, counts


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per document: n_words, n_removed, the kept words joined by one space, and the removed
    intervals of words as `start:end` pairs joined by commas (end exclusive)."""
    blocked, size = blocks.in_blocks(docs, id_col, text_col)
    ranges = blocks.doubling(size // 6, blocks.RANGE_KEYS)

    def keys_of(table: pa.Table) -> blocks.Keys:
        texts = [words_of(t) for t in table["text"].to_pylist()]
        codes, _, inside, keys, first, _, counts = _windows(texts, window)
        second = rolling(codes, window, BASE_2)[inside][first]
        return keys, (second >> np.uint64(48)).astype(np.uint16), counts.astype(np.uint64)

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        texts = [words_of(t) for t in table["text"].to_pylist()]
        codes, starts, inside, _, _, inverse, _ = _windows(texts, window)
        edges = np.zeros(len(codes) + 1, np.int64)
        at = np.flatnonzero(inside)[blocks.answers_of(answers)[inverse] > 0]
        np.add.at(edges, at, 1)
        np.add.at(edges, at + window, -1)
        covered = np.cumsum(edges)[:-1] > 0
        rows = []
        for i, (doc_id, words) in enumerate(zip(table["doc_id"].to_pylist(), texts)):
            gone = covered[starts[i]:starts[i + 1]]
            removed = int(gone.sum())
            if removed:
                words = [words[k] for k in np.flatnonzero(~gone).tolist()]
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans = ",".join(f"{a}:{b}" for a, b in turns.reshape(-1, 2).tolist())
            else:
                spans = ""
            rows.append((doc_id, len(gone), removed, b" ".join(words).decode(), spans))
        return blocks.table_of(rows, KEPT)

    repeated = blocks.key_totals(blocked, keys_of, lambda total: total > 1, ranges)
    return blocked.groupBy("_block").cogroup(repeated.groupBy("_block")).applyInArrow(
        lambda table, answers: cut(table, answers) if table.num_rows else blocks.table_of([], KEPT),
        KEPT)
