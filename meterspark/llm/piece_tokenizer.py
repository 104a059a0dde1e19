"""SentencePiece encoding through a table of distinct chunks.

No piece of the model goes on past a whitespace marker into the next word, so a text's pieces are
those of its chunks: a run of markers and the word after it. Each task segments every distinct chunk
of its batches once and joins the ids back by position. Tables belong to a task and start anew when
they reach `TABLE_CHUNKS`, so memory is bounded whatever the vocabulary; no text is shuffled.

A null or empty text has no ids and decodes to the empty text. Repeated rows are encoded alike.
Other columns than the text pass through unchanged, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from meterspark.llm import blocks

TABLE_CHUNKS = 1 << 17
MARKER = "▁"


class ChunkTable:
    """Ids and decoded text of each distinct chunk seen."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(MARKER in p.lstrip(MARKER) for p in pieces):
            raise ValueError("pieces of this model cross whitespace markers")
        self.marker = self.model.piece_to_id(MARKER)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.lengths, self.decoded = [np.zeros(0, np.int32)], [], []

    def add(self, chunks: dict[str, None]) -> None:
        if len(self.place) > TABLE_CHUNKS:
            self.clear()
        new = [c for c in chunks if c not in self.place]
        # The model puts a marker before what it gets, so a chunk goes without its first.
        ids = [i or [self.marker] for i in self.model.encode([c[1:] for c in new], num_threads=1)]
        for c in new:
            self.place[c] = len(self.place)
        self.ids.append(np.fromiter((i for own in ids for i in own), np.int32))
        self.lengths.extend(map(len, ids))
        if ids:
            self.decoded.extend(" " + d for d in self.model.decode(ids, num_threads=1))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.ids = [np.concatenate(self.ids)]
        lengths = np.array(self.lengths, np.int64)
        return self.ids[0], np.cumsum(lengths) - lengths, lengths


def _chunks(text: str | None) -> list[str]:
    return re.findall(" +[^ ]*", " " + text.replace(MARKER, " ")) if text else []


def _encoded(texts: list[str | None], table: ChunkTable) -> tuple[pa.Array, list[str]]:
    chunks = [_chunks(t) for t in texts]
    distinct: dict[str, None] = {}
    for own in chunks:
        distinct.update(dict.fromkeys(own))
    table.add(distinct)
    ids, starts, lengths = table.arrays()
    place, decoded = table.place, table.decoded
    at = [[place[c] for c in own] for own in chunks]
    counts = np.fromiter(map(len, at), np.int64, len(at))
    each = np.fromiter((p for own in at for p in own), np.int64, int(counts.sum()))
    ends = np.concatenate([[0], np.cumsum(lengths[each])])
    flat = ids[np.repeat(starts[each] - ends[:-1], lengths[each]) + np.arange(ends[-1])]
    offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
    return (pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
            ["".join([decoded[p] for p in own])[1:] for own in at])


def encode(docs: DataFrame, model: str, text_col: str = "text", ids_as: str = "ids",
           decoded_as: str = "decoded") -> DataFrame:
    """`docs` with the ids of the whole text and the text decoded from them, in place of the text.

    `model` is the path of the model's file on every executor.
    """
    rest = [f for f in docs.schema.fields if f.name not in (text_col, ids_as, decoded_as)]
    schema = T.StructType([*rest, T.StructField(ids_as, T.ArrayType(T.IntegerType())),
                           T.StructField(decoded_as, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        for batch in blocks.texts_of(batches, 256):
            ids, decoded = _encoded(batch[text_col].to_pylist(), table)
            yield pa.RecordBatch.from_arrays(
                [*(batch[f.name] for f in rest), ids, pa.array(decoded, pa.string())],
                names=[*(f.name for f in rest), ids_as, decoded_as])

    return docs.select(*[f.name for f in rest], text_col).mapInArrow(run, schema)
