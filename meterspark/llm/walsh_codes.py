"""Vectors as short codes: one codebook entry per part, found in integers only.

A vector is scaled, floored and cut into equal consecutive parts; a part's code is its nearest entry
by squared Euclidean distance, ties to the lower index. Distances are taken between Walsh-Hadamard
transforms: parts and entries are padded with zeros to a power of two P and transformed by additions
alone, which multiplies every squared distance by P exactly. Squared differences are added up in
sequency order, where smooth data has most of its energy first, and an entry is eliminated as soon as
its running sum exceeds the whole distance of the entry that looked best at first. So no distance is
rounded and no nearest entry is missed.

Rows whose vector is null, empty, or holds null or non-finite components take no part, nor do vectors
whose length is not that of the vector that comes first (by id, nulls last). A length that the
parts do not divide is filled up with zeros. Repeated rows and ids count each by itself. Without any
vector there are no codebooks and no rows. Components too large for 64-bit sums are computed with
Python's integers, so they are exact as well; an error beyond 64 bits is given as 2**63 - 1. Extra
columns play no part; those asked for come along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from meterspark.llm.blocks import batch_of, texts_of

LARGEST = (1 << 63) - 1

#: Of one task: 32-bit digits of the sum of an entry's component; at place -1 how many parts chose it.
SUMS = "part int, entry int, place int, digit int, value long"

#: Components that one task reads at least, where a table lies in many small files.
TASK_COMPONENTS = 1 << 23


@dataclass(frozen=True)
class Codebooks:
    """`entries[part][entry]` holds the integer components of an entry; `width` is those of a part."""
    length: int
    width: int
    scale: int
    entries: list[list[list[int]]]

    def digits(self) -> str:
        """All components in decimal, by part, entry and position."""
        return ",".join(str(x) for part in self.entries for entry in part for x in entry)


def sequency_order(size: int) -> np.ndarray:
    """For each number of sign changes, which row of the natural Hadamard matrix has so many."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    return sum((((gray >> b) & 1) << (bits - 1 - b) for b in range(bits)), np.zeros(size, np.int64))


def transformed(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, padded to a power of two, lowest sequency first."""
    n, width = rows.shape
    size = 1 << max(0, width - 1).bit_length()
    out = np.zeros((n, size), rows.dtype)
    out[:, :width] = rows
    step = 1
    while step < size:
        pairs = out.reshape(n, size // (2 * step), 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return out[:, sequency_order(size)]


def nearest(rows: np.ndarray, entries: np.ndarray, slab: int = 512, first: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Of each transformed row: its nearest transformed entry and their (scaled) squared distance."""
    found, far = np.empty(len(rows), np.int64), np.empty(len(rows), rows.dtype)
    size = rows.shape[1]
    for at in range(0, len(rows), slab):
        x = rows[at:at + slab]
        sums = np.zeros((len(x), len(entries)), rows.dtype)
        for j in range(min(first, size)):
            sums += (x[:, j, None] - entries[None, :, j]) ** 2
        guess = sums.argmin(axis=1)
        bound = ((x - entries[guess]) ** 2).sum(axis=1)
        row, entry = np.nonzero(sums <= bound[:, None])
        part = sums[row, entry]
        for j in range(first, size):
            part = part + (x[row, j] - entries[entry, j]) ** 2
            if j % 2 or j == size - 1:
                left = np.flatnonzero(part <= bound[row])
                row, entry, part = row[left], entry[left], part[left]
        # Pairs are in the order of rows and entries, and each row still has its guess at least.
        starts = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(part, starts)
        ties = np.flatnonzero(part == least[row])
        _, lowest = np.unique(row[ties], return_index=True)
        found[at:at + slab], far[at:at + slab] = entry[ties[lowest]], least
    return found, far


def _integers(batch: pa.RecordBatch, column: str, books: Codebooks) -> np.ndarray:
    """The scaled, floored components, a row per vector, padded to whole parts."""
    values = batch[column].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, books.length)
    size = 1 << max(0, books.width - 1).bit_length()
    most = max(books.scale * float(np.abs(values).max(initial=0.0)),
               *(abs(x) for part in books.entries for entry in part for x in entry), 1) + 1
    if 4.0 * size ** 3 * most * most < 2.0 ** 62:
        whole = np.floor(books.scale * values).astype(np.int64)
    else:
        whole = np.array([[floored(x, books.scale) for x in row] for row in values.tolist()], object)
    out = np.zeros((batch.num_rows, books.width * len(books.entries)), whole.dtype)
    out[:, :books.length] = whole
    return out


def floored(x: float, scale: int) -> int:
    """floor(scale * x) as an exact integer, however large."""
    top, bottom = x.as_integer_ratio()
    return top * scale // bottom


def _assigned(whole: np.ndarray, books: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each part: the entry of every row, and the exact squared distance."""
    for p, entries in enumerate(books.entries):
        rows = transformed(whole[:, p * books.width:(p + 1) * books.width])
        found, far = nearest(rows, transformed(np.array(entries, whole.dtype)))
        yield found, far // rows.shape[1]


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """The rows whose vector has components, all of them finite numbers."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = 4,
          entries: int = 256, rounds: int = 4, scale: int = 1024) -> Codebooks | None:
    """Codebooks that start as the parts of the vectors with the smallest ids; each round assigns all
    parts and moves every entry to the floored mean of its own. None if there is no vector.

    The driver holds the codebooks and a few rows per component of an entry and round, whatever the
    table's size: a task sums up its own parts first, and sums of all tasks meet in Spark, by 32-bit
    digits, so that sums of any size stay exact.
    """
    rows = usable(vectors, vector_col).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    order = [F.col("id").asc_nulls_last(), "vector"]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return None
    length = len(first[0]["vector"])
    width = -(-length // parts)
    rows = rows.filter(F.size("vector") == length)
    seeds = [[floored(x, scale) for x in r["vector"]] + [0] * (width * parts - length)
             for r in rows.orderBy(*order).limit(entries).collect()]
    books = Codebooks(length, width, scale,
                      [[s[p * width:(p + 1) * width] for s in seeds] for p in range(parts)])
    parted = _in_tasks(rows.select("vector"), length)
    for _ in range(rounds):
        sums = parted.mapInArrow(_partial_sums(books), SUMS).groupBy("part", "entry", "place", "digit").agg(
            F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        whole: dict[tuple[int, int], list[int]] = {}
        for r in sums.toLocalIterator():
            places = whole.setdefault((r["part"], r["entry"]), [0] * (width + 1))
            places[r["place"]] += int(r["value"]) << (32 * r["digit"])
        moved = [[*part] for part in books.entries]
        for (part, entry), places in whole.items():
            moved[part][entry] = [x // places[-1] for x in places[:-1]]
        books = Codebooks(length, width, scale, moved)
    return books


def _in_tasks(rows: DataFrame, length: int) -> DataFrame:
    """`rows` in as many tasks as there are cores, or more if a task had too many components else. Small
    files are read together; nothing is shuffled."""
    tasks = -(-rows.count() * length // TASK_COMPONENTS)
    return rows.coalesce(max(tasks, rows.sparkSession.sparkContext.defaultParallelism))


def digits(value: int) -> list[int]:
    """`value` in base 2**32, lowest first; the last digit has the sign."""
    out = []
    while not -(1 << 32) < value < 1 << 32:
        out.append(value & 0xFFFFFFFF)
        value >>= 32
    return [*out, value]


def _partial_sums(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[int]] = {}
        for batch in texts_of(batches, 4096):
            whole = _integers(batch, "vector", books)
            for p, (found, _) in enumerate(_assigned(whole, books)):
                part = whole[:, p * books.width:(p + 1) * books.width]
                order = np.argsort(found, kind="stable")
                chosen, starts, counts = np.unique(found[order], return_index=True, return_counts=True)
                added = np.add.reduceat(part[order], starts, axis=0) if len(order) else part
                for entry, n, sums in zip(chosen.tolist(), counts.tolist(), added.tolist()):
                    had = held.get((p, entry))
                    held[p, entry] = [*sums, n] if had is None else [a + b for a, b in zip(had, [*sums, n])]
        if held:
            yield batch_of([(p, entry, -1 if place == books.width else place, i, digit)
                            for (p, entry), sums in held.items() for place, value in enumerate(sums)
                            for i, digit in enumerate(digits(value))], SUMS)
    return run


def encode(vectors: DataFrame, books: Codebooks | None, id_col: str = "vec_id", vector_col: str = "embedding",
           more: tuple[Column, ...] = ()) -> DataFrame:
    """Per vector: its id, `code` (an entry per part), `error` (squared distances to these entries, in
    scaled units, summed over parts) and the columns `more`."""
    along = vectors.select(F.col(id_col), *more)
    layout = T.StructType([along.schema[0], T.StructField("code", T.ArrayType(T.IntegerType())),
                           T.StructField("error", T.LongType()), *along.schema[1:]])
    rows = usable(vectors, vector_col)
    if books is None:
        return rows.sparkSession.createDataFrame([], layout)
    rows = _in_tasks(rows.filter(F.size(vector_col) == books.length).select(
        F.col(id_col), *more, F.col(vector_col).cast("array<double>").alias("_vector")), books.length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts_of(batches, 4096):
            told = [*_assigned(_integers(batch, "_vector", books), books)]
            codes = np.stack([found for found, _ in told], axis=1).astype(np.int32)
            errors = sum(far.astype(object) for _, far in told)
            listed = pa.ListArray.from_arrays(
                pa.array(np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32)), pa.array(codes.ravel()))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.record_batch(
                [kept[0], listed, pa.array([min(e, LARGEST) for e in errors], pa.int64()), *kept[1:]],
                names=layout.names)

    return rows.mapInArrow(run, layout)


def hexadecimal(code: Column, entries: int = 256) -> Column:
    """The indexes of a code in their order, each with as many hex digits as the largest needs."""
    digits = max(1, math.ceil(math.log(entries, 16)))
    return F.lower(F.concat_ws("", F.transform(code, lambda e: F.lpad(F.hex(e), digits, "0"))))
