"""Totals of 64-bit keys over a whole corpus, exchanged between blocks of documents and key ranges.

A row per key of a 100 TB corpus would cost several times the corpus in shuffle. Instead

1. documents are dealt into blocks of a bounded number of bytes (`in_blocks`);
2. each block sends its distinct keys, sorted, cut by key range and delta-coded (`key_totals`):
   a key sends one entry per block at most, however often it occurs;
3. the task of a key range adds up the entries and answers each block in the block's key order;
4. a block meets its answers again in a cogroup, where it derives the same keys once more.

The deal depends on a row and on its input partition alone, so a recomputed task finds the same
blocks, and many equal rows do not end up in one block. Both uses of the blocks have the same
exchange, which Spark runs once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BLOCK_BYTES = 4 << 20
RANGE_KEYS = 1 << 20

#: What a block sends to a key range, and what it gets back.
ENTRIES = "_range int, _block int, n int, first binary, deltas binary, checks binary, weights binary"
ANSWERS = "_block int, _range int, n int, answers binary"

#: Of one block: sorted distinct keys, a second hash of each (or None) and a weight for each.
Keys = tuple[np.ndarray, "np.ndarray | None", np.ndarray]


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, lowest first, without the planes above the largest."""
    v = np.ascontiguousarray(values, dtype="<u8")
    planes = (int(v.max()).bit_length() + 7) // 8 if len(v) else 0
    return v.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpack(blob: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if blob and n:
        planes = np.frombuffer(blob, np.uint8).reshape(-1, n)
        out[:, :len(planes)] = planes.T
    return out.view("<u8").ravel()


def order_of(keys: np.ndarray) -> np.ndarray:
    """An order of 64-bit keys; places of equal keys ascend."""
    return ranked(keys)[0]


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of 64-bit keys, and the keys in it: sorted as one number with their places, which is faster.
    Places take the low bits; what keys begin with alike is dropped, and if others differ just where places lie,
    keys alone decide. Keys that end with zeros enough need not be looked up. Places of equal keys ascend."""
    if not len(keys):
        return np.zeros(0, np.int64), keys
    same = np.uint64(64 - int(keys.max() ^ keys.min()).bit_length())
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    both = keys << same if same < 64 else np.zeros_like(keys)
    whole = not int(np.bitwise_or.reduce(both) & low)
    both &= ~low
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    order = (both & low).astype(np.int64)
    if whole and same < 64:
        both &= ~low
        both >>= same
        both |= keys[0] & ~np.uint64((1 << (64 - int(same))) - 1)
        return order, both
    of = keys[order]
    if not (of[1:] >= of[:-1]).all():
        order = np.argsort(keys, kind="stable")
        of = keys[order]
    return order, of


def doubling(total: int, each: int) -> int:
    """The least power of two of which each part gets at most `each` of `total`, as an exponent."""
    return max(0, (max(1, total) - 1) // each).bit_length()


def in_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES,
              more: tuple[Column, ...] = ()) -> tuple[DataFrame, int]:
    """The documents as (_block, doc_id, text, *more), and their size in bytes."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col) + 1), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    return docs.select(
        F.pmod(F.xxhash64(id_col, F.spark_partition_id()), F.lit(blocks)).cast("int").alias("_block"),
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *more), size


def key_totals(blocked: DataFrame, keys_of: Callable[[pa.Table], Keys],
               answer: Callable[[np.ndarray], np.ndarray], ranges_log2: int,
               bits: int = 64) -> DataFrame:
    """What `answer` makes of the corpus-wide total of each key, for each block in its key order.

    Keys are uniform in their top bits, which name the range. Keys that share 64 bits but differ in
    their check are told apart. Of keys whose top `bits` alone are set, just those are sent.
    """
    shift = np.uint64(64 - ranges_log2) if ranges_log2 else None
    low = np.uint64(64 - bits)

    def entries(table: pa.Table) -> pa.Table:
        keys, checks, weights = keys_of(table)
        at = (keys >> shift).astype(np.int64) if shift is not None else np.zeros(len(keys), np.int64)
        ranges, starts = np.unique(at, return_index=True)
        block, ends = table["_block"][0].as_py(), np.append(starts[1:], len(keys))
        rows = []
        for r, a, b in zip(ranges.tolist(), starts.tolist(), ends.tolist()):
            k = keys[a:b]
            rows.append((r, block, b - a, k[:1].tobytes(), pack(np.diff(k, prepend=k[:1]) >> low),
                         checks[a:b].tobytes() if checks is not None else None, pack(weights[a:b])))
        return table_of(rows, ENTRIES)

    def totals(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        n = [r["n"] for r in rows]
        keys = np.concatenate([np.frombuffer(r["first"], "<u8") + np.cumsum(
            unpack(r["deltas"], r["n"]) << low, dtype=np.uint64) for r in rows])
        weights = np.concatenate([unpack(r["weights"], r["n"]) for r in rows])
        checks = (np.concatenate([np.frombuffer(r["checks"], np.uint16) for r in rows])
                  if rows[0]["checks"] is not None else np.zeros(len(keys), np.uint16))
        order = np.argsort(keys, kind="stable")
        k, c = keys[order], checks[order]
        if ((k[1:] == k[:-1]) & (c[1:] != c[:-1])).any():
            order = np.lexsort((checks, keys))
            k, c = keys[order], checks[order]
        starts = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])))
        sums = np.add.reduceat(weights[order], starts)
        each = np.empty(len(keys), np.uint64)
        each[order] = np.repeat(sums, np.diff(np.append(starts, len(keys))))
        parts = np.split(answer(each), np.cumsum(n)[:-1])
        return table_of([(r["_block"], r["_range"], r["n"], pack(p)) for r, p in zip(rows, parts)],
                        ANSWERS)

    return (blocked.groupBy("_block").applyInArrow(entries, ENTRIES)
            .groupBy("_range").applyInArrow(totals, ANSWERS))


def answers_of(table: pa.Table) -> np.ndarray:
    """All answers to a block, in the order of its sorted keys."""
    rows = sorted(table.to_pylist(), key=lambda r: r["_range"])
    return np.concatenate([np.zeros(0, np.uint64), *(unpack(r["answers"], r["n"]) for r in rows)])


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(),
          "double": pa.float64(), "boolean": pa.bool_(), "array<binary>": pa.list_(pa.binary()),
          "array<int>": pa.list_(pa.int32())}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def table_of(rows: list[tuple], ddl: str) -> pa.Table:
    schema = arrow_schema(ddl)
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def batch_of(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def texts_of(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `rows` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
