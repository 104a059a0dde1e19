"""Chat formatting with loss masks that follow character offsets.

A conversation is rendered once as a whole and encoded once, with the offsets of every token. Turn
spans and token spans are both sorted, so the tokens under a turn are found by two binary searches.

The template puts each turn between control strings:

    <s>[ROLE]role[/ROLE][INST]text[/INST]</s>      and, for the assistant,
    <s>[ROLE]assistant[/ROLE]text</s>

Control strings inside roles and texts are broken by the escape character after their first
character, and the escape character itself is doubled, so that the rendering can be read back. The
tokenizer knows control strings as tokens of their own; no token reaches over the edge of a text.

Turns are in the order of `turn` (nulls first), equal ones by role and text. A null role or text is
empty. Rows without conversation id make one conversation. Repeated rows are repeated turns. Extra
columns play no part.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from tokenizers import AddedToken, Tokenizer, processors

ESCAPE = "␛"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
_CONTROL = re.compile("|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROLS))
_TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](?:\[INST\](.*?)\[/INST\]|(.*?))</s>", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(ESCAPE, text.replace(ESCAPE, ESCAPE * 2))


def unescape(text: str) -> str:
    return re.sub(f"{ESCAPE}({ESCAPE}?)", r"\1", text)


def render(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, list[int]]:
    """The conversation, and start and end of each trained text in turn."""
    parts, edges, at = [], [], 0
    for role, text in turns:
        head, tail = ("", "") if role == trained else ("[INST]", "[/INST]")
        before = f"<s>[ROLE]{escape(role)}[/ROLE]{head}"
        body = escape(text)
        if role == trained:
            edges += [at + len(before), at + len(before) + len(body)]
        parts += [before, body, tail, "</s>"]
        at += len(before) + len(body) + len(tail) + 4
    return "".join(parts), edges


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(unescape(m[1]), unescape(m[2] if m[2] is not None else m[3]))
            for m in _TURN.finditer(formatted)]


def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.add_tokens([AddedToken(c, normalized=False) for c in CONTROLS])
    return tokenizer


def loss_mask(starts: np.ndarray, ends: np.ndarray, edges: list[int]) -> np.ndarray:
    """Which tokens lie under the sorted spans edges[0]:edges[1], edges[2]:edges[3], ..."""
    first = np.searchsorted(ends, edges[::2], side="right")
    last = np.searchsorted(starts, edges[1::2], side="left")
    filled = np.asarray(edges[1::2]) > np.asarray(edges[::2])
    mask = np.zeros(len(starts) + 1, np.int64)
    np.add.at(mask, first[filled], 1)
    np.add.at(mask, last[filled], -1)
    return np.cumsum(mask)[:-1] > 0


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """All text under the mask, each character once, as it was before escaping."""
    under = np.zeros(len(formatted) + 1, np.int64)
    np.add.at(under, starts[mask], 1)
    np.add.at(under, ends[mask], -1)
    inside = np.concatenate([[0], (np.cumsum(under)[:-1] > 0).astype(np.int8), [0]])
    turns = np.flatnonzero(np.diff(inside)).reshape(-1, 2).tolist()
    return "".join(unescape(formatted[a:b]) for a, b in turns)


def format_chats(turns: DataFrame, tokenizer: str, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: n_turns, formatted, and per token its id, start, end (code points of
    `formatted`) and whether it counts for the loss. `tokenizer` is a file on every executor."""
    id_type = turns.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("conv_id", id_type), T.StructField("n_turns", T.LongType()),
        T.StructField("formatted", T.StringType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("loss", T.ArrayType(T.BooleanType()))])
    loaded: dict[str, Tokenizer] = {}

    def conversation(table: pa.Table) -> pa.Table:
        if tokenizer not in loaded:
            loaded[tokenizer] = load(tokenizer)
        rows = [(r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or "")
                for r in table.select(["turn", "role", "text"]).to_pylist()]
        rows.sort()
        formatted, edges = render([(role, text) for _, _, role, text in rows])
        encoded = loaded[tokenizer].encode(formatted, add_special_tokens=False)
        spans = np.array(encoded.offsets, np.int32).reshape(-1, 2)
        loss = loss_mask(spans[:, 0], spans[:, 1], edges)
        return pa.table([
            table["conv_id"].slice(0, 1), pa.array([len(rows)], pa.int64()), pa.array([formatted]),
            pa.array([np.array(encoded.ids, np.int32)], pa.list_(pa.int32())),
            pa.array([spans[:, 0]], pa.list_(pa.int32())),
            pa.array([spans[:, 1]], pa.list_(pa.int32())), pa.array([loss], pa.list_(pa.bool_()))],
            names=schema.names)

    return turns.selectExpr(
        f"`{id_col}` AS conv_id", f"`{turn_col}` AS turn", f"`{role_col}` AS role",
        f"`{text_col}` AS text").groupBy("conv_id").applyInArrow(conversation, schema)
