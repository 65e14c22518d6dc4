"""Chat formatting: conversations as one masked training text each, assembled columnwise.

The text of a conversation is ``<s>``, its turns, ``</s>``. A turn is ``<|turn|>``, the
role, a line feed, the text, ``<|end|>``. Inside roles and texts every backslash is
doubled and every control string gets a backslash after its first character (a line feed
in a role gets one before it), so no control string occurs inside them and dropping the
first of each backslash pair gives them back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strings that a text must not hold unescaped; those of the template and other common ones.
CONTROLS = ("<s>", "</s>", "<|turn|>", "<|end|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Any first character and rest of a control string; splitting a few more strings does no harm.
SPLIT = r"([<\[])(/?s>|\|turn\|>|\|end\|>|/?INST\]|</?SYS>>)"

OPEN, TURN, NEWLINE, END, CLOSE = b"<s>", b"<|turn|>", b"\n", b"<|end|>", b"</s>"
SCHEMA = (
    "conv_id {key}, n_turns bigint, formatted binary, mask array<struct<start:bigint,length:bigint>>"
)


def format_conversations(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted (UTF-8 bytes), mask.

    ``mask`` holds the byte spans of the texts of ``trained_role``, escapes included.
    Turns are ordered by ``turn``, NULL first, ties by role and text; repeated rows are
    repeated turns. NULL roles and texts count as empty; rows without conversation id
    form one conversation with a NULL id; an empty table gives no rows. Other columns are
    left out, whatever their names. A conversation is one cell, so it must stay below
    2 GB; tasks hold one conversation or one Arrow batch at a time.
    """
    key = df.schema[conv].dataType.simpleString()
    rows = df.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_conversations(batches):
            yield _assemble(table, trained_role)

    return ordered.select("conv_id", "role", "text").mapInArrow(assemble, SCHEMA.format(key=key))


def _whole_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of ``batches`` cut only between conversations."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        code = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
        starts = np.flatnonzero(np.diff(code)) + 1
        if held and held[-1].column(0)[-1].as_py() != batch.column(0)[0].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if len(starts):
            cut = int(starts[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _escaped(column: pa.ChunkedArray, role: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column after escaping."""
    column = pc.replace_substring(column.cast(pa.large_string()), "\\", "\\\\")
    column = pc.replace_substring_regex(column, SPLIT, r"\1\\\2")
    if role:
        column = pc.replace_substring(column, "\n", "\\\n")
    one = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    _, offsets, data = one.buffers()
    offsets = np.frombuffer(offsets, np.int64)[one.offset : one.offset + len(one) + 1]
    return np.frombuffer(data or b"", np.uint8), offsets


def _scatter(target: np.ndarray, at: np.ndarray, source: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
    """Copy segment i of ``source`` (start, length) to ``target`` from ``at[i]`` on.

    Index arrays are made for a few million bytes at a time.
    """
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + 4_000_000)))
        n = lengths[first:last]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        target[np.repeat(at[first:last], n) + inside] = source[np.repeat(starts[first:last], n) + inside]
        first = last


def _assemble(table: pa.Table, trained_role: str) -> pa.RecordBatch:
    n = table.num_rows
    code = table.column(0).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    conv_of = np.cumsum(np.r_[False, code[1:] != code[:-1]])
    roles, role_at = _escaped(table.column(1), role=True)
    texts, text_at = _escaped(table.column(2))
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    # Offsets: turns follow one another; each conversation adds its opening and closing.
    turn_len = len(TURN) + role_len + len(NEWLINE) + text_len + len(END)
    turn_at = np.cumsum(turn_len) - turn_len + conv_of * (len(OPEN) + len(CLOSE)) + len(OPEN)
    total = int(turn_len.sum()) + len(first) * (len(OPEN) + len(CLOSE))
    conv_at = np.r_[turn_at[first] - len(OPEN), total]
    out = np.empty(total, np.uint8)

    def constant(value: bytes, at: np.ndarray) -> None:
        for i, byte in enumerate(value):
            out[at + i] = byte

    body_at = turn_at + len(TURN) + role_len + len(NEWLINE)
    constant(OPEN, conv_at[:-1])
    constant(TURN, turn_at)
    constant(NEWLINE, body_at - len(NEWLINE))
    constant(END, body_at + text_len)
    constant(CLOSE, conv_at[1:] - len(CLOSE))
    _scatter(out, turn_at + len(TURN), roles, role_at[:-1], role_len)
    _scatter(out, body_at, texts, text_at[:-1], text_len)

    trained = pc.equal(table.column(1), trained_role).to_numpy(zero_copy_only=False) if n else np.zeros(0, bool)
    spans = pa.StructArray.from_arrays(
        [pa.array(body_at[trained] - conv_at[conv_of[trained]]), pa.array(text_len[trained])], ["start", "length"]
    )
    counts = np.bincount(conv_of[trained], minlength=len(first))
    mask = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), spans)
    formatted = pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(conv_at.astype(np.int32)), pa.py_buffer(out)]
    )
    keys = table.column(0).combine_chunks().take(pa.array(first))
    return pa.RecordBatch.from_arrays(
        [keys, pa.array(np.diff(np.r_[first, n])), formatted, mask], ["conv_id", "n_turns", "formatted", "mask"]
    )


def unescaped(text: Column) -> Column:
    """A role or text as it was."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text), read from its bytes."""
    text = formatted.cast("string")
    inner = text.substr(F.lit(len(OPEN) + 1), F.char_length(text) - len(OPEN) - len(CLOSE))
    pieces = F.split(inner, r"<\|end\|>")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    header = r"(?s)^<\|turn\|>((?:[^\\\n]++|\\.)*+)\n(.*)$"
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.regexp_extract(p, header, 1)).alias("role"),
            unescaped(F.regexp_extract(p, header, 2)).alias("text"),
        ),
    )


def read_mask(formatted: Column, mask: Column) -> Column:
    """The masked texts, in order, as they were."""
    return F.transform(
        mask,
        lambda m: unescaped(F.substring(formatted, m["start"].cast("int") + 1, m["length"].cast("int")).cast("string")),
    )
