"""Chat formatting by columnar byte assembly, with a loss mask, and reading it back.

Every turn is an opening mark, its escaped text, a closing mark and a line feed:

    system     <<SYS>>text<</SYS>>
    user       [INST]text[/INST]
    assistant  <s>text</s>
    other      <<ROLE name>>text<</ROLE>>     (name percent-encoded)

Where a text holds one of these control strings, one backslash goes in after its
first character; strings that already have backslashes there get one more, so
taking one away again is exact, and no text holds a control string as it is. The
loss mask has the place and length, in characters, of each assistant text.

Turns are dealt by ranges of (conversation, turn, role, text), so one that holds a
third of all turns is formatted by many tasks, and each Arrow batch is assembled at
once: segment lengths, their cumulative offsets and the scatter indices are numpy
arrays, and marks and texts are copied into one preallocated buffer, which becomes
the string column. A conversation that goes over several ranges or batches gives a row
for each (``part``, ``chunk``, in this order), so memory is bounded by a batch, not by a conversation.

Defined results: a null text or role is an empty one. Turns are in order of turn
(null first), then role and text, so repeated turns stay, next to each other. A
null conversation id is one conversation. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, flat_bytes, map_arrow, small_batches

MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE_OPEN, ROLE_CLOSE = "<<ROLE {}>>", "<</ROLE>>"
AFTER_FIRST = r"/?INST\]|/?s>|</?SYS>>|<ROLE |</ROLE>>"
"""The control strings without their first character, which is [ or <."""
LOSS_ROLE = "assistant"
SCATTER = 1 << 20
HEAD = 64

_ESCAPE = rf"([\[<])(\\*)({AFTER_FIRST})"
_UNESCAPE = re.compile(rf"([\[<])\\(\\*{AFTER_FIRST.join(('(?:', ')'))})")
_OPEN = re.compile(r"<<SYS>>|\[INST\]|<s>|<<ROLE ([^>]*)>>")
_ROLE_OF = {opening: role for role, (opening, _) in MARKS.items()}


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, pattern=_ESCAPE, replacement=r"\1\\\2\3")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def marks(role: str) -> tuple[str, str]:
    opening, closing = MARKS.get(role) or (ROLE_OPEN.format(quote(role, safe="")), ROLE_CLOSE)
    return opening, closing + "\n"


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation, or of one chunk of it."""
    turns, at = [], 0
    while at < len(text):
        opening = _OPEN.match(text, at)
        role = _ROLE_OF.get(opening[0]) or unquote(opening[1])
        closing = marks(role)[1]
        end = text.index(closing, opening.end())
        turns.append((role, unescape(text[opening.end():end])))
        at = end + len(closing)
    return turns


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
    """Copy data[start:start + size] to ``to`` for every segment, about ``SCATTER`` bytes at a time."""
    ends = np.cumsum(size)
    first, before = 0, 0
    while first < len(size):
        last = max(first + 1, int(np.searchsorted(ends, before + SCATTER, side="right")))
        if last == first + 1:
            out[to[first]:to[first] + size[first]] = data[start[first]:start[first] + size[first]]
        else:
            n = size[first:last]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(to[first:last], n) + within] = data[np.repeat(start[first:last], n) + within]
        first, before = last, int(ends[last - 1])


def assemble(roles: pa.Array, texts: pa.Array, first: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Formatted text, loss starts and loss lengths of conversations that begin at turns ``first``."""
    roles = roles.fill_null("").dictionary_encode()
    names, role = roles.dictionary.to_pylist(), roles.indices.to_numpy()
    escaped = escape(texts.fill_null(""))
    content, offsets = flat_bytes(escaped)

    heads = [x for name in names for x in marks(name)]
    table = np.frombuffer("".join(heads).encode(), np.uint8)
    head_size = np.array([len(x) for x in heads], np.int64)  # marks are ASCII
    head_start = np.cumsum(head_size) - head_size

    n = len(role)
    sizes = np.empty((n, 3), np.int64)
    sizes[:, 0], sizes[:, 1], sizes[:, 2] = head_size[2 * role], np.diff(offsets), head_size[2 * role + 1]
    ends = np.cumsum(sizes.ravel())
    starts = (ends - sizes.ravel()).reshape(n, 3)
    buffer = pa.allocate_buffer(int(ends[-1]))
    out = np.frombuffer(buffer, np.uint8)
    _scatter(out, starts[:, 0], table, head_start[2 * role], sizes[:, 0])
    _scatter(out, starts[:, 1], content, offsets[:-1], sizes[:, 1])
    _scatter(out, starts[:, 2], table, head_start[2 * role + 1], sizes[:, 2])
    bounds = np.append(starts[first, 0], ends[-1]).astype(np.int32)
    formatted = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(bounds.tobytes()), buffer])

    chars = pc.utf8_length(escaped).to_numpy().astype(np.int64)
    turn_chars = sizes[:, 0] + chars + sizes[:, 2]
    before = np.cumsum(turn_chars) - turn_chars
    of = np.searchsorted(first, np.arange(n), side="right") - 1
    place = before - before[first][of] + sizes[:, 0]
    loss = np.flatnonzero(np.array([x == LOSS_ROLE for x in names])[role])
    cuts = pa.array(np.searchsorted(loss, np.append(first, n)), pa.int32())
    return (formatted, pa.ListArray.from_arrays(cuts, pa.array(place[loss])),
            pa.ListArray.from_arrays(cuts, pa.array(chars[loss])))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, chunk, part = None, 0, TaskContext.get().partitionId()
    for batch in small_batches(batches, "text"):
        conv = batch.column("conv")
        codes = conv.dictionary_encode(null_encoding="encode").indices.to_numpy()
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        chunks = np.zeros(len(first), np.int32)
        if last is not None and last[0].equals(conv[0]):
            chunks[0] = chunk + 1
        last, chunk = (conv[batch.num_rows - 1],), int(chunks[-1])
        found = assemble(batch.column("role"), batch.column("text"), first)
        parts = pa.array(np.full(len(first), part, np.int32))
        yield pa.RecordBatch.from_arrays([conv.take(pa.array(first)), parts, pa.array(chunks), *found],
                                         ["conv_id", "part", "chunk", "formatted", "loss_starts", "loss_lengths"])


def format_chat(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """conv_id, part, chunk, formatted, loss_starts, loss_lengths (places in the chunk's text)."""
    turns = df.select(col(conv_col).alias("conv"), col(turn_col).alias("turn"),
                      col(role_col).cast("string").alias("role"), col(text_col).cast("string").alias("text"))
    # a text's beginning is enough for the borders: turns that share it stay in one range, in order of the whole text
    dealt = turns.withColumn("head", F.substring("text", 1, HEAD)).repartitionByRange("conv", "turn", "role", "head")
    turns = dealt.sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    return map_arrow(turns, _format, f"conv_id {turns.schema['conv'].dataType.simpleString()}, part int, chunk int, "
                     "formatted string, loss_starts array<bigint>, loss_lengths array<bigint>")


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, starts: list[int], lengths: list[int]) -> None:
        for role, said in parse(text):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
        for start, length in zip(starts, lengths, strict=True):
            said = unescape(text[start:start + length])
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.chars += len(text)

    def row(self) -> tuple:
        return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now, types = None, [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for batch in small_batches(batches, "formatted"):
        rows, types[0] = [], batch.schema.field("conv_id").type
        for conv, text, starts, lengths in zip(*(batch.column(x).to_pylist() for x in
                                                 ("conv_id", "formatted", "loss_starts", "loss_lengths")), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    rows.append(now.row())
                now = _Digest(conv)
            now.add(text, starts, lengths)
        if rows:
            yield made(rows)
    if now is not None:
        yield made([now.row()])


def digests(formatted: DataFrame) -> DataFrame:
    """What reading a formatted table back gives, one row a conversation, its chunks in order."""
    # the digest of a conversation reads its chunks one after the other
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    return map_arrow(dealt, _digests, f"conv_id {dealt.schema['conv_id'].dataType.simpleString()}, n_turns long, "
                     "turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
