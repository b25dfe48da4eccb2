r"""Chat formatting: turns of conversations become one training text with a loss mask.

Columnar byte assembly.  For a batch of turns numpy computes the length of every segment (marker, role, marker,
text, marker), their cumulative offsets, and the places to which headers and contents are copied in one
preallocated buffer, which becomes an Arrow column without a Python string per turn.

Template: ``<|turn|>ROLE<|text|>TEXT<|end|>\n``.  Within roles and texts ``\`` becomes ``\b`` and ``<`` becomes
``\l``.  So no marker can begin inside a text, and :func:`unescape` gives back every text exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import flat_bytes, runs_by_bytes

#: Fixed values of the template.
TURN, TEXT, END = b"<|turn|>", b"<|text|>", b"<|end|>\n"
LOSS_ROLE = "assistant"
#: Bytes of text that one numpy step works on.
CHUNK = 1 << 23
#: Contents of more bytes are copied as one slice, without an index for each byte.
LARGE = 1 << 16

FORMATTED = "conv_id long, part long, n_turns long, formatted string, loss array<struct<start:long,length:long>>"
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(texts, "\\", "\\b"), "<", "\\l")


def unescape(texts: pa.Array) -> pa.Array:
    """Every backslash of an escaped text is followed by its code, so ``\\l`` never starts inside ``\\b``."""
    return pc.replace_substring(pc.replace_substring(texts, "\\l", "<"), "\\b", "\\")


def scatter(buffer: np.ndarray, starts: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> None:
    """Copies value i (``data[offsets[i]:offsets[i+1]]``) to ``buffer`` at ``starts[i]``."""
    lengths = np.diff(offsets)
    large = np.flatnonzero(lengths > LARGE)
    for i in large:
        buffer[starts[i] : starts[i] + lengths[i]] = data[offsets[i] : offsets[i + 1]]
    if len(large):
        data = data[np.repeat(lengths <= LARGE, lengths)]
        starts, lengths = np.delete(starts, large), np.delete(lengths, large)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
    buffer[np.repeat(starts - offsets[:-1], lengths) + np.arange(len(data))] = data


def stamp(buffer: np.ndarray, starts: np.ndarray, marker: bytes) -> None:
    buffer[starts[:, None] + np.arange(len(marker))] = np.frombuffer(marker, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns, the start of each turn (one more at the end), and the place of each content."""
    role_off, role_data = flat_bytes(escape(roles))
    text_off, text_data = flat_bytes(escape(texts))
    role_len, text_len = np.diff(role_off), np.diff(text_off)
    turns = np.concatenate([[0], np.cumsum(len(TURN) + role_len + len(TEXT) + text_len + len(END))])
    role_at = turns[:-1] + len(TURN)
    text_at = role_at + role_len + len(TEXT)
    buffer = np.empty(int(turns[-1]), np.uint8)
    stamp(buffer, turns[:-1], TURN)
    stamp(buffer, role_at + role_len, TEXT)
    stamp(buffer, text_at + text_len, END)
    scatter(buffer, role_at, role_off, role_data)
    scatter(buffer, text_at, text_off, text_data)
    return buffer, turns, text_at, text_len


def code_points(buffer: np.ndarray) -> np.ndarray:
    """Code points that begin before each byte; one entry more than bytes."""
    return np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])


def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end in runs_by_bytes(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(), CHUNK):
            yield batch.slice(start, end - start)


def _format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_conv, next_part = None, 0
    for batch in bounded(batches):
        conv = batch.column("conv_id")
        ids = conv.fill_null(0).to_numpy(zero_copy_only=False)
        valid = conv.is_valid().to_numpy(zero_copy_only=False)
        new = np.r_[True, (ids[1:] != ids[:-1]) | (valid[1:] != valid[:-1])]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(ids)]
        roles = batch.column("role").fill_null("")
        buffer, turns, text_at, text_len = assemble(roles, batch.column("text").fill_null(""))
        points = code_points(buffer)
        base = points[turns[first]]
        group = np.cumsum(new) - 1
        masked = np.flatnonzero(pc.equal(roles, LOSS_ROLE).to_numpy(zero_copy_only=False))
        loss_start = points[text_at[masked]] - base[group[masked]]
        loss_len = points[text_at[masked] + text_len[masked]] - points[text_at[masked]]
        loss_off = np.searchsorted(masked, np.r_[first, len(ids)]).astype(np.int32)
        part = np.zeros(len(first), np.int64)
        here = conv[0].as_py()
        if open_conv is not None and open_conv[0] == here:
            part[0] = next_part
        open_conv, next_part = (conv[len(ids) - 1].as_py(),), int(part[-1]) + 1
        text = pa.Array.from_buffers(
            pa.large_string(), len(first), [None, pa.py_buffer(turns[np.r_[first, len(ids)]]), pa.py_buffer(buffer)]
        )
        loss = pa.ListArray.from_arrays(
            pa.array(loss_off, pa.int32()),
            pa.StructArray.from_arrays([pa.array(loss_start), pa.array(loss_len)], ["start", "length"]),
        )
        yield pa.RecordBatch.from_arrays(
            [conv.take(pa.array(first)), pa.array(part), pa.array(last - first), text.cast(pa.string()), loss],
            ["conv_id", "part", "n_turns", "formatted", "loss"],
        )


def format_chats(turns: DataFrame) -> DataFrame:
    """Formatted conversations: ``conv_id, part, n_turns, formatted, loss``.

    ``turns`` needs conv_id, turn, role, text; other columns are ignored.  Turns are ordered by turn, then role,
    then text; equal rows stay as often as they occur.  A null role or text counts as empty, a null conv_id is a
    conversation of its own, an empty table gives no row.  ``loss`` lists spans of ``formatted`` in code points,
    one per assistant turn.  A conversation is cut into parts only where an Arrow batch ends, so that none needs
    to fit in memory; joining ``formatted`` by part gives the whole.  Parts follow each other within a partition.
    A single text of any length is formatted whole and is never cut.
    """
    narrow = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role"), F.col("text")
    )
    return (
        narrow.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_format_batches, FORMATTED)
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text, unescaped."""
    out = []
    for turn in formatted.split(END.decode())[:-1]:
        role, text = turn.removeprefix(TURN.decode()).split(TEXT.decode())
        out.append(tuple(unescape(pa.array([role, text])).to_pylist()))
    return out


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.n = conv, hashlib.sha256(), 0
        self.loss, self.loss_chars, self.chars = hashlib.sha256(), 0, 0

    def add(self, formatted: str, spans: list[dict]) -> None:
        self.chars += len(formatted)
        for role, text in parse(formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for span in spans:
            text = unescape(pa.array([formatted[span["start"] : span["start"] + span["length"]]]))[0].as_py()
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    state = None
    for batch in batches:
        rows = []
        cols = (batch.column(c).to_pylist() for c in ("conv_id", "part", "formatted", "loss"))
        for conv, part, formatted, spans in zip(*cols):
            if state is None or part == 0:
                if state is not None:
                    rows.append(state.row())
                state = _Digest(conv)
            state.add(formatted, spans)
        if rows:
            yield table(rows)
    if state is not None:
        yield table([state.row()])


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Reads :func:`format_chats` output back, part by part in its order, and digests each conversation."""
    return formatted.mapInArrow(_digest_batches, DIGEST)
