"""Chat formatting by columnar byte assembly.

Every turn becomes ``### role: text</turn>`` and a newline. Control strings inside roles and texts are escaped
reversibly: ``\\`` as ``\\b``, ``###`` as ``\\h``, ``</turn>`` as ``\\e`` and, in roles, ``:`` as ``\\c``; so neither
``###`` nor ``</turn>`` ever stands inside a turn. Per batch, the lengths of all segments (header, text, end) give
cumulative offsets, and one scatter of bytes fills a single preallocated buffer that becomes the Arrow column.

The output has one row per segment of at most ``segment_turns`` turns of a conversation, so a conversation of any length
is never held whole: conversations are dealt out by key, sorted by turn inside a partition and streamed.

Defined results: a null role or text counts as empty; turns are ordered by (turn, role, text), nulls first; repeated
rows are repeated turns; rows without a conversation id form one conversation with a null id; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template and its escapes, in the order they are applied.
HEAD, COLON, END = "### ", ": ", "</turn>\n"
ESCAPES = [("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e")]
ROLE_ESCAPES = [*ESCAPES, (":", "\\c")]
TRAINED = "assistant"
SLICE = 1 << 22  # bytes of text assembled at once, one turn at least
LONG = 1 << 12  # bytes of a segment that is copied by itself

FORMATTED = "conv_id long, segment long, formatted string, loss_starts array<int>, loss_ends array<int>"
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "loss_spans long"
)


def escaped(column: pa.Array, pairs: list[tuple[str, str]]) -> pa.Array:
    for plain, code in pairs:
        column = pc.replace_substring(column, plain, code)
    return column


def unescaped(text: str, pairs: list[tuple[str, str]]) -> str:
    if "\\" in text:
        for plain, code in reversed(pairs):
            text = text.replace(code, plain)
    return text


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), bounds


def scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
    """Copy segment i of ``data`` to ``out[at[i]:]``: long ones each by itself, all others at once."""
    for i in np.flatnonzero(lengths > LONG):
        out[at[i] : at[i] + lengths[i]] = data[starts[i] : starts[i] + lengths[i]]
    short = lengths <= LONG
    at, starts, lengths = at[short], starts[short], lengths[short]
    total = int(lengths.sum())
    if total:
        step = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(at, lengths) + step] = data[np.repeat(starts, lengths) + step]


def assemble(roles: pa.Array, texts: pa.Array, firsts: np.ndarray):
    """The formatted segments whose turns begin at ``firsts`` (one more at the end), and each text's code-point span."""
    roles = escaped(pc.fill_null(roles, ""), ROLE_ESCAPES)
    texts = escaped(pc.fill_null(texts, ""), ESCAPES)
    parts = []
    for column in (HEAD, roles, COLON, texts, END):
        if isinstance(column, str):
            data = np.frombuffer(column.encode(), np.uint8)
            parts.append((data, np.zeros(len(roles), np.int64), np.full(len(roles), len(data))))
        else:
            data, bounds = text_bytes(column)
            parts.append((data, bounds[:-1], np.diff(bounds)))
    lengths = np.stack([length for _, _, length in parts])
    turn_bytes = lengths.sum(axis=0)
    turn_at = np.concatenate([[0], np.cumsum(turn_bytes)])
    out = np.empty(int(turn_at[-1]), np.uint8)
    at = turn_at[:-1].copy()
    for data, starts, length in parts:
        scatter(out, at, data, starts, length)
        at += length
    formatted = pa.LargeStringArray.from_buffers(
        len(firsts) - 1, pa.py_buffer(turn_at[firsts].astype(np.int64).tobytes()), pa.py_buffer(out)
    )
    role_chars, text_chars = (pc.utf8_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (roles, texts))
    chars = role_chars + text_chars + len(HEAD) + len(COLON) + len(END)
    char_at = np.concatenate([[0], np.cumsum(chars)])
    segment = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    starts = char_at[:-1] - char_at[firsts[segment]] + len(HEAD) + role_chars + len(COLON)
    return formatted, starts, starts + text_chars


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about ``SLICE`` bytes of text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE, "right")))
            yield batch.slice(at, to - at)
            at = to


def segments_of(batch: pa.RecordBatch, last: tuple | None, turns_done: int, segment_turns: int):
    """Where segments begin in a sorted batch, and conversation and segment number of each."""
    ids = batch.column("conv_id").to_pylist()
    firsts, keys = [], []
    for at, conv in enumerate(ids):
        if last is None or last[0] != conv:
            last, turns_done = (conv,), 0
            firsts.append(at)
            keys.append((conv, 0))
        elif turns_done % segment_turns == 0 or at == 0:
            firsts.append(at)
            keys.append((conv, turns_done))
        turns_done += 1
    return np.array([*firsts, len(ids)]), keys, last, turns_done


def dealt(df: DataFrame, *order: str) -> DataFrame:
    """Conversations whole in a partition, in order."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_chats(turns: DataFrame, trained: str = TRAINED, segment_turns: int = 64) -> DataFrame:
    """conv_id, segment (its first turn's index), formatted, and code-point spans of the trained texts within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, 0
        for batch in slices(batches):
            firsts, keys, last, done = segments_of(batch, last, done, segment_turns)
            formatted, starts, ends = assemble(batch.column("role"), batch.column("text"), firsts)
            masked = pc.fill_null(pc.equal(batch.column("role"), trained), False).to_numpy(zero_copy_only=False)
            before = np.concatenate([[0], np.cumsum(masked)])[firsts].astype(np.int32)
            spans = [pa.ListArray.from_arrays(pa.array(before), pa.array(x[masked], pa.int32())) for x in (starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([conv for conv, _ in keys], pa.int64()),
                    pa.array([segment for _, segment in keys], pa.int64()),
                    formatted.cast(pa.string()),
                    *spans,
                ],
                names=["conv_id", "segment", "formatted", "loss_starts", "loss_ends"],
            )

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.col("role"), F.col("text")
    )
    return dealt(rows, "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


class Reader:
    """Digests of one conversation, fed with its segments in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.loss_chars, self.spans = conv_id, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, formatted: str, starts: list[int], ends: list[int]) -> None:
        if not formatted.endswith(END):
            raise ValueError(f"conversation {self.conv_id}: a segment without its end mark")
        for turn in formatted[: -len(END)].split(END):
            if not turn.startswith(HEAD):
                raise ValueError(f"conversation {self.conv_id}: a turn without its header")
            role, _, text = turn[len(HEAD) :].partition(COLON)
            role, text = unescaped(role, ROLE_ESCAPES), unescaped(text, ESCAPES)
            self.all.update(f"{role}\n{text}\n".encode())
            self.turns += 1
        for start, end in zip(starts, ends, strict=True):
            text = unescaped(formatted[start:end], ESCAPES)
            self.loss.update(text.encode())
            self.loss_chars += len(text)
            self.spans += 1
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
            self.spans,
        )


def rows_of(readers: list[Reader], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*[reader.row() for reader in readers], strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def digests() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [
            (name, pa.string() if kind == "string" else pa.int64())
            for name, kind in (part.split() for part in DIGEST.split(", "))
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if reader is None or reader.conv_id != row["conv_id"]:
                    reader = Reader(row["conv_id"])
                    done.append(reader)
                reader.feed(row["formatted"], row["loss_starts"], row["loss_ends"])
            if len(done) > 1:
                yield rows_of(done[:-1], schema)
                del done[:-1]
        if done:
            yield rows_of(done, schema)

    return run


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, what the formatted segments say: turns, digests of all text and of the text under the mask."""
    return dealt(formatted, "segment").mapInArrow(digests(), DIGEST)
