"""Conversations as one text with marked turns, placeholders and a loss mask.

A message is a list of typed parts: ``text``, ``image``, ``audio`` or ``document``. A
visitor walks through them in order. Text is escaped; any other part becomes a placeholder
that carries the number of the attachment within its message, and its reference, its place
and the tokens that the placeholder expands to are recorded.

The template writes ``START role MIDDLE body END`` for each turn. All marks hold one of
the strings of ``CONTROL``, and in a text these are broken by a backslash behind their
first character: one more than there are already, so that removing one restores the text.
No mark is left in an escaped text, and what is written can be split at the marks.

A formatted conversation is its pieces, one row per message, in the order of ``turn``. A
message is formatted where it lies. Only reading back and its digests need the pieces of a
conversation together: they are dealt by conversation, sorted, and read as a stream with a
running digest, so a conversation of any length takes the memory of one batch. SHA-256 of a
whole conversation has no parallel form; the formatted rows do not depend on it.

Defined cases: null texts and null roles are empty; a message without parts has an empty
body. A part of an unknown or null kind is a ``file``. Null turns come last; turns that
tie are ordered by their pieces. Messages without a conversation are one conversation. The
text parts of an assistant's message are under the loss mask, placeholders are not. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.llm.common import map_batches

# The template's marks, and the strings that must not stand in a text.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED = "assistant"
#: Tokens for each unit of a part: tiles of an image, seconds of a sound, pages of a document.
TOKENS = {"image": 256, "audio": 25, "document": 800, "file": 1}

_AFTER = "|".join(re.escape(c[1:]) for c in CONTROL)
_FIRST = "".join(sorted({re.escape(c[0]) for c in CONTROL}))
_RAW = re.compile(rf"([{_FIRST}])(\\*+)(?={_AFTER})")
_BROKEN = re.compile(rf"([{_FIRST}])\\(\\*+)(?={_AFTER})")
_PART = "struct<kind string, text string, ref string, units bigint>"
_SPAN = "struct<start: int, stop: int>"
_ATTACHED = "struct<kind: string, ref: string, place: int, tokens: bigint>"
PIECES = f"piece string, loss array<{_SPAN}>, attachments array<{_ATTACHED}>, expanded long"


def escaped(text: str) -> str:
    return _RAW.sub(r"\1\2\\", text)


def unescaped(text: str) -> str:
    return _BROKEN.sub(r"\1\2", text)


class Flattener:
    """Visits the parts of one message in order and writes its piece."""

    def __init__(self, role: str):
        self.learned = role == LEARNED
        self.written = [START, escaped(role), MIDDLE]
        self.length = sum(map(len, self.written))
        self.loss, self.attachments, self.expanded = [], [], 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind']}", self.visit_file)(part)

    def visit_text(self, part: dict) -> None:
        start = self.length
        self._write(escaped(part["text"] or ""))
        if self.learned:
            self.loss.append({"start": start, "stop": self.length})

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)

    def visit_file(self, part: dict) -> None:
        self._attach("file", part)

    def _attach(self, kind: str, part: dict) -> None:
        tokens = TOKENS[kind] * max(part["units"] if part["units"] is not None else 1, 0)
        self.attachments.append({"kind": kind, "ref": part["ref"], "place": self.length, "tokens": tokens})
        self.expanded += tokens
        self._write(f"<|{kind}:{len(self.attachments) - 1}|>")

    def _write(self, text: str) -> None:
        self.written.append(text)
        self.length += len(text)

    def piece(self) -> str:
        return "".join([*self.written, END])


_PLACEHOLDER = re.compile(r"<\|(\w+):(\d+)\|>")


def read_piece(piece: str) -> tuple[str, list[tuple[str, str]]]:
    """Role and parts of a written turn: ``("text", text)`` or ``(kind, number)``."""
    if not (piece.startswith(START) and piece.endswith(END)):
        raise ValueError("not a turn of this template")
    role, body = piece[len(START) : -len(END)].split(MIDDLE, 1)
    parts, at = [], 0
    for found in _PLACEHOLDER.finditer(body):
        if found.start() > at:
            parts.append(("text", unescaped(body[at : found.start()])))
        parts.append((found[1], found[2]))
        at = found.end()
    if at < len(body):
        parts.append(("text", unescaped(body[at:])))
    return unescaped(role), parts


def text_part(text: str = "text") -> Column:
    """The parts of a message that is one text."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.col(text).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")))


def formatted(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, piece, loss, attachments, expanded`` per message ``conv_id, turn, role, parts``; no shuffle.

    ``loss`` are spans of code points in ``piece``; ``attachments`` tell kind, reference,
    place in ``piece`` and tokens; ``expanded`` is the sum of these tokens.
    """
    rows = messages.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", F.col("parts").cast(f"array<{_PART}>"))

    def run(batches):
        for batch in batches:
            done = []
            for role, parts in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist()):
                writer = Flattener(role or "")
                for part in parts or []:
                    if part is not None:
                        writer.visit(part)
                done.append(writer)
            span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
            attached = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("place", pa.int32()), ("tokens", pa.int64())])
            yield {
                "conv_id": batch.column("conv_id"),
                "turn": batch.column("turn"),
                "piece": pa.array([w.piece() for w in done], pa.string()),
                "loss": pa.array([w.loss for w in done], pa.list_(span)),
                "attachments": pa.array([w.attachments for w in done], pa.list_(attached)),
                "expanded": pa.array([w.expanded for w in done], pa.int64()),
            }

    schema = rows.select("conv_id", "turn").withColumns(
        {n: F.lit(None).cast(t) for n, t in (("piece", "string"), ("loss", f"array<{_SPAN}>"), ("attachments", f"array<{_ATTACHED}>"), ("expanded", "bigint"))}
    ).schema
    return map_batches(rows, run, schema)


class _Reader:
    """Running digests over the pieces of one conversation."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_attachments = self.expanded = 0

    def read(self, piece: str, loss: list, attachments: list, expanded: int) -> None:
        role, parts = read_piece(piece)
        self.turns.update(f"{role}\n".encode())
        for kind, text in parts:
            self.turns.update((text if kind == "text" else f"<{attachments[int(text)]['ref'] or ''}>").encode())
        self.turns.update(b"\n")
        for span in loss:
            text = unescaped(piece[span["start"] : span["stop"]])
            self.learned.update(text.encode())
            self.loss_chars += len(text)
        self.n_turns += 1
        self.chars += len(piece)
        self.n_attachments += len(attachments)
        self.expanded += expanded

    def row(self) -> tuple:
        return (
            self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.learned.hexdigest(),
            self.chars, self.n_attachments, self.expanded,
        )


_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_attachments long, expanded_tokens long"
)


def _read_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row per conversation of a sorted stream of pieces, whose ends need not be those of batches."""
    names = [field.split()[0] for field in _DIGESTS.split(", ")]
    reader = None

    def rows(done):
        kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
        return {n: pa.array([r[i] for r in done], kinds[i]) for i, n in enumerate(names)}

    for batch in batches:
        done = []
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "piece", "loss", "attachments", "expanded")]
        for conv_id, piece, loss, attachments, expanded in zip(*columns):
            if reader is None or reader.conv_id != conv_id:
                if reader:
                    done.append(reader.row())
                reader = _Reader(conv_id)
            reader.read(piece, loss, attachments, expanded)
        if done:
            yield rows(done)
    if reader:
        yield rows([reader.row()])


def digests(pieces: DataFrame) -> DataFrame:
    """What is read back from the pieces of each conversation: digests of its turns and of what is learned."""
    sorted_pieces = pieces.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "piece")
    return map_batches(sorted_pieces, _read_stream, _DIGESTS)


#: A conversation of control strings, added to the table.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def conversations(table: DataFrame) -> DataFrame:
    """The rows of a table of texts, and the probe, as messages."""
    rows = table.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    probe = table.sparkSession.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    return rows.unionByName(probe).select("conv_id", "turn", "role", text_part().alias("parts"))
