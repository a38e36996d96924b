"""Chat formatting with typed content parts.

A message is a list of parts: text, image, audio or document. A visitor turns the parts into one
string with numbered placeholders in their order, notes which attachment stands behind each
placeholder and how many tokens it will take once expanded. Marks of the template all begin with `<`,
which no text can hold after escaping, so texts cannot imitate a turn and the output can be read back.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

PART = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("pages", T.IntegerType()),
])
ATTACHMENT = T.StructType([
    T.StructField("place", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("tokens", T.LongType()),
])
FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("formatted", T.StringType()),
    T.StructField("loss_start", T.LongType()),
    T.StructField("loss_end", T.LongType()),
    T.StructField("attachments", T.ArrayType(ATTACHMENT)),
])

IMAGE_PATCH, AUDIO_TOKENS_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 1024

OPEN, CLOSE = "<turn ", "</turn>"

_PLACEHOLDER = re.compile(r"<(image|audio|document):(\d+)>")


def escape(text: str) -> str:
    r"""Backslashes doubled and `<` written as `\l`: no mark of the template is left inside."""
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"l": "<", "g": ">"}.get(m[1], m[1]), text, flags=re.DOTALL)


class PartVisitor:
    """Flattens parts in order; `out` is the string so far, `attachments` what it refers to."""

    def __init__(self):
        self.out: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        handler = getattr(self, f"visit_{kind}", None)
        if handler is None:
            raise ValueError(f"unknown kind of content part: {kind}")
        handler(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil((part.get(k) or 0) / IMAGE_PATCH) for k in ("width", "height"))
        self._attach(part, max(1, across * down))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, max(1, math.ceil((part.get("seconds") or 0) * AUDIO_TOKENS_PER_SECOND)))

    def visit_document(self, part: dict) -> None:
        self._attach(part, max(1, (part.get("pages") or 0) * TOKENS_PER_PAGE))

    def _attach(self, part: dict, tokens: int) -> None:
        place = len(self.attachments)
        self.out.append(f"<{part['type']}:{place}>")
        self.attachments.append({"place": place, "type": part["type"], "uri": part.get("uri"), "tokens": tokens})


def format_turn(role: str, parts: list[dict]) -> tuple[str, int | None, int | None, list[dict]]:
    """(string, where its loss begins and ends, attachments); only assistants are under the loss."""
    visitor = PartVisitor()
    for part in parts:
        visitor.visit(part)
    head, body = "<turn {}>".format(escape(role).replace(">", "\\g")), "".join(visitor.out)
    span = (len(head), len(head) + len(body)) if role == "assistant" else (None, None)
    return f"{head}{body}{CLOSE}", *span, visitor.attachments


def read_turn(formatted: str, attachments: list[dict]) -> tuple[str, list[dict]]:
    """The role and the parts behind a formatted turn."""
    (turn,) = ConversationReader().feed(formatted)
    return unescape(turn.role), read_parts(turn.body, attachments)


class FoundTurn(NamedTuple):
    role: str  # as written, still escaped
    body: str
    start: int  # of the body, in characters of the conversation
    end: int


class ConversationReader:
    """Finds the turns of a formatted conversation by its marks alone.

    The conversation is fed in pieces cut anywhere; `feed` returns the turns that the piece completes. Only
    the text after the last whole turn is kept. `<` stands in no escaped text, so the first end mark after
    a beginning is that turn's own. Anything between turns is an error.
    """

    def __init__(self):
        self.rest, self.read = "", 0  # text of the open turn; characters before it

    def feed(self, piece: str) -> list[FoundTurn]:
        searched = max(0, len(self.rest) - len(CLOSE))
        text, at, found = self.rest + piece, 0, []
        while (end := text.find(CLOSE, max(at, searched))) >= 0:
            role_end = text.find(">", at)
            if not text.startswith(OPEN, at) or role_end > end:
                raise ValueError("text between the turns of a conversation")
            found.append(FoundTurn(text[at + len(OPEN) : role_end], text[role_end + 1 : end], self.read + role_end + 1, self.read + end))
            at = end + len(CLOSE)
        self.rest, self.read = text[at:], self.read + at
        if not self.rest.startswith(OPEN[: len(self.rest)]):
            raise ValueError("text between the turns of a conversation")
        return found

    def close(self) -> int:
        """The characters of the whole conversation; an unfinished turn is an error."""
        if self.rest:
            raise ValueError("a conversation ends within a turn")
        return self.read


def read_parts(body: str, attachments: list[dict]) -> list[dict]:
    """The parts behind the body of a formatted turn."""
    parts, at = [], 0
    for mark in _PLACEHOLDER.finditer(body):
        if mark.start() > at:
            parts.append({"type": "text", "text": unescape(body[at : mark.start()])})
        parts.append({"type": mark[1], "uri": attachments[int(mark[2])]["uri"]})
        at = mark.end()
    if at < len(body) or not parts:
        parts.append({"type": "text", "text": unescape(body[at:])})
    return parts


def _format(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for conv, turn, role, parts in zip(batch["conv_id"], batch["turn"], batch["role"], batch["parts"], strict=True):
            rows.append((conv, turn, *format_turn(role, list(parts))))
        yield pd.DataFrame(rows, columns=[f.name for f in FORMATTED]).astype(
            {"conv_id": "Int64", "turn": "Int64", "loss_start": "Int64", "loss_end": "Int64"}
        )


def formatted_turns(messages: DataFrame) -> DataFrame:
    """`FORMATTED` rows; a conversation's string is its turns' strings joined in order of `turn`.

    `messages` has conv_id, turn, role and either `parts` (an array of `PART`) or `text`, which then
    is the only part. Null roles, texts and part lists count as empty. Every turn is formatted by
    itself, so nothing is shuffled and no conversation is gathered.
    """
    given = "parts" in messages.columns
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in PART.fields[2:]]
    text_part = F.array(F.struct(F.lit("text").alias("type"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *blank))
    parts = F.coalesce(F.col("parts"), F.array().cast(T.ArrayType(PART))) if given else text_part
    ready = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        parts.cast(T.ArrayType(PART)).alias("parts"),
    )
    return ready.mapInPandas(_format, FORMATTED)


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, attachments long, attachment_tokens long"
)


class _Reading:
    """Running digests of one conversation; only the current turn is in memory.

    Turns and what is under the loss come from the marks that the reader finds in the joined text. The spans
    noted while formatting must be the same places, or it is an error.
    """

    def __init__(self, conv):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.reader = ConversationReader()
        self.n_turns = self.loss_chars = self.attached = self.tokens = 0

    def add(self, formatted: str, start, end, attachments) -> None:
        before, noted = self.reader.read, not pd.isna(start)
        found = self.reader.feed(formatted)
        if len(found) != 1 or self.reader.rest:
            raise ValueError("a formatted row holds other than one turn")
        turn = found[0]
        role, parts = unescape(turn.role), read_parts(turn.body, attachments)
        text = "".join(p.get("text", "") for p in parts)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        self.attached += len(attachments)
        self.tokens += sum(a["tokens"] for a in attachments)
        if (role == "assistant") != noted or (noted and (before + int(start), before + int(end)) != (turn.start, turn.end)):
            raise ValueError("a loss span is not where its turn is")
        if noted:
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.reader.close(), self.attached, self.tokens)


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in DIGEST.split(", ")]
    frame = lambda rows: pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
    current: _Reading | None = None
    for batch in batches:
        done = []
        for conv, formatted, start, end, attachments in zip(
            batch["conv_id"], batch["formatted"], batch["loss_start"], batch["loss_end"], batch["attachments"], strict=True
        ):
            conv = None if pd.isna(conv) else int(conv)
            if current is None or current.conv != conv:
                if current is not None:
                    done.append(current.row())
                current = _Reading(conv)
            current.add(formatted, start, end, list(attachments))
        yield frame(done)
    if current is not None:
        yield frame([current.row()])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """What each formatted conversation says when read back: counts and digests.

    A digest runs over the joined turns of its conversation in order, so one task reads them, as a stream
    split at the marks found in it, that holds a single turn: a conversation of any length takes no more memory. Null conv_id is a
    conversation of its own; turns with the same number are ordered by their formatted string.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.mapInPandas(_read_back, DIGEST)
