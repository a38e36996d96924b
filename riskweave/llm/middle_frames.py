"""Fill-in-the-middle over seekable compressed texts.

A text is stored as independent zstandard frames, each with the number of lines and characters before
it. A cut after so many lines lies in one known frame, and only that frame is decompressed to find it.
The rearranged text is then a list of byte ranges over the frames: it is streamed a frame at a time, into
digests or files, and read back the same way by looking for its marks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskweave.llm.common import stored, unused

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
FRAME_BYTES = 64 << 10
LEVEL = 3
FLUSH_BYTES = 8 << 20  # compressed bytes a task gathers before it hands on rows

_FRAME = pa.struct([("lines", pa.int64()), ("chars", pa.int64()), ("size", pa.int64()), ("data", pa.binary())])
_STORED = pa.schema([("doc_id", pa.int64()), ("ends_open", pa.bool_()), ("marked", pa.bool_()), ("frames", pa.list_(_FRAME))])
STORED = "doc_id long, ends_open boolean, marked boolean, frames array<struct<lines: long, chars: long, size: long, data: binary>>"
_TABLE = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
    ("output_sha256", pa.string()), ("restored_sha256", pa.string()),
])
TABLE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


class Rule(NamedTuple):
    """How often and how a text is rearranged; the seed and the doc_id decide the rest."""

    seed: int = 7
    percent: int = 100
    spm_percent: int = 50


def chars_in(data: bytes) -> int:
    """Code points of UTF-8 bytes, which need not begin or end at one: the bytes that begin one."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def frames_of(data: bytes, size: int, compressor) -> list[dict]:
    """Frames of at most `size` bytes (a little less, where a code point would be torn), with what is before each."""
    out, at, lines, chars = [], 0, 0, 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and end > at + 4 and data[end] & 0xC0 == 0x80:
            end -= 1
        piece = data[at:end]
        out.append({"lines": lines, "chars": chars, "size": at, "data": compressor.compress(piece)})
        lines, chars, at = lines + piece.count(b"\n"), chars + chars_in(piece), end
    return out


class FramedText:
    """A text as its frames; at most one of them is decompressed at a time."""

    def __init__(self, frames: list[dict], ends_open: bool, decompressor):
        self.frames, self.decompressor = frames, decompressor
        self.starts = [f["size"] for f in frames]
        self.lines_before = [f["lines"] for f in frames]
        self._at, self._data = -1, b""
        last = self.frame(len(frames) - 1) if frames else b""
        self.size = self.starts[-1] + len(last) if frames else 0
        self.units = (self.lines_before[-1] + last.count(b"\n") if frames else 0) + int(ends_open)

    def frame(self, i: int) -> bytes:
        if self._at != i:
            self._at, self._data = i, self.decompressor.decompress(self.frames[i]["data"])
        return self._data

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and characters of the first `units` lines."""
        if not units:
            return 0, 0
        if units >= self.units:
            whole = len(self.frames) - 1
            return self.size, self.frames[whole]["chars"] + chars_in(self.frame(whole))
        i = int(np.searchsorted(self.lines_before, units, "left")) - 1  # the frame that holds the line's end
        data, at = self.frame(i), 0
        for _ in range(units - self.lines_before[i]):
            at = data.index(b"\n", at) + 1
        return self.starts[i] + at, self.frames[i]["chars"] + chars_in(data[:at])

    def read(self, start: int, end: int) -> Iterator[bytes]:
        i = int(np.searchsorted(self.starts, start, "right")) - 1
        while start < end:
            data = self.frame(i)
            piece = data[start - self.starts[i] : end - self.starts[i]]
            yield piece
            start, i = start + len(piece), i + 1


class Output(NamedTuple):
    """A rearranged text: marks, and ranges of the framed text, in order."""

    text: FramedText
    form: str
    pieces: list[bytes | tuple[int, int]]

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        """The bytes from `start` to `end`, frame by frame; frames outside are not decompressed."""
        at = 0
        for piece in self.pieces:
            size = len(piece) if isinstance(piece, bytes) else piece[1] - piece[0]
            low, high = max(start - at, 0), size if end is None else min(end - at, size)
            if low < high:
                if isinstance(piece, bytes):
                    yield piece[low:high]
                else:
                    yield from self.text.read(piece[0] + low, piece[0] + high)
            at += size


def draws(doc_id: int | None, n: int, rule: Rule) -> tuple[int, int, bool, bool]:
    """Where prefix and middle end (in lines), whether the text is rearranged, and whether the suffix goes first."""
    digest = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return first, second, h[2] % 100 < rule.percent, h[3] % 100 < rule.spm_percent


def rearranged(text: FramedText, doc_id: int | None, marked: bool, rule: Rule) -> tuple[Output, int | None, int | None]:
    """The output of a text, and the characters of its prefix and middle (null if it stays as it is)."""
    first, second, chosen, suffix_first = draws(doc_id, text.units, rule)
    if not text.units or marked or not chosen:
        return Output(text, "plain", [(0, text.size)]), None, None
    (a, before), (b, upto) = text.cut(first), text.cut(second)
    prefix, middle, suffix = (0, a), (a, b), (b, text.size)
    if suffix_first:
        return Output(text, "spm", [SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle]), before, upto - before
    return Output(text, "psm", [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle]), before, upto - before


def marks_in(stream: Iterator[bytes], digest=None) -> tuple[dict[bytes, int], int]:
    """Where each mark first begins, and the length of the stream, which is also digested on the way."""
    found: dict[bytes, int] = {}
    at, tail = 0, b""
    for piece in stream:
        if digest is not None:
            digest.update(piece)
        data = tail + piece
        for mark in MARKS:
            place = data.find(mark) if mark not in found else -1
            if place >= 0:
                found[mark] = at - len(tail) + place
        at, tail = at + len(piece), data[-2:]
    return found, at


def restored(output: Output, found: dict[bytes, int], size: int) -> Iterator[bytes]:
    """The text again, from nothing but the output's bytes, its form and the places of its marks."""
    if output.form == "plain":
        yield from output.stream()
        return
    order = sorted(MARKS, key=found.__getitem__)
    ends = [found[m] for m in order[1:]] + [size]
    spans = {m: (found[m] + len(m), end) for m, end in zip(order, ends)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.stream(*spans[mark])


def _framing(frame_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=level)
        rows, held = [], 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
            for doc_id, value in zip(ids, texts):
                data = value.as_py() or b""
                marked = any(mark in data for mark in MARKS)
                frames = frames_of(data, frame_bytes, compressor)
                rows.append({"doc_id": doc_id, "ends_open": len(data) > 0 and data[-1] != 10, "marked": marked, "frames": frames})
                held += sum(len(f["data"]) for f in frames) + 100
                if held >= FLUSH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_STORED)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_STORED)

    return run


def _texts(frame_rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bool, FramedText]]:
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    for batch in frame_rows:
        for i in range(batch.num_rows):  # one row's frames as Python objects at a time
            row = batch.slice(i, 1).to_pylist()[0]
            yield row["doc_id"], row["marked"], FramedText(row["frames"], row["ends_open"], decompressor)


def _digesting(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for doc_id, marked, text in _texts(batches):
            output, prefix, middle = rearranged(text, doc_id, marked, rule)
            out, back = hashlib.sha256(), hashlib.sha256()
            found, size = marks_in(output.stream(), out)
            for piece in restored(output, found, size):
                back.update(piece)
            rows.append((doc_id, text.units, output.form, prefix, middle, out.hexdigest(), back.hexdigest()))
            if len(rows) == 4096:
                yield _rows(rows, _TABLE)
                rows = []
        if rows:
            yield _rows(rows, _TABLE)

    return run


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def framed(docs: DataFrame, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> DataFrame:
    """The whole texts as a stored table: doc_id, whether a last line has no end, whether a mark occurs, and
    frames (lines, chars and size: lines, characters and bytes before the frame; data: the zstandard frame).

    Nothing is shuffled; a task holds one text and some compressed rows. Null texts are empty ones, which have no frames.
    """
    if frame_bytes < 8:
        raise ValueError("a frame must hold whole code points")
    return stored(docs.select("doc_id", "text").mapInArrow(_framing(frame_bytes, level), STORED), "text-frames")


def fim_table(docs: DataFrame, rule: Rule = Rule(), frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, output_sha256, restored_sha256, a row for each row of `docs`.

    Texts without lines (null, empty) and texts that hold a mark stay as they are: form plain, no
    prefix or middle. A null doc_id draws as an empty number, equal rows draw alike, an empty table
    gives no rows, other columns are not looked at. The restored text is read from the output's own bytes.
    """
    return framed(docs, frame_bytes).mapInArrow(_digesting(rule), TABLE)


def fim_texts(docs: DataFrame, rule: Rule = Rule(), frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """`docs` with the columns form and output, the rearranged text (underscores are added where the names are taken).

    For texts that a row can hold anyway; null texts give empty outputs.
    """
    form, output = unused(docs, "form", "output")
    schema = docs.select("*").schema.add(form, "string").add(output, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor, decompressor = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        for batch in batches:
            forms, outputs = [], []
            ids, texts = (batch.column(batch.schema.names.index(n)) for n in ("doc_id", "text"))
            for doc_id, value in zip(ids.to_pylist(), texts.cast(pa.large_binary())):
                data = value.as_py() or b""
                text = FramedText(frames_of(data, frame_bytes, compressor), bool(data) and data[-1:] != b"\n", decompressor)
                made = rearranged(text, doc_id, any(m in data for m in MARKS), rule)[0]
                forms.append(made.form)
                outputs.append(b"".join(made.stream()).decode())
            columns = [*batch.columns, pa.array(forms, pa.string()), pa.array(outputs, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, form, output])

    return docs.mapInArrow(run, schema)
