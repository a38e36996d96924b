"""Documents packed into training sequences of a fixed length by the patterns of `cutting_stock`.

A task turns its documents into token ids and cuts them into full sequences and one shorter piece. The
histogram of piece lengths goes to the driver, where the patterns are found. Pieces are ranked within their length
class; ranks and the patterns' slots, laid end to end, say which sequence a piece joins. Pieces that no
pattern takes are laid end to end themselves and cut at every full sequence; what remains at the very
end becomes sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.llm.common import stored
from riskweave.llm.cutting_stock import CUT_COST, Pattern, length_classes, patterns

CAPACITY = 4096
RANK_ROWS = 50_000  # pieces ranked or laid end to end in one window
CACHE_CHARS = 12 << 20  # characters of the distinct words and parts that a Python worker remembers, about 300 MB
SLICE_CHARS = 1 << 20
FLUSH_BYTES = 8 << 20

# White space as the tokenizer's rule knows it (the Unicode property, without the separators U+001C to U+001F).
_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_SEPARATORS = re.compile("[\\x1c-\\x1f]")
_WORDS = re.compile("[^\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("ids", pa.binary()),
])
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class _Numbers(dict):
    """Numbers words in the order they first occur, and lists those not yet looked at."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


# The splitting rule that `_simple_parts` writes for words of Latin letters, ASCII digits and ASCII signs.
_SPLIT_RULE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_LATIN = "a-z\xb5\xdf-\xf6\xf8-\u01bf"
_SIMPLE = re.compile(f"[!-~{_LATIN}]+")
_simple_parts = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^0-9{_LATIN}]+").findall


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else one after U+00FF."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordIds:
    """Token ids of texts, for tokenizers that drop white space: no token depends on a neighbouring word.

    Every distinct word is tokenized once and remembered, up to `CACHE_CHARS` characters of words. Words of
    Latin letters and ASCII signs are split here by the file's own rule, if it is the one known, and their parts
    go to the file's merges directly; all others go through the library as they are.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        rule = json.loads(tokenizer.to_str())
        normalizers, splits = (rule[k] or {} for k in ("normalizer", "pre_tokenizer"))
        steps = splits.get("pretokenizers", [])
        self.known_rule = (
            normalizers.get("normalizers") == _NORMALIZERS and len(steps) == 2 and steps[0].get("pattern") == {"Regex": _SPLIT_RULE}
            and steps[1]["type"] == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
            and rule["model"]["type"] == "BPE" and all(t["content"].startswith("<|") for t in rule["added_tokens"])
        )
        self.merges = tokenizer.model
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.chars, self.parts_known = _Numbers(), 0, {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)
        self.known = 0

    def _merged(self, part: str) -> bytes:
        ids = self.parts_known.get(part)
        if ids is None:
            spelled = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
            ids = self.parts_known[part] = array("I", [t.id for t in self.merges.tokenize(spelled)]).tobytes()
            self.chars += len(part)
        return ids

    def _ids(self, word: str) -> bytes | None:
        """The ids of a simple word as unsigned 32-bit numbers, else None."""
        low = word.lower()
        if not _SIMPLE.fullmatch(low) or "<|" in word or not unicodedata.is_normalized("NFC", word):
            return None
        if low.isalpha():
            return self._merged(low)
        return b"".join([self._merged(part) for part in _simple_parts(low)])

    def _learn(self) -> None:
        words, self.numbers.fresh = self.numbers.fresh, []
        found = [self._ids(w) if self.known_rule else None for w in words]
        rest = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(rest), 4096):
            part = rest[at : at + 4096]
            encoded = self.tokenizer.encode_batch_fast([words[i] for i in part], add_special_tokens=False)
            for i, e in zip(part, encoded):
                found[i] = array("I", e.ids).tobytes()
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        total, upto = int(sizes.sum()), self.known + len(found)
        if upto > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * upto), np.resize(self.sizes, 2 * upto)
        if self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.used + total))
        self.flat[self.used : self.used + total] = np.frombuffer(b"".join(found), np.uint32)
        self.sizes[self.known : upto] = sizes
        self.starts[self.known : upto] = self.used + np.cumsum(sizes, dtype=np.int32) - sizes
        self.used, self.known = self.used + total, upto
        self.chars += sum(map(len, words))

    def _of(self, text: str) -> np.ndarray:
        words = _WORDS.findall(text) if _SEPARATORS.search(text) else text.split()
        if not words:
            return np.zeros(0, np.uint32)
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        if self.numbers.fresh:
            self._learn()
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes, dtype=np.int32)
        places = np.repeat(self.starts[numbers] - ends + sizes, sizes)
        places += np.arange(int(ends[-1]), dtype=np.int32)
        out = self.flat[places]
        if self.chars > CACHE_CHARS:
            self._forget()
        return out

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """Ids of slices of the text that end at white space, in order."""
        at = 0
        while at < len(text):
            end = at + SLICE_CHARS
            if end < len(text):
                space = _SPACE.search(text, end)
                end = space.start() if space else len(text)
            yield self._of(text[at:end])
            at = end


_REMEMBERED: dict[str, WordIds] = {}  # of this process: a Python worker serves many tasks


def _word_ids(path: str) -> WordIds:
    if path not in _REMEMBERED:
        from tokenizers import Tokenizer

        _REMEMBERED[path] = WordIds(word_tokenizer(Tokenizer.from_file(path)))
    return _REMEMBERED[path]


def _pieces(path: str, end_id: int, capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        word_ids = _word_ids(path)
        rows, held = [], 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for doc_id, value in zip(ids, texts):
                parts = [*word_ids.parts(value.as_py() or ""), np.array([end_id], np.uint32)]
                tokens = np.concatenate(parts).astype("<u4")
                for start in range(0, len(tokens), capacity):
                    piece = tokens[start : start + capacity]
                    data = piece.tobytes()
                    rows.append((doc_id, start, len(piece), zlib.crc32(data), len(tokens), data))
                    held += len(data) + 64
                if held >= FLUSH_BYTES:
                    yield _rows(rows)
                    rows, held = [], 0
        if rows:
            yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECES.types)], schema=_PIECES)


def word_tokenizer(tokenizer):
    """The tokenizer, if words can be tokenized one by one: its rule must drop white space and its
    added tokens must take none with them. Others are an error."""
    rule = json.loads(tokenizer.to_str())
    split = next((p for p in (rule.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"), None)
    drops = split is not None and split["behavior"] == "Removed" and split["invert"] and "\\\\s" not in split["pattern"]["Regex"].replace("[^\\\\s", "")
    alone = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in rule["added_tokens"])
    if not drops or not alone or rule.get("truncation") or rule.get("padding"):
        raise ValueError("words of this tokenizer depend on the white space around them")
    return tokenizer


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """The documents' ids cut into pieces of at most `capacity`, as a stored table.

    Columns: piece (a number written with the row), doc_id, start, length, ids_crc32, doc_tokens, ids (little-endian
    unsigned 32-bit). Every document ends with `end_id`, so null and empty texts have one piece of length 1.
    """
    made = docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer_path, end_id, capacity), PIECES)
    return stored(made.withColumn("piece", F.monotonically_increasing_id()), "packing-pieces", compression="zstd")


def running(rows: DataFrame, key: str, amount: Column, name: str, sizes: dict[int, int], rank_rows: int = RANK_ROWS) -> DataFrame:
    """`rows` with `name`: the sum of `amount` over the rows before, within equal `key`, in a fixed order.

    A key with many rows is spread over cells by a hash of the piece, `sizes` (key to rows, a bounded
    table) says over how many; sums within a cell are made in a window of about `rank_rows` rows, and a
    window over the cells of a key adds those before.
    """
    spread = {k: -(-n // rank_rows) for k, n in sizes.items() if n > rank_rows}
    cells = F.lit(1)
    if spread:
        table = F.create_map(*[F.lit(x) for pair in spread.items() for x in pair])
        cells = F.coalesce(F.try_element_at(table, F.col(key)), F.lit(1))
    celled = rows.withColumn("_cell", F.pmod(F.xxhash64("piece"), cells))
    totals = celled.groupBy(key, "_cell").agg(F.sum(amount).alias("_total"))
    earlier = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(key, "_cell", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(key, "_cell").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    summed = celled.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return summed.join(starts, [key, "_cell"]).withColumn(name, F.col("_start") + F.col("_inside")).drop("_cell", "_start", "_inside")


def _slots(found: list[Pattern], classes: int) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """For each class the slots of all patterns end to end (first rank, pieces per sequence, first sequence), and
    how many sequences there are. Its size depends on the classes only."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    taken, sequence = [0] * classes, 0
    for pattern in found:
        for k, per in pattern.pieces.items():
            out.setdefault(k, []).append((taken[k], per, sequence))
            taken[k] += per * pattern.copies
        sequence += pattern.copies
    packed = {k: tuple(np.array(column, np.int64) for column in zip(*rows)) for k, rows in out.items()}
    return {k: (*columns, np.int64(taken[k])) for k, columns in packed.items()}, sequence


def _classing(tops: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = np.searchsorted(tops, batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind, pa.int64())], names=["piece", "length", "class"])

    return run


def _placing(slots: dict[int, tuple]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (piece, class, rank, ...) with the sequence of their rank; null where no pattern takes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            kind, rank = (batch.column(names.index(n)).to_numpy() for n in ("class", "rank"))
            sequence = np.full(len(rank), -1, np.int64)
            for k in np.unique(kind):
                if k not in slots:
                    continue
                first, per, start, taken = slots[k]
                rows = np.flatnonzero((kind == k) & (rank < taken))
                at = np.searchsorted(first, rank[rows], "right") - 1
                sequence[rows] = start[at] + (rank[rows] - first[at]) // per[at]
            found = pa.array(sequence, mask=sequence < 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*names, "sequence_id"])

    return run


def tail_bounds(tokens: int, capacity: int) -> list[int]:
    """Where the last, incomplete stretch of the stream is cut: powers of two, the largest first."""
    at, out = tokens - tokens % capacity, []
    for bit in range(capacity.bit_length() - 1, -1, -1):
        if (tokens - at) >> bit & 1 and 1 << bit < capacity:
            at += 1 << bit
            out.append(at)
    return out


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, cut_cost: float = CUT_COST,
           rank_rows: int = RANK_ROWS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids.

    Every id of every document (null texts are empty: the end id alone) is in one piece, and offsets are
    gapless from 0 in each sequence. Documents are cut at multiples of `capacity`, and where the stream
    of pieces outside the patterns crosses a sequence's end. A pattern leaves at most a share `cut_cost` of a sequence empty, apart
    from the width of its length classes. Repeated rows and ids are packed each; no documents give no pieces.

    The driver sees at most `capacity` histogram rows, whatever the number of documents.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two, as the stream's end is cut into such lengths")
    whole = tokenized(docs, tokenizer_path, end_id, capacity)
    counts = {r["length"]: r["n"] for r in whole.groupBy("length").agg(F.count("*").alias("n")).collect()}
    lengths = np.array(sorted(counts), np.int64)
    tops = length_classes(lengths) if len(lengths) else lengths
    kinds = np.searchsorted(tops, lengths)
    demand = np.bincount(kinds, [counts[n] for n in lengths.tolist()], len(tops)).astype(np.int64)
    slots, sequences = _slots(patterns(tops, demand, capacity, cut_cost), len(tops))

    facts = ["piece", "length", "class", "rank"]
    narrow = whole.select("piece", "length").mapInArrow(_classing(tops), "piece long, length long, class long")
    ranked = running(narrow, "class", F.lit(1).cast("long"), "rank", dict(enumerate(demand.tolist())), rank_rows)
    placed = stored(
        ranked.select(*facts).mapInArrow(_placing(slots), "piece long, length long, class long, rank long, sequence_id long").drop("rank"),
        "packing-places",
    )
    in_order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "piece").rowsBetween(Window.unboundedPreceding, -1)
    by_pattern = placed.where("sequence_id IS NOT NULL").select(
        "piece", "sequence_id", F.coalesce(F.sum("length").over(in_order), F.lit(0)).alias("offset")
    )
    taken = whole.join(by_pattern, "piece")
    streamed = _streamed(whole, placed.where("sequence_id IS NULL").select("piece", "length"), sequences, capacity, rank_rows)
    return taken.select(*_COLUMNS, "ids").unionByName(streamed)


def _streamed(whole: DataFrame, rest: DataFrame, sequences: int, capacity: int, rank_rows: int) -> DataFrame:
    """The pieces outside the patterns, laid end to end and cut where sequences end. Sequence numbers follow the patterns'."""
    facts = rest.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).first()
    bounds = tail_bounds(facts["tokens"], capacity)
    end = facts["tokens"] - facts["tokens"] % capacity
    laid = running(rest.withColumn("_all", F.lit(0)), "_all", F.col("length"), "at", {0: facts["n"]}, rank_rows).select("piece", "length", "at")
    # A piece is at most a sequence long, so it meets at most one full sequence's end and the bounds of the tail.
    upto = F.col("at") + F.col("length")
    full = (F.floor(F.col("at") / capacity) + 1) * capacity
    inner = F.array(F.when((full < upto) & (full <= end), full), *[F.when((F.col("at") < b) & (upto > b), F.lit(b)) for b in bounds])
    edges = F.array_distinct(F.concat(F.array(F.col("at")), F.array_compact(inner), F.array(upto)))
    spans = F.transform(F.slice("edges", 1, F.size("edges") - 1), lambda a, i: F.struct(a.alias("low"), F.element_at("edges", i + 2).alias("high")))
    cut = laid.withColumn("edges", edges).withColumn("span", F.explode(spans)).select("piece", "at", "edges", "span.low", "span.high")
    tail = sum((F.when(F.col("low") >= b, 1).otherwise(0) for b in bounds), F.lit(0))
    begin = F.lit(end)
    for b in bounds:
        begin = F.when(F.col("low") >= b, F.lit(b)).otherwise(begin)
    in_tail = F.col("low") >= end
    cut = stored(cut.select(
        "piece", (F.col("low") - F.col("at")).alias("_skip"), (F.col("high") - F.col("low")).alias("_size"),
        (F.when(in_tail, end // capacity + tail).otherwise(F.floor(F.col("low") / capacity)) + sequences).cast("long").alias("sequence_id"),
        F.when(in_tail, F.col("low") - begin).otherwise(F.pmod("low", F.lit(capacity))).cast("long").alias("offset"),
        (F.size("edges") == 2).alias("_uncut"),
    ), "packing-stream")
    # Only pieces that are really cut need their ids for a new digest: one or two a streamed sequence, in a table of their own.
    uncut = whole.join(cut.where("_uncut").select("piece", "sequence_id", "offset"), "piece").select(*_COLUMNS, "ids")
    some = stored(cut.where("NOT _uncut").drop("_uncut"), "packing-cuts")
    ids = F.substring("ids", (F.col("_skip") * 4 + 1).cast("int"), (F.col("_size") * 4).cast("int"))
    torn = whole.join(some, "piece").withColumn("ids", ids).select(
        "doc_id", (F.col("start") + F.col("_skip")).alias("start"), F.col("_size").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset", "ids",
    )
    return uncut.unionByName(torn)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, size, and the ids of each sequence, unpadded; a sequence is at most one capacity long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    made = pieces.groupBy("sequence_id").agg(F.sum("length").alias("size"), parts.alias("parts"))
    return made.select("sequence_id", "size", F.unhex(F.concat_ws("", F.col("parts.ids"))).alias("ids"))
