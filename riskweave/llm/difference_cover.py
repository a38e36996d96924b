"""Repeated passages by difference-cover anchors.

Positions of a document are taken modulo seven, and only those in {0, 1, 3} are anchors. The set is a
difference cover: for any two positions there is a shift below seven that brings both to an anchor.
So two passages of thirteen equal words share an aligned anchor of seven words, wherever they stand, and
hashing three positions in seven finds every one of them. What surrounds a shared anchor is then
extended to windows of full length, which are compared by 96 and more bits of hash.

Documents are worked on in chunks, row groups of a stored copy. A chunk sends each anchor (and later
each window) once, sorted and packed, to the bucket of its hash, and gets back one bit for each; as
every pass over a chunk makes the same sorted list, the bit's place says what it is about. Rows that
one bucket gets for one hash are as many as chunks have it, however many documents repeat it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskweave.llm.common import file_system, new_folder, stored, whole_text

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
CHUNK_BYTES = 8 << 20
BUCKET_ENTRIES = 1 << 20
NONE = np.iinfo(np.int64).max  # a null doc_id: after all others

# An anchor is packed as 5 bytes beside its bucket: a wrong match only makes a candidate. More data has
# more buckets, so the share of wrong matches stays the same.
_ANCHOR = np.dtype([("low", np.uint32), ("high", np.uint8)])
_WINDOW = np.dtype([("a", np.uint64), ("b", np.uint32)])

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


# -- a chunk ------------------------------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Chunk:
    """The words of some documents, one after the other, and the hashes of runs of words."""

    def __init__(self, doc_ids: list[int | None], texts: list[str | None], window: int = WINDOW):
        self.doc_ids, self.texts, self.window = doc_ids, texts, window
        hashes = []
        for text in texts:
            words = (text or "").encode().split()
            hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        ids = np.array([NONE if d is None else d for d in doc_ids], np.int64)
        self.ids = np.repeat(ids, self.sizes)
        place = np.arange(len(self.words)) - np.repeat(self.starts, self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - place  # words to the end of the document
        self.place = place

    def runs(self, at: np.ndarray, length: int, multiplier: int) -> np.ndarray:
        out = np.full(len(at), length, np.uint64)
        for j in range(length):
            out = out * np.uint64(multiplier) + self.words[at + j]
        return _mixed(out)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the anchors and their hashes."""
        length = self.window - PERIOD + 1
        at = np.flatnonzero(np.isin(self.place % PERIOD, COVER) & (self.left >= length))
        return at, self.runs(at, length, 0x9E3779B97F4A7C15)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of the anchors at the positions given."""
        # A window starts up to six words before its anchor, within the same document.
        low = shared - np.minimum(self.place[shared], PERIOD - 1)
        change = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(change, low, 1)
        np.add.at(change, shared + 1, -1)
        return np.flatnonzero((np.cumsum(change)[:-1] > 0) & (self.left >= self.window))

    def window_keys(self, at: np.ndarray) -> np.ndarray:
        """Two hashes of each window."""
        keys = np.empty(len(at), _WINDOW)
        keys["a"] = self.runs(at, self.window, 0xD6E8FEB86659FD93)
        keys["b"] = self.runs(at, self.window, 0xA0761D6478BD642F) >> np.uint64(32)
        return keys

    def covered(self, repeated: np.ndarray) -> np.ndarray:
        """Words that lie in a window starting at the positions given."""
        change = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(change, repeated, 1)
        np.add.at(change, repeated + self.window, -1)
        return np.cumsum(change)[:-1] > 0

    def kept(self, covered: np.ndarray) -> Iterator[tuple[int | None, int, int, bytes]]:
        """(doc_id, words, words removed, what is kept)."""
        for doc_id, text, size, start in zip(self.doc_ids, self.texts, self.sizes, self.starts, strict=True):
            gone = covered[start : start + size]
            words = (text or "").encode().split()
            if gone.any():
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            yield doc_id, int(size), int(gone.sum()), b" ".join(words)


def distinct_windows(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in sorted order, and which of them each key is. Far faster than sorting records."""
    a, b = np.ascontiguousarray(keys["a"]), np.ascontiguousarray(keys["b"])
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.r_[np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    which = np.empty(len(a), np.int64)
    which[order] = np.cumsum(first) - 1
    return keys[order[first]], which


class ChunkAnchors:
    """The distinct anchors of a chunk in sorted order, and those the chunk itself shares."""

    def __init__(self, chunk: Chunk):
        self.at, hashes = chunk.anchors()
        self.distinct, self.which, times = np.unique(hashes, return_inverse=True, return_counts=True)
        self.repeated = times > 1

    def shared(self, elsewhere: np.ndarray) -> np.ndarray:
        return self.at[(self.repeated | elsewhere)[self.which]]


class ChunkWindows:
    """The distinct candidate windows of a chunk in sorted order, with the smallest doc_id of each."""

    def __init__(self, chunk: Chunk, shared: np.ndarray):
        self.at = chunk.candidates(shared)
        self.ids = chunk.ids[self.at]
        self.distinct, self.which = distinct_windows(chunk.window_keys(self.at))
        self.least = np.full(len(self.distinct), NONE, np.int64)
        np.minimum.at(self.least, self.which, self.ids)

    def repeated(self, smaller_elsewhere: np.ndarray) -> np.ndarray:
        return self.at[smaller_elsewhere[self.which] | (self.least[self.which] < self.ids)]


def read_chunk(name: str, window: int) -> Chunk:
    path, _, group = name.rpartition("#")
    fs, inner = file_system(path)
    with fs.open_input_file(inner) as file:
        table = pq.ParquetFile(file).read_row_group(int(group), columns=["doc_id", "text"])
    return Chunk(table["doc_id"].to_pylist(), table["text"].to_pylist(), window)


# -- buckets ------------------------------------------------------------------------------------

def _bounds(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes; buckets are equal ranges of the hash."""
    edges = (np.arange(1, buckets, dtype=object) * (1 << 64)) // buckets
    return np.r_[0, np.searchsorted(hashes, edges.astype(np.uint64)), len(hashes)]


def _packed_anchors(hashes: np.ndarray) -> bytes:
    out = np.empty(len(hashes), _ANCHOR)
    out["low"], out["high"] = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) & np.uint64(0xFF)
    return out.tobytes()


def _rows(name: str, bounds: np.ndarray, **columns) -> pa.RecordBatch | None:
    """A row per bucket that the chunk has something for."""
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if not len(full):
        return None
    packed = {k: pa.array([f(bounds[b], bounds[b + 1]) for b in full], pa.binary()) for k, f in columns.items()}
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int64()), pa.array([name] * len(full)), *packed.values()], names=["bucket", "chunk", *packed]
    )


def _send_anchors(window: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["chunk"].to_pylist():
                hashes = ChunkAnchors(read_chunk(name, window)).distinct
                sent = _rows(name, _bounds(hashes, buckets), entries=lambda i, j, h=hashes: _packed_anchors(h[i:j]))
                if sent is not None:
                    yield sent

    return run


def _flags(names: list[str], sizes: list[int], flags: np.ndarray, bucket: int) -> pa.Table:
    ends = np.cumsum(sizes)
    bits = [np.packbits(flags[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)]
    return pa.table({"chunk": pa.array(names), "bucket": pa.array([bucket] * len(names), pa.int64()), "bits": pa.array(bits, pa.binary())})


def _meet_anchors(bucket: pa.Table) -> pa.Table:
    """For each chunk and anchor of the bucket, whether another chunk has the anchor too."""
    entries = [np.frombuffer(x, _ANCHOR) for x in bucket["entries"].to_pylist()]
    flat = np.concatenate(entries)
    value = flat["low"].astype(np.uint64) | (flat["high"].astype(np.uint64) << np.uint64(32))
    _, which, times = np.unique(value, return_inverse=True, return_counts=True)
    return _flags(bucket["chunk"].to_pylist(), [len(e) for e in entries], (times > 1)[which], bucket["bucket"][0].as_py())


def _meet_windows(bucket: pa.Table) -> pa.Table:
    """For each chunk and window of the bucket, whether another chunk has it in a smaller document."""
    entries = [np.frombuffer(x, _WINDOW) for x in bucket["entries"].to_pylist()]
    ids = np.concatenate([np.frombuffer(x, np.int64) for x in bucket["ids"].to_pylist()])
    distinct, which = distinct_windows(np.concatenate(entries))
    least = np.full(len(distinct), NONE, np.int64)
    np.minimum.at(least, which, ids)
    return _flags(bucket["chunk"].to_pylist(), [len(e) for e in entries], least[which] < ids, bucket["bucket"][0].as_py())


def _received(table: pa.Table, kind: str, bounds: np.ndarray) -> np.ndarray:
    """One flag per sorted entry of a chunk, from the bits its buckets sent back."""
    out = np.zeros(bounds[-1], bool)
    for k, bucket, bits in zip(table["kind"].to_pylist(), table["bucket"].to_pylist(), table["bits"].to_pylist(), strict=True):
        if k == kind:
            i, j = bounds[bucket], bounds[bucket + 1]
            out[i:j] = np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i).astype(bool)
    return out


def _windows_of(table: pa.Table, window: int, buckets: int) -> tuple[str, Chunk, ChunkWindows]:
    name = table["chunk"][0].as_py()
    chunk = read_chunk(name, window)
    anchors = ChunkAnchors(chunk)
    return name, chunk, ChunkWindows(chunk, anchors.shared(_received(table, "anchor", _bounds(anchors.distinct, buckets))))


def _send_windows(window: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        name, _, windows = _windows_of(table, window, buckets)
        sent = _rows(
            name, _bounds(windows.distinct["a"], buckets),
            entries=lambda i, j: windows.distinct[i:j].tobytes(), ids=lambda i, j: windows.least[i:j].tobytes(),
        )
        types = [("bucket", pa.int64()), ("chunk", pa.string()), ("entries", pa.binary()), ("ids", pa.binary())]
        return pa.Table.from_batches([sent] if sent is not None else [], pa.schema(types))

    return run


def _finish(window: int, buckets: int, with_text: bool) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        _, chunk, windows = _windows_of(table, window, buckets)
        smaller = _received(table, "window", _bounds(windows.distinct["a"], buckets))
        rows = list(chunk.kept(chunk.covered(windows.repeated(smaller))))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table({
            "doc_id": pa.array(columns[0], pa.int64()),
            "n_words": pa.array(columns[1], pa.int64()),
            "n_removed": pa.array(columns[2], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in columns[3]], pa.string()),
            "kept_text": pa.array([t.decode() if with_text else None for t in columns[3]], pa.string()),
        })

    return run


# -- jobs ---------------------------------------------------------------------------------------


def _list_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = []
        for path in batch["path"].to_pylist():
            fs, inner = file_system(path)
            with fs.open_input_file(inner) as file:
                names += [f"{path}#{g}" for g in range(pq.ParquetFile(file).num_row_groups)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["chunk"])


def without_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    with_text: bool = True,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """`RESULT` of every document: words covered by a window that a smaller document also has are removed.

    Words are runs of bytes other than space, tab and line ends; a window is `window` of them in a
    row, seven at least, within one document. Windows are judged on the input. Null texts have no words; a
    null doc_id is larger than all others, and rows with the same doc_id do not remove from each other.
    An empty table gives an empty one.

    Texts are copied once to the shared folder and never shuffled; what is shuffled are 5 bytes per distinct anchor
    of a chunk and 20 (mostly runs of the same doc_id) per distinct window around shared anchors.
    """
    if window < PERIOD:
        raise ValueError(f"windows have {PERIOD} words at least")
    spark = docs.sparkSession
    folder = new_folder(spark, "passages")
    copied = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    copied.write.option("parquet.block.size", chunk_bytes).parquet(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select("path")
    chunks = stored(files.mapInArrow(_list_chunks, "chunk string"), "chunks")
    n = chunks.count()
    words = spark.read.parquet(folder).agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] / 6
    buckets = max(16, int(words * len(COVER) / PERIOD / bucket_entries))

    def met(sent: DataFrame, meet, kind: str) -> DataFrame:
        back = sent.repartition(max(buckets, 1), "bucket").groupBy("bucket").applyInArrow(meet, "chunk string, bucket long, bits binary")
        return stored(back.withColumn("kind", F.lit(kind)), f"{kind}-bits")

    def by_chunk(*bits: DataFrame) -> DataFrame:
        rows = chunks.select("chunk", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("bits"), F.lit("").alias("kind"))
        for more in bits:
            rows = rows.unionByName(more)
        return rows.repartition(max(2 * n, 1), "chunk").groupBy("chunk")

    sent = chunks.repartition(max(n, 1)).mapInArrow(_send_anchors(window, buckets), "bucket long, chunk string, entries binary")
    anchor_bits = met(sent, _meet_anchors, "anchor")
    sent = by_chunk(anchor_bits).applyInArrow(_send_windows(window, buckets), "bucket long, chunk string, entries binary, ids binary")
    window_bits = met(sent, _meet_windows, "window")
    return by_chunk(anchor_bits, window_bits).applyInArrow(_finish(window, buckets, with_text), RESULT)
