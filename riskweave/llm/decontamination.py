"""Benchmark items hidden in long documents, by MinHash containment search.

What matters is how much of an item lies in a document, not how alike the two are: a short item inside
a long document has next to no Jaccard similarity. So an item is represented by its smallest shingle
hashes, as many as its size class needs: of q shingles at containment t, any floor((1 - t) q) + 1 hold
at least one that the document has too. The search looks up the document's hashes among these, which
loses no pair, and verifies each candidate by its exact share of shingles. Documents too small to hold
t q shingles of a size class never meet it.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

SHINGLE, CONTAINMENT = 5, 0.8
BLOCK_BYTES = 32 << 20  # bytes of benchmark text that one pass over the documents looks for
_WORD = re.compile(r"\w+")

PAIRS = "doc_id long, item_id long, item_shingles long, shared long, containment double"


def words_of(text: str | None) -> list[str]:
    """Words in lower case without punctuation, so that layout changes hide nothing."""
    return _WORD.findall((text or "").lower())


def shingles_of(words: list[str], k: int) -> set[str]:
    return {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


def shingle_hashes(words: list[str], k: int) -> np.ndarray:
    """A hash per run of `k` words, put together from the hashes of the words."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out = np.full(max(0, len(h) - k + 1), k, np.uint64)
    for j in range(k):
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j]
    return (out ^ (out >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)


class ItemIndex:
    """Minimal shingle hashes of benchmark items, one table per shingle length and size class."""

    def __init__(self, items: list[tuple[int, str]], k: int = SHINGLE, containment: float = CONTAINMENT):
        self.shingles: list[tuple[int, int, set[str]]] = []  # item_id, length of its shingles, shingles
        keys: dict[tuple[int, int], dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        self.containment = containment
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            length = min(k, len(words))  # an item shorter than a shingle is one by itself
            shingles = shingles_of(words, length)
            number, size = len(self.shingles), len(shingles)
            self.shingles.append((item_id, length, shingles))
            needed = size - math.ceil(containment * size - 1e-9) + 1
            for h in np.unique(shingle_hashes(words, length))[:needed].tolist():
                keys[length, size.bit_length()][h].append(number)
        self.classes = [
            (length, math.ceil(containment * (1 << (bits - 1))), np.array(sorted(table), np.uint64), dict(table))
            for (length, bits), table in sorted(keys.items())
        ]

    def found(self, text: str | None) -> Iterator[tuple[int, int, int]]:
        """(item_id, shingles of the item, how many the text has) of the items it contains."""
        words = words_of(text)
        for length in sorted({c[0] for c in self.classes}):
            if len(words) < length:
                continue
            hashes = shingle_hashes(words, length)
            candidates: set[int] = set()
            for of_length, least, sorted_keys, table in self.classes:
                if of_length == length and len(hashes) >= least:
                    place = np.minimum(np.searchsorted(sorted_keys, hashes), len(sorted_keys) - 1)
                    for h in hashes[sorted_keys[place] == hashes].tolist():
                        candidates.update(table[h])
            have = shingles_of(words, length) if candidates else set()
            for number in sorted(candidates):
                item_id, _, shingles = self.shingles[number]
                shared = len(shingles & have)
                if shared >= self.containment * len(shingles) - 1e-9:
                    yield item_id, len(shingles), shared


def _searching(handle) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(*handle.value)
        for batch in batches:
            rows = [
                (doc_id, item_id, size, shared, shared / size)
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True)
                for item_id, size, shared in index.found(text)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64()] * 4 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "item_id", "item_shingles", "shared", "containment"],
            )

    return run


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of at most `block_bytes` bytes, or a single item, each small enough to broadcast."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        n = len(row["text"].encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += n
    if block:
        yield block


def contaminated(
    docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, containment: float = CONTAINMENT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """`PAIRS` of documents with the benchmark items of which they hold `containment` or more.

    Null and empty texts and items hold nothing. An item with fewer than `k` words is one shingle of its
    own length. Repeated rows give repeated pairs; an empty table gives none. The benchmark is the
    stated set of queries: each block of it is sent to all tasks, and one scan of the documents per block
    looks for it. Nothing is shuffled.
    """
    spark, out = docs.sparkSession, None
    for block in item_blocks(benchmark, block_bytes):
        handle = spark.sparkContext.broadcast((block, k, containment))
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_searching(handle), PAIRS)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], PAIRS)


def _marking(handle, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(*handle.value)
        for batch in batches:
            clean = [next(index.found(t), None) is None for t in batch["text"].to_pylist()]
            yield batch.select(names).filter(pa.array(clean, pa.bool_()))

    return run


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, containment: float = CONTAINMENT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents that hold no benchmark item, with their columns; the cases are those of `contaminated`."""
    spark, kept = docs.sparkSession, docs
    for block in item_blocks(benchmark, block_bytes):
        handle = spark.sparkContext.broadcast((block, k, containment))
        kept = kept.mapInArrow(_marking(handle, docs.columns), docs.schema)
    return kept
