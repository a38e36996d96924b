"""Near-duplicate documents by HyperMinHash.

A document is a set of word shingles. Their hashes fall into buckets, and a bucket keeps its smallest
hash in two bytes: the count of its leading zeros and the ten bits behind the first one. Bands of such
registers find candidates, the share of equal registers, corrected for accidental equality, estimates
the Jaccard similarity, and pairs that may pass are confirmed on their full sets.

Equal sets are one node from the start. In each band's bucket every node meets a centre; what resembles it
forms a group, which is cut into blocks that all hold the centre. Blocks are compared inside, and blocks of a
group only where it is still apart. Only nodes so close to the centre that all their partners are in its
group leave the bucket; the others meet further centres until the bucket is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskweave.llm.common import row_number, stored, unused, whole_text
from riskweave.llm.components import components

BUCKET_BITS, MANTISSA_BITS = 8, 10
REGISTERS = 1 << BUCKET_BITS
BAND_ROWS, BANDS = 6, 42  # at a similarity of 0.85 a pair shares no band with a chance of 2e-9
LOOSE = 0.35  # estimates below are outside a centre's group
SMALL = 32  # registers of sets up to this size may be few enough for one collision to matter
MARGIN = 0.1  # an estimate of 256 registers is off by more with a chance of 1e-5
BLOCK_ROWS = 512
BUCKET_ROWS = 4096  # larger buckets meet single centres first, then in pairs of blocks of this size
ROUNDS = 8

SKETCH = "_row long, n_shingles long, signature binary, registers binary"


# -- sets and registers -------------------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's `k`-word shingles; fewer words are one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(k, len(words))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j]
    return np.unique(_mixed(out))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Two bytes per bucket, 0 where it is empty. `hashes` are sorted, so a bucket's first is its least."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(hashes):
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        rest = (hashes[first] << np.uint64(BUCKET_BITS)) >> np.uint64(11)  # 53 bits: exact as a float
        bits = np.frexp(rest.astype(np.float64))[1]
        shift = bits - 1 - MANTISSA_BITS
        kept = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64))
        code = ((54 - bits).astype(np.uint64) << np.uint64(MANTISSA_BITS)) | (kept & np.uint64((1 << MANTISSA_BITS) - 1))
        out[bucket[first]] = code.astype(np.uint16)
    return out


_DETOURS = np.random.default_rng(7).integers(0, REGISTERS, (64, REGISTERS))
_ORDERS = np.random.default_rng(8).permuted(np.tile(np.arange(REGISTERS), (REGISTERS, 1)), axis=1)


def densified(regs: np.ndarray) -> np.ndarray:
    """Empty registers take the value of the first full one on a fixed walk, the same walk for all documents.

    A walk ends with an order of all registers of its own, so it finds a full one in the smallest set, and two
    sets that differ in few registers mostly end at the same one, however unequal their sizes.
    """
    out = regs.copy()
    for step in _DETOURS:
        empty = np.flatnonzero(out == 0)
        if not len(empty):
            return out
        out[empty] = regs[step[empty]]
    empty = np.flatnonzero(out == 0)
    full = np.flatnonzero(regs)
    if len(empty) and len(full):
        out[empty] = regs[full[_ORDERS[empty][:, full].argmin(1)]]
    return out


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of rows of registers from the share of equal ones among those in use.

    Registers of different sets agree by accident; the expected number of such, after the published
    approximation for large sets, is taken off.
    """
    used = ((a != 0) | (b != 0)).sum(-1)
    equal = ((a == b) & (a != 0)).sum(-1)
    ratio = np.minimum(n_a, n_b) / np.maximum(np.maximum(n_a, n_b), 1)
    accidental = 0.169919487159739 * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    accidental = np.minimum(accidental * used / REGISTERS, np.maximum(used - equal, 0))
    return np.maximum(equal - accidental, 0) / np.maximum(used - accidental, 1)


# -- inside tasks -------------------------------------------------------------------------------


def _sketching(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, signatures, codes = [], [], []
            for text in batch["text"].to_pylist():
                h = shingle_hashes(text, k)
                sizes.append(len(h))
                signatures.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                codes.append(registers(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["_row"], pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), pa.array(codes, pa.binary())],
                names=["_row", "n_shingles", "signature", "registers"],
            )

    return run


def _banding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node): a key stands for a band and its registers."""
    for batch in batches:
        nodes, codes = batch["_row"].to_numpy(), batch["registers"].to_pylist()
        if not codes:
            continue
        keys = np.empty((len(codes), BANDS), np.int64)
        for i, code in enumerate(codes):
            dense = densified(np.frombuffer(code, np.uint16)).tobytes()
            step = 2 * BAND_ROWS
            keys[i] = np.array([xxhash.xxh64_intdigest(dense[j * step : (j + 1) * step], j) for j in range(BANDS)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(nodes, BANDS))], names=["key", "node"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def tight(percent: int) -> float:
    """From this estimate on a node's partners are all in its centre's group.

    1 - estimate is a distance but for the correction, which is below 0.001: it is the chance that the
    first full registers of two documents differ in a random order. A pair looked at is apart by
    1 - percent / 100 + MARGIN at most, so both resemble a centre that one of them is this near to.
    """
    return LOOSE + 1 - percent / 100 + MARGIN + 0.001


def _resembling(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs whose estimate is not below `LOOSE`, and whether the node is so near that it needs no other centre."""
    bar = tight(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                likely = estimate(
                    _matrix(batch["registers"]), _matrix(batch["_other"]), batch["n_shingles"].to_numpy(), batch["_n"].to_numpy()
                )
                pairs = pa.RecordBatch.from_arrays([batch["centre"], batch["node"], pa.array(likely >= bar)], names=["centre", "node", "tight"])
                yield pairs.filter(pa.array(likely >= LOOSE))

    return run


def _meeting(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(centre, node) of whole buckets, whose rows follow each other: the first node that is left is the next centre."""
    bar = tight(percent)

    def pairs(nodes: np.ndarray, sizes: np.ndarray, regs: np.ndarray) -> tuple[list, list]:
        centres, others = [], []
        while len(nodes) > 1:
            likely = estimate(regs[1:], regs[:1], sizes[1:], sizes[0])
            met = nodes[1:][likely >= LOOSE]
            centres += [nodes[0]] * len(met)
            others += met.tolist()
            left = 1 + np.flatnonzero(likely < bar)
            nodes, sizes, regs = nodes[left], sizes[left], regs[left]
        return centres, others

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        empty = pa.table({"centre": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})

        def met() -> tuple[list, list]:
            nodes, sizes = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            return pairs(nodes, sizes, np.concatenate([h[2] for h in held]))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, units = batch["key"].to_numpy(), batch["unit"].to_numpy()
            nodes, sizes, regs = batch["node"].to_numpy(), batch["n_shingles"].to_numpy(), _matrix(batch["registers"])
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (units[1:] != units[:-1])])
            centres, others = [], []
            for start, end in zip(starts, np.r_[starts[1:], len(keys)], strict=True):
                now = (keys[start], units[start])
                if held and now != key:
                    c, o = met()
                    centres += c
                    others += o
                    held = []
                key = now
                held.append((nodes[start:end], sizes[start:end], regs[start:end]))
            yield pa.RecordBatch.from_arrays([pa.array(centres, pa.int64()), pa.array(others, pa.int64())], schema=empty.schema)
        if held:
            c, o = met()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(o, pa.int64())], schema=empty.schema)

    return run


def _packing(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t, k).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(sets, pa.binary())], names=["node", "hashes"])

    return run


class _Forest:
    """Union-find over the rows of a block."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[self.root(i)] = self.root(j)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _comparing(percent: int, inside: bool) -> Callable[[pa.Table], pa.Table]:
    """Confirmed links of a block: of its own rows (`inside`), and of these with the visitors.

    Links that join what is joined already are left out. Rows with the same label are joined from the start.
    """

    def run(block: pa.Table) -> pa.Table:
        nodes, visitor, labels = (block[c].to_pylist() for c in ("node", "visitor", "label"))
        sets = [np.frombuffer(s, np.uint64) for s in block["hashes"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        regs = np.stack([registers(s) for s in sets])
        forest, first, out = _Forest(len(nodes)), {}, []
        for i, x in enumerate(labels):
            forest.join(i, first.setdefault(x, i))
        order = sorted(range(len(nodes)), key=lambda i: (visitor[i], nodes[i]))
        regs, sizes_of = regs[order], sizes[order]
        homes = sum(not v for v in visitor)
        for at, i in enumerate(order):
            # Home rows meet later home rows if `inside`; visitors meet all home rows.
            others = slice(0, homes) if visitor[i] else slice(at + 1, homes if inside else at + 1)
            likely = estimate(regs[others], regs[at][None], sizes_of[others], sizes_of[at])
            bar = np.where(np.maximum(sizes_of[others], sizes_of[at]) <= SMALL, LOOSE, percent / 100 - MARGIN)
            for near in np.flatnonzero(likely >= bar):
                j = order[near + others.start]
                if forest.root(i) != forest.root(j) and linked(sets[i], sets[j], percent):
                    forest.join(i, j)
                    out.append((nodes[i], nodes[j]))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


# -- jobs ---------------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    """A row per row of `docs`: _row, doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * intersection >= percent * union of their sets of `k`-word
    shingles (A-Z in lower case; fewer words are one shingle). component_id is the smallest doc_id that
    links lead to, the document's own included; the row with it stays, of repeated rows with
    it one. Null and empty texts have no shingles and are linked with nothing. A null doc_id comes after
    all others. An empty table gives an empty one. `percent` is meant for 80 and more: bands are tuned to it.
    `docs` must be a stored table: rows are known by their number in the scan (`_row`).
    """
    rows = docs.select(row_number(docs).alias("_row"), "doc_id", whole_text().alias("text"))
    sketches = stored(rows.select("_row", "text").mapInArrow(_sketching(k), SKETCH), "sketches")
    classes = sketches.where("signature IS NOT NULL").groupBy("signature").agg(F.min("_row").alias("node"))
    same = stored(
        sketches.select("_row", "n_shingles", "signature").join(classes, "signature", "left")
        .select("_row", "n_shingles", F.coalesce("node", "_row").alias("node")),
        "classes",
    )
    nodes = sketches.join(same.where("node = _row").select("_row"), "_row").where("signature IS NOT NULL")
    nodes = stored(nodes.select("_row", "n_shingles", "registers"), "nodes")

    links = _links(rows, nodes, k, percent)
    labels = components(links)
    grouped = same.join(labels, "node", "left").select("_row", "n_shingles", F.coalesce("label", "node").alias("_label"))
    members = stored(rows.select("_row", "doc_id").join(grouped, "_row"), "near-members")
    heads = members.groupBy("_label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("_head"))
    return members.join(heads, "_label").select(
        "_row", "doc_id", "n_shingles", F.col("_head.doc_id").alias("component_id"), (F.col("_row") == F.col("_head._row")).alias("kept")
    )


def _groups(nodes: DataFrame, percent: int) -> DataFrame:
    """(centre, node): any two nodes that share a bucket and may be linked are in one group or are such a pair.

    The first centre of a bucket is its smallest node. Whoever is not `tight` to it stays: a bucket of at most
    `BUCKET_ROWS` such nodes is gone through in a task, a larger one meets more centres drawn by hash, and after
    `ROUNDS` of these its blocks meet in pairs, which is quadratic where thousands of nodes of a bucket are all unlike.
    """
    other = nodes.select(F.col("_row").alias("centre"), F.col("registers").alias("_other"), F.col("n_shingles").alias("_n"))
    named = nodes.withColumnRenamed("_row", "node")
    waiting, found, small = nodes.select("_row", "registers").mapInArrow(_banding, "key long, node long"), [], []
    for turn in range(ROUNDS):
        centre = F.min_by("node", F.xxhash64("node", F.lit(turn))) if turn else F.min("node")
        centres = waiting.groupBy("key").agg(centre.alias("centre"), F.count("*").alias("n")).where("n > 1")
        met = stored(waiting.join(centres, "key").where("node <> centre").select("key", "centre", "node", "n"), "buckets")
        ready = met.select("centre", "node").distinct().join(named, "node").join(other, "centre")
        ready = ready.select("centre", "node", "registers", "_other", "n_shingles", "_n")
        pairs = stored(ready.mapInArrow(_resembling(percent), "centre long, node long, tight boolean"), "candidates")
        found.append(pairs.select("centre", "node"))
        left = met.where("n > 2").join(pairs.where("tight"), ["centre", "node"], "left_anti").select("key", "node")
        left = left.join(left.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")
        left = stored(left.select("key", "node", "n"), "waiting")
        small.append(left.where(F.col("n") <= BUCKET_ROWS))
        waiting = left.where(F.col("n") > BUCKET_ROWS)
        if waiting.isEmpty():
            break
        if turn == ROUNDS - 1:
            small.append(waiting)
        waiting = waiting.select("key", "node")

    left = reduce(DataFrame.union, small)
    blocks = F.ceil(F.col("n") / BUCKET_ROWS).cast("int")
    left = left.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A node of a bucket of several blocks is in a unit with each other block.
    left = left.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("blocks = 1 OR to <> block")
    unit = F.least("block", "to") * F.col("blocks") + F.greatest("block", "to")
    units = left.select("key", unit.cast("long").alias("unit"), "node").join(named, "node").repartition("key", "unit")
    units = units.sortWithinPartitions("key", "unit", "node").select("key", "unit", "node", "n_shingles", "registers")
    found.append(units.mapInArrow(_meeting(percent), "centre long, node long"))
    return stored(reduce(DataFrame.union, found).distinct(), "near")


def _links(rows: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) that connect what belongs together."""
    near = _groups(nodes, percent)
    groups = near.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    home = near.join(groups, "centre").select("centre", "node", block.alias("block"), "blocks", F.lit(False).alias("visitor"))
    centre_rows = groups.select(
        "centre", F.col("centre").alias("node"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "blocks", F.lit(True).alias("visitor")
    )
    members = stored(home.union(centre_rows), "near-blocks")
    involved = members.select(F.col("node").alias("_row")).distinct()
    sets = stored(rows.select("_row", "text").join(involved, "_row").mapInArrow(_packing(k), "node long, hashes binary"), "sets")

    def compared(placed: DataFrame, inside: bool) -> DataFrame:
        ready = placed.join(sets, "node").select("centre", "block", "node", "visitor", "label", "hashes")
        return ready.groupBy("centre", "block").applyInArrow(_comparing(percent, inside), "a long, b long")

    links = stored(compared(members.withColumn("label", F.col("node")), True), "links-inside")
    if members.where("blocks > 1").isEmpty():
        return links
    # Groups of several blocks that are still apart: what is not joined with the group's largest part visits all blocks.
    large = members.where("blocks > 1 AND (NOT visitor OR block = 0)").join(components(links), "node", "left")
    large = stored(large.withColumn("label", F.coalesce("label", "node")), "large-groups")
    parts = large.groupBy("centre", "label").agg(F.count("*").alias("n"))
    largest = parts.groupBy("centre").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    apart = large.join(largest.select("centre", F.col("top.label").alias("main")), "centre")
    visits = apart.where("label <> main").withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    visits = visits.where((F.col("to") != F.col("block")) | F.col("visitor"))
    placed = apart.where("NOT visitor").select("centre", "block", "node", "visitor", "label").union(
        visits.select("centre", F.col("to").alias("block"), "node", F.lit(True).alias("visitor"), "label")
    )
    return links.union(stored(compared(placed, False), "links-across"))


def near_duplicate_table(docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    return near_duplicates(docs.select("doc_id", "text"), k, percent).drop("_row")


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with its columns. `docs` must be a stored table."""
    (row,) = unused(docs, "_row")
    stays = near_duplicates(docs, k, percent).where("kept").select(F.col("_row").alias(row))
    return docs.withColumn(row, row_number(docs)).join(stays, row, "left_semi").select(*docs.columns)
