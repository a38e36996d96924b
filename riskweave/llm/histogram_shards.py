"""Shards of near-equal bytes by histogram sort.

Rows are ordered by the CRC-32 of their text, so equal texts are neighbours and stay together. The
boundaries between shards are found by counting: each round splits the intervals that still hold a
boundary into probes, counts the exact bytes below every probe across all partitions, and keeps the
one interval around each target. When every boundary is within the tolerance, or its interval holds a
single key, each row goes to its place in one exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.llm.common import stored, unused, whole_text

KEYS = 1 << 32
PROBES = 256
TOLERANCE = 0.0005
SLICE_BYTES = 64 << 20


@dataclass
class _Bracket:
    """The keys low..high-1 hold the boundary; `below` and `upto` are the bytes below low and high."""

    target: float
    low: int
    high: int
    below: int
    upto: int

    def settled(self, slack: float) -> bool:
        return self.high - self.low <= 1 or min(self.target - self.below, self.upto - self.target) <= slack

    def boundary(self) -> int:
        return self.low if self.target - self.below <= self.upto - self.target else self.high


def splitters(rows: DataFrame, key: str, size: str, shards: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[int]:
    """shards - 1 ascending keys; a row belongs to the shard numbered by how many are at or below its key.

    Only `probes` counts per open boundary reach the driver in a round, and 2**32 keys need four
    rounds of 256 probes at the most. A tolerance is a share of one shard's bytes.
    """
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    brackets = [_Bracket(total * i / shards, 0, KEYS, 0, total) for i in range(1, shards)]
    slack = tolerance * total / shards
    while open_ := [b for b in brackets if not b.settled(slack)]:
        spans = sorted({(b.low, b.high) for b in open_})
        steps = {s: max(1, -(-(s[1] - s[0]) // probes)) for s in spans}
        k = F.col(key)
        cell: Column | None = None
        for place, (low, high) in enumerate(spans):
            inside = (k >= low) & (k < high)
            value = F.struct(F.lit(place).alias("span"), F.floor((k - low) / steps[low, high]).alias("probe"))
            cell = F.when(inside, value) if cell is None else cell.when(inside, value)
        counted = (
            rows.select(cell.alias("cell"), size).where("cell IS NOT NULL")
            .groupBy("cell.span", "cell.probe").agg(F.sum(size).alias("bytes")).collect()
        )
        bytes_in = {(r["span"], r["probe"]): r["bytes"] for r in counted}
        for b in open_:
            _narrow(b, spans.index((b.low, b.high)), steps[b.low, b.high], bytes_in)
    return [b.boundary() for b in brackets]


def _narrow(b: _Bracket, span: int, step: int, bytes_in: dict[tuple[int, int], int]) -> None:
    """Move the bracket to the probe interval that holds its target."""
    low, below, probe = b.low, b.below, 0
    while low + step < b.high and below + bytes_in.get((span, probe), 0) <= b.target:
        below += bytes_in.get((span, probe), 0)
        low, probe = low + step, probe + 1
    b.high, b.upto = min(low + step, b.high), below + bytes_in.get((span, probe), 0)
    b.low, b.below = low, below


def text_size() -> Column:
    return (F.octet_length(whole_text()) + 1).cast("long")


def text_crc() -> Column:
    return F.crc32(whole_text().cast("binary"))


def sharded(docs: DataFrame, shards: int = 8, slice_bytes: int = SLICE_BYTES, tolerance: float = TOLERANCE) -> DataFrame:
    """`docs` with size, text_crc32, shard (0..shards-1) and slot (0, 1, ... within the shard).

    Bytes per shard differ from the mean by the tolerance, or by the bytes of one group of equal texts
    where a group lies across a boundary: groups are never torn. Null texts are as empty ones (size 1,
    CRC 0), and an empty table gives an empty one. A shard may be far larger than a task, so it is made
    of slices of about `slice_bytes`; a slice takes rows by a hash of doc_id and text, which spreads a
    group of equal texts too. The slots of a shard run through its slices in order.
    Columns of `docs` named like the new ones are replaced.
    """
    new = ["size", "text_crc32", "shard", "slot"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    narrow = stored(docs.select("doc_id", text_size().alias("size"), text_crc().alias("text_crc32")), "shard-sizes")
    bounds = splitters(narrow, "text_crc32", "size", shards, tolerance)
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    slices = max(32, -(-total // (shards * slice_bytes)))

    mixed, part, rank, start = unused(docs, "_mixed", "_slice", "_rank", "_start")

    def placed(df: DataFrame) -> DataFrame:
        shard = sum((F.when(F.col("text_crc32") >= b, 1).otherwise(0) for b in bounds), F.lit(0))
        return df.withColumn("shard", shard.cast("int")).withColumn(mixed, F.xxhash64("doc_id", "text_crc32")).withColumn(
            part, F.pmod(F.col(mixed), F.lit(slices)).cast("int")
        )

    # shards x slices rows: one per 64 MB of text, 32 per shard at least.
    running = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed(narrow).groupBy("shard", part).agg(F.count("*").alias("rows"))
        .select("shard", part, F.coalesce(F.sum("rows").over(running), F.lit(0)).alias(start))
    )
    full = docs.withColumn("size", text_size()).withColumn("text_crc32", text_crc())
    order = Window.partitionBy("shard", part).orderBy(mixed, "doc_id", "text_crc32")
    return (
        placed(full)
        .withColumn(rank, F.row_number().over(order))
        .join(F.broadcast(starts), ["shard", part])
        .select(*docs.columns, "size", "text_crc32", "shard", (F.col(start) + F.col(rank) - 1).alias("slot"))
    )


def shard_table(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The digest of `sharded`: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return sharded(docs.select("doc_id", "text"), shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
