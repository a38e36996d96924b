"""Exact running totals that stay balanced when one key owns a large share of the rows.

A plain window partitioned by user puts a whole user into one task, and a sliding frame re-adds
its rows for every row. `before` avoids both:

* Look-backs are written as a ledger. A row adds its value when it happens and takes it away again
  when it leaves the look-back, so a sliding total becomes a running total over the ledger.
* The entries of keys with very many rows are range-partitioned by (key, time, id), which Spark does by
  the quantiles of a sample, into chunks of about `chunk_rows`. Outliers, bursts and many rows at one
  single time make no chunk larger, as the id breaks ties. What the earlier chunks add up to is
  computed by an aggregation (with map-side combine) and enters every chunk as a carry row. The
  window then runs on (key, chunk); no task holds more than one chunk.

Nothing is sampled away or dropped: chunk limits only decide where the rows are added up.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.session import materialize

HOT_ROWS = 1_000_000
CHUNK_ROWS = 250_000

# Order of ledger entries that share one time.
_CARRY, _EXPIRED, _ROW, _EXPIRES_AFTER = 0, 1, 2, 3


class Measure(NamedTuple):
    """A total over the rows before the current one, in (time, id) order.

    `within` limits it to that much time back (same unit as the time column); `inclusive` keeps a
    row lying exactly that far back. `per` restricts it to rows that agree on these columns.
    `how` is "sum", "max" or "last"; the last two look at the whole history.
    """

    name: str
    value: Column
    within: int | None = None
    inclusive: bool = False
    per: tuple[str, ...] = ()
    how: str = "sum"


def before(
    df: DataFrame,
    key: Sequence[str],
    time: str,
    ident: str,
    measures: Sequence[Measure],
    hot_rows: int = HOT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """`df` with one column per measure: its total over the earlier rows of the same key.

    Sums start at 0, "max" and "last" at null. `ident` breaks ties in `time` and must be unique
    within the key. A row without a time has null for every measure and counts in none. One pass
    over the key and time columns runs at once, to see whether any key has more than `hot_rows` rows.
    """
    key = list(key)
    subkeys = sorted({c for m in measures for c in m.per})
    lookbacks = sorted({(m.within, m.inclusive) for m in measures if m.within is not None})
    sizes = df.groupBy(*key).agg(F.count("*").alias("_n"), F.max(F.col(time).cast("double")).alias("_t1"))
    facts = sizes.agg(F.sum(F.when(F.col("_n") > hot_rows, F.col("_n"))), F.max("_t1")).first()
    rows = _ledger(df, key, subkeys, time, ident, measures, lookbacks, facts[1])
    if facts[0]:
        hot = sizes.where(F.col("_n") > hot_rows).select(*[F.col(k).alias(f"_hot_{k}") for k in key])
        chunks = -(-facts[0] * (1 + len(lookbacks)) // chunk_rows)
        rows = _chunked(rows, hot, key, subkeys, ident, measures, chunks)

    # One exchange on (key, chunk) serves every window below, finer ones included. Look-backs that
    # no later window needs are left out of its sort.
    rows = rows.repartition(*key, "_chunk")

    def slots(per: tuple[str, ...]) -> set[int]:
        return {lookbacks.index((m.within, m.inclusive)) + 1 for m in measures if m.per == per and m.within is not None}

    levels = sorted({m.per for m in measures}, key=lambda per: (len(per) > 0, -len(slots(per)), per))
    for done, per in enumerate(levels):
        earlier = (
            Window.partitionBy(*key, "_chunk", *per)
            .orderBy("_t", "_rank", ident)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        rows = rows.withColumns(
            {f"_m_{m.name}": _total(m, F.col(f"_m_{m.name}")).over(earlier) for m in measures if m.per == per}
        )
        still = {-1, 0}.union(*[slots(later) for later in levels[done + 1:]])
        rows = rows.where(F.col("_slot").isin(*(still if done + 1 < len(levels) else {0})))
    return rows.select(
        *df.columns,
        *[F.when(F.col("_t").isNotNull(), _result(m, F.col(f"_m_{m.name}"))).alias(m.name) for m in measures],
    )


def _chunked(
    entries: DataFrame, hot: DataFrame, key: list[str], subkeys: list[str], ident: str, measures: Sequence[Measure], chunks: int
) -> DataFrame:
    """Entries of hot keys in chunks with their carry rows, all others in chunk 0.

    The chunks are written once, as the totals and the windows must see the same limits. Hot keys are at most one in
    `hot_rows` rows, so they are broadcast: a shuffle join would bring every row of a key into one task.
    """
    hot = F.broadcast(hot)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in key])
    ranged = (
        entries.join(hot, same, "left_semi").repartitionByRange(chunks, *key, "_t", "_rank", ident)
        .withColumn("_chunk", F.spark_partition_id().cast("long") + 1)
    )
    placed = materialize(ranged)
    cold = entries.join(hot, same, "left_anti")
    return cold.unionByName(placed).unionByName(_carry_rows(placed, key, subkeys, measures), allowMissingColumns=True)


def _ledger(
    df: DataFrame,
    key: list[str],
    subkeys: list[str],
    time: str,
    ident: str,
    measures: Sequence[Measure],
    lookbacks: list[tuple[int, bool]],
    end: float | None,
) -> DataFrame:
    """The rows themselves (slot 0) plus one narrow entry per look-back at the time they leave it.

    What leaves its look-back after `end`, the last time of all, can no longer matter.
    """

    def entry(slot: int, rank: int, t: Column) -> Column:
        return F.struct(F.lit(slot).alias("slot"), F.lit(rank).alias("rank"), t.alias("t"))

    t = F.col(time)
    posts = [entry(0, _ROW, t)]
    for slot, (span, inclusive) in enumerate(lookbacks, start=1):
        posts.append(entry(slot, _EXPIRES_AFTER if inclusive else _EXPIRED, t + span))

    keep = {*key, *subkeys, ident}
    payload = [c for c in df.columns if c not in keep]
    values = {m.name: m.value if m.how != "last" else F.struct(t, F.col(ident), m.value.alias("value")) for m in measures}
    rows = df.withColumns({f"_m_{n}": F.when(t.isNotNull(), v) for n, v in values.items()})
    if lookbacks:
        rows = rows.withColumn("_post", F.explode(F.array(*posts)))
        rows = rows.where((F.col("_post.slot") == 0) | (F.col("_post.t").cast("double") <= F.lit(end)))
    else:
        rows = rows.withColumn("_post", posts[0])
    slot = F.col("_post.slot")

    def posted(m: Measure) -> Column:
        value = F.col(f"_m_{m.name}")
        added = F.when(slot == 0, value)
        if m.within is None:
            return added
        return added.when(slot == lookbacks.index((m.within, m.inclusive)) + 1, -value)

    def own(c: str) -> Column:
        return (F.when(slot == 0, F.col(c)) if lookbacks else F.col(c)).alias(c)

    return rows.select(
        *key,
        *[c for c in dict.fromkeys([*subkeys, ident]) if c not in key],
        *[own(c) for c in payload],
        F.lit(0).cast("long").alias("_chunk"),
        slot.alias("_slot"),
        F.col("_post.rank").alias("_rank"),
        F.col("_post.t").alias("_t"),
        *[posted(m).alias(f"_m_{m.name}") for m in measures],
    )


def _carry_rows(entries: DataFrame, key: list[str], subkeys: list[str], measures: Sequence[Measure]) -> DataFrame:
    """One row per (hot key, chunk, sub-key) holding the totals of all earlier chunks.

    All levels (the key alone and the key with each `per`) come from one grouping-sets pass.
    """
    levels = sorted({m.per for m in measures})
    sets = [[*key, "_chunk", *per] for per in levels]
    by = [*key, "_chunk", *subkeys]
    level = {per: sum(1 << (len(by) - 1 - i) for i, c in enumerate(by) if c not in (*key, "_chunk", *per)) for per in levels}
    sums = (
        entries.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by])
        .agg(
            F.grouping_id().alias("_level"),
            *[_total(m, F.col(f"_m_{m.name}")).alias(f"_m_{m.name}") for m in measures],
        )
    )
    earlier = (
        Window.partitionBy(*key, "_level", *subkeys)
        .orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return sums.select(
        *by,
        F.lit(-1).alias("_slot"),
        F.lit(_CARRY).alias("_rank"),
        *[
            F.when(F.col("_level") == level[m.per], _total(m, F.col(f"_m_{m.name}")).over(earlier)).alias(f"_m_{m.name}")
            for m in measures
        ],
    )


def _total(m: Measure, value: Column) -> Column:
    return F.sum(value) if m.how == "sum" else F.max(value)


def _result(m: Measure, total: Column) -> Column:
    if m.how == "sum":
        return F.coalesce(total, F.lit(0))
    return total if m.how == "max" else total["value"]


def with_blocks(df: DataFrame, key: Sequence[str], position: str, lead_in: int, block: int = 4096) -> DataFrame:
    """Cut each key into blocks of `block` consecutive positions for frames of up to `lead_in` rows.

    `position` is the row's number within its key (0, 1, 2, ...). A row also appears, marked
    `_lead_in`, in every later block whose first frames reach back to it; drop those after the
    window. Every block holds at most `block + lead_in` rows, so a hot key spreads over many tasks.
    Rows without a position stay, in the block null.
    """
    own = F.floor(F.col(position) / block)
    blocks = F.coalesce(F.sequence(own, F.floor((F.col(position) + lead_in) / block)), F.array(F.lit(None).cast("long")))
    return df.withColumn("_block", F.explode(blocks)).withColumn("_lead_in", F.coalesce(F.col("_block") > own, F.lit(False)))
