"""Mixing sources by temperature, realised as budgeted block permutations.

Token shares of the sources are raised to an exponent between 0 (all sources alike) and 1 (as they
come) and normalised to weights. The exponent is the largest that reaches a target entropy, but no
smaller than the limit on repeating a source allows; both are found by bisection. Each source then
gets its weight of the token budget: whole passes over its documents, and a last part of a pass that
takes documents in a permutation of blocks while the budget lasts.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.llm.common import row_number, stored, unused, whole_text

ENTROPY_SHARE = 0.95  # target entropy, as a share of that of equal weights
MOST_PASSES = 4.0  # how often a document may be repeated on average
BLOCK_ROWS = 4096
BISECTIONS = 50


class Mixture(NamedTuple):
    exponent: float
    weights: dict[str | None, float]
    entropy: float
    passes: float


def weights_at(tokens: dict[str | None, int], exponent: float) -> dict[str | None, float]:
    top = max(tokens.values())
    raised = {s: (n / top) ** exponent for s, n in tokens.items()}
    total = sum(raised[s] for s in sorted(raised, key=str))
    return {s: x / total for s, x in raised.items()}


def _entropy(weights: dict[str | None, float]) -> float:
    return -sum(w * math.log(w) for w in sorted(weights.values()) if w > 0)


def _passes(tokens: dict[str | None, int], weights: dict[str | None, float], budget: float) -> float:
    return max(weights[s] * budget / n for s, n in tokens.items())


def temperature(
    tokens: dict[str | None, int], budget: float, entropy_share: float = ENTROPY_SHARE, most_passes: float = MOST_PASSES
) -> Mixture:
    """The exponent and weights of sources with the given token counts.

    Entropy falls and the largest number of passes falls as the exponent grows, so each target is one
    point. If they are at odds the limit on passes wins; if even exponent 1 exceeds it (a budget above
    that many passes over everything) the weights are those of exponent 1. Sources without tokens have
    no weight.
    """
    tokens = {s: n for s, n in tokens.items() if n > 0}
    if not tokens:
        return Mixture(1.0, {}, 0.0, 0.0)
    target = entropy_share * math.log(len(tokens))
    spread = _bisect(lambda a: _entropy(weights_at(tokens, a)) >= target)
    rare = _bisect(lambda a: _passes(tokens, weights_at(tokens, a), budget) > most_passes)
    exponent = max(spread, rare)
    weights = weights_at(tokens, exponent)
    return Mixture(exponent, weights, _entropy(weights), _passes(tokens, weights, budget))


def _bisect(holds) -> float:
    """Where a condition that holds for small exponents ends, within 0 to 1."""
    if holds(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return high if not holds(low) else low


def word_count(text: Column) -> Column:
    """Runs of bytes other than space, tab and line ends."""
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def _key() -> Column:
    """What a row's places are made of: its id and its text."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(whole_text().cast("binary"))))


def _place(seed: int) -> Column:
    """Where a row stands in its source's permutation of a pass: 60 bits of a digest that SQL engines share."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("mix_pass").cast("string"), F.lit(":"), F.col("_key")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def draws(
    docs: DataFrame,
    budget: float | None = None,
    entropy_share: float = ENTROPY_SHARE,
    most_passes: float = MOST_PASSES,
    seed: int = 1,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """A row per document and pass of the mixture: _row, doc_id, source, mix_pass, mix_block, mix_position, mix_tokens.

    The budget is counted in words and defaults to those of all documents. Pass 0, 1, ... takes every
    document of its source while the source's budget covers whole passes; the last pass takes the
    documents whose words, summed up in the order of the permutation, end within what is left. So a
    source gets its weight of the budget less one document at most: where the first one that does not
    fit ends the pass, smaller ones behind it are not put in its place, which would favour short texts.
    Each pass is a permutation of its own; `mix_position` is the row's place in it, gapless from 0.
    Null sources are a source of their own; wordless and null texts cost nothing, and a source
    that has only such texts is left out. Equal rows share a place in the permutation and are ordered
    by `_row`, their number in the scan. An empty table gives an empty one.

    A source may be far larger than a task: its permutation is cut into blocks of about `block_rows`
    documents, and running sums go over runs of blocks, blocks and documents in turn, so that no window
    holds more than some thousand rows. The driver sees one number per source.
    """
    rows = stored(
        docs.select("doc_id", "source", word_count(whole_text()).alias("mix_tokens"), _key().alias("_key"))
        .withColumn("_row", row_number(docs)),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("rows")).collect()
    tokens = {r["source"]: r["tokens"] for r in sizes}
    budget = sum(tokens.values()) if budget is None else budget
    mixture = temperature(tokens, budget, entropy_share, most_passes)

    plan = []
    for r in sizes:
        if not r["tokens"]:
            continue
        share = mixture.weights[r["source"]] * budget
        whole = int(share // r["tokens"])
        left = math.floor(share - whole * r["tokens"])
        plan.append((r["source"], whole, left, max(1, -(-r["rows"] // block_rows))))
    wanted = docs.sparkSession.createDataFrame(plan, "_source string, _whole long, _left long, _blocks long")
    placed = (
        rows.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("mix_pass", F.explode(F.expr("sequence(0, cast(_whole as int))")))
        .withColumn("_place", _place(seed)).drop("_key")
        .withColumn("mix_block", F.expr("_place div (1152921504606846975 div _blocks + 1)"))
    )
    return _drawn(placed)


def _drawn(placed: DataFrame) -> DataFrame:
    """Whole passes, and the part of the last one's permutation that the rest of the budget pays for."""
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda name, window: F.coalesce(F.sum(name).over(window), F.lit(0))
    blocks = (
        placed.groupBy("source", "mix_pass", "mix_block").agg(F.sum("mix_tokens").alias("_sum"), F.count("*").alias("_n"))
        .withColumn("_run", F.floor(F.col("mix_block") / 4096))
    )
    of_source, of_run = earlier("source", "mix_pass").orderBy("_run"), earlier("source", "mix_pass", "_run").orderBy("mix_block")
    runs = blocks.groupBy("source", "mix_pass", "_run").agg(F.sum("_sum").alias("_run_sum"), F.sum("_n").alias("_run_n"))
    runs = runs.select(
        F.col("source").alias("_s"), F.col("mix_pass").alias("_p"), F.col("_run").alias("_r"),
        before("_run_sum", of_source).alias("_run_start"), before("_run_n", of_source).alias("_run_first"),
    )
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("mix_pass") == F.col("_p"))
    starts = (
        blocks.withColumns({"_in_run": before("_sum", of_run), "_in_run_n": before("_n", of_run)})
        .join(runs, same & (F.col("_run") == F.col("_r")))
        .select(
            F.col("source").alias("_s"), F.col("mix_pass").alias("_p"), F.col("mix_block").alias("_b"),
            (F.col("_run_start") + F.col("_in_run")).alias("_start"), (F.col("_run_first") + F.col("_in_run_n")).alias("_first"),
        )
    )
    order = Window.partitionBy("source", "mix_pass", "mix_block").orderBy("_place", "_row")
    upto = F.sum("mix_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.col("mix_pass") < F.col("_whole")
    return (
        placed.join(starts, same & (F.col("mix_block") == F.col("_b")))
        .where(whole | (F.col("_start") <= F.col("_left")))  # blocks beyond the budget need no sort
        .withColumns({"_upto": upto, "mix_position": F.col("_first") + F.row_number().over(order) - 1})
        .where(whole | (F.col("_start") + F.col("_upto") <= F.col("_left")))
        .select("_row", "doc_id", "source", "mix_pass", "mix_block", "mix_position", "mix_tokens")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mixture with their columns, a row per pass that draws them; `draws` has the rules.

    `docs` must be a stored table: its rows are known by their number in the scan.
    """
    (row,) = unused(docs, "_row")
    chosen = draws(docs, **options).select(F.col("_row").alias(row))
    return docs.withColumn(row, row_number(docs)).join(chosen, row).select(*docs.columns)
