"""Exact distribution statistics without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from riskweave.functions.history import Measure, before
from riskweave.session import materialize

# A sketch of this accuracy errs by 1/10,000 of the rows; the brackets are ten times as wide.
SKETCH_ACCURACY, BRACKET = 10_000, 0.001
# Values a mergeable sketch keeps exactly.
SKETCH_SIZE = 4096


def with_rows_below(counts: DataFrame, by: Sequence[str] = (), order: str = "value", **sizes: int) -> DataFrame:
    """Adds `below`, the number of rows that come before the value in the order."""
    keyed = counts if by else counts.withColumn("_all", F.lit(0))
    return before(keyed, by or ["_all"], order, order, [Measure("below", F.col("n"))], **sizes).drop("_all")


def exact_percentiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), written: bool = False, **sizes: int
) -> DataFrame:
    """Linearly interpolated percentiles per group, one column per entry of `probs`; without groups as
    `exact_percentiles_of`, in one row.

    A quantile sketch first brackets each rank. One pass then counts equal values inside the brackets,
    about a five-hundredth of the rows each, and everything between them as a whole; the small
    result is written, ranked by balanced running totals, and a percentile is read at the values that
    cover its rank. Null and NaN are left out, null groups are groups.
    """
    if not by:
        return exact_percentiles_of(df, [value], probs, written=written, **sizes).drop("metric", "count")
    by, ends = list(by), len(probs)
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(*by, x.alias("value"))
    around = [max(0.0, p - BRACKET) for p in probs.values()] + [min(1.0, p + BRACKET) for p in probs.values()]
    sketch = F.percentile_approx("value", F.array(*[F.lit(p) for p in around]), SKETCH_ACCURACY)
    limits = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(sketch.alias("_ends"), F.count("*").alias("_rows"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]
    joined = rows.join(limits, reduce(and_, same))

    end = [F.col("_ends")[i] for i in range(2 * ends)]
    # A bracket has to reach two ranks to either side, which those of few rows do not: these are inside as a whole.
    inside = reduce(or_, [(F.col("value") >= end[i]) & (F.col("value") <= end[ends + i]) for i in range(ends)])
    inside = inside | (F.col("_rows") < 4 / BRACKET)
    region = sum((F.when(F.col("value") > e, 1).otherwise(0) for e in end), F.lit(0))
    counts = materialize(
        joined.groupBy(*by, region.alias("_region"), F.when(inside, F.col("value")).alias("_exact"))
        .agg(F.min("value").alias("value"), F.count("*").alias("n")).drop("_region", "_exact")
    )
    totals = counts.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(F.sum("n").alias("_total"))
    ranked = with_rows_below(counts, by, **sizes)
    joined = ranked.join(totals, reduce(and_, same))
    below, upto = F.col("below"), F.col("below") + F.col("n")

    def at(rank):
        return F.max(F.when((below <= rank) & (rank < upto), F.col("value")))

    columns = []
    for name, p in probs.items():
        rank = (F.col("_total") - 1) * F.lit(float(p))
        low, high = at(F.floor(rank)), at(F.ceil(rank))
        part = F.max(rank - F.floor(rank))
        columns.append((low + (high - low) * part).alias(name))
    return joined.groupBy(*by).agg(*columns)


def exact_percentiles_of(
    df: DataFrame, names: Sequence[str], probs: dict[str, float], also: dict[str, Callable[[Column], Column]] | None = None,
    written: bool = False, **sizes: int,
) -> DataFrame:
    """(metric, count, what `also` aggregates, a percentile per entry of `probs`), a row per column of `names`.

    The rows stay wide and are written once, as the plan of `df` may hold joins; not if `df` is a table already `written`. One scan takes the count, the sketch and the `also` aggregates of all columns and
    brings one row to the driver. The next counts what lies below each bracket, the last hands on the values
    inside of them, about a five-hundredth of the rows each; equal values are counted together, the result is
    written and ranked by balanced running totals. Null and NaN are left out; a column without values has nulls.
    """
    names, also, spark = list(names), also or {}, df.sparkSession
    clean = [F.col(n).cast("double") for n in names]
    rows = df.select(*[F.when(~F.isnan(x), x).alias(f"_{i}") for i, x in enumerate(clean)])
    rows = rows if written else materialize(rows)
    around = [max(0.0, p - BRACKET) for p in probs.values()] + [min(1.0, p + BRACKET) for p in probs.values()]
    aggregates = []
    for i in range(len(names)):
        x = F.col(f"_{i}")
        aggregates += [F.count(x).alias(f"n{i}"), F.percentile_approx(x, around, SKETCH_ACCURACY).alias(f"ends{i}")]
        aggregates += [make(x).alias(f"{name}{i}") for name, make in also.items()]
    seen = rows.agg(*aggregates).first()

    cells = []  # column, name of the percentile, its bracket, its rank
    for i in range(len(names)):
        n = seen[f"n{i}"]
        for j, (name, p) in enumerate(probs.items() if n else ()):
            # A bracket has to reach two ranks to either side, which those of few rows do not: all values are inside.
            low, high = (-math.inf, math.inf) if n < 4 / BRACKET else (seen[f"ends{i}"][j], seen[f"ends{i}"][len(probs) + j])
            cells.append((len(cells), i, name, low, high, (n - 1) * float(p)))
    found = {}
    if cells:
        x = lambda cell: F.col(f"_{cell[1]}")
        below = rows.agg(*[F.count_if(x(c) < F.lit(c[3])).alias(f"c{c[0]}") for c in cells]).first()
        pairs = [F.when((x(c) >= F.lit(c[3])) & (x(c) <= F.lit(c[4])), F.struct(F.lit(c[0]).alias("cell"), x(c).alias("value"))) for c in cells]
        inside = rows.select(F.explode(F.array_compact(F.array(*pairs))).alias("_p")).groupBy("_p.cell", "_p.value").agg(F.count("*").alias("n"))
        ranked = with_rows_below(materialize(inside), ["cell"], **sizes)
        ranks = spark.createDataFrame([(c[0], int(below[c[0]]), c[5]) for c in cells], "cell int, _before long, _rank double")
        first = F.col("_before") + F.col("below")
        at = lambda rank: F.max(F.when((first <= rank) & (rank < first + F.col("n")), F.col("value")))
        near = ranked.join(F.broadcast(ranks), "cell").groupBy("cell").agg(
            at(F.floor("_rank")).alias("low"), at(F.ceil("_rank")).alias("high"), F.max(F.col("_rank") - F.floor("_rank")).alias("part"))
        found = {cells[r["cell"]][1:3]: r["value"] for r in near.select("cell", (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("value")).collect()}
    out = [(m, seen[f"n{i}"], *[seen[f"{a}{i}"] for a in also], *[found.get((i, p)) for p in probs]) for i, m in enumerate(names)]
    return spark.createDataFrame(out, ", ".join(["metric string", "count long", *[f"`{c}` double" for c in [*also, *probs]]]))


def discrete_percentiles(
    counts: DataFrame, probs: dict[str, float], by: Sequence[str] = (), value: str = "value", n: str = "n", **sizes: int
) -> DataFrame:
    """(by, count, a percentile per entry of `probs`) of values that stand `n` times each: the smallest value whose rank
    reaches the share. Exact, whatever the number of rows.

    Counts of the same value are added up first, so those of any windows, streams or tables can be put together. Null and
    NaN are left out; a group of these alone has the count 0 and nulls.
    """
    by = list(by) or ["_one"]
    rows = counts.withColumn("_one", F.lit(0)).select(*by, F.col(value).alias("value"), F.col(n).alias("n"))
    real = F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))
    known = rows.withColumn("value", F.when(real, F.col("value")))
    merged = materialize(known.groupBy(*by, "value").agg(F.sum("n").alias("n")))
    totals = merged.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("_total"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by])
    joined = with_rows_below(merged, by, **sizes).join(totals, same)

    def at(p):
        # In decimals, as 0.99 * 100 must not pass 99.
        rank = F.greatest(F.ceil(F.col("_total").cast("decimal(19,0)") * F.lit(Decimal(str(p)))).cast("long"), F.lit(1))
        return F.max(F.when((F.col("below") < rank) & (rank <= F.col("below") + F.col("n")), F.col("value").cast("double")))

    found = joined.groupBy(*by).agg(F.max("_total").alias("count"), *[at(p).alias(name) for name, p in probs.items()])
    return found.drop("_one")


def sketched(value: str) -> Column:
    """A mergeable quantile sketch of a column, as an aggregate; null and NaN are left out."""
    x = F.col(value).cast("double")
    return F.kll_sketch_agg_double(F.when(~F.isnan(x), x), F.lit(SKETCH_SIZE))


def sketch_percentiles(sketches: DataFrame, probs: dict[str, float], by: Sequence[str] = (), sketch: str = "sketch") -> DataFrame:
    """Percentiles of merged sketches, per group of `by`: the smallest value whose rank reaches the share.

    Exact up to `SKETCH_SIZE` values a group, beyond that off by about 0.1 % of the ranks. Sketches of
    any windows, streams or tables can be merged.
    """
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double(sketch, F.lit(SKETCH_SIZE)).alias("_merged"))
    return merged.select(*by, *[F.kll_sketch_get_quantile_double("_merged", F.lit(float(p))).alias(n) for n, p in probs.items()])
