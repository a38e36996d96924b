"""The fit of boosted trees on packs of rows, with histograms added up in tasks.

A fit by MLlib reads its rows about a dozen times for each tree and sorts them into bins anew. All thresholds lie between values of
one sample of rows; here rows are written once, in packs in which a feature is its place among these values, so that the bins of
a tree are looked up. A tree takes a pass a level. A task hands on sums per node, column and bin, whose size does not depend
on the rows; the driver chooses the splits, by the rules of `DecisionTreeRegressor` (at most 32 bins between weighted quantiles,
variance). The trees end in MLlib's own model.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskweave.session import materialize, shared_dir

# Rows in a pack; bins of a column; rows that thresholds are taken from; values of a feature that places in two bytes tell apart.
PACK_ROWS, BINS, SAMPLE, PLACES = 65_536, 32, 10_000, 65_536
# Trees between two written states; steps of probability that an AUC tells apart.
ROUNDS_PER_CUT, AUC_BINS = 7, 10_000
# Tasks whose sums the driver adds up itself.
PARTS = 32
EPSILON = np.finfo(float).eps
# Columns of a written pack.
KINDS = {"label": np.int8, "held": np.bool_, "key": np.int64}


class Grid(NamedTuple):
    """Sorted distinct sampled values of each feature, and the edges that rows are placed by.

    `exact`: the sample holds all rows; the edges are the values. Else they lie midway between these, and thresholds are among them.
    """

    values: list[np.ndarray]
    edges: list[np.ndarray]
    exact: bool


class Pack(NamedTuple):
    """Rows as columns: for each feature how many edges lie below the row's value, and what a round needs."""

    codes: list[np.ndarray]
    label: np.ndarray
    held: np.ndarray
    key: np.ndarray
    margin: np.ndarray


class Tree(NamedTuple):
    """Nodes in heap order. `feature` is a place in `columns`, -1 in a leaf; rows up to bin `split`, so up to its limit, go left.

    `cuts` are the codes up to which values do not exceed the limits.
    """

    columns: np.ndarray
    limits: list[np.ndarray]
    cuts: list[np.ndarray]
    feature: np.ndarray
    split: np.ndarray
    prediction: np.ndarray
    impurity: np.ndarray
    gain: np.ndarray
    stats: np.ndarray


class Draw(NamedTuple):
    """The rows and columns of a tree, and the weight of its positive rows."""

    number: int
    columns: np.ndarray
    subsample: float
    positive: float


def grid_of(x: np.ndarray, exact: bool) -> Grid:
    values = [np.unique(column[np.isfinite(column)]) for column in x.T]
    return Grid(values, values if exact else [(v[:-1] + v[1:]) / 2.0 for v in values], exact)


def pack_of(x: np.ndarray, label: np.ndarray, held: np.ndarray, key: np.ndarray, grid: Grid) -> Pack:
    """A pack of the rows of `x`, at margin 0. A missing value lies above all edges."""
    codes = [np.searchsorted(edges, column).astype(np.uint8 if len(edges) < 256 else np.uint16) for edges, column in zip(grid.edges, x.T)]
    return Pack(codes, label, held, key, np.zeros(len(x)))


def packed(rows: DataFrame, features: Column, label: Column, held: Column, key: Column, subsample: float, seed: int) -> tuple[DataFrame, Grid, Pack]:
    """Rows in packs, written as a table, the grid of their values and the sampled rows that are learned from.

    Rows have an array of numbers, a label and a key that draws go by; `held` ones are not learned from.
    """
    plain = rows.select(features.alias("x"), label.cast("byte").alias("label"), held.alias("held"), key.alias("key"))
    every, n = plain.agg(F.count("*"), F.count_if(~F.col("held"))).first()
    if not n:
        raise ValueError("there are no rows to learn from")
    exact = subsample * n <= SAMPLE and every < PLACES
    some = plain if exact else plain.where(~F.col("held")).sample(min(1.0, SAMPLE / (subsample * n)), seed)
    x, *others = (np.array(c) for c in zip(*some.collect()))
    grid = grid_of(x.astype(float), exact)
    sample = pack_of(x, *others, grid)
    learned = np.flatnonzero(~sample.held)
    sample = Pack([c[learned] for c in sample.codes], *(c[learned] for c in sample[1:]))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _gathered(batches):
            x = some.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
            label, held, key = (some.column(c).to_numpy() for c in ("label", "held", "key"))
            if not np.isfinite(x[~held.astype(bool)]).all():
                raise ValueError("features of rows to learn from must not be missing or infinite")
            made = pack_of(x, label, held, key, grid)
            yield pa.RecordBatch.from_pydict({
                "codes": pa.array([[c.tobytes() for c in made.codes]], pa.list_(pa.binary())),
                **{n: pa.array([getattr(made, n).astype(kind).tobytes()], pa.binary()) for n, kind in KINDS.items()},
            })

    return materialize(plain.mapInArrow(pack, "codes array<binary>, label binary, held binary, key binary")), grid, sample


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of all batches, `PACK_ROWS` at a time."""
    waiting, n = [], 0
    for batch in batches:
        while batch.num_rows:
            some = batch.slice(0, PACK_ROWS - n)
            batch = batch.slice(some.num_rows)
            waiting, n = [*waiting, some], n + some.num_rows
            if n == PACK_ROWS:
                yield pa.Table.from_batches(waiting)
                waiting, n = [], 0
    if n:
        yield pa.Table.from_batches(waiting)


def _opened(row) -> Pack:
    label, held, key = (np.frombuffer(row[n], kind) for n, kind in KINDS.items())
    return Pack([np.frombuffer(c, f"u{len(c) // len(label)}") for c in row["codes"]], label, held, key, np.zeros(len(label)))


def hashed(key: np.ndarray, number: int) -> np.ndarray:
    """Spark's `xxhash64` of the int `number`, begun with `key`: with the hash of other columns it is that of these and `number`."""
    def rotated(x, by):
        return x << np.uint64(by) | x >> np.uint64(64 - by)

    p1, p2, p3, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    with np.errstate(over="ignore"):
        h = key.view(np.uint64) + (p5 + np.uint64(4)) ^ np.uint64(number) * p1
        h = rotated(h, 23) * p2 + p3
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        return (h ^ h >> np.uint64(32)).view(np.int64)


def binned(pack: Pack, columns: np.ndarray, cuts: Sequence[np.ndarray], some: np.ndarray | None = None) -> np.ndarray:
    """(columns x rows): how many limits lie below the row's value, for all rows or those at the places `some`."""
    out = np.empty((len(columns), len(pack.label) if some is None else len(some)), np.uint8)
    for row, column, ends in zip(out, columns, cuts):
        codes = pack.codes[column]
        bins = np.searchsorted(ends, np.arange(1 << 8 * codes.itemsize)).astype(np.uint8)
        np.take(bins, codes if some is None else codes.take(some), out=row, mode="clip")
    return out


def landed(bins: np.ndarray, feature: np.ndarray, split: np.ndarray, steps: int) -> np.ndarray:
    """The node each row is in after `steps` steps. A leaf leads back to itself."""
    inner, every, n = feature >= 0, np.arange(len(feature)), bins.shape[1]
    left, column, limit = np.where(inner, 2 * every + 1, every), np.where(inner, feature, 0) * n, np.where(inner, split, 255)
    cells, rows, node = bins.ravel(), np.arange(n), np.zeros(n, np.intp)
    for _ in range(steps if len(bins) else 0):
        node = left.take(node) + (cells.take(column.take(node) + rows) > limit.take(node))
    return node


def moved(pack: Pack, tree: Tree, step: float) -> Pack:
    """The pack with `step` of the tree added to its margins."""
    bins = binned(pack, tree.columns, tree.cuts)
    node = landed(bins, tree.feature, tree.split, len(tree.feature).bit_length() - 1)
    return pack._replace(margin=pack.margin + step * tree.prediction.take(node))


def drawn(pack: Pack, draw: Draw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, weight, target) of the rows a tree learns from: Newton steps on the log loss."""
    chosen = np.flatnonzero(~pack.held & (hashed(pack.key, draw.number) & ((1 << 20) - 1) < int(draw.subsample * (1 << 20))))
    y = pack.label[chosen]
    p = _probability(pack.margin[chosen])
    spread = np.maximum(p * (1.0 - p), 1e-6)
    return chosen, np.where(y == 1, draw.positive, 1.0) * spread, (y - p) / spread


def _exp(x: np.ndarray) -> np.ndarray:
    """Spark's `exp` (Java's StrictMath) to the last digit, by which splits of equal gain are told apart."""
    high = x.view(np.int64) >> 32 & 0x7FFFFFFF
    k = np.where(high < 0x3FF0A2B2, np.sign(x), np.trunc(1.44269504088896338700 * x + np.copysign(0.5, x)))
    k = np.where(high > 0x3FD62E42, k, 0.0)
    upper, lower = x - k * 6.93147180369123816490e-01, k * 1.90821492927058770002e-10
    x = upper - lower
    t = x * x
    c = 4.13813679705723846039e-08
    for p in (-1.65339022054652515390e-06, 6.61375632143793436117e-05, -2.77777777770155933842e-03, 1.66666666666666019037e-01):
        c = p + t * c
    c = x - t * c
    return np.ldexp(1.0 - ((lower - x * c / (2.0 - c)) - upper), k.astype(np.int32))


def _probability(margin: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + _exp(-margin))


def limits_of(values: np.ndarray, weights: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """At most `most` thresholds between sorted distinct values with these weights and numbers of rows, as MLlib sets them."""
    there, filled = counts > 0, (counts > 0) & (values != 0)
    if not filled.any():
        return np.empty(0)
    whole = weights[there].sum()
    empty = whole - weights[filled].sum()
    kept = there if empty > EPSILON * counts[filled].sum() * 100 else filled
    weights = np.where(values == 0, empty, weights)[kept]
    between = (values[kept][:-1] + values[kept][1:]) / 2.0
    if len(between) > most:
        upto, target, at, found = np.cumsum(weights), whole / (most + 1), 1, []
        halves = (upto[:-1] + upto[1:]) / 2
        while at < len(upto):
            # No earlier value is nearer to the target than the one after it; sums this close are compared exactly.
            at = max(at, int(np.searchsorted(halves, target * (1 - 1e-9))) + 1)
            while at < len(upto) and not abs(upto[at - 1] - target) < abs(upto[at] - target):
                at += 1
            if at < len(upto):
                found.append(at - 1)
                target += whole / (most + 1)
                at += 1
        between = between[found]
    return between


def thresholds(sample: Pack, grid: Grid, draw: Draw) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(columns that can be split, limits of each, their cuts) by the sampled rows that the tree learns from."""
    chosen, weight, _ = drawn(sample, draw)
    most, columns, limits, cuts = min(BINS, max(len(weight), 1)) - 1, [], [], []
    for column in np.sort(draw.columns):
        values, codes = grid.values[column], sample.codes[column][chosen]
        found = limits_of(values, np.bincount(codes, weight, len(values)), np.bincount(codes, minlength=len(values)), most)
        if len(found):
            at = np.searchsorted(values, found, side="right") - 1
            columns.append(column)
            limits.append(found if grid.exact else grid.edges[column][at])
            cuts.append(at)
    return np.array(columns, dtype=np.intp), limits, cuts


def _impurity(stats: np.ndarray) -> np.ndarray:
    """Variance by (weight, sum, sum of squares, rows) on the first axis."""
    weight = np.where(stats[0] == 0, 1.0, stats[0])
    return np.where(stats[0] == 0, 0.0, (stats[2] - stats[1] * stats[1] / weight) / weight)


def best_splits(cells: np.ndarray, parents: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """For each node: gain, column and bin of its best split (gain -inf without one), sums of its rows and of both sides.

    `cells` is (columns, 4 sums, nodes, bins), `parents` (4 sums, nodes) as the splits above left them.
    """
    left = np.cumsum(cells, axis=3)
    right = left[..., -1:] - left
    if parents is None:
        parents = left[0, :, :, 0] + right[0, :, :, 0]
    sides, whole = [np.moveaxis(s, 1, 0) for s in (left, right)], _impurity(parents)
    (lw, rw), (low, high) = [s[0] for s in sides], [_impurity(s) for s in sides]
    with np.errstate(invalid="ignore"):
        gain = whole[None, :, None] - lw / (lw + rw) * low - rw / (lw + rw) * high
    gain = np.where((left[:, 3] >= 1) & (right[:, 3] >= 1) & (gain >= 0), gain, -np.inf)
    flat = np.moveaxis(gain, 1, 0).reshape(len(whole), -1)
    at, nodes = flat.argmax(axis=1), np.arange(len(whole))
    column, split = np.divmod(at, cells.shape[3])
    return flat[nodes, at], column, split, parents, left[column, :, nodes, split].T, right[column, :, nodes, split].T


def _summed(rdd: RDD, work: Callable) -> list[np.ndarray]:
    """The sums over all tasks of the arrays that `work` makes of each one's elements, in the order of the tasks; those of more
    than `PARTS` tasks are added up in other tasks first, so that the driver never holds many."""
    def task(part: Iterator) -> list:
        first = next(part, None)
        return [] if first is None else [work(chain([first], part))]

    made = rdd.mapPartitions(lambda part: task(iter(part)))
    return made.treeReduce(_added) if rdd.getNumPartitions() > PARTS else reduce(_added, made.collect())


def _added(some: list[np.ndarray], others: list[np.ndarray]) -> list[np.ndarray]:
    return [a + b for a, b in zip(some, others)]


def _rows_of(pack: Pack, draw: Draw, columns: np.ndarray, cuts: Sequence[np.ndarray]) -> tuple:
    chosen, weight, target = drawn(pack, draw)
    return binned(pack, columns, cuts, chosen), weight, target, pack.margin[pack.held], pack.label[pack.held]


def _auc_cells(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Negative and positive rows per step of probability."""
    with np.errstate(over="ignore"):
        bins = np.floor(AUC_BINS / (1.0 + _exp(-margin))).astype(np.intp)
    return np.array([np.bincount(bins[label == y], minlength=AUC_BINS + 1) for y in (0, 1)], dtype=float)


def auc_of(cells: np.ndarray) -> float:
    """The AUC by negative and positive rows per step; 0 when one class is missing."""
    neg, pos = cells
    pairs = pos.sum() * neg.sum()
    return (pos * (np.cumsum(neg) - neg / 2)).sum() / pairs if pairs else 0.0


def stop_round(aucs: Sequence[float], patience: int) -> tuple[int, bool]:
    """(the best round, whether `patience` rounds after it were no better); later rounds do not count."""
    best = 0
    for number, auc in enumerate(aucs):
        if auc > aucs[best]:
            best = number
        elif number - best >= patience:
            return best, True
    return best, False


def _histograms(tree: Tree, level: int, nodes: np.ndarray) -> Callable:
    """Work of a task: sums per column, node of `nodes` and bin; on the first level the AUC cells of the held rows as well."""
    feature, split, columns, n = tree.feature, tree.split, max(len(tree.columns), 1), len(nodes)
    slots = np.full(len(feature), n)
    slots[nodes] = np.arange(n)

    def work(part: Iterator[tuple]) -> list[np.ndarray]:
        cells, judged = np.zeros((columns, 4, (n + 1) * BINS)), np.zeros((2, AUC_BINS + 1))
        for bins, weight, target, margin, label in part:
            slot = slots.take(landed(bins, feature, split, level)) * BINS
            sums = weight, weight * target, weight * target * target, None
            # A tree without a column to split still has the sums of its root.
            for row, into in zip(bins if len(bins) else [np.uint8(0)], cells):
                cell = slot + row
                for one, values in zip(into, sums):
                    one += np.bincount(cell, values, len(one))
            if not level:
                judged += _auc_cells(margin, label)
        return [cells.reshape(columns, 4, n + 1, BINS)[:, :, :n], *([] if level else [judged])]

    return work


def grown(rows: RDD, columns: np.ndarray, limits: list[np.ndarray], cuts: list[np.ndarray], depth: int) -> tuple[Tree, np.ndarray]:
    """A tree on the drawn rows, and the AUC cells of the margins it starts from."""
    size = (2 << depth) - 1
    tree = Tree(columns, limits, cuts, np.full(size, -1), np.zeros(size, np.uint8), np.zeros(size), np.zeros(size), np.full(size, -1.0), np.zeros((4, size)))

    def put(nodes: np.ndarray, stats: np.ndarray) -> None:
        weight = np.where(stats[0] == 0, 1.0, stats[0])
        tree.stats[:, nodes], tree.impurity[nodes], tree.prediction[nodes] = stats, _impurity(stats), np.where(stats[0] == 0, 0.0, stats[1] / weight)

    nodes, judged = np.zeros(1, np.intp), None
    for level in range(depth):
        cells, *first = _summed(rows, _histograms(tree, level, nodes))
        gain, column, split, whole, left, right = best_splits(cells, tree.stats[:, nodes] if level else None)
        if not level:
            judged = first[0]
            put(nodes, whole)
        tree.impurity[nodes] = np.where(gain >= 0, tree.impurity[nodes], -1.0)
        good = gain > 0
        nodes = nodes[good]
        tree.feature[nodes], tree.split[nodes], tree.gain[nodes] = column[good], split[good], gain[good]
        nodes = np.stack([2 * nodes + 1, 2 * nodes + 2], axis=1).ravel()
        put(nodes, np.stack([left[:, good], right[:, good]], axis=2).reshape(4, -1))
        nodes = nodes[np.abs(tree.impurity[nodes]) >= EPSILON]
        if not len(nodes):
            break
    return tree, judged


def _dealt(packs: RDD, tasks: int) -> RDD:
    """The packs dealt out to tasks of near-equal rows: every pass waits for its longest task."""
    numbered = packs.mapPartitionsWithIndex(lambda task, part: (((task, i), pack) for i, pack in enumerate(part)))
    rows, to = [0] * tasks, {}
    for place, n in sorted(numbered.mapValues(lambda pack: len(pack.label)).collect(), key=lambda x: -x[1]):
        to[place] = rows.index(min(rows))
        rows[to[place]] += n
    # Never more tasks than that, however wide an exchange is set to be.
    return numbered.map(lambda x: (to[x[0]], x[1])).partitionBy(tasks, int).values().coalesce(tasks)


def fit_packs(
    packs: DataFrame, grid: Grid, sample: Pack, rounds: int, depth: int, step: float, subsample: float, colsample: float,
    positive: float, judged: bool, patience: int, seed: int,
) -> list[Tree]:
    """The trees of `learn.fit_boosted`. A round keeps its rows in bins while its tree is grown and adds the tree to the margins,
    which are written every few rounds, so that a lost executor repeats these only."""
    spark = packs.sparkSession
    shared_dir(spark)
    # Pickled packs are bytes already: no second form of them, compressed at that.
    level = StorageLevel.MEMORY_AND_DISK_DESER
    # A task a core: a pass is short, and a task streams its packs.
    state = _dealt(packs.rdd.map(_opened), spark.sparkContext.defaultParallelism).persist(level)
    width = len(grid.values)
    rng, trees, aucs, stale, rows = np.random.default_rng(seed), [], [], None, None
    try:
        for number in range(rounds):
            draw = Draw(number, rng.permutation(width)[: max(1, round(colsample * width))], subsample, positive)
            columns, limits, cuts = thresholds(sample, grid, draw)
            rows = state.map(lambda pack, of=(draw, columns, cuts): _rows_of(pack, *of)).persist(level)
            tree, cells = grown(rows, columns, limits, cuts, depth)
            rows.unpersist()
            if stale is not None:
                stale.unpersist()
            if judged and trees:
                aucs.append(auc_of(cells))
                if stop_round(aucs, patience)[1]:
                    break
            trees.append(tree)
            sample, stale = moved(sample, tree, step), state
            state = state.map(lambda pack, of=(tree, step): moved(pack, *of)).persist(level)
            if len(trees) % ROUNDS_PER_CUT == 0:
                state.checkpoint()
        else:
            if judged:
                aucs.append(auc_of(_summed(state, _judged)[0]))
    finally:
        for kept in (state, stale, rows):
            if kept is not None:
                kept.unpersist()
    return trees[: stop_round(aucs, patience)[0] + 1] if judged else trees


def _judged(part: Iterator[Pack]) -> list[np.ndarray]:
    return [np.sum([np.zeros((2, AUC_BINS + 1)), *(_auc_cells(pack.margin[pack.held], pack.label[pack.held]) for pack in part)], axis=0)]


def _node_rows(tree: Tree) -> list[tuple]:
    """The nodes in the order and form in which MLlib stores them. Leaves side by side that predict the same become one."""
    rows: list[tuple] = []

    def add(at: int) -> float | None:
        number, prediction = len(rows), float(tree.prediction[at])
        rows.append(())
        found, after = (-1.0, -1, -1, (-1, [], -1)), prediction
        if tree.feature[at] >= 0:
            left = add(2 * at + 1)
            beside = len(rows)
            right = add(2 * at + 2)
            if left is None or left != right:
                column = tree.feature[at]
                limit = float(tree.limits[column][tree.split[at]])
                found, after = (float(tree.gain[at]), number + 1, beside, (int(tree.columns[column]), [limit], -1)), None
            else:
                del rows[number + 1:]
                prediction = after = left
        stats = tree.stats[:, at].tolist()
        rows[number] = (number, prediction, float(tree.impurity[at]), stats[:3], int(stats[3]), *found)
        return after

    add(0)
    return rows


def as_model(spark: SparkSession, trees: Sequence[Tree], step: float, width: int, depth: int, seed: int) -> GBTClassificationModel:
    """The trees as one MLlib model, read from files in its own form, for which a model of one leaf is the pattern.

    It doubles a margin on the way to a probability, so trees weigh half a step.
    """
    sc, path = spark.sparkContext, f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    none = spark.createDataFrame([(Vectors.dense(np.zeros(width)), 0.0)], ["features", "label"])
    leaf = DecisionTreeRegressor(featuresCol="features", labelCol="label", maxDepth=depth, seed=seed).fit(none)
    members = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, 1)
    weights = sc._gateway.new_array(sc._jvm.double, 1)
    members[0], weights[0] = leaf._java_obj, step / 2
    made = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"boosted_{uuid.uuid4().hex[:12]}", members, weights)
    GBTClassificationModel(made).setFeaturesCol("features").write().save(f"{path}-leaf")

    about = json.loads(spark.read.text(f"{path}-leaf/metadata").first()[0]) | {"numFeatures": width, "numTrees": len(trees)}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each, nodes = (spark.read.parquet(f"{path}-leaf/{part}") for part in ("treesMetadata", "data"))
    _, text, weight = each.first()
    spark.createDataFrame([(i, text, weight) for i in range(len(trees))], each.schema).coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(i, node) for i, tree in enumerate(trees) for node in _node_rows(tree)], nodes.schema).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
