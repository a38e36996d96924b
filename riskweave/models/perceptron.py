"""The fit of a perceptron on windows of consecutive rows, for tables that are too large to hold every window.

A window of ten rows would repeat each row ten times. Here rows are written once, in packs of consecutive rows with the
places where windows start; tasks cut the windows out of a pack, a few thousand at a time, and work out the loss and its
gradient in numpy. A task hands on one gradient, whose size depends on the layers alone; the driver holds the weights and
takes the steps (L-BFGS, as MLlib's `MultilayerPerceptronClassifier`). The weights end in that class's own model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskweave.session import materialize

# Rows in a pack, windows that are worked on at once.
PACK_ROWS, CHUNK = 8192, 1024
LEARNED, JUDGED, NEITHER = 0, 1, 2


def packed(
    rows: DataFrame, features: Column, label: Column, part: Column, whole: Column | None = None, length: int = 1, ident: str | None = None
) -> DataFrame:
    """Rows in packs, written as a table.

    Without `whole` a window is the row's own features. With it, it is those of the `length` rows before a `whole` row; they
    must come right before it in its partition. `part` is LEARNED, JUDGED or NEITHER; rows without a label are NEITHER. A
    missing feature counts as 0. `ident` is kept for the scores.
    """
    id_type = "long" if ident is None else rows.schema[ident].dataType.simpleString()
    plain = rows.select(
        (F.lit(None).cast(id_type) if ident is None else F.col(ident)).alias("id"),
        F.transform(features, lambda v: F.coalesce(v.cast("double"), F.lit(0.0))).alias("x"),
        F.coalesce(label.cast("double"), F.lit(0.0)).alias("label"),
        F.when(label.isNull(), NEITHER).otherwise(part).cast("byte").alias("part"),
        (F.lit(True) if whole is None else whole).alias("whole"),
    )
    back = 0 if whole is None else length

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for first in range(0, batch.num_rows, PACK_ROWS):
                some = batch.slice(first, PACK_ROWS)
                x = some.column("x").flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
                lead = 0 if before is None else len(before)
                x = x if not lead else np.concatenate([before, x])
                before = x[max(0, len(x) - back):] if back else None
                mask = some.column("whole")
                ends = np.flatnonzero(mask.to_numpy(zero_copy_only=False))
                ids = some.column("id").filter(mask)
                yield pa.RecordBatch.from_pydict({
                    "x": pa.array([x.tobytes()], pa.binary()),
                    "start": pa.array([(ends + lead - back).astype(np.int32).tobytes()], pa.binary()),
                    "label": pa.array([some.column("label").to_numpy()[ends].tobytes()], pa.binary()),
                    "part": pa.array([some.column("part").to_numpy()[ends].tobytes()], pa.binary()),
                    "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                })

    # Uncompressed, so that the size of a read task bounds the batches that reach Python.
    return materialize(plain.mapInArrow(pack, f"x binary, start binary, label binary, part binary, ids array<{id_type}>"), "uncompressed")


class Windows:
    """The windows of a task's packs, a chunk at a time, in memory that every chunk uses again.

    Features are scaled in double precision before they become single; sums over chunks are double again.
    """

    def __init__(self, layers: Sequence[int], columns: int, centre: np.ndarray, stretch: np.ndarray):
        self.width, self.columns, self.centre, self.stretch = layers[0], columns, centre, stretch
        self.layers = [np.empty((CHUNK, n), np.float32) for n in layers]
        self.deltas = [np.empty((CHUNK, n), np.float32) for n in layers]
        self.spare = [np.empty((CHUNK, n), np.float32) for n in layers]

    def of(self, x, start, chosen: np.ndarray | None = None) -> Iterator[tuple[slice, np.ndarray]]:
        """(which of the chosen windows, their features as rows)."""
        starts = np.frombuffer(start, np.int32)
        starts = starts if chosen is None else starts[chosen]
        if len(starts):
            rows = ((np.frombuffer(x).reshape(-1, self.columns) - self.centre) * self.stretch).astype(np.float32)
            every = np.lib.stride_tricks.sliding_window_view(rows.ravel(), self.width)[::self.columns]
            for first in range(0, len(starts), CHUNK):
                some = starts[first:first + CHUNK]
                yield slice(first, first + CHUNK), np.take(every, some, axis=0, out=self.layers[0][:len(some)], mode="clip")

    def forward(self, x: np.ndarray, net: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """The input and what each layer makes of it: sigmoids, and the class probabilities at last."""
        made = [x]
        for number, (w, b) in enumerate(net, 1):
            z = np.matmul(made[-1], w, out=self.layers[number][:len(x)])
            z += b
            if number < len(net):
                with np.errstate(over="ignore"):
                    np.exp(np.negative(z, out=z), out=z)
                z += 1.0
                np.reciprocal(z, out=z)
            else:
                z -= z.max(axis=1, keepdims=True)
                np.exp(z, out=z)
                z /= z.sum(axis=1, keepdims=True)
            made.append(z)
        return made

    def add_gradient(self, made: list[np.ndarray], y: np.ndarray, net: list, into: list) -> None:
        """Adds the gradient of the log loss, summed over the rows, to the views `into`."""
        delta = self.deltas[-1][:len(y)]
        delta[:] = made[-1]
        delta[np.arange(len(y)), y] -= 1.0
        for number in range(len(net) - 1, -1, -1):
            w, b = into[number]
            w += made[number].T @ delta
            b += delta.sum(axis=0, dtype=float)
            if number:
                delta = np.matmul(delta, net[number][0].T, out=self.deltas[number][:len(y)])
                delta *= made[number]
                delta -= np.multiply(delta, made[number], out=self.spare[number][:len(y)])


def _split(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix, intercepts) of each layer, as views, in the order of MLlib's weights."""
    out, at = [], 0
    for n, m in zip(layers, layers[1:]):
        out.append((weights[at:at + n * m].reshape(n, m), weights[at + n * m:at + n * m + m]))
        at += n * m + m
    return out


def folded(weights: np.ndarray, layers: Sequence[int], mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Weights for features as they are, from those for (features - mean) * scale."""
    out = weights.copy()
    (w, b), (old, _) = _split(out, layers)[0], _split(weights, layers)[0]
    w[:] = scale[:, None] * old
    b -= (mean * scale) @ old
    return out


def _collected(packs: DataFrame, work: Callable, columns: Sequence[str] = ("x", "start", "label", "part")) -> list[np.ndarray]:
    """What `work` makes of the packs of each task, in the order of the tasks: an array whose size does not depend on the rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(v.as_buffer() for v in row) for b in batches for row in zip(*(b.column(c) for c in columns)))
        yield pa.RecordBatch.from_pydict({"made": pa.array([work(rows).tobytes()], pa.binary())})

    return [np.frombuffer(r["made"]) for r in packs.select(*columns).mapInArrow(task, "made binary").collect()]


def moments(packs: DataFrame, width: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, 1 / standard deviation) of each place of the learned windows; 0 for the latter where nothing varies."""

    def merged(parts: Iterator[tuple[float, np.ndarray, np.ndarray]]) -> np.ndarray:
        n, mean, squares = 0.0, np.zeros(width), np.zeros(width)
        for m, other, more in parts:
            if m:
                apart, n = other - mean, n + m
                squares = squares + more + apart**2 * ((n - m) * m / n)
                mean = mean + apart * (m / n)
        return np.concatenate([[n], mean, squares])

    def work(rows: Iterator[tuple]) -> np.ndarray:
        def chunks():
            for x, start, _, part in rows:
                starts = np.frombuffer(start, np.int32)[np.frombuffer(part, np.int8) == LEARNED]
                every = np.lib.stride_tricks.sliding_window_view(np.frombuffer(x), width)[::columns] if len(starts) else None
                for first in range(0, len(starts), CHUNK):
                    some = every[starts[first:first + CHUNK]]
                    mean = some.mean(axis=0)
                    yield len(some), mean, ((some - mean) ** 2).sum(axis=0)

        return merged(chunks())

    n, mean, squares = np.split(merged((p[0], p[1:width + 1], p[width + 1:]) for p in _collected(packs, work)), [1, width + 1])
    spread = np.sqrt(squares / max(n[0] - 1.0, 1.0))
    return mean, np.divide(1.0, spread, out=np.zeros(width), where=spread != 0)


class Scaling:
    """(features - mean) * scale of a window, as a scaling of the rows, which all places share, and one of the weights."""

    def __init__(self, columns: int, mean: np.ndarray, scale: np.ndarray):
        places = len(mean) // columns
        self.centre, most = mean.reshape(places, columns).mean(axis=0), scale.reshape(places, columns).max(axis=0)
        self.stretch = np.where(most > 0, most, 1.0)
        self.scale = scale / np.tile(self.stretch, places)
        self.mean = (mean - np.tile(self.centre, places)) * np.tile(self.stretch, places)

    def net(self, weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        return _split(folded(weights, layers, self.mean, self.scale).astype(np.float32), layers)


def loss_and_gradient(packs: DataFrame, layers: Sequence[int], columns: int, weights: np.ndarray, scaling: Scaling) -> tuple[float, np.ndarray]:
    """The mean log loss of the learned windows and its gradient at weights for scaled features, over all rows."""
    net, size, centre, stretch = scaling.net(weights, layers), len(weights), scaling.centre, scaling.stretch

    def work(rows: Iterator[tuple]) -> np.ndarray:
        total, windows = np.zeros(size + 2), Windows(layers, columns, centre, stretch)
        into = _split(total[2:], layers)
        for x, start, label, part in rows:
            chosen = np.frombuffer(part, np.int8) == LEARNED
            labels = np.frombuffer(label)[chosen].astype(np.intp)
            for which, some in windows.of(x, start, chosen):
                made, y = windows.forward(some, net), labels[which]
                total[:2] += len(y), _log_loss(made[-1], y, 1e-37)
                windows.add_gradient(made, y, net, into)
        return total

    total = np.sum([np.zeros(size + 2), *_collected(packs, work)], axis=0)
    gradient = total[2:] / max(total[0], 1.0)
    w, b = _split(gradient, layers)[0]
    w -= np.outer(scaling.mean, b)
    w *= scaling.scale[:, None]
    return total[1] / max(total[0], 1.0), gradient


def judged_loss(packs: DataFrame, layers: Sequence[int], columns: int, weights: np.ndarray, scaling: Scaling) -> float:
    """The mean log loss of the judged windows; 0 when there are none."""
    net, centre, stretch = scaling.net(weights, layers), scaling.centre, scaling.stretch

    def work(rows: Iterator[tuple]) -> np.ndarray:
        total, windows = np.zeros(2), Windows(layers, columns, centre, stretch)
        for x, start, label, part in rows:
            chosen = np.frombuffer(part, np.int8) == JUDGED
            labels = np.frombuffer(label)[chosen].astype(np.intp)
            for which, some in windows.of(x, start, chosen):
                y = labels[which]
                total += len(y), _log_loss(windows.forward(some, net)[-1], y, 1e-12)
        return total

    n, loss = np.array(_collected(packs, work)).reshape(-1, 2).sum(axis=0)
    return loss / n if n else 0.0


def _log_loss(p: np.ndarray, y: np.ndarray, least: float) -> float:
    return -np.log(np.maximum(p[np.arange(len(y)), y].astype(float), least)).sum()


def _direction(gradient: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Downhill, bent by the last steps and the changes of the gradient on them."""
    d, parts = -gradient, []
    for s, y in reversed(steps):
        a = (s @ d) / (s @ y)
        parts.append(a)
        d = d - a * y
    if steps:
        s, y = steps[-1]
        d = d * ((s @ y) / (y @ y))
    for (s, y), a in zip(steps, reversed(parts)):
        d = d + s * (a - (y @ d) / (s @ y))
    return d


def _step(loss: Callable, x: np.ndarray, f: float, g: np.ndarray, d: np.ndarray, t: float, tries: int = 10):
    """(x, loss, gradient) at a step along `d` that meets the strong Wolfe conditions, else at the lowest one tried that
    goes down enough; None where there is none."""
    slope, low, high, best = g @ d, (0.0, f, g @ d), None, None
    for number in range(2 * tries):
        if number >= tries and best:
            break
        at = x + t * d
        value, gradient = loss(at)
        here = gradient @ d
        enough = np.isfinite(value) and value <= f + 1e-4 * t * slope
        if enough and (best is None or value < best[1]):
            best = at, value, gradient
        if enough and abs(here) <= 0.9 * abs(slope):
            return at, value, gradient
        if not np.isfinite(value):
            t = (low[0] + t) / 2 if high is None else (low[0] + high[0]) / 2
            continue
        if not enough or value >= low[1] and low[0] > 0:
            high = t, value, here
        else:
            if here * ((high[0] - low[0]) if high else 1.0) >= 0:
                high = low
            low = t, value, here
        t = t * 1.5 if high is None else _between(*sorted((low, high)))
    return best


def _between(left: tuple, right: tuple) -> float:
    """The lowest point of the cubic through two points (t, value, slope), away from both ends."""
    (a, fa, da), (b, fb, db) = left, right
    d1 = da + db - 3 * (fa - fb) / (a - b)
    root = d1 * d1 - da * db
    d2 = np.sqrt(root) if root > 0 else 0.0
    span, below = b - a, db - da + 2 * d2
    t = b - span * (db + d2 - d1) / below if below else (a + b) / 2
    return min(max(t, a + 0.1 * span), a + 0.9 * span)


def descend(loss: Callable, start: np.ndarray, rounds: int, memory: int = 10, tolerance: float = 1e-6) -> np.ndarray:
    """The weights after at most `rounds` steps of L-BFGS; fewer once the loss or the gradient says that nothing is left."""
    x, (f, g), steps = start, loss(start), []
    first = highest = f
    for _ in range(rounds):
        if not np.isfinite(f) or np.linalg.norm(g) <= max(tolerance * abs(f), 1e-8):
            break
        d = _direction(g, steps)
        found = _step(loss, x, f, g, d, 1.0 if steps else 1.0 / np.linalg.norm(d)) if g @ d < 0 else None
        if found is None and steps:
            steps = []
            found = _step(loss, x, f, g, -g, 1.0 / np.linalg.norm(g))
        if found is None:
            break
        moved, value, gradient = found
        if (moved - x) @ (gradient - g) > 0:
            steps = [*steps, (moved - x, gradient - g)][-memory:]
        x, f, g = moved, value, gradient
        if abs(highest - f) <= tolerance * abs(first):
            break
    return x


def as_model(spark: SparkSession, layers: Sequence[int], weights: np.ndarray | None = None, seed: int = 42) -> MultilayerPerceptronClassificationModel:
    """MLlib's model with these weights, or with those it starts from: a fit of no rounds keeps them."""
    net = MultilayerPerceptronClassifier(layers=list(layers), featuresCol="features", labelCol="label", maxIter=0, seed=seed)
    if weights is not None:
        net = net.setInitialWeights(Vectors.dense(weights))
    one = Vectors.dense(np.zeros(layers[0]))
    return net.fit(spark.createDataFrame([(one, 0.0), (one, 1.0)], ["features", "label"]))


def fit_packs(
    packs: DataFrame, layers: Sequence[int], columns: int, rounds: int, seed: int, judged: bool, step: int
) -> MultilayerPerceptronClassificationModel:
    """The net for features as they are; learned on scaled ones. `judged`: as `validation` of `learn.fit_sequence`."""
    spark = packs.sparkSession
    mean, scale = moments(packs, layers[0], columns)
    scaling = Scaling(columns, mean, scale)

    def loss(weights: np.ndarray) -> tuple[float, np.ndarray]:
        return loss_and_gradient(packs, layers, columns, weights, scaling)

    best = descend(loss, as_model(spark, layers, seed=seed).weights.toArray(), step if judged else rounds)
    if judged:
        least = judged_loss(packs, layers, columns, best, scaling)
        for _ in range(step, rounds, step):
            later = descend(loss, best, step)
            now = judged_loss(packs, layers, columns, later, scaling)
            if not now < least:
                break
            best, least = later, now
    return as_model(spark, layers, folded(best, layers, mean, scale))


def pack_scores(net: MultilayerPerceptronClassificationModel, packs: DataFrame, columns: int, ident: str, output: str) -> DataFrame:
    """(ident, probability of class 1) of every window, in double precision."""
    layers, weights = net.getLayers(), net.weights.toArray()
    id_type = packs.schema["ids"].dataType.elementType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _split(weights, layers)
        for batch in batches:
            for x, start, ids in zip(batch.column("x"), batch.column("start"), batch.column("ids")):
                starts = np.frombuffer(start.as_buffer(), np.int32)
                if not len(starts):
                    continue
                every = np.lib.stride_tricks.sliding_window_view(np.frombuffer(x.as_buffer()), layers[0])[::columns]
                made = [_probability(every[starts[first:first + CHUNK]], split) for first in range(0, len(starts), CHUNK)]
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(np.concatenate(made))], names=[ident, output])

    return packs.select("x", "start", "ids").mapInArrow(score, f"`{ident}` {id_type}, `{output}` double")


def _probability(x: np.ndarray, net: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    with np.errstate(over="ignore"):
        for w, b in net[:-1]:
            x = 1.0 / (1.0 + np.exp(-(x @ w + b)))
        z = x @ net[-1][0] + net[-1][1]
        return 1.0 / (1.0 + np.exp(z[:, 0] - z[:, 1]))
