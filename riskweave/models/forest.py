"""Isolation forest: trees are grown in parallel, one group per tree, and scored in Arrow batches.

Each tree sees at most 256 rows, so growing is bounded whatever the size of the data: rows are
drawn by a hash of their id (repeatable, no shuffle of the full table) and only the drawn ones move.
The score is 2^(-mean path length / expected path length), after Liu, Ting and Zhou (2008).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from riskweave.session import materialize

SPARE = 1.5  # rows drawn per needed row, so that every tree fills up
NODE = "tree int, node int, feature int, threshold double, length double"


def expected_length(n: int) -> float:
    """Mean path length of an unsuccessful search among `n` keys."""
    if n <= 1:
        return 0.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n if n > 2 else 1.0


def grow_tree(x: np.ndarray, rng: np.random.Generator, depth: int) -> list[tuple]:
    """(node, feature, threshold, length) with children of node k at 2k+1 and 2k+2."""
    nodes, open_nodes = [], [(0, 0, x)]
    while open_nodes:
        node, level, rows = open_nodes.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if level == depth or len(rows) <= 1 or not len(splittable):
            nodes.append((node, -1, 0.0, level + expected_length(len(rows))))
            continue
        feature = int(rng.choice(splittable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        left = rows[:, feature] <= threshold
        nodes.append((node, feature, threshold, 0.0))
        open_nodes += [(2 * node + 1, level + 1, rows[left]), (2 * node + 2, level + 1, rows[~left])]
    return nodes


def path_lengths(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, length: np.ndarray, depth: int) -> np.ndarray:
    """Mean path length of each row over all trees (arrays are trees × nodes).

    A leaf leads back to itself, so all rows take `depth` steps without branching.
    """
    inner, node = feature >= 0, np.arange(feature.shape[1])
    left = np.where(inner, 2 * node + 1, node)
    limit = np.where(inner, threshold, np.inf)
    column = np.where(inner, feature, 0) * len(x)
    cells, rows, total = np.ascontiguousarray(x.T).ravel(), np.arange(len(x)), np.zeros(len(x))
    for c, t, l, n in zip(column, limit, left, length):
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(depth):
            at = l.take(at) + (cells.take(c.take(at) + rows) > t.take(at))
        total += n.take(at)
    return total / len(feature)


def draw_rows(df: DataFrame, n: int, features: Sequence[str], ident: str, trees: int, sample: int, seed: int) -> DataFrame:
    """`sample` of the `n` rows for each tree, without repeats within a tree.

    A row enters the whole part of need / n trees, and one more with a chance of the fractional part; a
    hash of its id decides, the same way for tables of any size.
    """
    rows = df.select(ident, *[F.col(f).cast("double").alias(f) for f in features])
    share, span = min(trees, SPARE * trees * sample / max(n, 1)), 1 << 32
    whole = int(share)
    chance = F.pmod(F.xxhash64(F.col(ident), F.lit(seed)), F.lit(span)) < int(span * (share - whole))
    copies = F.lit(whole) + chance.cast("int")
    strides = [s for s in range(1, max(trees, 2)) if np.gcd(s, trees) == 1]
    start = F.xxhash64(F.col(ident), F.lit(seed + 1))
    stride = F.element_at(F.array(*[F.lit(s) for s in strides]), (F.pmod(F.xxhash64(F.col(ident), F.lit(seed + 2)), F.lit(len(strides))) + 1).cast("int"))
    placed = rows.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1))).withColumn(
        "tree", F.pmod(F.pmod(start, F.lit(trees)) + F.col("_copy") * stride, F.lit(trees)).cast("int")
    )
    order = Window.partitionBy("tree").orderBy(F.xxhash64(F.col(ident), F.col("tree"), F.lit(seed)), ident)
    return placed.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample)


@dataclass
class IsolationForest:
    features: list[str]
    sample: int
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    length: np.ndarray
    contamination: float
    limit: float = 1.0
    low: float = 0.0
    high: float = 1.0

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str], **settings) -> IsolationForest:
        """Grow the trees (`grown` has the settings), then take the decision limit and the score range from
        the training rows.

        The range is kept with the model: scaling by each scored batch would make a single row
        always look most anomalous.
        """
        model = cls.grown(df, features, **settings)
        return model.calibrated(df.select(model.score_column().alias("anomaly_score")))

    @classmethod
    def fit_transform(cls, df: DataFrame, features: Sequence[str], train: Column, **settings) -> tuple[IsolationForest, DataFrame]:
        """A model fitted on the `train` rows, and all rows as `transform` gives them. Scores are computed once
        and written; limit, range and labels are read off that table."""
        model = cls.grown(df.where(train), features, **settings)
        scored = materialize(df.withColumn("anomaly_score", model.score_column()))
        return model.calibrated(scored.where(train)), model.labelled(scored)

    @classmethod
    def grown(
        cls, df: DataFrame, features: Sequence[str], ident: str = "transaction_id", trees: int = 200,
        sample: int = 256, contamination: float = 0.05, seed: int = 42,
    ) -> IsolationForest:
        """The trees, each from its own draw of `sample` rows, without limit and range."""
        features = list(features)
        depth = int(np.ceil(np.log2(sample)))

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iloc[0])
            x = pdf.sort_values("_rank")[features].to_numpy(dtype=float)
            nodes = grow_tree(x, np.random.default_rng([seed, tree]), depth)
            out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "length"])
            return out.assign(tree=tree)[["tree", "node", "feature", "threshold", "length"]]

        n = df.count()
        drawn = draw_rows(df, n, features, ident, trees, sample, seed)
        # At most trees x 511 nodes come back, independent of the data.
        nodes = drawn.groupBy("tree").applyInPandas(grow, NODE).toPandas()
        return cls._from_nodes(nodes, features, min(sample, n), depth, contamination)

    def calibrated(self, scored: DataFrame) -> IsolationForest:
        """Sets limit and range from the `anomaly_score` of the training rows."""
        spread = scored.agg(
            F.percentile_approx("anomaly_score", 1.0 - self.contamination, 10_000).alias("limit"),
            F.min("anomaly_score").alias("low"), F.max("anomaly_score").alias("high"),
        ).first()
        self.limit, self.low, self.high = spread["limit"], spread["low"], spread["high"]
        return self

    @classmethod
    def _from_nodes(cls, nodes: pd.DataFrame, features, sample, depth, contamination) -> IsolationForest:
        tree = nodes["tree"].rank(method="dense").astype(int).to_numpy() - 1
        shape = (tree.max() + 1, 2 ** (depth + 1) - 1)
        arrays = [np.full(shape, -1), np.zeros(shape), np.zeros(shape)]
        for array, name in zip(arrays, ("feature", "threshold", "length")):
            array[tree, nodes["node"].to_numpy()] = nodes[name].to_numpy()
        return cls(list(features), sample, depth, *arrays, contamination)

    def score_column(self) -> Column:
        """Anomaly score in (0, 1); higher is stranger. Rows are scored in Arrow batches."""
        feature, threshold, length, depth = self.feature, self.threshold, self.length, self.depth
        norm = max(expected_length(self.sample), 1e-9)

        @F.pandas_udf(T.DoubleType())
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                x = batch.to_numpy(dtype=float)
                yield pd.Series(2.0 ** (-path_lengths(x, feature, threshold, length, depth) / norm))

        return score(F.struct(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in self.features]))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds anomaly_score, isolation_forest (probability by the training range) and anomaly (0/1)."""
        return self.labelled(df.withColumn("anomaly_score", self.score_column()))

    def labelled(self, scored: DataFrame) -> DataFrame:
        scaled = (F.col("anomaly_score") - self.low) / (self.high - self.low + 1e-10)
        return scored.withColumns({
            "isolation_forest": F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled)),
            "anomaly": (F.col("anomaly_score") > self.limit).cast("int"),
        })

    def save(self, spark: SparkSession, path: str) -> None:
        tree, node = np.nonzero((self.feature >= 0) | (self.length > 0))
        nodes = pd.DataFrame({
            "tree": tree, "node": node, "feature": self.feature[tree, node].astype(int),
            "threshold": self.threshold[tree, node], "length": self.length[tree, node],
        })
        spark.createDataFrame(nodes, NODE).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = [(self.features, self.sample, self.depth, self.contamination, self.limit, self.low, self.high)]
        spark.createDataFrame(
            about, "features array<string>, sample int, depth int, contamination double, limit double, low double, high double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        about = spark.read.parquet(f"{path}/about").first()
        model = cls._from_nodes(nodes, about["features"], about["sample"], about["depth"], about["contamination"])
        model.limit, model.low, model.high = about["limit"], about["low"], about["high"]
        return model

    def importance(self) -> dict[str, float]:
        """An isolation forest ranks no feature above another."""
        return {f: 1.0 / len(self.features) for f in self.features}
