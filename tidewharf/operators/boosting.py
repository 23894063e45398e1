"""Second-order gradient boosting with an L2 penalty, grown level by level from distributed histograms.

For a squared error a row's gradient is prediction less label and its second derivative is one. Features are cut into
bins once. For each level of a tree one aggregate sums gradients and rows by (node, feature, bin); the driver gets at most
nodes x features x bins rows, whatever the number of training rows, and picks the splits. A leaf's weight is Newton's step
-G / (H + l2). Gradients are summed as whole millionths, so trees do not depend on the partitioning.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.scratch import materialized
from tidewharf.operators import forecast
from tidewharf.sources.tables import SupplyTables

MODEL = "newton_boosting"
TREES, DEPTH, BINS = 30, 4, 32
STEP, L2, LEAST_ROWS = 0.2, 1.0, 5
FINE = 1_000_000
STORED_EVERY = 10


@dataclass
class Tree:
    """Nodes are numbered from 1; the children of n are 2n and 2n + 1. A row goes left if its bin is at most the cut."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)  # node -> (feature, cut)
    weights: dict[int, float] = field(default_factory=dict)  # leaf -> weight

    def _text(self, node: int, value) -> str:
        if node not in self.splits:
            return value(node)
        feature, cut = self.splits[node]
        return f"CASE WHEN bins[{feature}] <= {cut} THEN {self._text(2 * node, value)} ELSE {self._text(2 * node + 1, value)} END"

    def node(self) -> Column:
        """The number of the node that a row has come to."""
        return F.expr(self._text(1, str))

    def weight(self) -> Column:
        return F.expr(self._text(1, lambda n: f"{self.weights[n]!r}D"))


@dataclass
class Model:
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def bins(self) -> Column:
        """How many edges lie below each feature's value; null counts as the lowest."""
        def below(name: str, edges: list[float]) -> Column:
            value = F.col(name).cast("double")
            listed = F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>")
            return F.size(F.filter(listed, lambda e: e < value)).cast("int")

        return F.array(*[below(name, edges) for name, edges in zip(self.features, self.edges)])


def fit(
    rows: DataFrame, features: Sequence[str], label: str, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
    step: float = STEP, l2: float = L2, least_rows: int = LEAST_ROWS,
) -> Model:
    """A model of the rows that have a label; edges are exact percentiles of the training rows."""
    rows = rows.where(F.col(label).isNotNull())
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    seen = rows.agg(F.avg(F.col(label).cast("double")).alias("base"), *[F.percentile(F.col(c).cast("double"), shares).alias(f"e{i}") for i, c in enumerate(features)]).first()
    edges = [sorted(set(seen[f"e{i}"] or [])) for i in range(len(features))]
    model = Model(list(features), edges, round(seen["base"] or 0.0, 6))
    state = rows.select(model.bins().alias("bins"), F.col(label).cast("double").alias("y"), F.lit(model.base).alias("p"))
    state = materialized(state)
    pending: list[Tree] = []
    for _ in range(trees):
        predicted = F.col("p")
        for tree in pending:
            predicted = predicted + tree.weight()
        errors = state.select("bins", F.round((predicted - F.col("y")) * FINE).cast("long").alias("g"))
        tree = _grown(errors, depth, step, l2, least_rows)
        model.trees.append(tree)
        pending.append(tree)
        if not tree.splits:
            break  # nothing is left to split on
        if len(pending) == STORED_EVERY:
            state = materialized(state.select("bins", "y", (predicted + tree.weight()).alias("p")))
            pending = []
    return model


def _grown(errors: DataFrame, depth: int, step: float, l2: float, least_rows: int) -> Tree:
    tree, open_ = Tree(), [1]
    for level in range(depth):
        each = errors.select(tree.node().alias("node"), "g", F.posexplode("bins").alias("feature", "bin"))
        sums = each.where(F.col("node").isin(open_)).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n"))
        histogram: dict[int, dict[int, list[tuple[int, int, int]]]] = defaultdict(lambda: defaultdict(list))
        for row in sums.collect():  # bounded by nodes x features x bins
            histogram[row["node"]][row["feature"]].append((row["bin"], row["g"], row["n"]))
        below = []
        for node in open_:
            whole_g, whole_n = (sum(b[i] for b in histogram[node].get(0, [])) for i in (1, 2))
            tree.weights[node] = leaf_weight(whole_g, whole_n, step, l2)
            cut = best_split(histogram[node], whole_g, whole_n, l2, least_rows)
            if cut:
                left_g, left_n = cut[2:]
                tree.splits[node] = cut[:2]
                tree.weights[2 * node] = leaf_weight(left_g, left_n, step, l2)
                tree.weights[2 * node + 1] = leaf_weight(whole_g - left_g, whole_n - left_n, step, l2)
                below += [2 * node, 2 * node + 1]
        open_ = below
        if not open_:
            break
    return tree


def leaf_weight(g: int, n: int, step: float, l2: float) -> float:
    return -step * (g / FINE) / (n + l2)


def best_split(histogram: dict[int, list[tuple[int, int, int]]], g: int, n: int, l2: float, least_rows: int) -> tuple[int, int, int, int] | None:
    """``(feature, cut, gradients and rows left of it)`` with the largest gain; the first feature and cut of equal ones."""
    def score(g: int, n: int) -> float:
        return (g / FINE) ** 2 / (n + l2)

    best, found = 1e-9, None
    for feature in sorted(histogram):
        left_g = left_n = 0
        for bin_, own_g, own_n in sorted(histogram[feature])[:-1]:
            left_g, left_n = left_g + own_g, left_n + own_n
            if min(left_n, n - left_n) >= least_rows:
                gain = score(left_g, left_n) + score(g - left_g, n - left_n) - score(g, n)
                if gain > best:
                    best, found = gain, (feature, bin_, left_g, left_n)
    return found


def predict(model: Model, rows: DataFrame, name: str = "predicted") -> DataFrame:
    """``rows`` with the model's value, never negative. The sum is taken in parts, so that no expression grows too long."""
    out = rows.withColumn("bins", model.bins()).withColumn(name, F.lit(model.base))
    for tree in model.trees:
        out = out.withColumn(name, F.col(name) + tree.weight())
    return out.withColumn(name, F.greatest(F.col(name), F.lit(0.0))).drop("bins")


def holdout(t: SupplyTables, size: int = forecast.SAMPLE_SIZE, **settings) -> DataFrame:
    """(model, product_id, demand_date, actual, predicted) of every test row, fitted on at most ``size`` training rows."""
    rows = forecast.split_features(t)
    model = fit(forecast.training_part(rows, size), forecast.FEATURES, "demand", **settings)
    return predict(model, rows.filter("is_test")).select(
        F.lit(MODEL).alias("model"), "product_id", "demand_date", F.col("demand").alias("actual"), "predicted"
    )
