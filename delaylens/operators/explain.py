"""Importance tables and per-row attributions."""

from __future__ import annotations

from dataclasses import dataclass
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .report import top_by_absolute
from .scale import complete_rows, hash_uniform
from .split import sample_n


def feature_importance(spark: SparkSession, model, names: list[str], n: int = 20) -> DataFrame:
    values = model.featureImportances.toArray()
    table = spark.createDataFrame([(c, float(v)) for c, v in zip(names, values)], "feature string, importance double")
    return table.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


def coefficient_importance(spark: SparkSession, model, names: list[str], n: int = 20) -> DataFrame:
    values = model.coefficients.toArray()
    table = spark.createDataFrame([(c, float(v)) for c, v in zip(names, values)], "feature string, coefficient double")
    return top_by_absolute(table, "coefficient", "feature", n)


def pca_back_projection(components: DataFrame, weights: DataFrame) -> DataFrame:
    """Component weights carried back to the original columns: ``sum(weight * loading)``."""
    joined = components.join(weights, "component")
    table = joined.groupBy("column").agg(F.sum(F.col("weight") * F.col("loading")).alias("importance"))
    return top_by_absolute(table, "importance", "column")


# --- additive attributions -------------------------------------------------------------------------
# Long form shared by all explainers: (key, feature, value, phi), base value in column "base".

def linear_shap(df: DataFrame, key: str, weights: dict[str, float], intercept: float,
                means: dict[str, float] | None = None) -> DataFrame:
    """Attribution ``w * (x - mean)`` of a linear score (the log-odds of a logistic model)."""
    names = list(weights)
    if means is None:
        means = df.agg(*[F.avg(c).alias(c) for c in names]).first().asDict()
    base = intercept + sum(w * means[c] for c, w in weights.items())
    parts = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                      (F.lit(float(w)) * (F.col(c) - F.lit(means[c]))).alias("phi")) for c, w in weights.items()]
    return df.select(key, F.lit(float(base)).alias("base"), F.inline(F.array(*parts)))


def linear_shap_of_model(df: DataFrame, key: str, model, names: list[str]) -> DataFrame:
    return linear_shap(df, key, dict(zip(names, model.coefficients.toArray().tolist())), float(model.intercept))


@dataclass(frozen=True)
class Leaf:
    """One leaf: its value and, per feature on the path, the interval and the share of rows that pass."""

    value: float
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def tree_leaves(tree, weight: float, positive_class: bool) -> list[Leaf]:
    """Leaves of a fitted Spark tree. A model is as large as its parameters allow, never as the data."""
    leaves: list[Leaf] = []

    def walk(node, path: dict[int, tuple[float, float, float]]):
        stats = node.impurityStats()
        if node.getClass().getSimpleName() == "LeafNode":
            value = node.prediction()
            if positive_class:
                counts = list(stats.stats())
                value = counts[1] / sum(counts)
            items = sorted(path.items())
            leaves.append(Leaf(weight * value, np.array([f for f, _ in items], dtype=int),
                               *(np.array([p[i] for _, p in items], dtype=float) for i in range(3))))
            return
        split, rows = node.split(), node.impurityStats().count()
        feature, cut = split.featureIndex(), split.threshold()
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, interval in ((node.leftChild(), (low, min(high, cut))), (node.rightChild(), (max(low, cut), high))):
            passed = child.impurityStats().count() / rows
            walk(child, {**path, feature: (*interval, share * passed)})

    walk(tree._call_java("rootNode"), {})
    return leaves


def ensemble_leaves(model) -> list[Leaf]:
    """Leaves of a forest or of boosted trees, weighted so that the leaf sums add up to the model's raw output."""
    name = type(model).__name__
    trees = model.trees if hasattr(model, "trees") else [model]
    if name.startswith("GBT"):
        weights = model.treeWeights
    else:
        weights = [1.0 / len(trees)] * len(trees)
    positive = name in ("RandomForestClassificationModel", "DecisionTreeClassificationModel")
    return [leaf for tree, w in zip(trees, weights) for leaf in tree_leaves(tree, w, positive)]


@dataclass(frozen=True)
class Split:
    """An inner node; a child is a node or a leaf's value. ``left_share`` of the node's rows went left."""

    feature: int
    cut: float
    left: "Split | float"
    right: "Split | float"
    left_share: float


def ensemble_trees(model) -> list["Split | float"]:
    """The trees of ``ensemble_leaves``, node by node."""
    name = type(model).__name__
    trees = model.trees if hasattr(model, "trees") else [model]
    weights = model.treeWeights if name.startswith("GBT") else [1.0 / len(trees)] * len(trees)
    positive = name in ("RandomForestClassificationModel", "DecisionTreeClassificationModel")

    def read(node, weight: float):
        if node.getClass().getSimpleName() == "LeafNode":
            counts = list(node.impurityStats().stats())
            return weight * (counts[1] / sum(counts) if positive else node.prediction())
        split = node.split()
        share = node.leftChild().impurityStats().count() / node.impurityStats().count()
        return Split(split.featureIndex(), split.threshold(), read(node.leftChild(), weight), read(node.rightChild(), weight), share)

    return [read(tree._call_java("rootNode"), w) for tree, w in zip(trees, weights)]


def extended(weights: np.ndarray, share: float, inside: np.ndarray) -> np.ndarray:
    """Coalition weights by size, after one more feature joined the path."""
    n = len(weights)
    size = np.arange(n)[:, None]
    out = np.zeros((n + 1, weights.shape[1]))
    out[:n] = share * weights * (n - size) / (n + 1)
    out[1:] += inside * weights * (size + 1) / (n + 1)
    return out


def unwound(weights: np.ndarray, share: float, inside: np.ndarray) -> np.ndarray:
    """The sum of the coalition weights without one feature of the path, taken back step by step."""
    last = len(weights) - 1
    carried, total = weights[last], np.zeros(weights.shape[1])
    for j in range(last - 1, -1, -1):
        one = carried * (last + 1) / (j + 1)
        total += np.where(inside, one, weights[j] * (last + 1) / (share * (last - j)))
        carried = weights[j] - one * share * (last - j) / (last + 1)
    return total


def path_shares(shares: list[float], inside: np.ndarray) -> np.ndarray:
    """Per (feature of the path, column of ``inside``): what the feature gets of the leaf's value."""
    weights = np.ones((1, inside.shape[1]))
    for share, own in zip(shares, inside):
        weights = extended(weights, share, own)
    return np.stack([(own - share) * unwound(weights, share, own) for share, own in zip(shares, inside)])


def attribute_tree(node: "Split | float", x: np.ndarray, phi: np.ndarray, path: dict[int, tuple[float, np.ndarray]]) -> None:
    """Add the exact attributions of all leaves below ``node`` for a block of rows.

    At a leaf, rows differ only in which of the path's conditions they meet, so the shares are worked out once for
    each of these patterns where there are fewer of them than rows. A feature that comes again is one condition.
    """
    if not isinstance(node, Split):
        if path:
            shares, inside = zip(*path.values())
            m = len(shares)
            if 2 << m <= len(x):
                pattern = np.zeros(len(x), np.int64)
                for i, own in enumerate(inside):
                    pattern += own.astype(np.int64) << i
                got = path_shares(shares, (np.arange(1 << m) >> np.arange(m)[:, None] & 1).astype(bool))[:, pattern]
            else:
                got = path_shares(shares, np.stack(inside))
            phi[:, list(path)] += node * got.T
        return
    left = x[:, node.feature] <= node.cut
    before = path.get(node.feature)
    for child, goes, part in ((node.left, left, node.left_share), (node.right, ~left, 1 - node.left_share)):
        own = (part, goes) if before is None else (before[0] * part, before[1] & goes)
        attribute_tree(child, x, phi, {**path, node.feature: own})


def tree_shap(df: DataFrame, key: str, model, names: list[str]) -> DataFrame:
    """Path-dependent attributions of a tree ensemble; phi and base add up to its raw output per row."""
    base = float(sum(leaf.value * leaf.share.prod() for leaf in ensemble_leaves(model)))
    trees = ensemble_trees(model)
    out = T.StructType([df.schema[key], T.StructField("value", T.ArrayType(T.DoubleType())),
                        T.StructField("phi", T.ArrayType(T.DoubleType()))])

    def explain(batches):
        for pdf in batches:
            x = pdf[names].to_numpy(dtype=float)
            phi = np.zeros_like(x)
            for tree in trees:
                attribute_tree(tree, x, phi, {})
            yield pd.DataFrame({key: pdf[key], "value": list(x), "phi": list(phi)})

    rows = complete_rows(df.select(key, *[F.col(c).cast("double").alias(c) for c in names]), names)
    found = rows.mapInPandas(explain, out)
    zipped = F.arrays_zip(F.array(*[F.lit(c) for c in names]).alias("feature"), "value", "phi")
    return found.select(key, F.lit(base).alias("base"), F.inline(zipped))


def sampled_shap(rows: DataFrame, key: str, names: list[str], predict, background: DataFrame,
                 background_key: str, permutations: int = 100, seed: int = 42) -> DataFrame:
    """Permutation-sampled attributions of any model.

    Each permutation starts from one of at most ``permutations`` background rows and switches the
    features to the row's own values one by one; a feature's marginal differences are averaged. ``predict``
    maps a DataFrame with the feature columns to the same rows plus ``score``. phi and base add up to the
    score exactly when the permutations use every background row.
    """
    drawn = sample_n(complete_rows(background, names), permutations, background_key, seed)
    points = [[float(r[c]) for c in names] for r in drawn.select(*names).collect()]
    if not points:
        raise ValueError("the background has no complete row")
    d, p = len(names), len(points)
    starts = F.broadcast(rows.sparkSession.createDataFrame(list(enumerate(points)), "__p int, __from array<double>"))
    own = F.array(*[F.col(c).cast("double") for c in names])
    base_rows = complete_rows(rows, names).select(
        key, own.alias("__own"), F.explode(F.sequence(F.lit(0), F.lit(p - 1))).alias("__p"))
    order = F.array_sort(F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)),
        lambda j: F.struct(F.xxhash64(F.col(key), F.col("__p"), j, F.lit(seed)).alias("h"), j.alias("j"))))
    shuffled = base_rows.withColumn("__order", F.transform(order, lambda s: s["j"])).join(starts, "__p")
    steps = shuffled.select(key, "__own", "__from", "__order",
                            F.explode(F.sequence(F.lit(0), F.lit(d))).alias("__step"))
    switched = {c: F.when(F.array_position("__order", F.lit(j)) <= F.col("__step"), F.col("__own")[j])
                .otherwise(F.col("__from")[j]) for j, c in enumerate(names)}
    scored = predict(steps.select(key, "__own", "__order", "__step", *[v.alias(c) for c, v in switched.items()]))
    # The score after step s counts for the feature switched at s and against the one switched at s + 1.
    ends = F.array(
        F.when(F.col("__step") > 0, F.struct(F.get("__order", F.col("__step") - 1).alias("j"), F.col("score").alias("v"))),
        F.when(F.col("__step") < d, F.struct(F.get("__order", F.col("__step")).alias("j"), (-F.col("score")).alias("v"))))
    parts = scored.select(
        key, "__own", F.when(F.col("__step") == 0, F.col("score")).alias("__start"),
        F.inline(F.array_compact(ends)))
    phi = parts.groupBy(key, "__own", "j").agg((F.sum("v") / p).alias("phi"), F.sum("__start").alias("__start"))
    labels = F.array(*[F.lit(c) for c in names])
    packed = phi.groupBy(key, "__own").agg(
        (F.sum("__start") / p).alias("base"), F.collect_list(F.struct("j", "phi")).alias("parts"))
    return packed.select(key, "__own", "base", F.inline("parts")).select(
        key, "base", labels[F.col("j")].alias("feature"), F.col("__own")[F.col("j")].alias("value"), "phi")


def backward_multipliers(net, weights: np.ndarray, x: np.ndarray, reference: np.ndarray, probability: bool):
    """Per (row, reference): the output's change per change of each input, carried back layer by layer; and both outputs.

    A unit passes on the slope between its two inputs; where they are equal, its derivative there.
    """
    layers = list(net.layers(weights))

    def slopes(after, before, a, b, derivative):
        gap = a[:, None] - b[None]
        close = np.abs(gap) < 1e-9
        return np.where(close, np.broadcast_to(derivative[None], gap.shape), (after[:, None] - before[None]) / np.where(close, 1.0, gap))

    own, other, passed = x, reference, []
    for w, b in layers[:-1]:
        za, zb = own @ w + b, other @ w + b
        own, other = np.maximum(za, 0.0), np.maximum(zb, 0.0)
        passed.append(slopes(own, other, za, zb, (zb > 0).astype(float)))
    w, b = layers[-1]
    out, base = (own @ w + b)[:, 0], (other @ w + b)[:, 0]
    back = np.broadcast_to(w[:, 0], (len(x), len(reference), len(w)))
    if probability:
        a, c = (1 / (1 + np.exp(-np.clip(v, -500, 500))) for v in (out, base))
        back = back * slopes(a, c, out, base, c * (1 - c))[..., None]
        out, base = a, c
    for (w, _), slope in zip(layers[-2::-1], passed[::-1]):
        back = (back * slope) @ w.T
    return back, out, base


def network_shap(df: DataFrame, key: str, fitted, background: DataFrame, background_key: str, size: int = 100,
                 seed: int = 42, probability: bool = True) -> DataFrame:
    """Attributions of a fitted network by multipliers propagated backwards against a background set.

    For each of at most ``size`` background rows the change of the output is shared among the inputs' changes; the
    shares are averaged. phi and base, the background's mean output, add up to the score of every row: the
    probability of a classifier, or with ``probability=False`` its log-odds, or a regressor's output. They are the
    Shapley values where no unit joins features through a bend, and near them elsewhere. Incomplete rows have none.
    """
    names, net, weights = fitted.features, fitted.net, fitted.weights
    drawn = sample_n(complete_rows(background, names), size, background_key, seed)
    reference = drawn.select(*[F.col(c).cast("double") for c in names]).toPandas().to_numpy(dtype=float)
    if not len(reference):
        raise ValueError("the background has no complete row")
    squash = probability and net.task == "classification"
    out = T.StructType([df.schema[key], T.StructField("base", T.DoubleType()), T.StructField("value", T.ArrayType(T.DoubleType())),
                        T.StructField("phi", T.ArrayType(T.DoubleType()))])
    # rows at once, so that rows x background x widest layer stays near 4 million numbers
    block = max(1, (1 << 22) // (len(reference) * max(len(names), *net.hidden)))

    def explain(batches):
        for pdf in batches:
            for first in range(0, len(pdf), block):
                part = pdf.iloc[first:first + block]
                x = part[names].to_numpy(dtype=float)
                back, _, base = backward_multipliers(net, weights, x, reference, squash)
                phi = (back * (x[:, None] - reference[None])).mean(1)
                yield pd.DataFrame({key: part[key], "base": base.mean(), "value": list(x), "phi": list(phi)})

    rows = complete_rows(df.select(key, *[F.col(c).cast("double").alias(c) for c in names]), names)
    zipped = F.arrays_zip(F.array(*[F.lit(c) for c in names]).alias("feature"), "value", "phi")
    return rows.mapInPandas(explain, out).select(key, "base", F.inline(zipped))


def shap_summary(attributions: DataFrame, n: int = 20) -> DataFrame:
    table = attributions.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    return table.orderBy(F.desc("mean_abs_phi"), F.asc("feature")).limit(n)


def shap_dependence(attributions: DataFrame, key: str, feature: str, interaction: str | None = None) -> DataFrame:
    """``(key, value, phi)`` of a feature, with the other feature's value beside it when asked for.

    ``key`` names one row; both features of a row meet in one aggregate over the key.
    """
    if interaction is None:
        return attributions.where(F.col("feature") == feature).select(key, "value", "phi")
    of = lambda name, value: F.max(F.when(F.col("feature") == name, F.col(value)))
    both = attributions.where(F.col("feature").isin(feature, interaction)).groupBy(key).agg(
        of(feature, "value").alias("value"), of(feature, "phi").alias("phi"), of(interaction, "value").alias("interaction"),
        F.max(F.col("feature") == feature).alias("__own"))
    return both.where("__own").drop("__own")


def force_table(attributions: DataFrame, key: str, n: int = 3) -> DataFrame:
    """Base value and contributions of the first ``n`` keys."""
    keys = attributions.select(key).distinct().orderBy(key).limit(n)
    mine = attributions.join(F.broadcast(keys), key, "left_semi")
    base = mine.select(key, F.lit("base").alias("feature"), F.col("base").alias("contribution")).distinct()
    return mine.select(key, "feature", F.col("phi").alias("contribution")).unionByName(base)
