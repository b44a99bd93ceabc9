"""Exact metrics, curves and comparison tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .scale import WINDOW_ROWS, running_totals
from .split import sample_n

METRICS = ["Accuracy", "Precision", "Recall", "F1 Score", "ROC AUC"]
_CELLS = ["tp", "fp", "fn", "tn"]


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is 0 where the denominator is 0."""
    return F.when(bottom == 0, 0.0).otherwise(top.cast("double") / bottom)


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def score_table(df: DataFrame, label: str, score: str, prediction: str | None = None,
                by: list[str] | None = None) -> DataFrame:
    """One row per distinct score with its positives ``p``, negatives ``n`` and, if given, prediction cells."""
    y = F.col(label)
    cells = []
    if prediction is not None:
        hat = F.col(prediction)
        cells = [F.count_if((y == a) & (hat == b)).alias(c) for c, a, b in
                 (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))]
    return df.groupBy(*(by or []), score).agg(F.count_if(y == 1).alias("p"), F.count_if(y == 0).alias("n"), *cells)


def _auc(p: Column, n: Column, cum_n: Column) -> Column:
    """Rank formula: ties count half; 0 when a class is absent."""
    wins = F.sum(p * (cum_n - n / 2.0))
    return ratio(wins, F.sum(p).cast("double") * F.sum(n))


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] | None = None,
            max_window_rows: int = WINDOW_ROWS) -> DataFrame:
    by = by or []
    ranked = running_totals(score_table(df, label, score, by=by), [score], ["n"], by, max_window_rows)
    return ranked.groupBy(*by).agg(_auc(F.col("p"), F.col("n"), F.col("cum_n")).alias("roc_auc"))


def classification_wide(df: DataFrame, label: str, prediction: str, score: str, by: list[str] | None = None,
                        max_window_rows: int = WINDOW_ROWS) -> DataFrame:
    """All classification metrics per ``by`` group from one grouping of the rows by score."""
    by = by or []
    table = score_table(df, label, score, prediction, by)
    ranked = running_totals(table, [score], ["n"], by, max_window_rows)
    sums = ranked.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _CELLS],
                                   _auc(F.col("p"), F.col("n"), F.col("cum_n")).alias("ROC AUC"))
    tp, fp, fn, tn = (F.col(c) for c in _CELLS)
    return sums.select(
        *by, ratio(tp + tn, tp + fp + fn + tn).alias("Accuracy"), ratio(tp, tp + fp).alias("Precision"),
        ratio(tp, tp + fn).alias("Recall"), _f1(tp, fp, fn).alias("F1 Score"), "ROC AUC")


def classification_metrics(df: DataFrame, label: str, prediction: str, score: str, model: str = "Model",
                           stage: str = "Test", max_window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Long records ``(Model, Stage, Metric, Value)``."""
    wide = classification_wide(df, label, prediction, score, max_window_rows=max_window_rows)
    return wide.unpivot([], METRICS, "Metric", "Value").select(
        F.lit(model).alias("Model"), F.lit(stage).alias("Stage"), "Metric", "Value")


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    cells = df.groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("hat")).agg(
        F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("y") == F.col("hat"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("hat").alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")))
    per_class = cells.select(F.inline(sides)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    scored = per_class.select("class", ratio(tp, predicted).alias("precision"), ratio(tp, support).alias("recall"),
                              ratio(2 * tp, support + predicted).alias("f1"), "support", "tp")
    names = ["precision", "recall", "f1"]
    total = F.sum("support")
    averages = scored.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), *[ratio(F.sum("tp"), total).alias(c) for c in names],
                     total.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in names], total.alias("support")),
            F.struct(F.lit("weighted avg").alias("class"),
                     *[ratio(F.sum(F.col(c) * support), total).alias(c) for c in names], total.alias("support")),
        ).alias("rows")).select(F.inline("rows"))
    return scored.drop("tp").unionByName(averages)


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: list[int] = (0, 1)) -> DataFrame:
    """Every (actual, predicted) cell, empty ones as 0, from one aggregate."""
    cells = [(a, b) for a in classes for b in classes]
    counts = df.agg(*[F.count_if((F.col(label) == a) & (F.col(prediction) == b)).alias(f"c{i}")
                      for i, (a, b) in enumerate(cells)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{i}").alias("n"))
        for i, (a, b) in enumerate(cells)])))


def _cumulative(df: DataFrame, label: str, score: str, max_window_rows: int) -> DataFrame:
    """Per distinct score: positives and negatives at or above it, with the totals."""
    table = score_table(df, label, score).withColumn("down", -F.col(score))
    ranked = running_totals(table, ["down"], ["p", "n"], max_window_rows=max_window_rows)
    whole = df.agg(F.count_if(F.col(label) == 1).alias("P"), F.count_if(F.col(label) == 0).alias("N")).first()
    return ranked.select(F.col(score).cast("double").alias("threshold"), F.col("cum_p").alias("tp"),
                         F.col("cum_n").alias("fp"), F.lit(whole["P"]).alias("P"), F.lit(whole["N"]).alias("N"))


def roc_curve(df: DataFrame, label: str, score: str, max_window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``(threshold, fpr, tpr)`` for every distinct score, and the start point at infinity."""
    points = _cumulative(df, label, score, max_window_rows).select(
        "threshold", ratio(F.col("fp"), F.col("N")).alias("fpr"), ratio(F.col("tp"), F.col("P")).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(start)


def precision_recall_curve(df: DataFrame, label: str, score: str, max_window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``(threshold, precision, recall)`` for every distinct score, and the end point (1, 0) without threshold."""
    tp, fp = F.col("tp"), F.col("fp")
    points = _cumulative(df, label, score, max_window_rows).select(
        "threshold", ratio(tp, tp + fp).alias("precision"), ratio(tp, F.col("P")).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """Metrics of ``score > t`` for several thresholds in one aggregate; AUC is that of the hard predictions."""
    y, s = F.col(label), F.col(score)
    sums = df.agg(*[F.count_if((y == a) & ((s > t) if b else (s <= t))).alias(f"{c}{i}")
                    for i, t in enumerate(thresholds)
                    for c, a, b in (("tp", 1, True), ("fp", 0, True), ("fn", 1, False), ("tn", 0, False))])
    rows = []
    for i, t in enumerate(thresholds):
        tp, fp, fn, tn = (F.col(f"{c}{i}") for c in _CELLS)
        rows.append(F.struct(
            F.lit(float(t)).alias("threshold"), ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
            ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), _f1(tp, fp, fn).alias("f1"),
            ((ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2).alias("roc_auc")))
    return sums.select(F.inline(F.array(*rows)))


def regression_metrics(df: DataFrame, label: str, prediction: str, model: str = "Model", stage: str = "Test") -> DataFrame:
    """``(Model, Stage, MAE, RMSE, R2)`` from one aggregate."""
    y = F.col(label).cast("double")
    e = y - F.col(prediction)
    stats = df.agg(F.avg(F.abs(e)).alias("MAE"), F.avg(e * e).alias("mse"), F.var_pop(y).alias("spread"))
    r2 = F.when(F.col("spread") > 0, 1 - F.col("mse") / F.col("spread")).otherwise(
        F.when(F.col("mse") == 0, 1.0).when(F.col("mse").isNotNull(), 0.0))
    return stats.select(F.lit(model).alias("Model"), F.lit(stage).alias("Stage"), "MAE",
                        F.sqrt("mse").alias("RMSE"), r2.alias("R2"))


def residual_table(df: DataFrame, label: str, prediction: str, key: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """A reproducible sample of actual, predicted and residual, with the diagonal's ends over all rows."""
    a, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    ends = df.agg(F.least(F.min(a), F.min(p)).alias("lo"), F.greatest(F.max(a), F.max(p)).alias("hi"))
    rows = df.select(key, a.alias("actual"), p.alias("predicted"), (a - p).alias("residual"))
    return sample_n(rows, n, key, seed).withColumns(
        {"line_low": ends.select("lo").scalar(), "line_high": ends.select("hi").scalar()})


def compare_models(parts: list[DataFrame]) -> DataFrame:
    """One table from the metric rows of several models."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def cv_summary(folds: DataFrame, group: str = "params", metrics: list[str] = ("auc", "precision", "recall", "f1"),
               best_by: str = "auc") -> DataFrame:
    """Mean and population deviation over folds per parameter set; ``is_best`` marks the highest mean."""
    table = folds.groupBy(group).agg(*[f(m).alias(f"{n}_{m}") for m in metrics
                                       for n, f in (("mean", F.avg), ("std", F.stddev_pop))])
    best = table.agg(F.min(F.struct((-F.col(f"mean_{best_by}")).alias("v"), F.col(group).alias("k")))["k"])
    return table.withColumn("is_best", F.col(group) == best.scalar())
