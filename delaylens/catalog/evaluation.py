"""Baselines, metrics, curves and attributions with literal weights."""

from pyspark.sql import functions as F

from ..operators import curves, evaluate, explain, models, split
from ..sources import stores
from .base import HASH, LATE, PREDICTIONS, SEED, Tables, q6, query, r6, rounded

AUC = """
, sc AS (SELECT probability AS s, sum(label) AS p, count(*) - sum(label) AS n FROM pred GROUP BY 1),
cu AS (SELECT *, sum(n) OVER (ORDER BY s) - n AS below FROM sc),
au AS (SELECT sum(p * (below + n / 2)) / (sum(p) * sum(n)) AS auc FROM cu)"""
CELLS = """
, c AS (SELECT CAST(sum(label * prediction) AS DOUBLE) AS tp, CAST(sum((1 - label) * prediction) AS DOUBLE) AS fp,
  CAST(sum(label * (1 - prediction)) AS DOUBLE) AS fn, CAST(sum((1 - label) * (1 - prediction)) AS DOUBLE) AS tn FROM pred)"""

SPLIT = f"CASE WHEN {HASH} / 4294967296e0 < 0.2e0 THEN 'test' WHEN {HASH} / 4294967296e0 < 0.4e0 THEN 'val' ELSE 'train' END"
PARTS = f", x AS (SELECT FLIGHT_ID, ARR_DELAY, {LATE} AS y, {SPLIT} AS part FROM flights WHERE ARR_DELAY IS NOT NULL)"


def parts(t: Tables):
    rows = split.random_split(t.late.select("FLIGHT_ID", "ARR_DELAY", "LATE"), "FLIGHT_ID", seed=SEED)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


@query("m1_mean_baseline", PARTS + f"""
SELECT FLIGHT_ID, ARR_DELAY, {q6("(SELECT avg(ARR_DELAY) FROM x WHERE part = 'train')")} AS prediction FROM x WHERE part = 'test'""")
def m1(t: Tables):
    train, test = parts(t)
    return rounded(models.mean_baseline(test, train, "ARR_DELAY").select("FLIGHT_ID", "ARR_DELAY", "prediction"), "prediction")


@query("m2_majority_baseline", PARTS + """
, g AS (SELECT y, count(*) AS n FROM x WHERE part = 'train' GROUP BY y)
SELECT FLIGHT_ID, y AS LATE, (SELECT y FROM g ORDER BY n DESC, y LIMIT 1) AS prediction,
       CAST((SELECT y FROM g ORDER BY n DESC, y LIMIT 1) AS DOUBLE) AS probability FROM x WHERE part = 'test'""")
def m2(t: Tables):
    train, test = parts(t)
    return models.majority_baseline(test, train, "LATE").select("FLIGHT_ID", "LATE", "prediction", "probability")


@query("m3_median_and_zero_baselines", PARTS + f"""
SELECT FLIGHT_ID, ARR_DELAY, {q6("(SELECT quantile_cont(ARR_DELAY, 0.5) FROM x WHERE part = 'train')")} AS median_prediction,
       CAST(0 AS DOUBLE) AS zero_prediction FROM x WHERE part = 'test'""")
def m3(t: Tables):
    train, test = parts(t)
    out = models.median_baseline(test, train, "ARR_DELAY").withColumnRenamed("prediction", "median_prediction")
    out = models.zero_baseline(out).withColumnRenamed("prediction", "zero_prediction")
    return out.select("FLIGHT_ID", "ARR_DELAY", r6("median_prediction").alias("median_prediction"), "zero_prediction")


@query("i1_classification_metrics", PREDICTIONS + AUC + CELLS + f"""
SELECT 'Delay rule' AS "Model", 'Test' AS "Stage", m.k AS "Metric", {q6("m.v")} AS "Value" FROM (SELECT unnest([
 {{'k': 'Accuracy', 'v': (tp + tn) / (tp + fp + fn + tn)}}, {{'k': 'Precision', 'v': tp / (tp + fp)}},
 {{'k': 'Recall', 'v': tp / (tp + fn)}}, {{'k': 'F1 Score', 'v': 2 * tp / (2 * tp + fp + fn)}}, {{'k': 'ROC AUC', 'v': auc}}]) AS m FROM c, au)""")
def i1(t: Tables):
    return rounded(evaluate.classification_metrics(t.predictions, "label", "prediction", "probability", "Delay rule"), "Value")


@query("i2_classification_report", PREDICTIONS + CELLS + f"""
, k AS (SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, 2 * tn / (2 * tn + fp + fn) AS f, tn + fp AS s FROM c
  UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c),
a AS (SELECT * FROM k UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM c
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM k
  UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM k)
SELECT class, {q6("p")} AS precision, {q6("r")} AS recall, {q6("f")} AS f1, CAST(s AS BIGINT) AS support FROM a""")
def i2(t: Tables):
    return rounded(evaluate.classification_report(t.predictions, "label", "prediction"), "precision", "recall", "f1")


@query("i3_confusion_matrix", PREDICTIONS + """
SELECT a AS actual, p AS predicted, count(label) AS n
FROM (SELECT unnest([0, 0, 1, 1]) AS a, unnest([0, 1, 0, 1]) AS p) LEFT JOIN pred ON label = a AND prediction = p GROUP BY a, p""")
def i3(t: Tables):
    return evaluate.confusion_matrix(t.predictions, "label", "prediction")


@query("i3_confusion_matrix_labels", """
SELECT a AS actual, p AS predicted, count(doc_id) AS n
FROM (SELECT unnest([0, 0, 1, 1]) AS a, unnest([0, 1, 0, 1]) AS p) LEFT JOIN labels ON quality = a AND toxic = p GROUP BY a, p""", native=True)
def i3_labels(t: Tables):
    return evaluate.confusion_matrix(t.table("labels"), "quality", "toxic")


DOWN = """
, sc AS (SELECT probability AS s, sum(label) AS p, count(*) - sum(label) AS n FROM pred GROUP BY 1),
cu AS (SELECT s, CAST(sum(p) OVER (ORDER BY s DESC) AS DOUBLE) AS tp, CAST(sum(n) OVER (ORDER BY s DESC) AS DOUBLE) AS fp,
  sum(p) OVER () AS pos, sum(n) OVER () AS neg FROM sc)"""


@query("i4_roc_curve", PREDICTIONS + DOWN + f"""
SELECT {q6("s")} AS threshold, {q6("fp / neg")} AS fpr, {q6("tp / pos")} AS tpr FROM cu
UNION ALL SELECT CAST('infinity' AS DOUBLE), 0, 0""")
def i4(t: Tables):
    return rounded(evaluate.roc_curve(t.predictions, "label", "probability"), "threshold", "fpr", "tpr")


@query("i4_roc_auc", PREDICTIONS + AUC + f"SELECT {q6('auc')} AS roc_auc FROM au")
def i4_auc(t: Tables):
    return rounded(evaluate.roc_auc(t.predictions, "label", "probability"), "roc_auc")


BINNED = PREDICTIONS + """
, sc AS (SELECT least(CAST(floor(probability * 1024) AS BIGINT), 1024) AS c, min(probability) AS s, sum(label) AS p,
  count(*) - sum(label) AS n FROM pred WHERE probability IS NOT NULL GROUP BY 1),
cu AS (SELECT s, CAST(sum(p) OVER (ORDER BY c DESC) AS DOUBLE) AS tp, CAST(sum(n) OVER (ORDER BY c DESC) AS DOUBLE) AS fp,
  sum(p) OVER () AS pos, sum(n) OVER () AS neg FROM sc)"""


@query("i4_i5_curves_from_summary", BINNED + f"""
SELECT {q6("s")} AS threshold, {q6("fp / neg")} AS fpr, {q6("tp / pos")} AS tpr, {q6("tp / (tp + fp)")} AS precision,
       {q6("tp / pos")} AS recall FROM cu""")
def i4_points(t: Tables):
    """The first grid alone, as SQL can state it: two halves of the rows, summarised apart and merged."""
    half = F.pmod(F.xxhash64("FLIGHT_ID"), F.lit(2))
    parts = [curves.score_summary(t.predictions.where(half == i), "label", "probability", tolerance=1.0) for i in (0, 1)]
    names = ["threshold", "fpr", "tpr", "precision", "recall"]
    return rounded(curves.summary_points(curves.merge_summaries(parts)).select(*names), *names)


@query("i4_roc_auc_from_summary", PREDICTIONS + AUC + f"SELECT {q6('auc')} AS exact, true AS within_bound, true AS bound_met FROM au")
def i4_summary(t: Tables):
    """The AUC of the refined summary against the exact one: off by no more than its bound, that at most 1e-5."""
    found = curves.summary_auc(curves.score_summary(t.predictions, "label", "probability", 1e-5)).first()
    exact = evaluate.roc_auc(t.predictions, "label", "probability")
    return exact.select(r6("roc_auc").alias("exact"),
                        (F.abs(F.col("roc_auc") - found["roc_auc"]) <= found["bound"] + 1e-12).alias("within_bound"),
                        F.lit(found["bound"] <= 1e-5).alias("bound_met"))


@query("i5_precision_recall_curve", PREDICTIONS + DOWN + f"""
SELECT {q6("s")} AS threshold, {q6("tp / (tp + fp)")} AS precision, {q6("tp / pos")} AS recall FROM cu
UNION ALL SELECT NULL, 1, 0""")
def i5(t: Tables):
    return rounded(evaluate.precision_recall_curve(t.predictions, "label", "probability"), "threshold", "precision", "recall")


@query("i6_threshold_sweep", PREDICTIONS + f"""
, th AS (SELECT unnest([0.1e0, 0.3e0, 0.5e0, 0.7e0]) AS t),
c AS (SELECT t, CAST(count(*) FILTER (label = 1 AND probability > t) AS DOUBLE) AS tp, count(*) FILTER (label = 0 AND probability > t) AS fp,
  count(*) FILTER (label = 1 AND probability <= t) AS fn, CAST(count(*) FILTER (label = 0 AND probability <= t) AS DOUBLE) AS tn FROM pred, th GROUP BY t)
SELECT t AS threshold, {q6("(tp + tn) / (tp + fp + fn + tn)")} AS accuracy, {q6("tp / (tp + fp)")} AS precision, {q6("tp / (tp + fn)")} AS recall,
       {q6("2 * tp / (2 * tp + fp + fn)")} AS f1, {q6("(tp / (tp + fn) + tn / (tn + fp)) / 2")} AS roc_auc FROM c""")
def i6(t: Tables):
    out = evaluate.threshold_sweep(t.predictions, "label", "probability", [0.1, 0.3, 0.5, 0.7])
    return rounded(out, "accuracy", "precision", "recall", "f1", "roc_auc")


REG = ", x AS (SELECT FLIGHT_ID, ARR_DELAY AS y, DEP_DELAY AS p FROM flights WHERE ARR_DELAY IS NOT NULL)"
REG_METRICS = (f"{q6('avg(abs(y - p))')} AS \"MAE\", {q6('sqrt(avg((y - p) * (y - p)))')} AS \"RMSE\", "
               f"{q6('1 - avg((y - p) * (y - p)) / var_pop(y)')} AS \"R2\" FROM x")


@query("i7_regression_metrics", REG + f"SELECT 'Departure delay' AS \"Model\", 'Test' AS \"Stage\", {REG_METRICS}")
def i7(t: Tables):
    return rounded(evaluate.regression_metrics(t.late, "ARR_DELAY", "DEP_DELAY", "Departure delay"), "MAE", "RMSE", "R2")


@query("i8_residual_table", REG + f"""
SELECT FLIGHT_ID, y AS actual, p AS predicted, y - p AS residual, (SELECT least(min(y), min(p)) FROM x) AS line_low,
       (SELECT greatest(max(y), max(p)) FROM x) AS line_high FROM x ORDER BY {HASH}, FLIGHT_ID LIMIT 1000""")
def i8(t: Tables):
    return evaluate.residual_table(t.late, "ARR_DELAY", "DEP_DELAY", "FLIGHT_ID", 1000, SEED)


COMPARED = PARTS + f"""
, b AS (SELECT avg(ARR_DELAY) FILTER (part = 'train') AS mean FROM x),
z AS (SELECT 'Mean' AS name, ARR_DELAY AS y, mean AS p FROM x, b WHERE part = 'test' UNION ALL
  SELECT 'Zero', ARR_DELAY, CAST(0 AS DOUBLE) FROM x WHERE part = 'test')
SELECT name AS "Model", 'Test' AS "Stage", {REG_METRICS.replace("FROM x", "FROM z")} GROUP BY name"""


def compared(t: Tables):
    train, test = parts(t)
    return evaluate.compare_models([
        evaluate.regression_metrics(models.mean_baseline(test, train, "ARR_DELAY"), "ARR_DELAY", "prediction", "Mean"),
        evaluate.regression_metrics(models.zero_baseline(test), "ARR_DELAY", "prediction", "Zero"),
    ])


@query("i9_compare_models", COMPARED)
def i9(t: Tables):
    return rounded(compared(t), "MAE", "RMSE", "R2")


@query("a8_comparison_table", COMPARED)
def a8(t: Tables):
    path = stores.write_table(compared(t), stores.scratch_path(t.spark, "comparison"))
    return rounded(t.spark.read.parquet(path), "MAE", "RMSE", "R2")


FOLDS = f"""
, f AS (SELECT *, CAST({HASH} % 3 AS INT) AS fold FROM (SELECT FLIGHT_ID, label, probability FROM pred)),
r AS (SELECT fold, s.params, label, CASE WHEN probability > s.cut THEN 1 ELSE 0 END AS hat
  FROM f, (SELECT unnest(['cut=0.3', 'cut=0.5']) AS params, unnest([0.3e0, 0.5e0]) AS cut) s),
c AS (SELECT params, fold, CAST(sum(label * hat) AS DOUBLE) AS tp, sum((1 - label) * hat) AS fp, sum(label * (1 - hat)) AS fn,
  CAST(sum((1 - label) * (1 - hat)) AS DOUBLE) AS tn FROM r GROUP BY params, fold),
m AS (SELECT params, fold, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
  2 * tp / (2 * tp + fp + fn) AS f1 FROM c),
a AS (SELECT params, """ + ", ".join(f"avg({m}) AS mean_{m}, stddev_pop({m}) AS std_{m}" for m in ("auc", "precision", "recall", "f1")) + """
  FROM m GROUP BY params)"""


@query("i11_cv_summary", PREDICTIONS + FOLDS + "SELECT params, " + ", ".join(
    f"{q6(f'mean_{m}')} AS mean_{m}, {q6(f'std_{m}')} AS std_{m}" for m in ("auc", "precision", "recall", "f1"))
    + ", params = (SELECT params FROM a ORDER BY mean_auc DESC, params LIMIT 1) AS is_best FROM a")
def i11(t: Tables):
    rows = split.kfold(t.predictions, "FLIGHT_ID", 3, SEED)
    cut = F.explode(F.array(F.struct(F.lit("cut=0.3").alias("params"), F.lit(0.3).alias("cut")),
                            F.struct(F.lit("cut=0.5").alias("params"), F.lit(0.5).alias("cut")))).alias("s")
    judged = rows.select("fold", "label", "probability", cut).select(
        "fold", "label", "s.params", (F.col("probability") > F.col("s.cut")).cast("int").alias("hat"))
    scores = evaluate.classification_wide(judged, "label", "hat", "hat", by=["params", "fold"]).select(
        "params", "fold", F.col("ROC AUC").alias("auc"), F.col("Precision").alias("precision"),
        F.col("Recall").alias("recall"), F.col("F1 Score").alias("f1"))
    out = evaluate.cv_summary(scores)
    return rounded(out, *[c for c in out.columns if c.startswith(("mean_", "std_"))])


# --- attributions of a linear score ----------------------------------------------------------------

WEIGHTS = {"DEP_DELAY": 0.8, "TAXI_OUT": 0.5, "TAXI_IN": -0.25}
INTERCEPT = -2.0
BASE = f"{INTERCEPT}e0 + " + " + ".join(f"{w}e0 * m_{c}" for c, w in WEIGHTS.items())
SHAP = f"""
, m AS (SELECT {", ".join(f"avg({c}) AS m_{c}" for c in WEIGHTS)} FROM flights WHERE ARR_DELAY IS NOT NULL),
sh AS (""" + " UNION ALL ".join(
    f"SELECT FLIGHT_ID, {BASE} AS base, '{c}' AS feature, {c} AS value, {w}e0 * ({c} - m_{c}) AS phi FROM flights, m WHERE ARR_DELAY IS NOT NULL"
    for c, w in WEIGHTS.items()) + ")"


def attributions(t: Tables):
    return explain.linear_shap(t.late, "FLIGHT_ID", WEIGHTS, INTERCEPT)


@query("x4_linear_shap", SHAP + f"SELECT FLIGHT_ID, {q6('base')} AS base, feature, value, {q6('phi')} AS phi FROM sh")
def x4(t: Tables):
    return rounded(attributions(t), "base", "phi")


@query("x7_shap_summary", SHAP + f"SELECT feature, {q6('avg(abs(phi))')} AS mean_abs_phi FROM sh GROUP BY feature")
def x7(t: Tables):
    return rounded(explain.shap_summary(attributions(t)), "mean_abs_phi")


@query("x8_shap_dependence", SHAP + f"""
SELECT FLIGHT_ID, max(value) FILTER (feature = 'DEP_DELAY') AS value, {q6("max(phi) FILTER (feature = 'DEP_DELAY')")} AS phi,
       max(value) FILTER (feature = 'TAXI_OUT') AS interaction
FROM sh WHERE feature IN ('DEP_DELAY', 'TAXI_OUT') GROUP BY FLIGHT_ID""")
def x8(t: Tables):
    return rounded(explain.shap_dependence(attributions(t), "FLIGHT_ID", "DEP_DELAY", "TAXI_OUT"), "phi")


@query("x9_force_table", SHAP + f"""
, k AS (SELECT DISTINCT FLIGHT_ID FROM sh ORDER BY FLIGHT_ID LIMIT 3)
SELECT FLIGHT_ID, feature, {q6("phi")} AS contribution FROM sh WHERE FLIGHT_ID IN (SELECT FLIGHT_ID FROM k)
UNION ALL SELECT DISTINCT FLIGHT_ID, 'base', {q6("base")} FROM sh WHERE FLIGHT_ID IN (SELECT FLIGHT_ID FROM k)""")
def x9(t: Tables):
    return rounded(explain.force_table(attributions(t), "FLIGHT_ID", 3), "contribution")
