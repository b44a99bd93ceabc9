"""Estimators of Spark ML with parameters given in the usual penalised-likelihood terms."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.feature import PCA, PCAModel, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from .encode import Scaling, apply_standard, fit_standard
from .scale import complete_rows, exact_quantiles

FEATURES = "features"
WEIGHT = "class_weight"


def assembler(features: list[str], target: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=target, handleInvalid="error")


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """One vector per complete row; the assembler's own skipping would be one n-column test."""
    return assembler(features).transform(complete_rows(df, features))


def complete_rows_stage(columns: list[str]) -> SQLTransformer:
    """``complete_rows`` as a storable stage."""
    test = " AND ".join(f"`{c}` IS NOT NULL" for c in columns)
    return SQLTransformer(statement=f"SELECT * FROM __THIS__ WHERE {test}")


# --- baselines -------------------------------------------------------------------------------------

def mean_baseline(df: DataFrame, train: DataFrame, label: str) -> DataFrame:
    return df.withColumn("prediction", train.agg(F.avg(label)).scalar())


def median_baseline(df: DataFrame, train: DataFrame, label: str) -> DataFrame:
    return df.withColumn("prediction", F.lit(exact_quantiles(train, [label], [0.5])[label][0]))


def zero_baseline(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", F.lit(0.0))


def majority_baseline(df: DataFrame, train: DataFrame, label: str) -> DataFrame:
    """The most frequent class (smaller label on a tie), with probability 0 or 1."""
    counts = train.groupBy(label).agg(F.count("*").alias("n"))
    top = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("y")))["y"]).scalar()
    return df.withColumn("prediction", top).withColumn("probability", F.col("prediction").cast("double"))


# --- class weights and penalties -------------------------------------------------------------------

def class_weights(df: DataFrame, label: str, balanced: bool = True) -> DataFrame:
    """Add ``n / (classes * n_c)`` per row, or 1; the class counts are one small aggregate."""
    if not balanced:
        return df.withColumn(WEIGHT, F.lit(1.0))
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    total = sum(counts.values())
    weights = [v for y, n in counts.items() for v in (F.lit(y), F.lit(total / (len(counts) * n)))]
    return df.withColumn(WEIGHT, F.create_map(*weights)[F.col(label)])


def ridge_penalty(train: DataFrame, label: str, alpha: float) -> float:
    """Spark scales the squared error by 1/n and the label by its deviation; ``alpha`` refers to neither."""
    stats = train.agg(F.stddev_samp(label).alias("s"), F.count(label).alias("n")).first()
    return alpha * (stats["s"] or 1.0) / stats["n"]


def ridge(train: DataFrame, label: str, alpha: float = 1.0):
    return LinearRegression(featuresCol=FEATURES, labelCol=label, elasticNetParam=0.0, standardization=False,
                            regParam=ridge_penalty(train, label, alpha), tol=1e-9, maxIter=200).fit(train)


def logistic(train: DataFrame, label: str, c: float = 1.0, l1: bool = False, balanced: bool = True,
             max_iter: int = 100, tol: float = 1e-6):
    """Logistic regression with inverse penalty strength ``c``; the intercept is not penalised."""
    weighted = class_weights(train, label, balanced)
    total = weighted.agg(F.sum(WEIGHT)).first()[0]
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, elasticNetParam=1.0 if l1 else 0.0,
        regParam=1.0 / (c * total), standardization=False, maxIter=max_iter, tol=tol).fit(weighted)


def forest_regressor(train: DataFrame, label: str, trees: int = 100, depth: int = 10, seed: int = 42):
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=depth,
                                 seed=seed).fit(train)


def forest_classifier(train: DataFrame, label: str, trees: int = 100, depth: int = 10, seed: int = 42):
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=depth,
                                  seed=seed).fit(train)


def boosted_trees(label: str, rounds: int = 1000, step: float = 0.1, depth: int = 5, min_rows: int = 1,
                  row_share: float = 1.0, column_share: float = 1.0, stop_flag: str | None = None,
                  seed: int = 42) -> GBTClassifier:
    """Unfitted boosted trees; with ``stop_flag`` the marked rows decide when to stop.

    ``min_rows`` bounds rows per leaf, near to but not the same as a bound on summed curvature.
    """
    est = GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=rounds, stepSize=step, maxDepth=depth,
                        minInstancesPerNode=min_rows, subsamplingRate=row_share,
                        featureSubsetStrategy="all" if column_share >= 1 else str(column_share), seed=seed,
                        cacheNodeIds=True, checkpointInterval=10)
    return est.setValidationIndicatorCol(stop_flag) if stop_flag else est


def perceptron_ladder(train: DataFrame, validation: DataFrame, label: str, hidden: list[int],
                      ladder: list[int] = (25, 50, 100), seed: int = 42):
    """Sigmoid perceptron fitted for a ladder of iteration counts; the one with the least validation loss wins.

    Returns the model and ``(iterations, split, loss)`` rows.
    """
    width = train.select(FEATURES).first()[0].size
    classes = train.select(label).distinct().count()
    best, rows, weights = None, [], None
    for i, steps in enumerate(ladder):
        est = MultilayerPerceptronClassifier(featuresCol=FEATURES, labelCol=label, layers=[width, *hidden, classes],
                                             maxIter=steps - (ladder[i - 1] if i else 0), seed=seed)
        if weights is not None:
            est.setInitialWeights(weights)
        model = est.fit(train)
        weights = model.weights
        for name, rowset in (("train", train), ("val", validation)):
            loss = log_loss(score(rowset, model), label).first()[0]
            rows.append((steps, name, loss))
        if best is None or rows[-1][2] < best[0]:
            best = (rows[-1][2], model)
        else:
            break
    return best[1], train.sparkSession.createDataFrame(rows, "iteration int, split string, loss double")


def log_loss(scored: DataFrame, label: str, probability: str = "probability_1") -> DataFrame:
    p = F.least(F.greatest(F.col(probability), F.lit(1e-15)), F.lit(1 - 1e-15))
    return scored.agg(F.avg(F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))).alias("loss"))


# --- scoring ---------------------------------------------------------------------------------------

def positive_probability() -> Column:
    return vector_to_array(F.col("probability"))[1]


def score(df: DataFrame, model: Transformer, threshold: float = 0.5) -> DataFrame:
    """Batch scoring: probability of class 1 and the class at the threshold."""
    scored = model.transform(df).withColumn("probability_1", positive_probability())
    return scored.withColumn("predicted", (F.col("probability_1") > threshold).cast("int"))


# --- principal components --------------------------------------------------------------------------

def fit_pca(df: DataFrame, columns: list[str], variance: float = 0.95) -> tuple[Scaling, PCAModel, int]:
    """Standardise, then find how many components reach the wanted share of variance."""
    scaling = fit_standard(df, columns)
    vectors = assemble(apply_standard(df.select(*columns), scaling), columns)
    model = PCA(k=len(columns), inputCol=FEATURES, outputCol="components").fit(vectors)
    reached, count = 0.0, 0
    for share in model.explainedVariance.toArray():
        reached, count = reached + share, count + 1
        if reached >= variance - 1e-12:
            break
    return scaling, model, count


def component_signs(model: PCAModel) -> list[int]:
    """+1 or -1 per component, so that its largest absolute entry is positive."""
    loadings = model.pc.toArray()
    return [1 if column[abs(column).argmax()] >= 0 else -1 for column in loadings.T]


def apply_pca(df: DataFrame, columns: list[str], scaling: Scaling, model: PCAModel, count: int) -> DataFrame:
    """Add ``PC1 .. PCk`` to the rows that have every column."""
    scaled = apply_standard(complete_rows(df, columns).withColumns({f"__raw_{c}": F.col(c) for c in columns}), scaling)
    out = model.transform(assemble(scaled, columns))
    parts, signs = vector_to_array("components"), component_signs(model)
    out = out.withColumns({f"PC{i + 1}": parts[i] * signs[i] for i in range(count)})
    return out.drop(FEATURES, "components").withColumns({c: F.col(f"__raw_{c}") for c in columns}).drop(
        *[f"__raw_{c}" for c in columns])


def explained_variance_table(df: DataFrame, model: PCAModel) -> DataFrame:
    rows, total = [], 0.0
    for i, share in enumerate(model.explainedVariance.toArray()):
        total += float(share)
        rows.append((i + 1, float(share), total))
    return df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double")


def component_table(df: DataFrame, model: PCAModel, columns: list[str], count: int) -> DataFrame:
    """Loadings in long form ``(component, column, loading)``."""
    loadings, signs = model.pc.toArray(), component_signs(model)
    rows = [(k + 1, c, float(loadings[j, k] * signs[k])) for k in range(count) for j, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "component int, column string, loading double")


def scaler_pca_logistic(train: DataFrame, columns: list[str], label: str, components: int,
                        weight: str | None = None, max_iter: int = 200) -> PipelineModel:
    """Scaler, components and classifier as one fitted, storable model on raw columns."""
    classifier = LogisticRegression(featuresCol="components", labelCol=label, maxIter=max_iter)
    if weight:
        classifier.setWeightCol(weight)
    return Pipeline(stages=[
        complete_rows_stage(columns),
        assembler(columns, "raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        PCA(k=components, inputCol="scaled", outputCol="components"),
        classifier,
    ]).fit(train)


def select_top_features(df: DataFrame, features: list[str], label: str, n: int = 30, trees: int = 100,
                        depth: int = 10, seed: int = 42) -> DataFrame:
    """``(feature, importance)`` of the ``n`` best columns by forest importance."""
    from .explain import feature_importance

    model = forest_regressor(assemble(df, features), label, trees, depth, seed)
    return feature_importance(df.sparkSession, model, features, n)
