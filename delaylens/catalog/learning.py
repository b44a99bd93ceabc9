"""Models, search, components and attributions: results without an SQL equivalent."""

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, functions as F

from ..operators import encode, evaluate, explain, models, neural, search, split
from ..operators.scale import bounded, complete_rows, spread
from ..plans import congestion, delay_minutes, late_flights, logistic_study
from ..session import checkpointed, short_lived_shuffles
from ..sources import stores
from ..sources.sample_tables import classification_sample
from ..streaming.scoring import landed_stream, score_records, score_stream
from .base import SEED, Tables, query

KEY = "FLIGHT_ID"
FIVE = ["CRS_DEP_TIME", "CRS_ELAPSED_TIME", "DEP_DELAY", "TAXI_OUT", "TAXI_IN"]
TWENTY = [f"feature_{i}" for i in range(20)]


def learning_rows(t: Tables, *needed: str, forest: bool = False) -> DataFrame:
    """Five scaled measures, a split and fold columns and the ``needed`` ones, by default key and both labels; persisted
    because fits iterate, but for the vectors, which say the same as the measures in twice the room. A forest draws its
    rows by partition: for it, rows in few partitions are dealt by all columns, whichever are needed.
    """
    rows = complete_rows(t.late.select(KEY, "ARR_DELAY", "LATE", *FIVE))
    rows = split.random_split(rows, KEY, seed=SEED)
    rows = encode.standard_scale(rows, FIVE, fit_on=rows.where("split = 'train'"))
    rows, columns = split.kfold(rows, KEY, 3, SEED), [*(needed or (KEY, "ARR_DELAY", "LATE")), *FIVE, "split", "fold"]
    if forest:
        dealt = spread(models.assemble(rows, FIVE))
        kept = dealt.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
        kept.count()
        dealt.unpersist()
    else:
        kept = spread(rows.select(*columns))
    rows = models.assemble(kept, FIVE)
    rows.kept = kept
    return rows


def part(rows: DataFrame, name: str) -> DataFrame:
    return rows.where(F.col("split") == name)


def let_go(rows: DataFrame) -> None:
    """Release training rows, or other persisted ones."""
    getattr(rows, "kept", rows).unpersist()


def settled(rows: DataFrame, result: DataFrame) -> DataFrame:
    """Evaluate a small result before the training rows are released."""
    out = bounded(result)
    let_go(rows)
    return out


def released(rows: DataFrame, result: DataFrame) -> DataFrame:
    """Write a large result, in columns, before the training rows are released."""
    folder = stores.write_table(result, stores.scratch_path(result.sparkSession, "result"))
    let_go(rows)
    return result.sparkSession.read.schema(result.schema).parquet(folder)


def judged(scored: DataFrame, name: str) -> DataFrame:
    return bounded(evaluate.classification_metrics(scored, "LATE", "predicted", "probability_1", name))


@query("m4_ridge")
def m4(t: Tables):
    rows = learning_rows(t, "ARR_DELAY")
    found = [bounded(evaluate.regression_metrics(models.ridge(part(rows, "train"), "ARR_DELAY", alpha).transform(
        part(rows, "test")), "ARR_DELAY", "prediction", f"Ridge alpha={alpha}")) for alpha in (1.0, 10.0)]
    return settled(rows, evaluate.compare_models(found))


@query("m5_forest_regression")
def m5(t: Tables):
    rows = learning_rows(t, "ARR_DELAY", forest=True)
    found = [bounded(evaluate.regression_metrics(models.forest_regressor(
        part(rows, "train"), "ARR_DELAY", trees, depth).transform(part(rows, "test")), "ARR_DELAY", "prediction",
        f"Forest trees={trees} depth={depth}")) for trees, depth in ((50, 5), (50, 10))]
    return settled(rows, evaluate.compare_models(found))


@query("m6_logistic_l1")
def m6(t: Tables):
    rows = learning_rows(t, "LATE")
    found = [judged(models.score(part(rows, "test"), models.logistic(part(rows, "train"), "LATE", c, l1=True)),
                    f"Logistic C={c}") for c in (1.0, 10.0)]
    return settled(rows, evaluate.compare_models(found))


@query("m7_logistic_variants")
def m7(t: Tables):
    return logistic_study.compare_variants(t.flights, "minimal")["metrics"]


@query("m7_logistic_busy_airports")
def m7_busy(t: Tables):
    return logistic_study.compare_variants(t.flights, "busy", [{"balanced": True, "c": 0.01}])["metrics"]


@query("m8_neural_classifier")
def m8(t: Tables):
    rows = learning_rows(t, "LATE")
    model, _ = models.perceptron_ladder(part(rows, "train"), part(rows, "val"), "LATE", [32], (25, 50))
    return settled(rows, judged(models.score(part(rows, "test"), model), "Perceptron"))


@query("m8_neural_classifier_dropout")
def m8_dropout(t: Tables):
    rows = learning_rows(t, "LATE")
    net = neural.Net(len(FIVE), (32, 32), "classification", 0.1, 1e-3, 32)
    fitted = neural.fit_network(part(rows, "train"), FIVE, "LATE", net, part(rows, "val"), 12, 5)
    scored = fitted.transform(part(rows, "test"), "probability_1").withColumn(
        "predicted", (F.col("probability_1") > 0.5).cast("int"))
    return settled(rows, judged(scored, "Network"))


@query("m9_neural_regressor")
def m9(t: Tables):
    rows = learning_rows(t, "ARR_DELAY")
    fitted = neural.fit_network(part(rows, "train"), FIVE, "ARR_DELAY", neural.Net(len(FIVE), (64, 32), rate=3e-3),
                                part(rows, "val"), 12, 3, "mae")
    return settled(rows, evaluate.regression_metrics(fitted.transform(part(rows, "test")), "ARR_DELAY", "prediction", "Network"))


@query("m10_boosted_trees")
def m10(t: Tables):
    """All 72 settings on 5 folds; a sixth of them goes on from the first round, four from the second."""
    settings = congestion.CongestionSettings(rounds=3, keep={1: 12, 2: 4})
    return congestion.run(t.flights, settings)["summary"]


@query("m10_score_unseen")
def m10_unseen(t: Tables):
    """Fitted on four fifths of the rows, stored, loaded, applied to the rest."""
    folder = stores.scratch_path(t.spark, "congestion")
    rows = split.random_split(t.flights, KEY, 0.2, 0.0, SEED)
    grid = {"step": [0.1], "depth": [5], "min_curvature": [1], "row_share": [0.8], "column_share": [0.8]}
    settings = congestion.CongestionSettings(folds=2, rounds=10, grid=grid)
    congestion.store(congestion.run(part(rows, "train").drop("split"), settings), t.spark, folder)
    found = checkpointed(congestion.score_unseen(part(rows, "test").drop("split"), congestion.load(t.spark, folder), settings))
    stores.remove_path(t.spark, folder)
    return found


@query("m11_grid_search")
def m11(t: Tables):
    rows = learning_rows(t, "LATE")
    base = LogisticRegression(labelCol="LATE", maxIter=50)
    _, _, table = search.grid_search(base, {"regParam": [0.0, 0.01, 0.1]}, part(rows, "train").select("LATE", "features", "fold"),
                                     BinaryClassificationEvaluator(labelCol="LATE", numBins=0), 3)
    return settled(rows, table)


@query("m11_resumable_search", "SELECT 7 AS fits, 0 AS fits_again, 2 AS kept, true AS same_scores, true AS same_setting, true AS best_is_highest",
       native=True)
def m11_resumable(t: Tables):
    """Three penalties on three folds, the best two kept after the first: 3 + 2 + 2 fits. The second search reads them
    all from the ledger, the third call finds the stored setting."""
    rows = learning_rows(t, KEY, "LATE")
    train, made = part(rows, "train").select(KEY, "LATE", "features", "fold"), []

    def fit(data, setting):
        made.append(setting)
        return LogisticRegression(labelCol="LATE", maxIter=50, **setting).fit(data)

    settings = search.combinations({"regParam": [0.0, 0.01, 0.1]})
    folder = stores.scratch_path(t.spark, "search")
    job = (train, settings, 3, "LATE", fit)
    best, first = search.stored_or_searched(*job, f"{folder}/params", f"{folder}/ledger", "logistic", keep=[2])
    fits = len(made)
    again = search.resumable_scores(*job, f"{folder}/ledger", "logistic", keep=[2])
    stored, none = search.stored_or_searched(*job, f"{folder}/params", f"{folder}/ledger", "logistic", keep=[2])
    means = first.groupBy("params").agg(F.count("*").alias("n"), F.avg("auc").alias("auc")).where("n = 3").collect()
    top = max(means, key=lambda r: r["auc"])
    row = (fits, len(made) - fits, len(means), sorted(first.collect()) == sorted(again.collect()), none is None and stored == best,
           abs(top["auc"] - next(r["auc"] for r in means if r["params"] == search.describe(best))) == 0.0)
    let_go(rows)
    return t.spark.createDataFrame([row], "fits int, fits_again int, kept int, same_scores boolean, same_setting boolean, best_is_highest boolean")


@query("m12_random_search")
def m12(t: Tables):
    rows = learning_rows(t, "LATE")
    base = LogisticRegression(labelCol="LATE", maxIter=50)
    grid = {"regParam": [0.0, 0.001, 0.01, 0.1], "elasticNetParam": [0.0, 1.0]}
    _, _, table = search.random_search(base, grid, 3, part(rows, "train").select("LATE", "features", "fold"),
                                       BinaryClassificationEvaluator(labelCol="LATE", numBins=0), 3)
    return settled(rows, table)


@query("m12_network_random_search")
def m12_network(t: Tables):
    rows = learning_rows(t, "LATE")
    _, table = neural.network_random_search(part(rows, "train"), part(rows, "val"), FIVE, "LATE", trials=2, epochs=4)
    return settled(rows, table)


@query("m13_kfold_network_search")
def m13(t: Tables):
    rows = learning_rows(t, "ARR_DELAY")
    settings = [{"hidden": h, "batch": 64, "epochs": 3, "rate": 1e-2} for h in ((64, 32), (64, 64))]
    _, table = neural.kfold_network_search(part(rows, "train"), part(rows, "val"), FIVE, "ARR_DELAY", settings, k=3)
    return settled(rows, table)


@query("m14_load_or_fit")
def m14(t: Tables):
    rows, folder = learning_rows(t, "LATE"), stores.scratch_path(t.spark, "models")
    uses = []
    for attempt in (1, 2):  # the second call reuses the stored model
        model, reused = stores.load_or_fit(part(rows, "train"), folder, "logistic", {"c": 1.0},
                                           lambda d: models.logistic(d, "LATE"))
        uses.append((attempt, reused, float(model.intercept)))
    return settled(rows, t.spark.createDataFrame(uses, "attempt int, reused boolean, intercept double"))


@query("m15_score")
def m15(t: Tables):
    rows = learning_rows(t, KEY, "LATE")
    model = models.logistic(part(rows, "train"), "LATE")
    return released(rows, models.score(part(rows, "test"), model).select(KEY, "LATE", "probability_1", "predicted"))


@query("m16_score_records")
def m16(t: Tables):
    model = five_measure_model(t)
    return score_records(t.flights.select(KEY, *FIVE), model)


def five_measure_model(t: Tables):
    """Every stage's fit reads the training rows several times; they are written out once, so that none of them joins
    the tables again and leaves another set of shuffle files."""
    train, folder = complete_rows(t.late.select("LATE", *FIVE)), stores.scratch_path(t.spark, "five")
    with short_lived_shuffles(t.spark):
        stores.write_table(train, folder)
    try:
        return models.scaler_pca_logistic(t.spark.read.schema(train.schema).parquet(folder), FIVE, "LATE", 5)
    finally:
        stores.remove_path(t.spark, folder)


@query("a5_save_and_load_model")
def a5(t: Tables):
    folder = stores.scratch_path(t.spark, "models")
    stores.save_model(five_measure_model(t), folder, "five")
    model = stores.load_model(t.spark, folder, "five")
    return models.score(t.flights.select(KEY, *FIVE), model).select(KEY, "probability_1", "predicted")


@query("t1_stream_scoring")
def t1(t: Tables):
    model = five_measure_model(t)
    with short_lived_shuffles(t.spark):
        source = stores.write_table(t.flights.select(KEY, *FIVE), stores.scratch_path(t.spark, "arrivals"))
    out, mark = stores.scratch_path(t.spark, "scored"), stores.scratch_path(t.spark, "progress")
    stream = landed_stream(t.spark, source, t.spark.read.parquet(source).schema)
    score_stream(stream, model, out, mark, [KEY], once=True).awaitTermination()
    for folder in (source, mark):  # all files are scored
        stores.remove_path(t.spark, folder)
    return t.spark.read.parquet(out)


@query("f8_pca")
def f8(t: Tables):
    rows = complete_rows(t.late.select(KEY, *FIVE)).persist(StorageLevel.MEMORY_AND_DISK)
    scaling, model, count = models.fit_pca(rows, FIVE)
    return released(rows, models.apply_pca(rows, FIVE, scaling, model, count).select(KEY, *[f"PC{i + 1}" for i in range(count)]))


@query("f9_explained_variance")
def f9(t: Tables):
    rows = complete_rows(t.late.select(*FIVE))
    return models.explained_variance_table(rows, models.fit_pca(rows, FIVE)[1])


@query("f9_explained_variance_embeddings")
def f9_embeddings(t: Tables):
    rows = classification_sample(t.spark, t.folder)
    return models.explained_variance_table(rows, models.fit_pca(rows, TWENTY)[1])


@query("f10_select_top_features")
def f10(t: Tables):
    rows = learning_rows(t, "ARR_DELAY", forest=True)
    return settled(rows, models.select_top_features(rows.drop("features"), FIVE, "ARR_DELAY", 3, trees=20, depth=5))


@query("f12_scaler_pca_logistic")
def f12(t: Tables):
    scored = models.score(t.late.select(KEY, "LATE", *FIVE), five_measure_model(t))
    return judged(scored, "Scaler, components, logistic")


@query("i10_learning_curve")
def i10(t: Tables):
    rows = learning_rows(t, "ARR_DELAY")
    fitted = neural.fit_network(part(rows, "train"), FIVE, "ARR_DELAY", neural.Net(len(FIVE), (64, 32)),
                                part(rows, "val"), 6, 3, "mae")
    let_go(rows)
    return fitted.learning_curve(rows)


@query("x1_feature_importance")
def x1(t: Tables):
    rows = learning_rows(t, "LATE", forest=True)
    model = models.forest_classifier(part(rows, "train"), "LATE", 20, 5)
    return settled(rows, explain.feature_importance(t.spark, model, FIVE))


@query("x2_coefficient_importance")
def x2(t: Tables):
    rows = learning_rows(t, "LATE")
    return settled(rows, explain.coefficient_importance(t.spark, models.logistic(part(rows, "train"), "LATE"), FIVE))


@query("x2_coefficient_importance_embeddings")
def x2_embeddings(t: Tables):
    rows = models.assemble(classification_sample(t.spark, t.folder), TWENTY)
    return explain.coefficient_importance(t.spark, models.logistic(rows, "target"), TWENTY)


@query("x3_pca_back_projection")
def x3(t: Tables):
    return logistic_study.component_study(t.flights, "air only")["importance"]


@query("x5_tree_shap")
def x5(t: Tables):
    rows = learning_rows(t, KEY, "ARR_DELAY", forest=True)
    model = models.forest_regressor(part(rows, "train"), "ARR_DELAY", 10, 5)
    return released(rows, explain.tree_shap(rows.drop("features"), KEY, model, FIVE))


@query("x6_sampled_shap")
def x6(t: Tables):
    rows = learning_rows(t, KEY, "LATE")
    model = models.logistic(part(rows, "train"), "LATE")

    def predict(points: DataFrame) -> DataFrame:
        return models.score(models.assemble(points, FIVE), model).withColumnRenamed("probability_1", "score")

    sample = split.sample_n(part(rows, "test").drop("features"), 1000, KEY, SEED)
    found = explain.sampled_shap(sample, KEY, FIVE, predict, part(rows, "train"), KEY, 20)
    return settled(rows, explain.shap_summary(found))


def embedding_network(t: Tables):
    """A network on twenty embedding elements, and its rows."""
    rows = spread(classification_sample(t.spark, t.folder))
    net = neural.Net(20, (64, 32), "classification", 0.0, 3e-3, 32)
    return rows, neural.fit_network(rows, TWENTY, "target", net, epochs=8, key="vec_id")


@query("x6_network_shap")
def x6_network(t: Tables):
    rows, fitted = embedding_network(t)
    return settled(rows, explain.shap_summary(explain.network_shap(rows, "vec_id", fitted, rows, "vec_id")))


@query("x6_network_shap_adds_up", f"""
SELECT vec_id, 20::BIGINT AS features, true AS adds_up FROM embeddings
WHERE {" AND ".join(f"embedding[{i + 1}] IS NOT NULL" for i in range(20))}
""", native=True)
def x6_adds_up(t: Tables):
    """Whether base and attributions give each row's score to 1e-6."""
    rows, fitted = embedding_network(t)
    total = explain.network_shap(rows, "vec_id", fitted, rows, "vec_id").groupBy("vec_id").agg(
        F.count("*").alias("features"), (F.sum("phi") + F.first("base")).alias("total"))
    scored = fitted.transform(rows.select("vec_id", *TWENTY), "score").join(total, "vec_id")
    return released(rows, scored.select("vec_id", "features", (F.abs(F.col("score") - F.col("total")) <= 1e-6).alias("adds_up")))


@query("late_flight_run")
def late_flight_run(t: Tables):
    settings = late_flights.LateFlightSettings(epochs=8, logistic_iterations=40)
    return late_flights.run(t.flights, settings)["comparison"]


@query("delay_minutes_run")
def delay_minutes_run(t: Tables):
    settings = delay_minutes.DelayMinutesSettings(
        trees=10, depth=5, folds=2, outlier_columns=("DEP_DELAY", "TAXI_OUT", "TAXI_IN", "ARR_DELAY"))
    networks = [{"hidden": (64, 32), "batch": 32, "epochs": 8}]
    return delay_minutes.run(t.flights, settings, networks)["comparison"]
