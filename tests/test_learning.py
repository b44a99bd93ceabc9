"""Properties of models and attributions."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens.catalog.learning import FIVE, learning_rows, let_go, part
from delaylens.operators import evaluate, explain, models, neural, search, split
from delaylens.operators.scale import complete_rows
from delaylens.sources import stores
from delaylens.streaming.scoring import landed_stream, score_stream


@pytest.fixture(scope="module")
def rows(tables):
    return learning_rows(tables)


@pytest.fixture(scope="module")
def data(rows):
    pdf = part(rows, "train").select(*FIVE, "ARR_DELAY", "LATE").toPandas()
    return pdf[FIVE].to_numpy(), pdf["ARR_DELAY"].to_numpy(), pdf["LATE"].to_numpy()


@pytest.mark.parametrize("alpha", [1.0, 10.0])
def test_ridge_is_the_closed_form(rows, data, alpha):
    x, y, _ = data
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    got = models.ridge(part(rows, "train"), "ARR_DELAY", alpha).coefficients.toArray()
    assert got == pytest.approx(want, rel=1e-4)


def test_logistic_optimality(rows, data):
    x, _, y = data
    c = 1.0
    model = models.logistic(part(rows, "train"), "LATE", c, l1=True, max_iter=500, tol=1e-10)
    w, b = model.coefficients.toArray(), model.intercept
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    p = 1 / (1 + np.exp(-(x @ w + b)))
    grad = c * x.T @ (weight * (p - y))
    assert abs((weight * (p - y)).sum()) < 1e-2
    for g, v in zip(grad, w):
        assert abs(g + np.sign(v)) < 0.05 if v else abs(g) <= 1.05


def test_models_beat_baselines(rows):
    train, test = part(rows, "train"), part(rows, "test")
    scored = models.score(test, models.logistic(train, "LATE"))
    assert evaluate.roc_auc(scored, "LATE", "probability_1").first()[0] > 0.9
    mean = evaluate.regression_metrics(models.mean_baseline(test, train, "ARR_DELAY"), "ARR_DELAY", "prediction").first()
    ridge = evaluate.regression_metrics(models.ridge(train, "ARR_DELAY").transform(test), "ARR_DELAY", "prediction").first()
    assert ridge["MAE"] < mean["MAE"] / 2


def test_network_gradient_matches_differences():
    net = neural.Net(3, (4, 3), "classification")
    rng = np.random.default_rng(0)
    x, y, w = rng.normal(size=(6, 3)), rng.integers(0, 2, 6).astype(float), np.ones(6)
    flat = net.start(1)
    grad = net.gradient(flat, x, y, w, rng)
    for i in range(0, net.size, 5):
        step = np.zeros(net.size)
        step[i] = 1e-6
        up, down = (net.loss(net.forward(flat + s, x)[0], y).mean() for s in (step, -step))
        assert grad[i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_network_learns_and_stops(rows):
    train, val, test = (part(rows, p) for p in ("train", "val", "test"))
    net = neural.Net(len(FIVE), (32,), rate=1e-2, batch=512)
    fitted = neural.fit_network(train, FIVE, "ARR_DELAY", net, val, 15, 3, "mae")
    mae = evaluate.regression_metrics(fitted.transform(test), "ARR_DELAY", "prediction").first()["MAE"]
    mean = evaluate.regression_metrics(models.mean_baseline(test, train, "ARR_DELAY"), "ARR_DELAY", "prediction").first()["MAE"]
    assert mae < mean / 2
    curve = fitted.learning_curve(test).where("split = 'val'").orderBy("iteration").collect()
    assert curve[-1]["mae"] < curve[0]["mae"]


@pytest.mark.parametrize("dropout", [0.0, 0.2])
def test_network_weights_for_any_partitioning(spark, dropout):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "id int, a double, b double, c double, y int")
    net = neural.Net(3, (8, 4), "classification", dropout, 1e-2, 100)
    found = [neural.fit_network(df.repartition(n), ["a", "b", "c"], "y", net, epochs=3, key="id") for n in (1, 4, 16)]
    for other in found[1:]:
        assert np.abs(found[0].weights - other.weights).max() < 1e-8
        assert other.history == [pytest.approx(h) for h in found[0].history]


def test_networks_side_by_side_share_jobs_and_equal_single_fits(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 2))
    df = spark.createDataFrame([(float(a), float(b), float(a - b), i % 3 if i % 50 else None, i % 5 == 0) for i, (a, b) in enumerate(x)],
                               "a double, b double, y double, fold int, val boolean").repartition(3)
    train, val = df.where("not val"), df.where("val")
    settings = [{"hidden": h, "batch": 80, "epochs": 2, "rate": 1e-2} for h in ((4,), (6, 3))]
    jobs, real = [], neural.sum_over_tasks
    monkeypatch.setattr(neural, "sum_over_tasks", lambda *a, **more: jobs.append(1) or real(*a, **more))
    best, table = neural.kfold_network_search(train, val, ["a", "b"], "y", settings, k=3, patience=99)
    assert len(jobs) == 2 * 4 + 1  # the steps of two epochs and the last judgement, for eight fits at once
    finals = []
    for setting, row in zip(settings, table.collect()):
        net = neural.Net(2, setting["hidden"], rate=1e-2, batch=80)
        sides = [(train.where(f"fold != {i}"), train.where(f"fold = {i}")) for i in range(3)] + [(train, val)]
        alone = [neural.fit_network(a, ["a", "b"], "y", net, b, 2, 99, "mae") for a, b in sides]
        maes = [min(h[3] for h in f.history if h[1] == "val") for f in alone]
        assert (row["fold_mae"], row["fold_std"], row["validation_mae"]) == pytest.approx((np.mean(maes[:3]), np.std(maes[:3]), maes[3]))
        finals.append((maes[3], alone[3]))
    assert np.abs(best.weights - min(finals, key=lambda f: f[0])[1].weights).max() < 1e-8


def test_training_rows_are_kept_without_their_vectors(tables):
    rows = learning_rows(tables, "LATE")
    assert rows.kept.columns == ["LATE", *FIVE, "split", "fold"]
    assert rows.kept.is_cached and not rows.is_cached
    let_go(rows)
    assert not rows.kept.is_cached


def test_forest_rows_are_dealt_alike_whichever_columns_are_kept(tables):
    where, found = F.spark_partition_id().alias("p"), []
    for needed in ((), ("FLIGHT_ID", "ARR_DELAY")):
        rows = learning_rows(tables, *needed, forest=True)
        found.append(sorted(tuple(r) for r in rows.select("FLIGHT_ID", where).collect()))
        let_go(rows)
    assert found[0] == found[1]


def test_a_large_result_is_written_in_columns(tables):
    from delaylens.catalog.learning import released

    rows = tables.late.select("FLIGHT_ID", "LATE").limit(50).persist()
    out = released(rows, rows.withColumn("twice", F.col("LATE") * 2))
    assert not rows.is_cached and out.columns == ["FLIGHT_ID", "LATE", "twice"] and out.count() == 50
    assert all(f.endswith(".parquet") for f in out.inputFiles()) and out.inputFiles()


def test_network_steps_equal_adam_on_whole_batches(spark):
    """One step an epoch: the weights of plain Adam on the mean gradient of all rows."""
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(200, 2)), rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(v)) for (a, b), v in zip(x, y)], "a double, b double, y double")
    net = neural.Net(2, (5,), rate=1e-2, batch=200)
    fitted = neural.fit_network(df.repartition(3), ["a", "b"], "y", net, epochs=6, patience=99, seed=1)
    flat, first, second, losses = net.start(1), np.zeros(net.size), np.zeros(net.size), []
    for k in range(1, 8):
        losses.append(((net.forward(flat, x)[0] - y) ** 2).mean())
        g = net.gradient(flat, x, y, np.ones(200), None)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        flat = flat - 1e-2 * (first / (1 - 0.9 ** k)) / (np.sqrt(second / (1 - 0.999 ** k)) + 1e-8)
    assert [h[2] for h in fitted.history] == pytest.approx(losses)


def exhaustive(net, weights, x, background, output):
    """Shapley values of one row by all coalitions, averaged over background rows."""
    d, phi = len(x), np.zeros(len(x))
    value = {}
    for n in range(d + 1):
        for s in combinations(range(d), n):
            points = background.copy()
            points[:, list(s)] = x[list(s)]
            value[s] = output(points).mean()
    for i in range(d):
        for n in range(d):
            for s in combinations([j for j in range(d) if j != i], n):
                share = factorial(n) * factorial(d - n - 1) / factorial(d)
                phi[i] += share * (value[tuple(sorted((*s, i)))] - value[s])
    return phi


@pytest.mark.parametrize("apart", [True, False])
def test_network_attributions(spark, apart):
    """On six features: equal to all coalitions where units don't join features, near them elsewhere; always additive."""
    rng = np.random.default_rng(8)
    names = list("abcdef")
    net = neural.Net(6, (12,) if apart else (10, 6), "classification")
    weights = rng.normal(scale=0.6, size=net.size)
    if apart:
        weights[:72] *= np.kron(np.eye(6), np.ones(2)).ravel()  # two units for each feature
    x = rng.normal(size=(12, 6))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, " + ", ".join(f"{c} double" for c in names))
    df = df.union(spark.createDataFrame([(99, None, *[0.0] * 5)], df.schema))
    fitted = neural.FittedNet(net, names, weights)
    background = df.where("id >= 4")
    found = explain.network_shap(df, "id", fitted, background, "id", probability=False).toPandas()
    assert set(found.id) == set(range(12))
    logit = lambda points: np.log(net.forward(weights, points)[0] / (1 - net.forward(weights, points)[0]))
    for i, own in found.groupby("id"):
        phi = own.set_index("feature").phi[names].to_numpy()
        assert phi.sum() + own.base.iloc[0] == pytest.approx(logit(x[i:i + 1])[0], abs=1e-6)
        want = exhaustive(net, weights, x[i], x[4:], logit)
        if apart:
            assert phi == pytest.approx(want, abs=1e-6)
        else:
            assert np.abs(phi - want).max() < 0.35 * np.abs(want).max() + 0.05
    scores = explain.network_shap(df, "id", fitted, background, "id").groupBy("id").agg((F.sum("phi") + F.first("base")).alias("s"))
    assert {r["id"]: r["s"] for r in scores.collect()} == pytest.approx(dict(enumerate(net.forward(weights, x)[0])), abs=1e-6)


def test_perceptron_ladder(rows):
    train = part(rows, "train")
    model, curve = models.perceptron_ladder(train, part(rows, "val"), "LATE", [8], (10, 20))
    assert evaluate.roc_auc(models.score(part(rows, "test"), model), "LATE", "probability_1").first()[0] > 0.8
    assert curve.count() in (2, 4)


def tree_value(leaves, known, x):
    """Expected output when only ``known`` features are fixed: the definition that attributions must split."""
    total = 0.0
    for leaf in leaves:
        v = leaf.value
        for f, lo, hi, share in zip(leaf.feature, leaf.low, leaf.high, leaf.share):
            v *= float(lo < x[f] <= hi) if f in known else share
        total += v
    return total


@pytest.mark.parametrize("kind", ["forest", "classes", "boosted"])
def test_tree_attributions(rows, kind):
    train, test = part(rows, "train"), part(rows, "test").orderBy("FLIGHT_ID").limit(40)
    if kind == "forest":
        model = models.forest_regressor(train, "ARR_DELAY", 4, 4)
        raw = F.col("prediction")
    elif kind == "classes":
        model = models.forest_classifier(train, "LATE", 4, 4)
        raw = models.positive_probability()
    else:
        model = models.boosted_trees("LATE", rounds=3, depth=3).fit(train)
        raw = None
    found = explain.tree_shap(test.drop("features"), "FLIGHT_ID", model, FIVE).persist()
    sums = {r["FLIGHT_ID"]: r["total"] for r in found.groupBy("FLIGHT_ID").agg(
        (F.sum("phi") + F.first("base")).alias("total")).collect()}
    leaves = explain.ensemble_leaves(model)
    points = {r["FLIGHT_ID"]: [r[c] for c in FIVE] for r in test.collect()}
    if raw is not None:
        want = {r["FLIGHT_ID"]: r["raw"] for r in model.transform(test).withColumn("raw", raw).collect()}
    else:
        want = {k: tree_value(leaves, set(range(5)), x) for k, x in points.items()}
        p1 = {r["FLIGHT_ID"]: r["p"] for r in model.transform(test).withColumn("p", models.positive_probability()).collect()}
        assert {k: 1 / (1 + np.exp(-2 * v)) for k, v in want.items()} == pytest.approx(p1)
    assert sums == pytest.approx(want)
    key, x = next(iter(points.items()))
    phi = {r["feature"]: r["phi"] for r in found.where(F.col("FLIGHT_ID") == key).collect()}
    for i, name in enumerate(FIVE):
        others = [j for j in range(5) if j != i]
        exact = sum(factorial(len(s)) * factorial(4 - len(s)) / factorial(5)
                    * (tree_value(leaves, {*s, i}, x) - tree_value(leaves, set(s), x))
                    for n in range(5) for s in combinations(others, n))
        assert phi[name] == pytest.approx(exact, abs=1e-9)


def test_sampled_attributions_of_a_linear_score(rows):
    """On a linear score every permutation gives w * (x - background mean)."""
    weights = [1.0, -2.0, 0.5, 3.0, 0.0]
    sample = split.sample_n(part(rows, "test").drop("features"), 5, "FLIGHT_ID")
    background = part(rows, "train")

    def predict(df):
        return df.withColumn("score", sum((F.col(c) * w for c, w in zip(FIVE, weights)), F.lit(1.0)))

    found = explain.sampled_shap(sample, "FLIGHT_ID", FIVE, predict, background, "FLIGHT_ID", 10).collect()
    drawn = split.sample_n(background, 10, "FLIGHT_ID").toPandas()
    assert len(found) == 25
    for r in found:
        j = FIVE.index(r["feature"])
        assert r["phi"] == pytest.approx(weights[j] * (r["value"] - drawn[r["feature"]].mean()), abs=1e-9)
        assert r["base"] == pytest.approx(1.0 + sum(w * drawn[c].mean() for c, w in zip(FIVE, weights)))


def test_components(rows):
    scaling, model, count = models.fit_pca(rows, FIVE, 0.95)
    assert 1 <= count <= 5
    out = models.apply_pca(rows.drop("features"), FIVE, scaling, model, count)
    assert out.count() == rows.count() and set(FIVE) <= set(out.columns)
    variance = models.explained_variance_table(rows, model).orderBy("component").collect()
    assert variance[-1]["cumulative"] == pytest.approx(1.0)
    assert out.agg(F.abs(F.corr("PC1", "PC2"))).first()[0] < 1e-6
    table = models.component_table(rows, model, FIVE, count)
    biggest = table.groupBy("component").agg(F.max_by("loading", F.abs("loading")).alias("v")).collect()
    assert all(r["v"] > 0 for r in biggest)
    unit = rows.sparkSession.createDataFrame([(1, 2.0)], "component int, weight double")
    back = {r["column"]: r["importance"] for r in explain.pca_back_projection(table, unit).collect()}
    first = {r["column"]: r["loading"] for r in table.where("component = 1").collect()}
    assert back == pytest.approx({c: 2 * v for c, v in first.items()})


def test_store_and_stream(spark, rows, tables, tmp_path):
    train = part(rows, "train")
    raw = tables.late.select("FLIGHT_ID", "LATE", *FIVE)
    model, reused = stores.load_or_fit(raw, str(tmp_path), "m", {"k": 3},
                                       lambda d: models.scaler_pca_logistic(d, FIVE, "LATE", 3))
    again, second = stores.load_or_fit(raw, str(tmp_path), "m", {"k": 3}, lambda d: pytest.fail("fitted again"))
    assert (reused, second) == (False, True)
    a = models.score(raw, model).select("FLIGHT_ID", "probability_1")
    assert a.exceptAll(models.score(raw, again).select("FLIGHT_ID", "probability_1")).isEmpty()
    source = stores.write_table(raw.repartition(3), str(tmp_path / "in"))
    stream = landed_stream(spark, source, spark.read.parquet(source).schema, files_per_trigger=1)
    for _ in range(2):  # a restart continues from the checkpoint and repeats nothing
        score_stream(stream, model, str(tmp_path / "out"), str(tmp_path / "mark"), ["FLIGHT_ID"], once=True).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.select("FLIGHT_ID", "probability_1").exceptAll(a).isEmpty() and out.count() == a.count()
    assert train.count() > 0


def test_fold_scores_and_summary(rows):
    settings = search.combinations({"c": [0.1, 1.0]})
    scores = search.fold_scores(rows.select("FLIGHT_ID", "LATE", "fold", "features"), settings, 3, "LATE",
                                lambda d, s: models.logistic(d, "LATE", s["c"], max_iter=20))
    assert scores.count() == 6
    summary = evaluate.cv_summary(scores).collect()
    assert sum(r["is_best"] for r in summary) == 1


def test_the_five_measure_model_reads_flights_once_and_leaves_no_copy(tables, monkeypatch):
    from delaylens.catalog import learning

    real, seen = models.scaler_pca_logistic, []

    def watched(train, *more):
        plan = train._jdf.queryExecution().optimizedPlan().toString()
        seen.append((plan.count("Relation"), plan.count("Join"), sorted(train.columns), train.inputFiles()[0].rpartition("/")[0]))
        return real(train, *more)

    monkeypatch.setattr(models, "scaler_pca_logistic", watched)
    flights = tables.flights
    fitted = learning.five_measure_model(tables)
    assert [s[:3] for s in seen] == [(1, 0, sorted(["LATE", *FIVE]))]
    assert not stores.path_exists(tables.spark, seen[0][3])
    same = real(complete_rows(tables.late.select("LATE", *FIVE)), FIVE, "LATE", 5)
    a, b = (models.score(flights.select("FLIGHT_ID", *FIVE), m).agg(F.sum("probability_1"), F.sum("predicted")).first() for m in (fitted, same))
    assert tuple(a) == pytest.approx(tuple(b), rel=1e-9)


def test_the_logistic_study_keeps_neither_dummies_nor_vectors(tables, monkeypatch):
    from delaylens.plans import logistic_study

    kept, real = [], logistic_study.spread
    monkeypatch.setattr(logistic_study, "spread", lambda df: kept.append(real(df)) or kept[-1])
    columns = logistic_study.COLUMN_SETS["minimal"]
    train, test, features, last = logistic_study._parts(tables.flights, columns, 42)
    assert [sorted(k.columns) for k in kept] == [sorted(["FLIGHT_ID", "DELAY_STATUS", *columns]), sorted(["DELAY_STATUS", "split", *columns])]
    assert last.is_cached and not kept[0].is_cached
    wide, names = logistic_study.column_set(logistic_study.study_frame(tables.flights), columns)
    assert features == names and train.first()["features"].size == len(names)
    assert train.count() + test.count() == wide.count()
    last.unpersist()
