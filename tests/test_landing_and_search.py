"""Landing by manifest with rows set aside, and searches that go on where they stopped."""

import pytest
from pyspark.sql import functions as F, types as T

from delaylens.operators import search
from delaylens.sources import flights, stores

SCHEMA = T.StructType().add("FLIGHT_ID", T.StringType()).add("FL_DATE", T.DateType()).add("DISTANCE", T.DoubleType())


def batch(folder, name, lines):
    (folder / name).write_text("FLIGHT_ID,FL_DATE,DISTANCE\n" + "".join(f"{x}\n" for x in lines))
    return str(folder / name)


def held(spark, target):
    return sorted((r.FLIGHT_ID, r.FL_YEAR) for r in flights.landed_rows(spark, target, SCHEMA).collect())


def test_landing_sets_bad_rows_aside_and_replaces_whole_years(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "landed")
    assert held(spark, target) == [] and flights.quarantined_rows(spark, target).count() == 0
    first = batch(tmp_path, "a.csv", ["a,2020-01-01,1", "b,2020-02-01,far", "c,2021-01-01,", "d,,3", "e,2021-13-45,4"])
    assert flights.land_checked(spark, target, first, SCHEMA) == {"rows": 5, "quarantined": 3}
    assert held(spark, target) == [("a", 2020), ("c", 2021)]
    second = batch(tmp_path, "b.csv", ["x,2021-05-05,1", "y,2022-01-01,2"])
    assert flights.land_checked(spark, target, second, SCHEMA) == {"rows": 2, "quarantined": 0}
    after = [("a", 2020), ("x", 2021), ("y", 2022)]
    assert held(spark, target) == after
    records = [r.record for r in flights.quarantined_rows(spark, target).collect()]
    assert sorted(r for r in records if r) == ["b,2020-02-01,far", "e,2021-13-45,4"] and len(records) == 3
    # a landing that breaks off before its manifest changes nothing, nor does one that comes second
    with monkeypatch.context() as m:
        m.setattr(flights, "commit_manifest", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            flights.land_checked(spark, target, first, SCHEMA)
    with pytest.raises(RuntimeError):
        stores.commit_manifest(spark, target, {"parts": {}}, 2)
    assert held(spark, target) == after
    assert flights.land_checked(spark, target, batch(tmp_path, "c.csv", []), SCHEMA)["rows"] == 0
    assert held(spark, target) == after


class Rule:
    """A stand-in for a fitted model: the probability is x to a power."""

    def __init__(self, power):
        self.power = power

    def transform(self, df):
        p = F.pow("x", F.lit(self.power))
        return df.withColumns({"probability": F.array(1 - p, p), "prediction": (p > 0.5).cast("double")})


def test_search_resumes_and_notices_other_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "score", lambda df, model: model.transform(df).withColumns(
        {"probability_1": F.col("probability")[1], "predicted": F.col("prediction").cast("int")}))
    df = spark.createDataFrame([(i, i % 97 / 97, int(i % 97 > 40 + i % 11), i % 3) for i in range(300)], "id int, x double, y int, fold int")
    settings, made = [{"power": 1.0}, {"power": 2.0}, {"power": -1.0}], []

    def fit(data, setting):
        if len(made) == stop[0]:
            raise RuntimeError("executor gone")
        made.append((setting["power"], tuple(r[0] for r in data.select("fold").distinct().orderBy("fold").collect())))
        return Rule(setting["power"])

    ledger, stop = str(tmp_path / "ledger"), [4]
    job = (settings, 3, "y", fit, ledger, "s")
    with pytest.raises(RuntimeError):
        search.resumable_scores(df, *job, parallelism=1)
    stop[0] = None
    scores = search.resumable_scores(df, *job, parallelism=1)
    assert scores.count() == 9 and len(made) == 9 == len(set(made))
    assert sorted(search.resumable_scores(df.repartition(7), *job).collect()) == sorted(scores.collect()) and len(made) == 9
    assert search.best_setting(settings, scores) == {"power": 1.0}  # as good as its square, and earlier
    search.resumable_scores(df.withColumn("x", F.col("x") / 2), *job)
    assert len(made) == 18
    kept = search.resumable_scores(df, settings, 3, "y", fit, ledger, "other", keep=[1])
    assert len(made) == 18 + 5 and {r.params: r.n for r in kept.groupBy("params").agg(F.count("*").alias("n")).collect()} == {
        "power=1.0": 3, "power=2.0": 1, "power=-1.0": 1}
    assert search.best_setting(settings, kept) == {"power": 1.0}
    args = (df, settings, 3, "y", fit, str(tmp_path / "params"), ledger, "s")
    assert search.stored_or_searched(*args)[0] == {"power": 1.0} and search.stored_or_searched(*args) == ({"power": 1.0}, None)
    assert len(made) == 23


def test_a_search_scores_like_a_cross_validator_without_copies_of_its_folds(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    from delaylens.operators import models

    copied = []

    class Watched(LogisticRegression):
        def fitMultiple(self, dataset, paramMaps):
            copied.append(dataset.is_cached)
            return super().fitMultiple(dataset, paramMaps)

    rows = [(float(i % 7), float(i % 11), int(i % 7 + i % 3 > 4), i % 3) for i in range(300)]
    df = models.assemble(spark.createDataFrame(rows, "a double, b double, y int, fold int"), ["a", "b"]).persist()
    evaluator = BinaryClassificationEvaluator(labelCol="y", numBins=0)
    base = Watched(labelCol="y", maxIter=20)
    maps = search.param_maps(base, {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 1.0]})
    plain = CrossValidator(estimator=LogisticRegression(labelCol="y", maxIter=20), estimatorParamMaps=[
        {LogisticRegression.regParam: m[base.regParam], LogisticRegression.elasticNetParam: m[base.elasticNetParam]} for m in maps],
        evaluator=evaluator, numFolds=3, foldCol="fold").fit(df)
    model, best, table = search.grid_search(base, {}, df, evaluator, 3, maps=maps)
    found = table.collect()
    assert copied and not any(copied)
    assert [r["mean"] for r in found] == pytest.approx(plain.avgMetrics)
    assert [r["std"] for r in found] == pytest.approx(plain.stdMetrics)
    assert sum(r["is_best"] for r in found) == 1
    assert list(model.coefficients) == pytest.approx(list(plain.bestModel.coefficients))
    for wrong in (df.withColumn("fold", df["fold"] + 1), df.where("fold < 2"), df.selectExpr("* except (fold)", "nullif(fold, 1) fold")):
        with pytest.raises(ValueError):
            search.grid_search(base, {}, wrong, evaluator, 3, maps=maps)
    df.unpersist()
