"""The paths that only large data takes, forced on small data and compared with brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens.operators import encode, evaluate, scale, split


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key."""
    rng = np.random.default_rng(1)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 41}", float(np.round(rng.normal(), 2)), int(rng.random() < 0.3))
            for i in range(3000)]
    return spark.createDataFrame(rows, "id int, k string, x double, y int").repartition(5).persist()


def test_running_totals_ranged_equals_window(spark, skewed):
    table = skewed.groupBy("k", "x").agg(F.count("*").alias("n"))
    small = scale.running_totals(table, ["x"], ["n"], ["k"])
    large = scale.running_totals(table, ["x"], ["n"], ["k"], max_window_rows=50)
    assert sorted(small.collect()) == sorted(large.select(small.columns).collect())


def test_null_group_on_both_paths(skewed):
    rows = skewed.withColumn("g", F.when(F.col("id") % 3 > 0, F.col("id") % 3))
    for limit in (scale.WINDOW_ROWS, 20):
        found = {r["g"]: r for r in evaluate.roc_auc(rows, "y", "x", by=["g"], max_window_rows=limit).collect()}
        assert set(found) == {None, 1, 2}
        own = [(r["y"], r["x"]) for r in rows.where("g IS NULL").collect()]
        assert [v for k, v in found[None].asDict().items() if k != "g"] == [pytest.approx(brute_auc(own))]


def test_quantiles_on_both_paths(skewed):
    x = np.array([r["x"] for r in skewed.collect()])
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    want = np.quantile(x, probabilities)
    assert scale.exact_quantiles(skewed, ["x"], probabilities)["x"] == pytest.approx(want)
    assert scale.exact_quantiles(skewed, ["x", "id"], probabilities, max_window_rows=100)["x"] == pytest.approx(want)
    assert scale.approximate_quantiles(skewed, ["x"], [0.5])["x"][0] == pytest.approx(np.median(x), abs=0.02)


def test_bounded_large_table_stays_distributed(spark, skewed):
    table = skewed.groupBy("k").agg(F.avg("x").alias("m"))
    assert "Hint broadcast" in scale.bounded(table)._jdf.queryExecution().logical().toString()
    kept = scale.bounded(table, max_rows=3)
    assert "Hint" not in kept._jdf.queryExecution().logical().toString()
    assert sorted(kept.collect()) == sorted(table.collect())


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_and_curves_on_both_paths(skewed):
    rows = [(r["y"], r["x"]) for r in skewed.collect()]
    for limit in (scale.WINDOW_ROWS, 60):
        assert evaluate.roc_auc(skewed, "y", "x", max_window_rows=limit).first()[0] == pytest.approx(brute_auc(rows))
        curve = sorted(evaluate.roc_curve(skewed, "y", "x", limit).collect(), key=lambda r: -r["threshold"])
        fpr, tpr = [r["fpr"] for r in curve], [r["tpr"] for r in curve]
        assert np.trapezoid(tpr, fpr) == pytest.approx(brute_auc(rows))
        assert (fpr[0], tpr[0], fpr[-1], tpr[-1]) == (0, 0, 1, 1)


def test_categories_on_both_paths(skewed):
    small = encode.fit_categories(skewed, "k")
    large = encode.fit_categories(skewed, "k", max_window_rows=7)
    assert sorted(small.collect()) == sorted(large.collect())
    assert sorted(r["code"] for r in large.collect()) == list(range(small.count()))


def test_stratified_cuts_are_exact(skewed):
    total = skewed.groupBy("y").count().collect()
    done = split.stratified_split(skewed, "y", "id", 0.15, 0.15)
    got = {(r["y"], r["split"]): r["n"] for r in done.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    for y, n in total:
        test = int(np.ceil(0.15 * n))
        val = int(np.ceil(0.15 * (n - test)))
        assert (got[y, "test"], got[y, "val"], got[y, "train"]) == (test, val, n - test - val)
    again = split.stratified_split(skewed.repartition(3), "y", "id", 0.15, 0.15)
    assert done.exceptAll(again).isEmpty()


def test_stratified_folds_are_even(skewed):
    folds = split.stratified_kfold(skewed, "y", "id", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in folds if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_split_moves_no_rows(skewed):
    """Applying the cuts adds a broadcast join, not a shuffle."""
    plan = split.stratified_split(skewed, "y", "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" in plan
    assert "Exchange hashpartitioning" not in plan.split("InMemoryRelation")[0]


def test_spread_keeps_rows(spark, skewed):
    assert scale.spread(skewed.coalesce(1).where("id > 10")).count() == 2989


def test_wide_scaling_plans_quickly(spark):
    """Scaling many columns of filtered rows must not blow up the optimizer."""
    import time

    columns = [f"c{i}" for i in range(40)]
    df = spark.range(200).select("id", *[(F.col("id") * (i + 1) % 17).cast("double").alias(c) for i, c in enumerate(columns)])
    from delaylens.operators.models import assemble

    begin = time.time()
    done = scale.complete_rows(df, columns)
    assert assemble(encode.standard_scale(done, columns), columns).count() == 200
    assert time.time() - begin < 60
