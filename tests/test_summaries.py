"""Summaries that are merged: score cells and profile sketches, and ranks found by halves of a hash."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens.operators import curves, evaluate, scale, sketches


@pytest.fixture(scope="module")
def scored(spark):
    """Close scores, many ties, NULLs and scores outside [0, 1]."""
    rng = np.random.default_rng(5)
    s = np.concatenate([0.5 + rng.normal(size=3000) * 1e-5, np.full(900, 0.25), rng.random(2000)])
    rows = [(i, float(x), int(rng.random() < x)) for i, x in enumerate(s)]
    rows += [(i, x, y) for i, (x, y) in enumerate([(None, 1), (0.4, None), (0.3, 7)], len(rows))]
    return spark.createDataFrame(rows, "id int, s double, y int").repartition(4).persist()


def exact(rows):
    known = rows.where("s IS NOT NULL AND y IN (0, 1)")
    return evaluate.roc_auc(known, "y", "s").first()[0]


@pytest.mark.parametrize("tolerance", [1.0, 1e-3, 1e-6])
def test_auc_from_cells_is_within_its_bound(scored, tolerance):
    summary = curves.score_summary(scored, "y", "s", tolerance)
    found = curves.summary_auc(summary).first()
    assert found.bound <= tolerance and abs(found.roc_auc - exact(scored)) <= found.bound + 1e-12
    if tolerance < 1:
        assert summary.where("level > 0").count() > 0  # 3,000 scores lie in one or two cells of the first grid


def test_merged_cells_equal_those_of_all_rows(scored):
    a, b = scored.where("id % 3 = 0"), scored.where("id % 3 > 0")
    coarse = curves.merge_summaries([curves.score_summary(x, "y", "s", 1.0) for x in (a, b)])
    assert sorted(coarse.select("level", "cell", "lo", "hi", "p", "n").collect()) == sorted(curves.score_summary(scored, "y", "s", 1.0).collect())
    mixed = curves.merge_summaries([curves.score_summary(a, "y", "s", 1.0), curves.score_summary(b, "y", "s", 1e-6)])
    assert mixed.agg(F.sum("p"), F.sum("n")).first() == scored.where("s IS NOT NULL").agg(
        F.sum(F.when(F.col("y") == 1, 1)), F.sum(F.when(F.col("y") == 0, 1))).first()
    found = curves.summary_auc(mixed).first()
    assert abs(found.roc_auc - exact(scored)) <= found.bound + 1e-12


def test_points_from_cells_lie_on_the_exact_curves(scored):
    known = scored.where("s IS NOT NULL AND y IN (0, 1)")
    roc = {r.threshold: (r.fpr, r.tpr) for r in evaluate.roc_curve(known, "y", "s").collect()}
    precision = {r.threshold: r.precision for r in evaluate.precision_recall_curve(known, "y", "s").collect()}
    points = curves.summary_points(curves.score_summary(scored, "y", "s", 1e-4)).collect()
    assert len(points) > 500
    for r in points:
        assert (r.fpr, r.tpr) == pytest.approx(roc[r.threshold]) and r.precision == pytest.approx(precision[r.threshold])


def test_scores_outside_the_grid_and_no_rows(spark):
    rows = spark.createDataFrame([(-2.0, 0), (-1.0, 1), (3.0, 1), (1.0, 0), (float("nan"), 1)], "s double, y int")
    found = curves.summary_auc(curves.score_summary(rows, "y", "s", 0.0)).first()
    assert 0 < found.bound < 1 and abs(found.roc_auc - exact(rows)) <= found.bound
    assert curves.summary_auc(curves.score_summary(rows.limit(0), "y", "s")).first().asDict() == {"roc_auc": None, "bound": None}


def test_sketches_of_parts_equal_sketches_of_the_whole(spark):
    rng = np.random.default_rng(6)
    rows = [(int(d) if d < 3 else None, float(x), None if x < 0 else int(1000 * x), f"v{int(abs(x) * 3)}", None)
            for d, x in zip(rng.integers(0, 4, 6000), rng.normal(size=6000))]
    df = spark.createDataFrame(rows, "day int, x double, k int, t string, none double").repartition(3)
    parts = sketches.sketch_parts(df, "day")
    assert {r.part for r in parts.select("part").distinct().collect()} == {0, 1, 2, None}
    merged = sketches.merge_parts(parts)
    found = {r.column: r for r in sketches.profile_of(merged).collect()}
    x = np.array([r[1] for r in rows])
    assert found["x"]["count"] == 6000 and found["x"].mean == pytest.approx(x.mean()) and found["x"].std == pytest.approx(x.std(ddof=1))
    assert abs(found["x"].distinct - 6000) <= 0.05 * 6000
    for p in (25, 50, 75):
        assert abs((x <= found["x"][f"q{p}"]).mean() - p / 100) <= sketches.RANK_ERROR
    assert found["k"].nulls == sum(r[2] is None for r in rows) and found["none"]["count"] == 0 and found["none"].q50 is None
    whole = {r.column: r for r in sketches.profile_of(sketches.merge_parts(sketches.sketch_parts(df.withColumn("day", F.lit(1)), "day"))).collect()}
    assert all(whole[c].distinct == found[c].distinct for c in found)  # registers of parts add up to those of the whole
    counts = {v: sum(r[3] == v for r in rows) for v in {r[3] for r in rows}}
    top = [(r.value, r.n) for r in sketches.frequent_values(merged, 3).collect()]
    assert sorted(top) == sorted(sorted(counts.items(), key=lambda c: -c[1])[:3])


def test_stored_parts_are_not_read_again(spark, tmp_path):
    df = spark.createDataFrame([(d, float(i)) for d in (1, 2, None) for i in range(50)], "day int, x double")
    folder = str(tmp_path / "profile")
    assert sketches.update_parts(spark, folder, df.where("day = 1"), "day") == [1]
    changed = df.withColumn("x", F.when(F.col("day") == 1, F.lit(1e9)).otherwise(F.col("x")))  # would show if read
    assert sketches.update_parts(spark, folder, changed, "day") == [2, None]
    assert sketches.update_parts(spark, folder, changed, "day") == []
    found = sketches.profile_of(sketches.stored_profile(spark, folder)).first()
    assert (found["count"], found.max) == (150, 49.0)


def test_cuts_in_one_bucket_one_hash_and_one_key(spark):
    """All rows share the upper half of the hash, half of them the whole hash, a third the key as well."""
    rows = [(("a" if i % 2 else None), (7 << 16) + (i % 50 if i % 4 > 1 else 3), "hot" if i % 3 == 0 else f"k{i % 400:03d}") for i in range(4000)]
    df = spark.createDataFrame(rows, "stratum string, u long, k string").repartition(4)
    wanted = F.array(F.lit(1), F.ceil(F.col("size") / 3), F.ceil(F.col("size") * 0.9), F.col("size"))
    found = {r["__stratum"]: r["__cuts"] for r in scale.rank_cuts(df, "k", "stratum", "u", wanted).collect()}
    for s in ("a", None):
        own = sorted((u, k) for t, u, k in rows if t == s)
        places = [1, math.ceil(len(own) / 3), math.ceil(len(own) * 0.9), len(own)]
        assert [(found[s][i].u, found[s][i].k) for i in range(4)] == [own[p - 1] for p in places]
