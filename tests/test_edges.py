"""Null, empty and odd values."""

import datetime
from types import SimpleNamespace

import pytest
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F, types as T

from delaylens.functions import times
from delaylens.operators import clean, encode, evaluate, features as fx, lookup, report, split
from delaylens.sources import stores
from delaylens.sources.flights import CORRUPT, flights_schema, nan_to_null, read_flights


def one(df):
    return df.first()[0]


def values(df, column=None):
    return [r[column] if column else r[0] for r in df.collect()]


def test_clock_edges(spark):
    df = spark.createDataFrame([(0,), (2359,), (2400,), (None,)], "t int")
    rows = df.select(times.hhmm_to_minutes("t"), times.hour_of_hhmm("t"),
                     times.time_slot(times.hhmm_to_minutes("t")), times.time_of_day(times.hour_of_hhmm("t"))).collect()
    assert [tuple(r) for r in rows] == [
        (0, 0, "Early Morning", "late_night"), (1439, 23, "Evening", "late_night"),
        (1440, 24, "Evening", "late_night"), (None, None, None, "late_night")]


def test_slot_borders(spark):
    df = spark.createDataFrame([(360,), (361,), (720,), (1080,), (1081,), (1441,)], "m int")
    assert values(df.select(times.time_slot("m"))) == [
        "Early Morning", "Morning", "Morning", "Afternoon", "Evening", None]


@pytest.mark.parametrize("text, city, state", [
    ("Aspen, CO", "Aspen", "CO"), ("Nowhere", "Nowhere", None), ("A , B, C", "A", "B, C"), (None, None, None)])
def test_city_state(spark, text, city, state):
    df = spark.createDataFrame([(text,)], "ORIGIN_CITY string")
    row = fx.split_city_state(df, ["ORIGIN_CITY"]).first()
    assert (row["ORIGIN_CITY_CITY"], row["ORIGIN_CITY_STATE"]) == (city, state)


def test_unreadable_text(spark):
    df = spark.createDataFrame([("abc", "not a date"), ("2.5", "2024-02-29"), (None, None)], "x string, d string")
    out = clean.coerce_numeric(df, ["x"]).select("x", times.parse_date("d")).collect()
    assert [tuple(r) for r in out] == [(None, None), (2.5, datetime.date(2024, 2, 29)), (None, None)]
    assert values(clean.cast_columns(df, {"x": "int"}), "x") == [None, None, None]


def test_label_variants(spark):
    df = spark.createDataFrame([(15.0,), (16.0,), (-15.0,), (None,)], "d double")
    assert values(df.select(times.over_threshold("d"))) == [0, 1, 0, 0]
    assert values(df.select(times.over_threshold("d", ">=", -15))) == [1, 1, 1, 0]
    assert values(df.select(times.over_threshold("d", null_as=1))) == [0, 1, 0, 1]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(200.0,), (None,)], "d double")
    assert values(df.select(times.clip_upper("d", 120))) == [120.0, None]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None)], "x double, s string")
    assert values(nan_to_null(df), "x") == [None, 1.0]


def test_csv_with_bad_fields(spark, tmp_path):
    (tmp_path / "f.csv").write_text("FL_DATE,AIRLINE\n2024-01-02,AA\nnonsense,BB\n")
    schema = T.StructType([T.StructField("FL_DATE", T.DateType()), T.StructField("AIRLINE", T.StringType())])
    rows = read_flights(spark, str(tmp_path), schema, keep_corrupt=True).orderBy("AIRLINE").collect()
    assert rows[0]["FL_DATE"] == datetime.date(2024, 1, 2) and rows[0][CORRUPT] is None
    assert rows[1]["FL_DATE"] is None and "nonsense" in rows[1][CORRUPT]
    assert flights_schema("K").names[0] == "K"


def test_iqr_edges(spark):
    constant = spark.createDataFrame([(5.0,)] * 4 + [(None,), (9.0,)], "x double")
    assert sorted(values(clean.remove_outliers_iqr(constant, "x", 1.5))) == [5.0] * 4
    assert values(clean.select_outliers_iqr(constant, "x", 1.5)) == [9.0]
    nothing = spark.createDataFrame([(None,)], "x double")
    assert clean.remove_outliers_iqr(nothing, "x").count() == 0
    assert clean.remove_outliers_iqr_all(nothing, ["x"]).count() == 0
    assert clean.remove_outliers_iqr(nothing.limit(0), "x").count() == 0


def test_sequential_and_joint_fences_differ(spark):
    rows = [(float(i), float(i % 7)) for i in range(60)] + [(1000.0, 3.0), (30.0, 500.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    for mode in ("sequential", "joint"):
        kept = clean.remove_outliers_iqr_all(df, ["a", "b"], mode=mode)
        assert kept.agg(F.max("a"), F.max("b")).first() == (59.0, 6.0)
    approx = clean.remove_outliers_iqr_all(df, ["a", "b"], approx=True)
    assert approx.count() == 60


def test_all_null_and_audit(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert clean.drop_all_null_columns(df).columns == ["a"]
    assert dict(clean.null_audit(df).collect()) == {"a": 1, "b": 2}


def test_require(spark):
    df = spark.createDataFrame([(1,), (1,)], "y int")
    with pytest.raises(ValueError, match="missing"):
        clean.require(df, ["z"])
    with pytest.raises(ValueError, match="no rows"):
        clean.require(df.limit(0), non_empty=True)
    with pytest.raises(ValueError, match="classes"):
        clean.require(df, label="y")


def test_align_schema_and_report(spark):
    df = spark.createDataFrame([(1, 2)], "b int, c int")
    want = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    assert clean.align_schema(df, want).schema == want
    assert {tuple(r) for r in clean.schema_difference(df, want).collect()} == {
        ("a", "missing", 0), ("b", "moved", 1), ("c", "extra", 1)}
    assert clean.keep_numeric(df)[1] == []


def test_elapsed_without_column_is_unchanged(spark):
    df = spark.createDataFrame([(1.0,)], "CRS_ELAPSED_TIME double")
    assert fx.elapsed_time_diff(df, "ACTUAL_ELAPSED_TIME") is df


def test_congestion_brute_force_and_nulls(spark):
    rows = [(i, "2024-01-01" if i % 3 else "2024-01-02", None if i == 5 else "A", None if i == 7 else (i * 37) % 24 * 100)
            for i in range(60)]
    df = spark.createDataFrame(rows, "id int, FL_DATE string, ORIGIN string, CRS_DEP_TIME int")
    got = {r["id"]: r["RACI"] for r in fx.airport_congestion(df).collect()}

    def near(a):
        if a[2] is None or a[3] is None:
            return 0
        return sum(b[1] == a[1] and b[2] == a[2] and b[3] is not None
                   and abs(b[3] // 100 - a[3] // 100) * 60 <= 60 for b in rows)

    assert got == {a[0]: near(a) for a in rows}


def test_group_scores_for_unseen_and_null(spark):
    train = spark.createDataFrame([("A", 1, 10.0), ("A", 0, -5.0), ("B", 0, 20.0), (None, 1, 30.0)],
                                  "ORIGIN string, y int, ARR_DELAY double")
    new = spark.createDataFrame([("A",), ("Z",), (None,)], "ORIGIN string")
    assert values(fx.delay_propensity(new, "y", fit_on=train), "ADP") == [0.5, 0.5, 0.5]
    assert values(fx.delay_severity(new, fit_on=train), "HDS") == [10.0, 20.0, 20.0]


def test_woe_edges(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("a", 1), ("b", 0), (None, 1), (None, 0)], "c string, y int")
    fitted = encode.fit_woe(train, ["c"], "y")
    new = spark.createDataFrame([("a",), ("b",), ("zzz",), (None,)], "c string")
    got = values(encode.apply_woe(new, ["c"], fitted), "c_WOE")
    import math
    assert got[0] == pytest.approx(math.log((3 / 5) / (2 / 5))) and got[1] == 0.0 and got[2] == 0.0
    assert got[3] == pytest.approx(math.log((2 / 5) / (2 / 5)))


def test_encoders_on_unseen(spark):
    train = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "c string")
    new = spark.createDataFrame([("y",), ("q",), (None,)], "c string")
    fitted = encode.fit_categories(train, "c")
    assert values(encode.label_encode(new, "c", fitted)) == [1, -1, -1]
    assert [tuple(r) for r in encode.one_hot(new, "c", fitted).collect()] == [(0, 1, 0), (0, 0, 0), (0, 0, 0)]
    assert [tuple(r) for r in encode.binary_encode(new, ["c"], {"c": fitted}).collect()] == [(1, 0), (0, 0), (0, 0)]
    vec = encode.one_hot(new, "c", fitted, form="vector").collect()
    assert [r[0].toArray().tolist() for r in vec] == [[0, 1, 0], [0, 0, 0], [0, 0, 0]]
    first = spark.createDataFrame([("x",), ("y",), ("z",), ("q",)], "c string")
    vec = encode.one_hot(first, "c", fitted, drop_first=True, form="vector").collect()
    assert [r[0].toArray().tolist() for r in vec] == [[0, 0], [1, 0], [0, 1], [0, 0]]
    assert [tuple(r) for r in encode.one_hot(first, "c", fitted, drop_first=True).collect()] == [(0, 0), (1, 0), (0, 1), (0, 0)]


def test_the_place_of_a_one_is_read_from_a_sparse_vector_as_it_is(spark):
    from pyspark.ml.linalg import Vectors

    wide = 2 ** 31 - 1  # 16 GB written out
    rows = [(Vectors.sparse(wide, [wide - 7], [1.0]),), (Vectors.sparse(wide, [3, 9], [2.0, 1.0]),), (Vectors.sparse(wide, [], []),),
            (Vectors.dense([0.0, 0.0, 1.0]),), (Vectors.dense([0.0]),), (None,)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("v", VectorUDT())]))
    assert values(df.select(encode.hot_place("v"))) == [wide - 7, 9, -1, 2, -1, None]


def test_queries_of_one_hot_vectors_do_not_write_them_out(spark):
    from delaylens.catalog.encoders import f2_sparse, f3_vector

    flights = spark.createDataFrame([("a", 7), ("b", 5), ("c", None), ("d", 7)], "FLIGHT_ID string, FL_NUMBER int")
    for query, expected in ((f2_sparse, {"a": 1, "b": 0, "c": -1, "d": 1}), (f3_vector, {"a": 0, "b": None, "c": None, "d": 0})):
        found = query(SimpleNamespace(spark=spark, flights=flights))
        assert {r["FLIGHT_ID"]: r["hot"] for r in found.collect()} == expected
        assert "vector_to_array" not in found._jdf.queryExecution().analyzed().toString()


def test_one_hot_has_one_schema_for_any_number_of_categories(spark):
    many = spark.range(300).selectExpr("CAST(id AS STRING) AS c", "id")
    wide = encode.dummies_drop_first(many, ["c"])
    assert len(wide.columns) == 300 and "c_vec" not in wide.columns
    assert sum(wide.where("id = 7").first()[1:]) == 1 and sum(wide.where("id = 0").first()[1:]) == 0
    narrow = encode.dummies_drop_first(many, ["c"], form="vector")
    assert narrow.columns == ["id", "c_vec"] and narrow.first()["c_vec"].size == 299


def test_ordinal_encode(spark):
    new = spark.createDataFrame([("y",), ("q",), (None,)], "c string")
    assert values(encode.ordinal_encode(new, "c", ["x", "y"])) == [1, -1, None]


def test_scaling_edges(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0, 0.5), (3.0, 5.0, 1, 0.1), (None, 5.0, 1, 0.2)],
                               "x double, k double, flag int, t_SIN double")
    assert encode.scalable_columns(df) == ["x", "k"]
    out = encode.standard_scale(df)
    assert values(out, "x") == [-1.0, 1.0, None] and values(out, "k") == [0.0, 0.0, 0.0]
    assert values(encode.impute_mean(df, ["x"]), "x") == [1.0, 3.0, 2.0]


def test_histogram_constant_and_null(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (None, 7.0)], "a double, b double")
    assert {tuple(r) for r in report.histogram(df, ["a", "b"]).collect()} == {("a", 0, 1), ("a", 19, 1), ("b", 0, 3)}


def test_correlation_edges(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.3, None), (2.0, 4.0, 0.3, 1.0), (3.0, 6.5, 0.3, None)],
                               "a double, b double, k double, s double")
    found = {(r[2], r[3]): r[4] for r in report.correlation_matrix(df).collect()}
    assert found["a", "b"] == pytest.approx(0.9979487) and found["a", "k"] is None and found["a", "s"] is None
    left, dropped = report.drop_correlated(df, 0.9)
    assert dropped == ["b"] and left.columns == ["a", "k", "s"]
    assert all(r[4] is None for r in report.correlation_matrix(df.limit(0)).collect())


def test_reports_on_empty_and_ties(spark):
    empty = spark.createDataFrame([], "AIRLINE string, ARR_DELAY double")
    assert report.avg_delay_by_airline(empty).count() == 0
    row = report.avg_delay_insights(empty, 1).first()
    assert row["worst"] is None and row["delayed_pct"] is None
    ties = spark.createDataFrame([("b", 1.0), ("a", 1.0)], "k string, v double")
    assert report.extreme_group(ties, "k", "v").first()[:3] == ("a", 1.0, "a")
    assert values(report.top_by_absolute(ties, "v", "k", 1)) == ["a"]


def test_profile_alerts(spark):
    df = spark.createDataFrame([(1, 0.0, "a"), (1, None, "b"), (1, 2.0, "c")], "k int, x double, s string")
    stats = report.profile(df)
    alerts = {tuple(r) for r in report.profile_alerts(stats, 3).collect()}
    assert {("k", "constant"), ("x", "missing"), ("x", "zeros"), ("s", "unique")} <= alerts


def test_metrics_edges(spark):
    single = spark.createDataFrame([(0, 0, 0.2), (0, 0, 0.9)], "y int, p int, s double")
    got = {r["Metric"]: r["Value"] for r in evaluate.classification_metrics(single, "y", "p", "s").collect()}
    assert got == {"Accuracy": 1.0, "Precision": 0.0, "Recall": 0.0, "F1 Score": 0.0, "ROC AUC": 0.0}
    tied = spark.createDataFrame([(0, 0.5), (1, 0.5)], "y int, s double")
    assert one(evaluate.roc_auc(tied, "y", "s")) == 0.5
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y double, p double")
    assert evaluate.regression_metrics(flat, "y", "p").first()["R2"] == 0.0
    assert {tuple(r) for r in evaluate.confusion_matrix(single, "y", "p").collect()} == {
        (0, 0, 2), (0, 1, 0), (1, 0, 0), (1, 1, 0)}


def test_lookup_default_and_shared_column_names(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    fitted = spark.createDataFrame([("a", 9)], "k string, v int")
    assert values(lookup.lookup_map(df, "k", fitted, {"v": "w"}, defaults={"w": -1}), "w") == [9, -1, -1]
    assert values(lookup.lookup_map(df, "k", fitted, {"v": "w"}), "w") == [9, None, None]


def test_two_way_split_when_a_side_has_one_class(spark):
    df = spark.createDataFrame([(f"k{i}", int(i == 0)) for i in range(30)], "k string, y int")
    assert set(values(split.split_or_two_way(df, "y", "k").select("split").distinct())) == {"test", "train"}


def test_stores(spark, tmp_path):
    path = str(tmp_path / "params")
    assert stores.get_best_params(spark, path, "m") is None
    stores.save_best_params(spark, path, "m", {"C": 1})
    stores.save_best_params(spark, path, "m", {"C": 10})
    assert stores.get_best_params(spark, path, "m") == {"C": "10"}
    assert stores.load_model(spark, str(tmp_path), "absent") is None
    assert stores.load_fitted(spark, str(tmp_path), "absent") is None
    table = spark.createDataFrame([("a", 1)], "k string, v int")
    stores.save_fitted(table, str(tmp_path), "t")
    assert stores.load_fitted(spark, str(tmp_path), "t").collect() == table.collect()
