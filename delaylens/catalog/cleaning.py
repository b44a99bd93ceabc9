"""Sources, sinks, filters, casts and outlier rules."""

from pyspark.sql import functions as F, types as T

from ..operators import clean, report
from ..operators.scale import hash_uniform
from ..sources import stores
from ..sources.flights import DELAY_CAUSES, flights_schema, land_checked, landed_rows, quarantined_rows, read_flights
from .base import HASH, LATE, PREDICTIONS, SEED, Tables, q6, query, r6

ALL = [f.name for f in flights_schema("FLIGHT_ID")]
ALL_SQL = ", ".join("CAST(FL_DATE AS VARCHAR) AS FL_DATE" if c == "FL_DATE" else c for c in ALL)


def all_columns(df):
    return df.select(*[F.col(c).cast("string").alias(c) if c == "FL_DATE" else c for c in ALL])


@query("a1_read_flights_csv", f"SELECT {ALL_SQL} FROM flights")
def a1(t: Tables):
    path = stores.write_table(t.flights, stores.scratch_path(t.spark, "flights_csv"), "csv")
    return all_columns(read_flights(t.spark, path, flights_schema("FLIGHT_ID")))


@query("a2_write_table", "SELECT FLIGHT_ID, CAST(FL_DATE AS VARCHAR) AS FL_DATE, ARR_DELAY, "
                         "CAST(year(FL_DATE) AS INT) AS FL_YEAR FROM flights")
def a2(t: Tables):
    rows = t.flights.select("FLIGHT_ID", "FL_DATE", "ARR_DELAY", F.year("FL_DATE").alias("FL_YEAR"))
    path = stores.write_table(rows, stores.scratch_path(t.spark, "flights"), partition_by=["FL_YEAR"])
    return t.spark.read.parquet(path).select("FLIGHT_ID", F.col("FL_DATE").cast("string"), "ARR_DELAY", "FL_YEAR")


@query("a3_land_dataset", "SELECT CAST(year(FL_DATE) AS INT) AS FL_YEAR, count(*) AS n, "
                          "count(ARR_DELAY) AS known FROM flights GROUP BY 1")
def a3(t: Tables):
    target = stores.scratch_path(t.spark, "landed")
    for _ in range(2):  # the second call finds the finished copy
        stores.land_dataset(t.spark, target, lambda: t.flights)
    landed = t.spark.read.parquet(target)
    return landed.groupBy("FL_YEAR").agg(F.count("*").alias("n"), F.count("ARR_DELAY").alias("known"))


@query("a3_land_checked", f"""
, d AS (SELECT year(FL_DATE) AS y, ARR_DELAY, {HASH} % 20 AS h, {HASH} % 3 AS batch FROM flights)
SELECT *, set_aside AS counted FROM (SELECT CAST(y AS INT) AS FL_YEAR, count(*) AS n, count(ARR_DELAY) AS known,
  (SELECT count(*) FROM d WHERE h = 0 AND batch = 0) + (SELECT count(*) FROM d WHERE h = 0 AND y = 1997) AS set_aside
  FROM d WHERE h > 0 AND (batch = 0 OR y = 1997) GROUP BY y)""")
def a3_checked(t: Tables):
    """Files in which every twentieth row has text in place of its distance: a third of the rows, then all of 1997."""
    schema = flights_schema("FLIGHT_ID")
    h = hash_uniform("FLIGHT_ID", SEED)
    rows = t.flights.select(schema.fieldNames()).withColumn("DISTANCE", F.when(h % 20 == 0, "far").otherwise(F.col("DISTANCE").cast("string")))
    target, found = stores.scratch_path(t.spark, "checked"), 0
    for part in (rows.where(h % 3 == 0), rows.where(F.year("FL_DATE") == 1997)):
        path = stores.write_table(part, stores.scratch_path(t.spark, "batch_csv"), "csv")
        found += land_checked(t.spark, target, path, schema)["quarantined"]
    aside = quarantined_rows(t.spark, target).where(F.col("record").contains("far"))
    years = landed_rows(t.spark, target, schema).groupBy("FL_YEAR").agg(F.count("*").alias("n"), F.count("ARR_DELAY").alias("known"))
    return years.withColumns({"set_aside": F.lit(aside.count()).cast("long"), "counted": F.lit(found).cast("long")})


@query("a4_head", "SELECT FLIGHT_ID, ARR_DELAY FROM flights ORDER BY FLIGHT_ID LIMIT 1000")
def a4(t: Tables):
    return report.head(t.flights, 1000, "FLIGHT_ID").select("FLIGHT_ID", "ARR_DELAY")


@query("a6_best_params", "SELECT AIRLINE AS model, CAST(CAST(max(ARR_DELAY) AS INT) AS VARCHAR) AS threshold "
                         "FROM flights GROUP BY AIRLINE")
def a6(t: Tables):
    path = stores.scratch_path(t.spark, "params")
    for measure in (F.min("ARR_DELAY"), F.max("ARR_DELAY")):  # the later rows win
        found = t.flights.groupBy(F.col("AIRLINE").alias("model")).agg(measure.cast("int").cast("string").alias("v"))
        stores.append_best_params(found.select("model", F.create_map(F.lit("threshold"), "v").alias("params")), path)
    return stores.load_best_params(t.spark, path).select("model", F.col("params")["threshold"].alias("threshold"))


@query("a7_run_metrics", PREDICTIONS + f"""
SELECT AIRLINE AS model, 'Test' AS stage, 'Accuracy' AS metric,
       {q6("avg(CASE WHEN label = prediction THEN 1 ELSE 0 END)")} AS value FROM pred GROUP BY AIRLINE""")
def a7(t: Tables):
    path = stores.scratch_path(t.spark, "run_metrics")
    hit = F.avg((F.col("label") == F.col("prediction")).cast("int"))
    records = t.predictions.groupBy("AIRLINE").agg(hit.alias("Value")).select(
        F.col("AIRLINE").alias("Model"), F.lit("Test").alias("Stage"), F.lit("Accuracy").alias("Metric"), "Value")
    stores.log_metrics(records, path, "run-1")
    log = stores.read_metrics(t.spark, path).where(F.col("run_id") == "run-1")
    return log.select("model", "stage", "metric", r6("value").alias("value"))


@query("b1_filter_not_cancelled", "SELECT FLIGHT_ID, CANCELLED, ARR_DELAY FROM flights WHERE CANCELLED = 0")
def b1(t: Tables):
    return clean.filter_not_cancelled(t.flights).select("FLIGHT_ID", "CANCELLED", "ARR_DELAY")


@query("b2_filter_completed", "SELECT FLIGHT_ID, ARR_DELAY FROM flights WHERE CANCELLED = 0 AND DIVERTED = 0")
def b2(t: Tables):
    return clean.filter_completed(t.flights).select("FLIGHT_ID", "ARR_DELAY")


@query("b3_select_cancelled", "SELECT FLIGHT_ID, CANCELLATION_CODE FROM flights WHERE CANCELLED = 1")
def b3(t: Tables):
    return clean.select_cancelled(t.flights).select("FLIGHT_ID", "CANCELLATION_CODE")


@query("b4_exclude_columns", "SELECT FLIGHT_ID, " + ", ".join(DELAY_CAUSES) + " FROM flights")
def b4(t: Tables):
    unwanted = [c for c in ALL if c not in ("FLIGHT_ID", *DELAY_CAUSES)]
    return clean.exclude_columns(t.flights, unwanted + ["NOT_A_COLUMN"])


NUMERIC = [f.name for f in flights_schema() if not isinstance(f.dataType, (T.StringType, T.DateType))]


@query("b5_keep_numeric", f"SELECT {', '.join(NUMERIC)} FROM flights")
def b5(t: Tables):
    return clean.keep_numeric(t.flights)[0]


@query("b6_fill_delay_causes", "SELECT FLIGHT_ID, "
       + ", ".join(f"coalesce({c}, CAST(0 AS DOUBLE)) AS {c}" for c in DELAY_CAUSES) + " FROM flights")
def b6(t: Tables):
    return clean.fill_delay_causes(t.flights, DELAY_CAUSES).select("FLIGHT_ID", *DELAY_CAUSES)


@query("b7_drop_null_label", "SELECT FLIGHT_ID, ARR_DELAY FROM flights WHERE ARR_DELAY IS NOT NULL")
def b7(t: Tables):
    return clean.drop_null_label(t.flights, "ARR_DELAY").select("FLIGHT_ID", "ARR_DELAY")


@query("b8_drop_any_null", "SELECT FLIGHT_ID, DEP_DELAY, AIR_TIME FROM flights "
                           "WHERE DEP_DELAY IS NOT NULL AND AIR_TIME IS NOT NULL")
def b8(t: Tables):
    return clean.drop_any_null(t.flights, ["DEP_DELAY", "AIR_TIME"]).select("FLIGHT_ID", "DEP_DELAY", "AIR_TIME")


@query("b9_drop_all_null_columns", "SELECT FLIGHT_ID, DIVERTED FROM flights WHERE CANCELLED = 1")
def b9(t: Tables):
    cancelled = clean.select_cancelled(t.flights).select("FLIGHT_ID", "DEP_TIME", "ARR_DELAY", "DIVERTED")
    return clean.drop_all_null_columns(cancelled)


@query("b10_null_audit", "SELECT c.k AS \"column\", c.n AS nulls FROM (SELECT unnest(["
       + ", ".join(f"{{'k': '{c}', 'n': count(*) - count({c})}}" for c in ALL) + "]) AS c FROM flights)")
def b10(t: Tables):
    return clean.null_audit(t.flights)


@query("b11_coerce_numeric", "SELECT FLIGHT_ID, TRY_CAST(replace(AIRLINE, 'Brand#', '') AS DOUBLE) AS CODE, "
                             "TRY_CAST(ORIGIN AS DOUBLE) AS ORIGIN FROM flights")
def b11(t: Tables):
    rows = t.flights.select("FLIGHT_ID", F.replace("AIRLINE", F.lit("Brand#"), F.lit("")).alias("CODE"), "ORIGIN")
    return clean.coerce_numeric(rows, ["CODE", "ORIGIN"])


@query("b12_binary_target", f"""
SELECT FLIGHT_ID, {LATE} AS LATE,
       CASE WHEN ARR_DELAY > 10 THEN 1 ELSE 0 END AS LATE_REPORT,
       CASE WHEN ARR_DELAY >= -15 THEN 1 ELSE 0 END AS LATE_WIDE,
       CASE WHEN ARR_DELAY <= 15 THEN 0 ELSE 1 END AS LATE_OR_UNKNOWN FROM flights""")
def b12(t: Tables):
    out = clean.binary_target(t.flights, "ARR_DELAY", "LATE")
    out = clean.binary_target(out, "ARR_DELAY", "LATE_REPORT", threshold=10)
    out = clean.binary_target(out, "ARR_DELAY", "LATE_WIDE", ">=", -15)
    out = clean.binary_target(out, "ARR_DELAY", "LATE_OR_UNKNOWN", null_as=1)
    return out.select("FLIGHT_ID", "LATE", "LATE_REPORT", "LATE_WIDE", "LATE_OR_UNKNOWN")


def fence_sql(column: str, k: float, source: str = "flights") -> str:
    return (f"SELECT quantile_cont({column}, 0.25) - {k}e0 * (quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) AS lo, "
            f"quantile_cont({column}, 0.75) + {k}e0 * (quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) AS hi FROM {source}")


@query("b13_remove_outliers_iqr", f"""
, f AS ({fence_sql("ARR_DELAY", 3)})
SELECT FLIGHT_ID, ARR_DELAY FROM flights, f WHERE ARR_DELAY >= lo AND ARR_DELAY <= hi""")
def b13(t: Tables):
    return clean.remove_outliers_iqr(t.flights).select("FLIGHT_ID", "ARR_DELAY")


@query("b14_remove_outliers_iqr_all", f"""
, f1 AS ({fence_sql("DEP_DELAY", 1.5)}),
s1 AS (SELECT flights.* FROM flights, f1 WHERE DEP_DELAY BETWEEN lo AND hi),
f2 AS ({fence_sql("TAXI_OUT", 1.5, "s1")}),
s2 AS (SELECT s1.* FROM s1, f2 WHERE TAXI_OUT BETWEEN lo AND hi),
f3 AS ({fence_sql("ARR_DELAY", 1.5, "s2")})
SELECT FLIGHT_ID, DEP_DELAY, TAXI_OUT, ARR_DELAY FROM s2, f3 WHERE ARR_DELAY BETWEEN lo AND hi""")
def b14(t: Tables):
    columns = ["DEP_DELAY", "TAXI_OUT", "ARR_DELAY"]
    return clean.remove_outliers_iqr_all(t.flights.select("FLIGHT_ID", *columns), columns)


def fences_sql(columns: list[str], k: float) -> str:
    """Each column's fences on the rows that passed the columns before."""
    steps = "".join(f"""
, f{i} AS MATERIALIZED ({fence_sql(c, k, f"s{i - 1}" if i else "flights")}),
s{i} AS MATERIALIZED (SELECT r.* FROM {f"s{i - 1}" if i else "flights"} r, f{i} WHERE {c} BETWEEN lo AND hi)"""
                    for i, c in enumerate(columns))
    return f"{steps}\nSELECT FLIGHT_ID, {', '.join(columns)} FROM s{len(columns) - 1}"


@query("b14_remove_outliers_iqr_all_columns", fences_sql(NUMERIC, 1.5))
def b14_all_columns(t: Tables):
    return clean.remove_outliers_iqr_all(t.flights.select("FLIGHT_ID", *NUMERIC), NUMERIC)


@query("b14_remove_outliers_joint", f"""
, f1 AS ({fence_sql("l_quantity", 0.25, "lineitem")}), f2 AS ({fence_sql("l_extendedprice", 0.25, "lineitem")})
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem, f1, f2
WHERE l_quantity BETWEEN f1.lo AND f1.hi AND l_extendedprice BETWEEN f2.lo AND f2.hi""")
def b14_joint(t: Tables):
    columns = ["l_quantity", "l_extendedprice"]
    rows = t.table("lineitem").select("l_orderkey", "l_linenumber", *columns)
    return clean.remove_outliers_iqr_all(rows, columns, k=0.25, mode="joint")


@query("b15_select_outliers_iqr", f"""
, f AS ({fence_sql("ARR_DELAY", 1.5)})
SELECT FLIGHT_ID, ARR_DELAY FROM flights, f WHERE ARR_DELAY < lo OR ARR_DELAY > hi""")
def b15(t: Tables):
    return clean.select_outliers_iqr(t.flights).select("FLIGHT_ID", "ARR_DELAY")


@query("b16_clip_upper", "SELECT FLIGHT_ID, CASE WHEN DEP_DELAY > 120 THEN CAST(120 AS DOUBLE) ELSE DEP_DELAY END "
                         "AS DEP_DELAY FROM flights")
def b16(t: Tables):
    from ..functions.times import clip_upper

    return t.flights.select("FLIGHT_ID", clip_upper("DEP_DELAY", 120).alias("DEP_DELAY"))


@query("b17_cast_columns", "SELECT FLIGHT_ID, CAST(DEP_TIME AS INT) AS DEP_TIME, CAST(FL_NUMBER AS VARCHAR) AS FL_NUMBER, "
                           "CAST(CRS_DEP_TIME AS DOUBLE) AS CRS_DEP_TIME FROM flights")
def b17(t: Tables):
    types = {"DEP_TIME": "int", "FL_NUMBER": "string", "CRS_DEP_TIME": "double"}
    return clean.cast_columns(t.flights.select("FLIGHT_ID", *types), types)


EXPECTED = T.StructType([T.StructField("ARR_DELAY", T.DoubleType()), T.StructField("FLIGHT_ID", T.StringType()),
                         T.StructField("GATE", T.StringType()), T.StructField("FL_NUMBER", T.LongType())])


@query("b18_align_schema", "SELECT ARR_DELAY, FLIGHT_ID, CAST(NULL AS VARCHAR) AS GATE, "
                           "CAST(FL_NUMBER AS BIGINT) AS FL_NUMBER FROM flights")
def b18(t: Tables):
    return clean.align_schema(t.flights, EXPECTED)


@query("b19_low_cardinality", "SELECT c.k AS \"column\", c.n AS \"distinct\" FROM (SELECT unnest(["
       + ", ".join(f"{{'k': '{c}', 'n': count(DISTINCT {c})}}" for c in ALL if c != "FLIGHT_ID")
       + "]) AS c FROM flights) WHERE c.n BETWEEN 2 AND 49")
def b19(t: Tables):
    rows = t.flights.drop("FLIGHT_ID")
    return report.distinct_counts(rows, clean.low_cardinality_columns(rows))


@query("b20_filter_delayed", "SELECT FLIGHT_ID, AIRLINE, ARR_DELAY FROM flights WHERE ARR_DELAY > 0 AND AIRLINE IS NOT NULL")
def b20(t: Tables):
    return clean.filter_delayed(t.flights).select("FLIGHT_ID", "AIRLINE", "ARR_DELAY")


@query("b21_select_features", f"SELECT CRS_DEP_TIME, DISTANCE, TAXI_OUT, {LATE} AS LATE FROM flights "
                              "WHERE TAXI_OUT IS NOT NULL")
def b21(t: Tables):
    labelled = clean.binary_target(t.flights, "ARR_DELAY", "LATE")
    return clean.select_features(labelled, ["CRS_DEP_TIME", "DISTANCE", "TAXI_OUT"], "LATE")


@query("b22_require", f"SELECT {LATE} AS LATE, count(*) AS n FROM flights WHERE ARR_DELAY IS NOT NULL GROUP BY 1")
def b22(t: Tables):
    checked = clean.require(t.late, ["ARR_DELAY", "AIRLINE"], non_empty=True, label="LATE")
    return report.target_distribution(checked, "LATE")
