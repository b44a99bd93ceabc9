"""Grouped reports, profile and correlation."""

from pyspark.sql import functions as F, types as T

from ..operators import report, sketches
from ..operators.scale import bounded, value_counts_long
from ..sources import stores
from ..sources.flights import DELAY_CAUSES, flights_schema
from .base import LATE, PREDICTIONS, Tables, q6, query, r6, rounded

GROUPED = "SELECT AIRLINE, avg(ARR_DELAY) AS avg_delay, count(*) AS flight_count FROM flights WHERE ARR_DELAY > 0 AND AIRLINE IS NOT NULL GROUP BY AIRLINE"


@query("e5_share_of_total", f"SELECT DEST, count(*) AS n, {q6('count(*) / sum(count(*)) OVER ()')} AS share FROM flights GROUP BY DEST")
def e5(t: Tables):
    counts = t.flights.groupBy("DEST").agg(F.count("*").alias("n"))
    return rounded(report.share_of_total(counts), "share")


@query("e6_extreme_group", """
, g AS (SELECT DEST AS k, sum(ARR_DELAY) AS v FROM flights GROUP BY DEST)
SELECT (SELECT k FROM g ORDER BY v DESC, k LIMIT 1) AS max_key, (SELECT max(v) FROM g) AS max_value,
       (SELECT k FROM g ORDER BY v, k LIMIT 1) AS min_key, (SELECT min(v) FROM g) AS min_value""")
def e6(t: Tables):
    return report.extreme_group(t.flights.groupBy("DEST").agg(F.sum("ARR_DELAY").alias("v")), "DEST", "v")


@query("h1_value_counts", "SELECT AIRLINE, count(*) AS n FROM flights WHERE AIRLINE IS NOT NULL GROUP BY AIRLINE")
def h1(t: Tables):
    return report.value_counts(t.flights, "AIRLINE")


@query("h1_value_counts_events", "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type", native=True)
def h1_events(t: Tables):
    return report.value_counts(t.table("events"), "event_type")


@query("h2_top_destinations", "SELECT DEST_CITY, count(*) AS n FROM flights GROUP BY DEST_CITY ORDER BY n DESC, DEST_CITY LIMIT 20")
def h2(t: Tables):
    return report.top_n(t.flights, "DEST_CITY", 20)


@query("h3_avg_delay_by_airline", f"SELECT AIRLINE, {q6('avg_delay')} AS avg_delay, flight_count FROM ({GROUPED}) WHERE flight_count >= 100")
def h3(t: Tables):
    return rounded(report.avg_delay_by_airline(t.flights), "avg_delay")


@query("h4_avg_delay_insights", f"""
, g AS (SELECT * FROM ({GROUPED}) WHERE flight_count >= 100)
SELECT (SELECT AIRLINE FROM g ORDER BY avg_delay DESC, AIRLINE DESC LIMIT 1) AS worst, {q6("(SELECT max(avg_delay) FROM g)")} AS worst_avg,
       (SELECT AIRLINE FROM g ORDER BY avg_delay, AIRLINE LIMIT 1) AS best, {q6("(SELECT min(avg_delay) FROM g)")} AS best_avg,
       (SELECT CAST(sum(flight_count) AS BIGINT) FROM g) AS flights_analysed,
       {q6("count(*) FILTER (ARR_DELAY > 0) * 100e0 / count(*)")} AS delayed_pct,
       {q6("avg(ARR_DELAY) FILTER (ARR_DELAY > 0)")} AS overall_avg
FROM flights WHERE ARR_DELAY IS NOT NULL AND AIRLINE IS NOT NULL""")
def h4(t: Tables):
    return rounded(report.avg_delay_insights(t.flights), "worst_avg", "best_avg", "delayed_pct", "overall_avg")


@query("h5_total_delay_by_year", "SELECT CAST(year(FL_DATE) AS INT) AS year, sum(ARR_DELAY) AS total FROM flights GROUP BY 1")
def h5(t: Tables):
    return report.total_delay_by_year(t.flights)


@query("h6_total_delay_by_year_month", "SELECT CAST(year(FL_DATE) AS INT) AS year, CAST(month(FL_DATE) AS INT) AS month, "
                                       "sum(ARR_DELAY) AS total FROM flights GROUP BY 1, 2")
def h6(t: Tables):
    return report.total_delay_by_year_month(t.flights)


@query("h7_monthly_trend", """
, m AS (SELECT CAST(year(FL_DATE) AS INT) AS year, CAST(month(FL_DATE) AS INT) AS month, sum(DEP_DELAY) AS total FROM flights GROUP BY 1, 2),
y AS (SELECT year, sum(total) AS year_total FROM m GROUP BY year)
SELECT year, month, total, year_total, CAST(make_date(year, month, 1) AS VARCHAR) AS date,
       year = (SELECT year FROM y ORDER BY year_total, year LIMIT 1) AS is_min_year FROM m JOIN y USING (year)""")
def h7(t: Tables):
    return report.monthly_trend(t.flights, "DEP_DELAY").withColumn("date", F.col("date").cast("string"))


@query("h8_delay_cause_breakdown", ", s AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS cause, '{c.replace('DELAY_DUE_', '').replace('_', ' ').title()}' AS label, coalesce(sum({c}), 0) AS minutes FROM flights"
    for c in DELAY_CAUSES) + f""")
SELECT cause, label, minutes, {q6("minutes * 100e0 / (SELECT sum(minutes) FROM s)")} AS pct,
       cause = (SELECT cause FROM s ORDER BY minutes DESC, cause LIMIT 1) AS is_primary FROM s""")
def h8(t: Tables):
    return rounded(report.delay_cause_breakdown(t.flights, DELAY_CAUSES), "pct")


@query("h9_delay_rate_by_weekday", f"""
SELECT dayname(FL_DATE) AS day, {q6(f"avg({LATE})")} AS delay_rate FROM flights WHERE ARR_DELAY IS NOT NULL GROUP BY 1""")
def h9(t: Tables):
    from ..functions.times import day_name

    return rounded(report.delay_rate_by(t.late.withColumn("day", day_name("FL_DATE")), "day", "LATE"), "delay_rate")


def _contribution(key: str, limit: str = "") -> str:
    return f"""
, g AS (SELECT {key}, count(*) AS flights, CAST(sum({LATE}) AS BIGINT) AS delayed FROM flights WHERE ARR_DELAY IS NOT NULL GROUP BY 1),
w AS (SELECT *, delayed / flights AS delay_rate, flights / (SELECT sum(flights) FROM g) AS weight FROM g)
SELECT {key}, flights, delayed, {q6("delay_rate")} AS delay_rate, {q6("weight")} AS weight,
       {q6("weight * delay_rate")} AS contribution FROM w ORDER BY weight * delay_rate DESC, {key} {limit}"""


@query("h10_weighted_contribution_airline", _contribution("AIRLINE"))
def h10_airline(t: Tables):
    return rounded(report.weighted_contribution(t.late, "AIRLINE", "LATE"), "delay_rate", "weight", "contribution")


@query("h10_weighted_contribution_origin", _contribution("ORIGIN_CITY", "LIMIT 20"))
def h10_origin(t: Tables):
    return rounded(report.weighted_contribution(t.late, "ORIGIN_CITY", "LATE", 20), "delay_rate", "weight", "contribution")


@query("h10_weighted_contribution_dest", _contribution("DEST_CITY", "LIMIT 20"))
def h10_dest(t: Tables):
    return rounded(report.weighted_contribution(t.late, "DEST_CITY", "LATE", 20), "delay_rate", "weight", "contribution")


@query("h11_target_distribution", f"SELECT {LATE} AS LATE, count(*) AS n FROM flights WHERE ARR_DELAY IS NOT NULL GROUP BY 1")
def h11(t: Tables):
    return report.target_distribution(t.late, "LATE")


def _bins(table: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(CASE WHEN lo = hi THEN 0 ELSE least(floor(({column} - lo) / (hi - lo) * 20), 19) END AS INT) AS bin,
 count(*) AS n FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) WHERE {column} IS NOT NULL GROUP BY 2"""


MEASURES = [f.name for f in flights_schema() if not isinstance(f.dataType, (T.StringType, T.DateType))]


@query("h12_histogram", " UNION ALL ".join(_bins("flights", c) for c in MEASURES))
def h12(t: Tables):
    return report.histogram(t.flights, MEASURES)


@query("h12_histogram_events", _bins("events", "value"), native=True)
def h12_events(t: Tables):
    return report.histogram(t.table("events"), ["value"])


TEXTS = [f.name for f in flights_schema() if isinstance(f.dataType, T.StringType)]


@query("h13_category_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM flights WHERE {c} IS NOT NULL GROUP BY {c}" for c in TEXTS))
def h13(t: Tables):
    return report.category_counts(t.flights, TEXTS)


@query("h14_distinct_counts", "SELECT c.k AS \"column\", c.n AS \"distinct\" FROM (SELECT unnest(["
       + ", ".join(f"{{'k': '{c}', 'n': count(DISTINCT {c})}}" for c in TEXTS + MEASURES) + "]) AS c FROM flights)")
def h14(t: Tables):
    return report.distinct_counts(t.flights, TEXTS + MEASURES)


@query("h15_shape", """
SELECT 'raw' AS stage, count(*) AS n_rows, 33 AS n_columns FROM flights UNION ALL
SELECT 'not cancelled', count(*), 33 FROM flights WHERE CANCELLED = 0 UNION ALL
SELECT 'labelled', count(*), 34 FROM flights WHERE ARR_DELAY IS NOT NULL""")
def h15(t: Tables):
    return report.shape({"raw": t.flights, "not cancelled": t.flights.where("CANCELLED = 0"), "labelled": t.late})


PAIRS = [(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:]]
CORRELATIONS = "SELECT c.a AS column_a, c.b AS column_b, c.r AS r FROM (SELECT unnest([" + ", ".join(
    f"{{'a': '{a}', 'b': '{b}', 'r': abs(corr({a}, {b}))}}" for a, b in PAIRS) + "]) AS c FROM flights)"


@query("h16_correlation_matrix", f"SELECT column_a, column_b, {q6('r')} AS abs_corr FROM ({CORRELATIONS})")
def h16(t: Tables):
    found = report.correlation_matrix(t.flights, MEASURES)
    return rounded(found.select("column_a", "column_b", "abs_corr"), "abs_corr")


@query("h16_correlation_lineitem", "SELECT 'l_quantity' AS column_a, 'l_extendedprice' AS column_b, "
       f"{q6('abs(corr(l_quantity, l_extendedprice))')} AS abs_corr FROM lineitem", native=True)
def h16_lineitem(t: Tables):
    found = report.correlation_matrix(t.table("lineitem"), ["l_quantity", "l_extendedprice"])
    return rounded(found.select("column_a", "column_b", "abs_corr"), "abs_corr")


@query("h17_high_correlation_pairs", f"SELECT column_a, column_b, {q6('r')} AS abs_corr, column_b AS drop_column "
                                     f"FROM ({CORRELATIONS}) WHERE r >= 0.9 AND NOT isnan(r)")
def h17(t: Tables):
    return rounded(report.high_correlation_pairs(report.correlation_matrix(t.flights, MEASURES), 0.9), "abs_corr")


def _profile_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", unnest([
 {{'s': 'count', 'v': CAST(count(v) AS DOUBLE)}}, {{'s': 'nulls', 'v': CAST(count(*) - count(v) AS DOUBLE)}},
 {{'s': 'distinct', 'v': CAST(count(DISTINCT v) AS DOUBLE)}}, {{'s': 'zeros', 'v': CAST(count(*) FILTER (v = 0) AS DOUBLE)}},
 {{'s': 'min', 'v': min(v)}}, {{'s': 'max', 'v': max(v)}}, {{'s': 'mean', 'v': avg(v)}}, {{'s': 'std', 'v': stddev_samp(v)}},
 {{'s': 'q25', 'v': quantile_cont(v, 0.25)}}, {{'s': 'q50', 'v': quantile_cont(v, 0.5)}}, {{'s': 'q75', 'v': quantile_cont(v, 0.75)}},
 {{'s': 'skewness', 'v': avg((v - m) ** 3) / stddev_pop(v) ** 3}}, {{'s': 'kurtosis', 'v': avg((v - m) ** 4) / var_pop(v) ** 2 - 3}}]) AS x
FROM (SELECT CAST({c} AS DOUBLE) AS v, avg(CAST({c} AS DOUBLE)) OVER () AS m FROM flights)"""


@query("h18_profile", "SELECT \"column\", x.s AS statistic, round(x.v, 4) + 0.0 AS value FROM ("
       + " UNION ALL ".join(_profile_sql(c) for c in MEASURES)
       + ") WHERE coalesce(NOT isnan(x.v), true)")  # a constant column has no skewness and kurtosis
def h18(t: Tables):
    found = report.profile(t.flights, MEASURES)
    return found.withColumn("value", F.round("value", 4) + F.lit(0.0))


def _sketch_sql(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", count({c}) AS count, count(*) - count({c}) AS nulls, count(CASE WHEN {c} = 0 THEN 1 END) AS zeros, "
            f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, {q6(f'avg({c})')} AS mean, "
            "true AS distinct_near, true AS q25_near, true AS q50_near, true AS q75_near FROM flights")


@query("h18_profile_from_sketches", " UNION ALL ".join(_sketch_sql(c) for c in MEASURES))
def h18_sketches(t: Tables):
    """Stored parts of each year, added in two updates and merged. The estimates are held against exact value counts:
    distinct values within 5 %, quantiles within 1 % of the ranks."""
    rows = t.flights.select(*MEASURES, F.year("FL_DATE").alias("FL_YEAR"))
    folder = stores.scratch_path(t.spark, "profile")
    sketches.update_parts(t.spark, folder, rows.where(F.col("FL_YEAR") < 1998), "FL_YEAR", MEASURES)
    sketches.update_parts(t.spark, folder, rows, "FL_YEAR", MEASURES)
    found = bounded(sketches.profile_of(sketches.stored_profile(t.spark, folder)))
    v, n = F.col("value"), F.col("n")
    counts = value_counts_long(rows, MEASURES).join(found, "column")
    ranks = counts.groupBy("column").agg(
        F.count("*").alias("exact"), F.sum("n").alias("all"),
        *[F.sum(F.when(test, n).otherwise(0)).alias(f"{name}{q}") for q in (25, 50, 75)
          for name, test in (("below", v < F.col(f"q{q}")), ("upto", v <= F.col(f"q{q}")))])
    slack = sketches.RANK_ERROR * F.col("all")
    near = {f"q{q}_near": (F.col(f"below{q}") - slack <= q / 100 * F.col("all")) & (F.col(f"upto{q}") + slack >= q / 100 * F.col("all"))
            for q in (25, 50, 75)}
    near["distinct_near"] = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(sketches.DISTINCT_ERROR * F.col("exact"), F.lit(1))
    return found.join(ranks, "column", "left").select(
        "column", "count", "nulls", "zeros", "min", "max", r6("mean").alias("mean"),
        *[F.coalesce(test, F.col("count") == 0).alias(name) for name, test in near.items()])


@query("h18_top_values", "SELECT \"column\", value, n, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value) AS INT) AS place FROM ("
       + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM flights WHERE {c} IS NOT NULL GROUP BY {c}"
                            for c in ("AIRLINE", "DEST_CITY", "FL_NUMBER")) + ")) WHERE place <= 5")
def h18_top(t: Tables):
    return report.top_values(t.flights, ["AIRLINE", "DEST_CITY", "FL_NUMBER"])


@query("h18_duplicate_rows", "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM flights "
                             "GROUP BY FL_DATE, AIRLINE, ORIGIN, DEST)")
def h18_duplicates(t: Tables):
    return report.duplicate_rows(t.flights.select("FL_DATE", "AIRLINE", "ORIGIN", "DEST"))


@query("h19_pivot_metrics", PREDICTIONS + """
SELECT AIRLINE AS "Model", 'Test' AS "Stage", round(avg(CASE WHEN label = prediction THEN 1 ELSE 0 END), 4) AS "Accuracy",
       round(sum(label * prediction) / sum(label), 4) AS "Recall" FROM pred GROUP BY AIRLINE""")
def h19(t: Tables):
    hit = F.avg((F.col("label") == F.col("prediction")).cast("int"))
    found = F.sum(F.col("label") * F.col("prediction")) / F.sum("label")
    records = t.predictions.groupBy(F.col("AIRLINE").alias("Model"), F.lit("Test").alias("Stage")).agg(
        hit.alias("Accuracy"), found.alias("Recall")).unpivot(["Model", "Stage"], ["Accuracy", "Recall"], "Metric", "Value")
    return report.pivot_metrics(records, ["Accuracy", "Recall"])


@query("k1_sort_by_absolute", f"SELECT ORIGIN_CITY, {q6('avg(ARR_DELAY)')} AS shift FROM flights GROUP BY ORIGIN_CITY")
def k1(t: Tables):
    means = t.flights.groupBy("ORIGIN_CITY").agg(F.avg("ARR_DELAY").alias("shift"))
    return rounded(report.top_by_absolute(means, "shift", "ORIGIN_CITY"), "shift")


@query("k2_top_k", f"SELECT FL_NUMBER, {q6('avg(ARR_DELAY)')} AS shift FROM flights WHERE ARR_DELAY IS NOT NULL GROUP BY FL_NUMBER "
                   "ORDER BY abs(avg(ARR_DELAY)) DESC, FL_NUMBER LIMIT 30")
def k2(t: Tables):
    means = t.flights.where("ARR_DELAY IS NOT NULL").groupBy("FL_NUMBER").agg(F.avg("ARR_DELAY").alias("shift"))
    return rounded(report.top_by_absolute(means, "shift", "FL_NUMBER", 30), "shift")
