"""Derived columns, lookups and group-to-row features."""

from pyspark.sql import functions as F

from ..functions import times
from ..operators import features as fx, lookup, split
from .base import HASH, LATE, SEED, Tables, q6, query, r6, rounded

MIN = "(CRS_DEP_TIME // 100) * 60 + CRS_DEP_TIME % 100"


@query("c1_hhmm_to_minutes", f"SELECT FLIGHT_ID, CAST({MIN} AS INT) AS minutes FROM flights")
def c1(t: Tables):
    return t.flights.select("FLIGHT_ID", times.hhmm_to_minutes("CRS_DEP_TIME").cast("int").alias("minutes"))


def _cyc(position: str, period: str, name: str) -> str:
    angle = f"2 * pi() * ({position}) / ({period})"
    return f"{q6(f'sin({angle})')} AS {name}_SIN, {q6(f'cos({angle})')} AS {name}_COS"


_FILLED = "floor(d / 100) * 60 + d % 100"


@query("c2_cyclical_minutes", f"""
, m AS (SELECT avg(DEP_TIME) AS a, avg(WHEELS_OFF) AS b, max(WHEELS_OFF) AS top FROM flights),
x AS (SELECT FLIGHT_ID, coalesce(DEP_TIME, a) AS d, coalesce(WHEELS_OFF, b) AS w, top FROM flights, m)
SELECT FLIGHT_ID, {q6(_FILLED)} AS DEP_TIME_MINUTES, {_cyc(_FILLED, "1440", "DEP_TIME_MINUTES")},
       {_cyc("w", "top", "WHEELS_OFF")} FROM x""")
def c2(t: Tables):
    out = fx.cyclical_minutes(t.flights.select("FLIGHT_ID", "DEP_TIME", "WHEELS_OFF"), ["DEP_TIME", "WHEELS_OFF"])
    names = [c for c in out.columns if c.endswith(("_SIN", "_COS", "_MINUTES"))]
    return rounded(out.select("FLIGHT_ID", *names), *names)


@query("c2_cyclical_minutes_fit_on", f"""
, u AS (SELECT *, {HASH} / 4294967296e0 >= 0.4e0 AS own FROM flights),
m AS (SELECT avg(DEP_TIME) AS a, avg(WHEELS_OFF) AS b, max(WHEELS_OFF) AS top FROM u WHERE own),
x AS (SELECT FLIGHT_ID, coalesce(DEP_TIME, a) AS d, coalesce(WHEELS_OFF, b) AS w, top FROM flights, m)
SELECT FLIGHT_ID, {q6(_FILLED)} AS DEP_TIME_MINUTES, {_cyc(_FILLED, "1440", "DEP_TIME_MINUTES")},
       {_cyc("w", "top", "WHEELS_OFF")} FROM x""")
def c2_fit_on(t: Tables):
    rows = split.random_split(t.flights.select("FLIGHT_ID", "DEP_TIME", "WHEELS_OFF"), "FLIGHT_ID", seed=SEED)
    out = fx.cyclical_minutes(rows, ["DEP_TIME", "WHEELS_OFF"], fit_on=rows.where("split = 'train'"))
    names = [c for c in out.columns if c.endswith(("_SIN", "_COS", "_MINUTES"))]
    return rounded(out.select("FLIGHT_ID", *names), *names)


def _part(position: str, period: int, name: str) -> str:
    angle = f"2 * pi() * ({position}) / {period}"
    return f"{q6(f'sin({angle})')} AS {name}_sin, {q6(f'cos({angle})')} AS {name}_cos"


@query("c3_cyclical_hour_minute", "SELECT FLIGHT_ID, " + ", ".join(
    f"{_part(f'floor({c} / 100)', 24, c.lower() + '_hour')}, {_part(f'{c} % 100', 60, c.lower() + '_minute')}"
    for c in ("CRS_DEP_TIME", "ARR_TIME")) + " FROM flights")
def c3(t: Tables):
    out = fx.cyclical_hour_minute(t.flights.select("FLIGHT_ID", "CRS_DEP_TIME", "ARR_TIME"), ["CRS_DEP_TIME", "ARR_TIME"])
    names = [c for c in out.columns if c.endswith(("_sin", "_cos"))]
    return rounded(out.select("FLIGHT_ID", *names), *names)


@query("c4_hour_of_hhmm", "SELECT FLIGHT_ID, CAST(CRS_DEP_TIME // 100 AS INT) AS dep_hour, "
                          "CAST(floor(ARR_TIME / 100) AS INT) AS arr_hour FROM flights")
def c4(t: Tables):
    return t.flights.select("FLIGHT_ID", times.hour_of_hhmm("CRS_DEP_TIME").alias("dep_hour"),
                            times.hour_of_hhmm("ARR_TIME").alias("arr_hour"))


@query("c5_time_of_day", """
SELECT FLIGHT_ID, CASE WHEN CRS_DEP_TIME // 100 BETWEEN 5 AND 9 THEN 'morning'
  WHEN CRS_DEP_TIME // 100 BETWEEN 10 AND 14 THEN 'midday'
  WHEN CRS_DEP_TIME // 100 BETWEEN 15 AND 19 THEN 'evening' ELSE 'late_night' END AS bucket FROM flights""")
def c5(t: Tables):
    return t.flights.select("FLIGHT_ID", times.time_of_day(times.hour_of_hhmm("CRS_DEP_TIME")).alias("bucket"))


SLOT = (f"CASE WHEN {MIN} BETWEEN 0 AND 360 THEN 'Early Morning' WHEN {MIN} BETWEEN 361 AND 720 THEN 'Morning' "
        f"WHEN {MIN} BETWEEN 721 AND 1080 THEN 'Afternoon' WHEN {MIN} BETWEEN 1081 AND 1440 THEN 'Evening' END")


@query("c6_time_slot", f"SELECT FLIGHT_ID, {SLOT} AS slot FROM flights")
def c6(t: Tables):
    return t.flights.select("FLIGHT_ID", times.time_slot(times.hhmm_to_minutes("CRS_DEP_TIME")).alias("slot"))


@query("c7_parse_date", "SELECT FLIGHT_ID, CAST(FL_DATE AS VARCHAR) AS parsed, CAST(NULL AS VARCHAR) AS unreadable FROM flights")
def c7(t: Tables):
    text = F.date_format("FL_DATE", "yyyy-MM-dd")
    return t.flights.select("FLIGHT_ID", times.parse_date(text).cast("string").alias("parsed"),
                            times.parse_date("AIRLINE").cast("string").alias("unreadable"))


@query("c8_weekday_features", """
SELECT FLIGHT_ID, CAST(isodow(FL_DATE) - 1 AS INT) AS DAY_OF_WEEK,
       CASE WHEN isodow(FL_DATE) >= 6 THEN 1 ELSE 0 END AS IS_WEEKEND FROM flights""")
def c8(t: Tables):
    return fx.weekday_features(t.flights).select("FLIGHT_ID", "DAY_OF_WEEK", "IS_WEEKEND")


@query("c9_day_name_features", 'SELECT FLIGHT_ID, dayname(FL_DATE) AS "FL_DATE_day_name", '
                               'isodow(FL_DATE) >= 6 AS "FL_DATE_is_weekend" FROM flights')
def c9(t: Tables):
    return fx.day_name_features(t.flights, ["FL_DATE"]).select("FLIGHT_ID", "FL_DATE_day_name", "FL_DATE_is_weekend")


@query("c10_date_parts", """
SELECT FLIGHT_ID, CAST(year(FL_DATE) AS INT) AS FL_YEAR, CAST(month(FL_DATE) AS INT) AS FL_MONTH,
       CAST(day(FL_DATE) AS INT) AS FL_DAY, CAST(isodow(FL_DATE) - 1 AS INT) AS FL_DOW FROM flights""")
def c10(t: Tables):
    return fx.date_parts(t.flights).select("FLIGHT_ID", "FL_YEAR", "FL_MONTH", "FL_DAY", "FL_DOW")


@query("c11_split_city_state", """
SELECT FLIGHT_ID, split_part(ORIGIN_CITY, ', ', 1) AS ORIGIN_CITY_CITY, split_part(ORIGIN_CITY, ', ', 2) AS ORIGIN_CITY_STATE,
       split_part(DEST_CITY, ', ', 1) AS DEST_CITY_CITY, split_part(DEST_CITY, ', ', 2) AS DEST_CITY_STATE FROM flights""")
def c11(t: Tables):
    return fx.split_city_state(t.flights.select("FLIGHT_ID", "ORIGIN_CITY", "DEST_CITY"), ["ORIGIN_CITY", "DEST_CITY"])


@query("c11_split_city_state_overwrite", """
SELECT FLIGHT_ID, split_part(ORIGIN_CITY, ', ', 1) AS ORIGIN_CITY, split_part(ORIGIN_CITY, ', ', 2) AS origin_state FROM flights""")
def c11_overwrite(t: Tables):
    return fx.split_city_state(t.flights.select("FLIGHT_ID", "ORIGIN_CITY"), ["ORIGIN_CITY"], naming="overwrite")


@query("c12_elapsed_time_diff", "SELECT FLIGHT_ID, ELAPSED_TIME - CRS_ELAPSED_TIME AS ELAPSED_TIME_DIFF FROM flights "
                                "WHERE ELAPSED_TIME IS NOT NULL AND CRS_ELAPSED_TIME IS NOT NULL")
def c12(t: Tables):
    return fx.elapsed_time_diff(t.flights).select("FLIGHT_ID", "ELAPSED_TIME_DIFF")


@query("c13_total_taxi_time", "SELECT FLIGHT_ID, CASE WHEN TAXI_OUT + TAXI_IN > 30 THEN CAST(30 AS DOUBLE) "
                              "ELSE TAXI_OUT + TAXI_IN END AS TTT FROM flights")
def c13(t: Tables):
    return fx.total_taxi_time(t.flights, 30.0).select("FLIGHT_ID", "TTT")


@query("c14_month_start", "SELECT FLIGHT_ID, CAST(CAST(date_trunc('month', FL_DATE) AS DATE) AS VARCHAR) AS month_start FROM flights")
def c14(t: Tables):
    return t.flights.select("FLIGHT_ID", times.month_start(F.year("FL_DATE"), F.month("FL_DATE")).cast("string").alias("month_start"))


@query("c15_cause_label", """
SELECT event_id, upper(substr(replace(event_type, '_', ' '), 1, 1)) || substr(replace(event_type, '_', ' '), 2) AS label FROM events""",
       native=True)
def c15(t: Tables):
    tagged = t.table("events").withColumn("event_type", F.concat(F.lit("DELAY_DUE_"), F.upper("event_type")))
    return tagged.select("event_id", times.cause_label("event_type").alias("label"))


# --- lookups ---------------------------------------------------------------------------------------

@query("d1_lookup_map", f"""
, g AS (SELECT ORIGIN, avg(TAXI_OUT) AS a FROM flights WHERE DIVERTED = 1 GROUP BY ORIGIN)
SELECT FLIGHT_ID, {q6("coalesce(a, -1)")} AS ORIGIN_TAXI FROM flights LEFT JOIN g USING (ORIGIN)""")
def d1(t: Tables):
    fitted = t.flights.where("DIVERTED = 1").groupBy("ORIGIN").agg(F.avg("TAXI_OUT").alias("a"))
    out = lookup.lookup_map(t.flights.select("FLIGHT_ID", "ORIGIN"), "ORIGIN", fitted, {"a": "ORIGIN_TAXI"},
                            defaults={"ORIGIN_TAXI": -1.0})
    return out.select("FLIGHT_ID", r6("ORIGIN_TAXI").alias("ORIGIN_TAXI"))


@query("d2_in_top_k", """
, k AS (SELECT DEST FROM flights GROUP BY DEST ORDER BY count(*) DESC, DEST LIMIT 5)
SELECT FLIGHT_ID, CASE WHEN DEST IN (SELECT DEST FROM k) THEN 1 ELSE 0 END AS is_busy_destination FROM flights""")
def d2(t: Tables):
    return lookup.in_top_k(t.flights.select("FLIGHT_ID", "DEST"), "DEST", 5, "is_busy_destination").drop("DEST")


# --- group-to-row features -------------------------------------------------------------------------

@query("e1_airport_congestion", f"""
, x AS (SELECT *, {MIN} AS m FROM flights)
SELECT FLIGHT_ID, count(*) OVER (PARTITION BY FL_DATE, ORIGIN ORDER BY m RANGE BETWEEN 60 PRECEDING AND 60 FOLLOWING) AS RACI FROM x""")
def e1(t: Tables):
    rows = t.flights.select("FLIGHT_ID", "FL_DATE", "ORIGIN", "CRS_DEP_TIME")
    return fx.airport_congestion(rows).select("FLIGHT_ID", "RACI")


@query("e2_delay_propensity", f"""
, x AS (SELECT FLIGHT_ID, ORIGIN, {LATE} AS late FROM flights)
SELECT FLIGHT_ID, {q6("avg(late) OVER (PARTITION BY ORIGIN)")} AS ADP FROM x""")
def e2(t: Tables):
    rows = t.flights.select("FLIGHT_ID", "ORIGIN", times.over_threshold("ARR_DELAY").alias("LATE"))
    return rounded(fx.delay_propensity(rows, "LATE").select("FLIGHT_ID", "ADP"), "ADP")


@query("e3_delay_severity", f"""
, g AS (SELECT ORIGIN, avg(ARR_DELAY) AS a FROM flights WHERE ARR_DELAY > 0 GROUP BY ORIGIN),
o AS (SELECT avg(ARR_DELAY) AS a FROM flights WHERE ARR_DELAY > 0)
SELECT FLIGHT_ID, {q6("coalesce(g.a, o.a)")} AS HDS FROM flights LEFT JOIN g USING (ORIGIN), o""")
def e3(t: Tables):
    rows = t.flights.select("FLIGHT_ID", "ORIGIN", "ARR_DELAY")
    return rounded(fx.delay_severity(rows).select("FLIGHT_ID", "HDS"), "HDS")


@query("e4_time_of_day_risk", f"""
, x AS (SELECT FLIGHT_ID, {LATE} AS late, {SLOT} AS slot FROM flights)
SELECT FLIGHT_ID, {q6("avg(late) OVER (PARTITION BY slot)")} AS TODR FROM x""")
def e4(t: Tables):
    rows = t.flights.select("FLIGHT_ID", "CRS_DEP_TIME", times.over_threshold("ARR_DELAY").alias("LATE"))
    return rounded(fx.time_of_day_risk(rows, "LATE").select("FLIGHT_ID", "TODR"), "TODR")
