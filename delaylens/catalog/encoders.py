"""Fitted encoders, scaling and splits."""

from pyspark.sql import functions as F

from ..functions.times import WEEKDAYS, day_name
from ..operators import encode, split
from .base import HASH, LATE, SEED, Tables, q6, query, r6, rounded

AIRPORTS = [f"AP{i}" for i in range(12)]


def _woe_sql(columns: list[str], train: str, null: str = "'\\u0000null'") -> str:
    tables, joins, out = [], "", []
    for i, c in enumerate(columns):
        tables.append(f"""g{i} AS (SELECT {c} AS k, count(*) AS n, sum(y) AS p FROM {train} GROUP BY 1),
w{i} AS (SELECT k, CASE WHEN n = 1 THEN 0 ELSE ln(((p + 1) / ((SELECT sum(p) FROM g{i}) + 2e0)) / ((n - p + 1) / ((SELECT sum(n - p) FROM g{i}) + 2e0))) END AS woe FROM g{i})""")
        joins += f" LEFT JOIN w{i} ON x.{c} IS NOT DISTINCT FROM w{i}.k"
        out.append(f"{q6(f'coalesce(w{i}.woe, 0)')} AS {c}_WOE")
    return ", " + ",\n".join(tables) + f"\nSELECT FLIGHT_ID, {', '.join(out)} FROM x{joins}"


X = f", x AS (SELECT *, {LATE} AS y FROM flights WHERE ARR_DELAY IS NOT NULL)"
TRAIN = f", tr AS (SELECT * FROM x WHERE {HASH} / 4294967296e0 >= 0.4e0)"
WOE_COLUMNS = ["AIRLINE", "ORIGIN_CITY", "DEST"]


@query("f1_woe_encode", X + _woe_sql(WOE_COLUMNS, "x"))
def f1(t: Tables):
    out = encode.woe_encode(t.late.select("FLIGHT_ID", *WOE_COLUMNS, "LATE"), WOE_COLUMNS, "LATE")
    names = [f"{c}_WOE" for c in WOE_COLUMNS]
    return rounded(out.select("FLIGHT_ID", *names), *names)


@query("f1_woe_encode_missing", f", x AS (SELECT *, CASE WHEN DEP_DELAY > 0 THEN 1 ELSE 0 END AS y, "
       "coalesce(CANCELLATION_CODE, 'Missing') AS CODE FROM flights)"
       + _woe_sql(["CODE"], "x").replace("CODE_WOE", "CANCELLATION_CODE_WOE"))
def f1_missing(t: Tables):
    rows = t.flights.select("FLIGHT_ID", "CANCELLATION_CODE",
                            F.when(F.col("DEP_DELAY") > 0, 1).otherwise(0).alias("LATE"))
    out = encode.woe_encode(rows, ["CANCELLATION_CODE"], "LATE", null_mode="missing")
    return rounded(out.select("FLIGHT_ID", "CANCELLATION_CODE_WOE"), "CANCELLATION_CODE_WOE")


@query("d5_apply_fitted_encoding", X + TRAIN + _woe_sql(["FLIGHT_NO"], "tr").replace("x.FLIGHT_NO", "CAST(x.FL_NUMBER AS VARCHAR)")
       .replace("SELECT FLIGHT_NO AS k", "SELECT CAST(FL_NUMBER AS VARCHAR) AS k"))
def d5(t: Tables):
    rows = t.late.select("FLIGHT_ID", F.col("FL_NUMBER").cast("string").alias("FLIGHT_NO"), "LATE")
    train = split.random_split(rows, "FLIGHT_ID", seed=SEED).where("split = 'train'")
    fitted = encode.fit_woe(train, ["FLIGHT_NO"], "LATE")
    return rounded(encode.apply_woe(rows, ["FLIGHT_NO"], fitted).select("FLIGHT_ID", "FLIGHT_NO_WOE"), "FLIGHT_NO_WOE")


@query("f2_one_hot", "SELECT FLIGHT_ID, " + ", ".join(
    f"CASE WHEN DEST = '{a}' THEN 1 ELSE 0 END AS DEST_{a}" for a in AIRPORTS) + " FROM flights")
def f2(t: Tables):
    return encode.one_hot(t.flights.select("FLIGHT_ID", "DEST"), "DEST")


@query("f2_one_hot_sparse", "SELECT FLIGHT_ID, CAST(dense_rank() OVER (ORDER BY CAST(FL_NUMBER AS VARCHAR)) - 1 AS INT) AS hot FROM flights")
def f2_sparse(t: Tables):
    rows = encode.one_hot(t.flights.select("FLIGHT_ID", "FL_NUMBER"), "FL_NUMBER", form="vector")
    return rows.select("FLIGHT_ID", encode.hot_place("FL_NUMBER_vec").cast("int").alias("hot"))


@query("f3_dummies_drop_first", "SELECT FLIGHT_ID, " + ", ".join(
    f"CASE WHEN DEST = '{a}' THEN 1 ELSE 0 END AS DEST_{a}" for a in sorted(AIRPORTS)[1:]) + " FROM flights")
def f3(t: Tables):
    return encode.dummies_drop_first(t.flights.select("FLIGHT_ID", "DEST"), ["DEST"])


@query("f3_dummies_drop_first_vector", "SELECT FLIGHT_ID, CAST(nullif(dense_rank() OVER (ORDER BY CAST(FL_NUMBER AS VARCHAR)) - 2, -1) AS INT) AS hot FROM flights")
def f3_vector(t: Tables):
    rows = encode.dummies_drop_first(t.flights.select("FLIGHT_ID", "FL_NUMBER"), ["FL_NUMBER"], form="vector")
    return rows.select("FLIGHT_ID", F.nullif(encode.hot_place("FL_NUMBER_vec"), F.lit(-1)).cast("int").alias("hot"))


@query("f4_ordinal_encode", "SELECT FLIGHT_ID, CAST(isodow(FL_DATE) - 1 AS BIGINT) AS day FROM flights")
def f4(t: Tables):
    rows = t.flights.select("FLIGHT_ID", day_name("FL_DATE").alias("day"))
    return encode.ordinal_encode(rows, "day", WEEKDAYS)


@query("f5_binary_encode", ", o AS (SELECT FLIGHT_ID, dense_rank() OVER (ORDER BY ORIGIN) AS d FROM flights)\nSELECT FLIGHT_ID, "
       + ", ".join(f"CAST((d >> {3 - j}) & 1 AS INT) AS ORIGIN_{j}" for j in range(4)) + " FROM o")
def f5(t: Tables):
    return encode.binary_encode(t.flights.select("FLIGHT_ID", "ORIGIN"), ["ORIGIN"])


@query("f6_label_encode", "SELECT FLIGHT_ID, CAST(dense_rank() OVER (ORDER BY DEST) - 1 AS BIGINT) AS DEST, "
                          "CAST(dense_rank() OVER (ORDER BY DEST_CITY) - 1 AS BIGINT) AS DEST_CITY FROM flights")
def f6(t: Tables):
    out = encode.label_encode(t.flights.select("FLIGHT_ID", "DEST", "DEST_CITY"), "DEST")
    return encode.label_encode(out, "DEST_CITY")


SCALED = ["DEP_DELAY", "TAXI_OUT", "DISTANCE"]


@query("f7_standard_scale", "SELECT FLIGHT_ID, CANCELLED, " + ", ".join(
    f"{q6(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}" for c in SCALED) + " FROM flights")
def f7(t: Tables):
    out = encode.standard_scale(t.flights.select("FLIGHT_ID", "CANCELLED", *SCALED))
    return rounded(out, *SCALED)


@query("f11_impute_mean", "SELECT FLIGHT_ID, " + ", ".join(
    f"{q6(f'coalesce({c}, avg({c}) OVER ())')} AS {c}" for c in ("DEP_DELAY", "AIR_TIME")) + " FROM flights")
def f11(t: Tables):
    out = encode.impute_mean(t.flights.select("FLIGHT_ID", "DEP_DELAY", "AIR_TIME"), ["DEP_DELAY", "AIR_TIME"])
    return rounded(out, "DEP_DELAY", "AIR_TIME")


# --- splits ----------------------------------------------------------------------------------------

RANKED = f"""
, r AS (SELECT FLIGHT_ID, LATE, row_number() OVER (PARTITION BY LATE ORDER BY u, FLIGHT_ID) AS i, count(*) OVER (PARTITION BY LATE) AS n
  FROM (SELECT FLIGHT_ID, {LATE} AS LATE, {HASH} AS u FROM flights WHERE ARR_DELAY IS NOT NULL))"""


@query("g1_stratified_split", RANKED + """
, s AS (SELECT *, ceil(n * 0.15e0) AS t FROM r)
SELECT FLIGHT_ID, LATE, CASE WHEN i <= t THEN 'test' WHEN i <= t + ceil((n - t) * 0.15e0) THEN 'val' ELSE 'train' END AS split FROM s""")
def g1(t: Tables):
    return split.stratified_split(t.late.select("FLIGHT_ID", "LATE"), "LATE", "FLIGHT_ID", seed=SEED)


@query("g2_random_split", f"""
SELECT FLIGHT_ID, CASE WHEN u < 0.2e0 THEN 'test' WHEN u < 0.4e0 THEN 'val' ELSE 'train' END AS split
FROM (SELECT FLIGHT_ID, {HASH} / 4294967296e0 AS u FROM flights)""")
def g2(t: Tables):
    return split.random_split(t.flights.select("FLIGHT_ID"), "FLIGHT_ID", seed=SEED)


@query("g3_kfold", f"SELECT FLIGHT_ID, CAST({HASH} % 3 AS INT) AS fold FROM flights")
def g3(t: Tables):
    return split.kfold(t.flights.select("FLIGHT_ID"), "FLIGHT_ID", 3, SEED)


@query("g4_stratified_kfold", RANKED + "SELECT FLIGHT_ID, LATE, CAST(((i - 1) * 5) // n AS INT) AS fold FROM r")
def g4(t: Tables):
    return split.stratified_kfold(t.late.select("FLIGHT_ID", "LATE"), "LATE", "FLIGHT_ID", 5, SEED)


@query("g5_sample_n", f"SELECT FLIGHT_ID, ARR_DELAY FROM flights ORDER BY {HASH}, FLIGHT_ID LIMIT 1000")
def g5(t: Tables):
    return split.sample_n(t.flights.select("FLIGHT_ID", "ARR_DELAY"), 1000, "FLIGHT_ID", SEED)
