"""The sample tables and the flights view derived from them.

The view's text is valid in Spark and in the checking engine. ``{name}`` marks a table; the key is
text so that it stays unique at any scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

KEY = "FLIGHT_ID"

MEASURES_SQL = """
WITH base AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
         o.o_orderdate, p.p_brand, s.s_suppkey, c.c_custkey,
         no.n_name AS o_nation, ro.r_name AS o_region, nd.n_name AS d_nation, rd.r_name AS d_region,
         (l.l_orderkey*7919 + l.l_partkey*104729 + l.l_suppkey*1299709 + l.l_linenumber*15485863) % 1000003 AS m
  FROM {lineitem} l
  JOIN {orders} o ON l.l_orderkey = o.o_orderkey
  JOIN {part} p ON l.l_partkey = p.p_partkey
  JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} no ON s.s_nationkey = no.n_nationkey
  JOIN {region} ro ON no.n_regionkey = ro.r_regionkey
  JOIN {nation} nd ON c.c_nationkey = nd.n_nationkey
  JOIN {region} rd ON nd.n_regionkey = rd.r_regionkey
), h AS (
  SELECT base.*,
         (m*m + 48271*m + 11) % 1000003 AS h1, (m*m + 69621*m + 23) % 999983 AS h2,
         (m*m + 16807*m + 37) % 999979 AS h3, (m*m + 39373*m + 51) % 999961 AS h4
  FROM base
), t AS (
  SELECT h.*,
         h1 % 1440 AS dep_min,
         60 + h2 % 300 AS crs_el,
         CASE WHEN h3 % 100 < 18 THEN 16 + h4 % 120 ELSE h4 % 22 - 12 END
           + (CASE WHEN h1 % 1440 >= 1020 THEN 4 ELSE 0 END) AS dep_delay,
         8 + h3 % 25 AS taxi_out, 3 + h4 % 14 AS taxi_in, h2 % 21 - 12 AS air_adj,
         CASE WHEN h4 % 53 = 0 THEN 1 ELSE 0 END AS cancelled,
         CASE WHEN h4 % 53 <> 0 AND h3 % 211 = 0 THEN 1 ELSE 0 END AS diverted
  FROM h
), u AS (
  SELECT t.*,
         dep_delay + air_adj + (taxi_out - 20) AS arr_delay,
         (dep_min + dep_delay + 1440) % 1440 AS act_dep, (dep_min + crs_el) % 1440 AS crs_arr
  FROM t
), w AS (
  SELECT u.*, CASE WHEN cancelled = 1 OR diverted = 1 THEN 1 ELSE 0 END AS nofly,
         (dep_min + crs_el + arr_delay + 2880) % 1440 AS act_arr,
         (act_dep + taxi_out) % 1440 AS woff,
         (dep_min + crs_el + arr_delay - taxi_in + 2880) % 1440 AS won
  FROM u
)
"""

FLIGHTS_SELECT = """SELECT
  concat_ws('-', CAST(l_orderkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)),
            CAST(l_partkey AS VARCHAR(20)), CAST(l_suppkey AS VARCHAR(20))) AS FLIGHT_ID,
  CAST(o_orderdate AS DATE) AS FL_DATE,
  p_brand AS AIRLINE,
  concat(p_brand, ': X') AS AIRLINE_DOT,
  replace(p_brand, 'Brand#', 'B') AS AIRLINE_CODE,
  CAST(19000 + CAST(replace(p_brand, 'Brand#', '') AS INT) AS INT) AS DOT_CODE,
  CAST(l_partkey AS INT) AS FL_NUMBER,
  concat('AP', CAST(s_suppkey % 12 AS VARCHAR(4))) AS ORIGIN,
  concat(o_nation, ', ', o_region) AS ORIGIN_CITY,
  concat('AP', CAST(c_custkey % 12 AS VARCHAR(4))) AS DEST,
  concat(d_nation, ', ', d_region) AS DEST_CITY,
  CAST((dep_min - dep_min % 60)/60*100 + dep_min % 60 AS INT) AS CRS_DEP_TIME,
  CASE WHEN cancelled = 1 THEN NULL ELSE CAST((act_dep - act_dep % 60)/60*100 + act_dep % 60 AS DOUBLE) END AS DEP_TIME,
  CASE WHEN cancelled = 1 THEN NULL ELSE CAST(dep_delay AS DOUBLE) END AS DEP_DELAY,
  CASE WHEN cancelled = 1 THEN NULL ELSE CAST(taxi_out AS DOUBLE) END AS TAXI_OUT,
  CASE WHEN cancelled = 1 THEN NULL ELSE CAST((woff - woff % 60)/60*100 + woff % 60 AS DOUBLE) END AS WHEELS_OFF,
  CASE WHEN cancelled = 1 THEN NULL ELSE CAST((won - won % 60)/60*100 + won % 60 AS DOUBLE) END AS WHEELS_ON,
  CASE WHEN cancelled = 1 THEN NULL ELSE CAST(taxi_in AS DOUBLE) END AS TAXI_IN,
  CAST((crs_arr - crs_arr % 60)/60*100 + crs_arr % 60 AS INT) AS CRS_ARR_TIME,
  CASE WHEN cancelled = 1 THEN NULL ELSE CAST((act_arr - act_arr % 60)/60*100 + act_arr % 60 AS DOUBLE) END AS ARR_TIME,
  CASE WHEN nofly = 1 THEN NULL ELSE CAST(arr_delay AS DOUBLE) END AS ARR_DELAY,
  CAST(cancelled AS DOUBLE) AS CANCELLED,
  CASE WHEN cancelled = 1 THEN substr('ABCD', CAST(1 + h1 % 4 AS INT), 1) ELSE NULL END AS CANCELLATION_CODE,
  CAST(diverted AS DOUBLE) AS DIVERTED,
  CAST(crs_el AS DOUBLE) AS CRS_ELAPSED_TIME,
  CASE WHEN nofly = 1 THEN NULL ELSE CAST(crs_el + arr_delay - dep_delay AS DOUBLE) END AS ELAPSED_TIME,
  CASE WHEN nofly = 1 THEN NULL ELSE CAST(crs_el + arr_delay - dep_delay - taxi_out - taxi_in AS DOUBLE) END AS AIR_TIME,
  CAST(crs_el * 7 + h1 % 90 AS DOUBLE) AS DISTANCE,
  CASE WHEN nofly = 1 OR arr_delay <= 14 THEN NULL ELSE CAST(arr_delay - arr_delay % 3 - (CASE WHEN h1 % 5 = 0 THEN arr_delay % 2 ELSE 0 END) AS DOUBLE) END AS DELAY_DUE_CARRIER,
  CASE WHEN nofly = 1 OR arr_delay <= 14 THEN NULL ELSE CAST(CASE WHEN h1 % 5 = 0 THEN arr_delay % 2 ELSE 0 END AS DOUBLE) END AS DELAY_DUE_WEATHER,
  CASE WHEN nofly = 1 OR arr_delay <= 14 THEN NULL ELSE CAST(CASE WHEN h2 % 2 = 0 THEN arr_delay % 3 ELSE 0 END AS DOUBLE) END AS DELAY_DUE_NAS,
  CASE WHEN nofly = 1 OR arr_delay <= 14 THEN NULL ELSE CAST(0 AS DOUBLE) END AS DELAY_DUE_SECURITY,
  CASE WHEN nofly = 1 OR arr_delay <= 14 THEN NULL ELSE CAST(CASE WHEN h2 % 2 = 0 THEN 0 ELSE arr_delay % 3 END AS DOUBLE) END AS DELAY_DUE_LATE_AIRCRAFT
"""



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows with the columns emitted by a generator.

    Filters on derived columns would be moved below their projection with every formula written out in
    full, nested ones many times over. A generator's output is not rewritten, so each formula runs once.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights view as a lazy plan over the sample tables."""
    used = ["lineitem", "orders", "part", "supplier", "customer", "nation", "region"]
    measures = spark.sql(MEASURES_SQL + "SELECT * FROM w", **{name: table(spark, sf_dir, name) for name in used})
    return spark.sql(FLIGHTS_SELECT + "FROM {w}", w=computed_once(measures.drop("m", "h3", "h4", "air_adj")))


def flights_cte() -> str:
    """The same view as the leading CTE of a check query."""
    text = MEASURES_SQL.format(**{name: name for name in TABLES}) + FLIGHTS_SELECT + "FROM w"
    return "WITH flights AS (" + text + ")"


def classification_sample(spark: SparkSession, sf_dir: str, width: int = 20) -> DataFrame:
    """Embedding elements as ``feature_i`` columns with a binary target."""
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(
        "vec_id",
        *[F.col("embedding")[i].cast("double").alias(f"feature_{i}") for i in range(width)],
        F.when(F.col("label") < 5, 1).otherwise(0).alias("target"),
    )
