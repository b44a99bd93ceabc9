"""Registration of queries over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources import sample_tables

QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
CHECKS: dict[str, str] = {}

SEED = 42

#: SQL for the 32-bit hash behind splits and samples.
HASH = f"CAST('0x' || substr(md5(concat_ws('|', FLIGHT_ID, '{SEED}')), 1, 8) AS BIGINT)"
LATE = "CASE WHEN ARR_DELAY > 15 THEN 1 ELSE 0 END"
PREDICTIONS = f"""
, pred AS (
  SELECT FLIGHT_ID, AIRLINE, {LATE} AS label, 1 / (1 + exp(-(DEP_DELAY - 15) / 10)) AS probability,
         CASE WHEN 1 / (1 + exp(-(DEP_DELAY - 15) / 10)) > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM flights WHERE ARR_DELAY IS NOT NULL
)"""


class Tables:
    """The sample tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str, flights: DataFrame | None = None):
        self.spark, self.folder, self._flights = spark, folder, flights

    @cached_property
    def flights(self) -> DataFrame:
        return self._flights if self._flights is not None else sample_tables.flights(self.spark, self.folder)

    def table(self, name: str) -> DataFrame:
        return sample_tables.table(self.spark, self.folder, name)

    @cached_property
    def late(self) -> DataFrame:
        """Flights with a known arrival delay and the label ``LATE``."""
        known = self.flights.where(F.col("ARR_DELAY").isNotNull())
        return known.withColumn("LATE", (F.col("ARR_DELAY") > 15).cast("int"))

    @cached_property
    def predictions(self) -> DataFrame:
        """Label, and a probability that only depends on the departure delay."""
        p = 1 / (1 + F.exp(-(F.col("DEP_DELAY") - 15) / 10))
        rows = self.late.select("FLIGHT_ID", "AIRLINE", F.col("LATE").alias("label"), p.alias("probability"))
        return rows.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


def query(name: str, sql: str | None = None, native: bool = False):
    """Register ``fn(tables)``; ``sql`` starts with SELECT, or with a comma to add common tables first."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql.strip() if native else f"{sample_tables.flights_cte()}\n{sql.strip()}"
        return fn

    return add


def r6(c: str | Column) -> Column:
    """Six decimals without a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def q6(expression: str) -> str:
    """SQL side of ``r6``."""
    return f"round({expression}, 6) + 0.0"
