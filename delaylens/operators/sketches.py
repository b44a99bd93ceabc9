"""Column profiles from mergeable sketches, kept per part of a growing table.

A profile row ``(part, column)`` holds exact counts and sums beside three sketches: distinct values (HyperLogLog, 4,096
registers: standard error 1.6 %), quantiles (KLL of size 400: rank error 1 % at most in 99 of 100 cases) and, for text,
frequent items (tracked up to 1,024: a value that makes up more than 1 / 768 of the rows is found). Rows of several
parts are merged without reading the table again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.stores import path_exists
from .scale import numeric_columns, text_columns

REGISTERS_LOG, QUANTILE_SIZE, ITEMS = 12, 400, 1024
RANK_ERROR, DISTINCT_ERROR = 0.01, 0.05
_SUMS = ("rows", "known", "zeros", "total", "squares")
#: Columns that only numbers or only texts have.
_OWN = {"zeros": "long", "low": "double", "high": "double", "total": "double", "squares": "double", "quantiles": "binary",
        "items": "struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"}


def sketch_parts(df: DataFrame, part: str, columns: list[str] | None = None) -> DataFrame:
    """One profile row per (``part``, column) in one pass over the numbers and one over the texts.

    NULL is a part like any other; NaN counts as a NULL. Columns other than numbers and text are left out.
    """
    columns = [c for c in columns or df.columns if c != part]
    numbers, texts = ([c for c in f(df) if c in columns] for f in (numeric_columns, text_columns))
    made = []
    for names, kind in ((numbers, "double"), (texts, "string")):
        if not names:
            continue
        long = df.select(F.col(part).alias("part"), *[F.col(c).cast(kind) for c in names]).unpivot("part", names, "column", "value")
        if kind == "double":
            v = F.when(~F.isnan("value"), F.col("value") + 0.0)  # one zero
            own = [F.count_if(v == 0).alias("zeros"), F.min(v).alias("low"), F.max(v).alias("high"), F.sum(v).alias("total"),
                   F.sum(v * v).alias("squares"), F.kll_sketch_agg_double(v, F.lit(QUANTILE_SIZE)).alias("quantiles")]
        else:
            v = F.col("value")
            own = [F.expr(f"approx_top_k_accumulate(value, {ITEMS})").alias("items")]
        seen = F.when(v.isNotNull(), F.xxhash64(v))
        made.append(long.groupBy("part", "column").agg(F.count("*").alias("rows"), F.count(v).alias("known"),
                                                       F.hll_sketch_agg(seen, F.lit(REGISTERS_LOG)).alias("distinct"), *own))
    if not made:
        raise ValueError("no column of numbers or text")
    out = made[0]
    for other in made[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out.withColumns({c: F.lit(None).cast(kind) for c, kind in _OWN.items() if c not in out.columns})


def merge_parts(parts: DataFrame) -> DataFrame:
    """One profile row per column from the rows of all parts."""
    merged = parts.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.hll_union_agg("distinct").alias("distinct"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.kll_merge_agg_double("quantiles").alias("quantiles"))
    items = parts.where(F.col("items").isNotNull()).groupBy("column").agg(
        F.expr(f"approx_top_k_combine(items, {ITEMS})").alias("items"))
    return merged.join(items, "column", "left")


def update_parts(spark: SparkSession, folder: str, df: DataFrame, part: str, columns: list[str] | None = None) -> list:
    """Add to the stored profile the parts of ``df`` that it lacks; returns them. Parts already there aren't read.

    Each part is written as a folder of its own in one commit, so an update that broke off is repeated as a whole.
    ``part`` must be a column with few values, such as the partition column of the landed table.
    """
    known = []
    if path_exists(spark, folder):
        own = T.StructType([T.StructField("part", df.schema[part].dataType)])
        known = [r["part"] for r in spark.read.schema(own).parquet(folder).distinct().collect()]
    there = [r[0] for r in df.select(part).distinct().collect()]
    new = sorted((v for v in there if v is not None and v not in known), key=str)
    if None in there and None not in known:
        new.append(None)
    if not new:
        return []
    wanted = F.col(part).isin([v for v in new if v is not None])
    rows = df.where(wanted | F.col(part).isNull() if None in new else wanted)
    sketch_parts(rows, part, columns).withColumn("part_key", F.coalesce(F.col("part").cast("string"), F.lit("-"))).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part_key").parquet(folder)
    return new


def stored_profile(spark: SparkSession, folder: str) -> DataFrame:
    return merge_parts(spark.read.parquet(folder).drop("part_key"))


def profile_of(merged: DataFrame, probabilities: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(column, count, nulls, distinct, zeros, min, max, mean, std, q<percent> ...)``; distinct and q are estimates."""
    n, total = F.col("known"), F.col("total")
    spread = F.greatest(F.col("squares") - total * total / n, F.lit(0.0))
    return merged.select(
        "column", n.alias("count"), (F.col("rows") - n).alias("nulls"), F.hll_sketch_estimate("distinct").alias("distinct"),
        "zeros", F.col("low").alias("min"), F.col("high").alias("max"), F.when(n > 0, total / n).alias("mean"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std"),
        *[F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(p))).alias(f"q{round(100 * p)}") for p in probabilities])


def frequent_values(merged: DataFrame, k: int = 5) -> DataFrame:
    """``(column, value, n)``: the ``k`` most frequent values of each text column; ``n`` is an estimate from above."""
    found = merged.where(F.col("items").isNotNull()).select("column", F.expr(f"approx_top_k_estimate(items, {k})").alias("top"))
    return found.select("column", F.inline("top")).select("column", F.col("item").alias("value"), F.col("count").alias("n"))
