"""Applying fitted tables to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scale import bounded


def lookup_map(df: DataFrame, key: str, fitted: DataFrame, values: dict[str, str], fitted_key: str | None = None,
               defaults: dict[str, object] | None = None, is_bounded: bool = False) -> DataFrame:
    """Left join ``fitted`` on ``key``: add ``values`` ({fitted column: new column}) with defaults for misses.

    ``is_bounded`` says that ``fitted`` already went through ``bounded``.
    """
    fitted_key = fitted_key or key
    defaults = defaults or {}
    side = fitted.select(F.col(fitted_key).alias("__key"), *[F.col(v).alias(f"__v_{v}") for v in values])
    side = side if is_bounded else bounded(side)
    joined = df.join(side, F.col(key) == F.col("__key"), "left")
    added = {}
    for source, target in values.items():
        value = F.col(f"__v_{source}")
        default = defaults.get(target)
        added[target] = value if default is None else F.coalesce(value, F.lit(default))
    return joined.withColumns(added).drop("__key", *[f"__v_{v}" for v in values])


def top_k_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-NULL keys, ties broken by the key itself."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(k)


def in_top_k(df: DataFrame, key: str, k: int, flag: str) -> DataFrame:
    """1 where the key is one of the ``k`` most frequent, else 0."""
    marked = top_k_keys(df, key, k).select(key, F.lit(1).alias("hit"))
    return lookup_map(df, key, marked, {"hit": flag}, defaults={flag: 0})
