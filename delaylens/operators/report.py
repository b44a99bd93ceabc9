"""Grouped reports, data-quality profile and correlation tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import times as t
from .clean import filter_delayed
from .scale import bounded, numeric_columns, quantiles_of_counts, sum_over_tasks, value_counts_long


def head(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.orderBy(key).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column))


def top_n(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    return value_counts(df, column).limit(n).orderBy("n", column)


def top_by_absolute(table: DataFrame, value: str, name: str, n: int | None = None) -> DataFrame:
    """Sort by absolute value, largest first, ties by name; optionally the first ``n`` rows."""
    ordered = table.orderBy(F.abs(value).desc(), F.asc(name))
    return ordered if n is None else ordered.limit(n)


def avg_delay_by_airline(df: DataFrame, min_count: int = 100, delay: str = "ARR_DELAY",
                         group: str = "AIRLINE") -> DataFrame:
    """Mean delay and row count over delayed rows, for groups with at least ``min_count`` of them."""
    stats = filter_delayed(df, delay, group).groupBy(group).agg(
        F.avg(delay).alias("avg_delay"), F.count("*").alias("flight_count"))
    return stats.where(F.col("flight_count") >= min_count).orderBy("avg_delay", group)


def avg_delay_insights(df: DataFrame, min_count: int = 100, delay: str = "ARR_DELAY",
                       group: str = "AIRLINE") -> DataFrame:
    """Worst and best group, rows analysed, share of delayed rows and their overall mean, from one scan."""
    known = df.where(F.col(delay).isNotNull() & F.col(group).isNotNull())
    late = F.col(delay) > 0
    per_group = known.groupBy(group).agg(
        F.count("*").alias("known"), F.count_if(late).alias("late"),
        F.sum(F.when(late, F.col(delay))).alias("minutes"))
    enough = F.col("late") >= min_count
    mean = F.when(enough & (F.col("late") > 0), F.col("minutes") / F.col("late"))
    rank = F.when(mean.isNotNull(), F.struct(mean.alias("m"), F.col(group).alias("g")))
    return per_group.agg(
        F.max(rank)["g"].alias("worst"), F.max(rank)["m"].alias("worst_avg"),
        F.min(rank)["g"].alias("best"), F.min(rank)["m"].alias("best_avg"),
        F.sum(F.when(enough, F.col("late"))).alias("flights_analysed"),
        (F.sum("late") * 100.0 / F.sum("known")).alias("delayed_pct"),
        (F.sum("minutes") / F.sum("late")).alias("overall_avg"),
    )


def total_delay_by_year(df: DataFrame, column: str = "ARR_DELAY", date: str = "FL_DATE") -> DataFrame:
    return df.groupBy(F.year(date).alias("year")).agg(F.sum(column).alias("total")).orderBy("year")


def total_delay_by_year_month(df: DataFrame, column: str = "ARR_DELAY", date: str = "FL_DATE") -> DataFrame:
    keys = [F.year(date).alias("year"), F.month(date).alias("month")]
    return df.groupBy(*keys).agg(F.sum(column).alias("total")).orderBy("year", "month")


def extreme_group(table: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with the largest and the smallest value; the smaller key wins a tie."""
    rows = table.where(F.col(value).isNotNull())
    top = F.min(F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))
    low = F.min(F.struct(F.col(value).alias("v"), F.col(key).alias("k")))
    return rows.agg(top["k"].alias("max_key"), (-top["v"]).alias("max_value"),
                    low["k"].alias("min_key"), low["v"].alias("min_value"))


def monthly_trend(df: DataFrame, column: str = "ARR_DELAY", date: str = "FL_DATE") -> DataFrame:
    """Month totals with their first day, the year's total and a flag for the year with the least total."""
    months = total_delay_by_year_month(df, column, date)
    years = months.groupBy("year").agg(F.sum("total").alias("year_total"))
    least = extreme_group(years, "year", "year_total").select(F.col("min_key"))
    return (
        months.join(years, "year")
        .withColumns({"date": t.month_start("year", "month"), "is_min_year": F.col("year") == least.scalar()})
        .orderBy("date")
    )


def delay_cause_breakdown(df: DataFrame, causes: list[str]) -> DataFrame:
    """Total minutes and share per cause, largest first, the first flagged as primary. One pass."""
    sums = df.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in causes])
    long = sums.unpivot([], causes, "cause", "minutes")
    whole = Window.partitionBy()  # as many rows as causes
    place = F.row_number().over(whole.orderBy(F.desc("minutes"), F.asc("cause")))
    total = F.sum("minutes").over(whole)
    return long.select(
        "cause", t.cause_label("cause").alias("label"), "minutes",
        F.when(total != 0, F.col("minutes") * 100.0 / total).alias("pct"), (place == 1).alias("is_primary"),
    ).orderBy(F.desc("minutes"), "cause")


def delay_rate_by(df: DataFrame, key: str, label: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(label).alias("delay_rate")).orderBy(F.desc("delay_rate"), key)


def share_of_total(table: DataFrame, count: str = "n", target: str = "share") -> DataFrame:
    """Each row's part of the column total; the total is a one-value subquery."""
    total = table.agg(F.sum(count)).scalar()
    return table.withColumn(target, F.col(count).cast("double") / total)


def weighted_contribution(df: DataFrame, key: str, label: str, top: int | None = None) -> DataFrame:
    """Rows, positives, rate, weight and weight x rate per key, largest contribution first."""
    stats = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(label).alias("flights"), F.sum(label).cast("bigint").alias("delayed"))
    stats = stats.withColumn("delay_rate", F.col("delayed") / F.col("flights"))
    stats = share_of_total(stats, "flights", "weight")
    stats = stats.withColumn("contribution", F.col("weight") * F.col("delay_rate"))
    stats = stats.orderBy(F.desc("contribution"), F.asc(key))
    return stats if top is None else stats.limit(top)


def target_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(label)


def histogram(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """Equal-width bins per numeric column, last bin closed; a constant column has one bin. Empty bins are absent."""
    bounds = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns
                      for n, f in (("lo", F.min), ("hi", F.max))]).first()
    numbered = []
    for c in columns:
        lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        value = F.col(c).cast("double")
        if lo is None or lo == hi:
            number = F.when(value.isNotNull(), F.lit(0))
        else:
            number = F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
            number = F.when(value.isNotNull(), number)
        numbered.append(number.alias(c))
    long = df.select(*numbered).unpivot([], columns, "column", "bin").where(F.col("bin").isNotNull())
    return long.groupBy("column", "bin").agg(F.count("*").alias("n")).orderBy("column", "bin")


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts per (column, value) for several text columns in one pass."""
    return value_counts_long(df, columns, "string").orderBy("column", F.desc("n"), "value")


def distinct_counts(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column, all columns in one pass; ``approx`` uses sketches and no shuffle of values."""
    columns = columns or df.columns
    if approx:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return one.unpivot([], columns, "column", "distinct")
    counted = value_counts_long(df, columns, "string").groupBy("column").agg(F.count("*").alias("distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(counted, "column", "left").select("column", F.coalesce("distinct", F.lit(0)).alias("distinct"))


def shape(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per named stage."""
    parts = [df.agg(F.lit(name).alias("stage"), F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))
             for name, df in stages.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Absolute Pearson correlation of every column pair, over the rows where both are known.

    Pairs (a, b) with a before b; undefined ones (a constant side) are NULL. Hundreds of pair aggregates
    do not fit Spark's generated code, so each task adds up matrix products of its Arrow batches and only
    the sums, as many as pairs of columns, are combined. Values are centred first to keep the digits.
    """
    columns = columns or numeric_columns(df)
    d = len(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    means = numbers.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centre = np.array([means[c] if means[c] is not None else 0.0 for c in columns])

    def products(batches):
        total = np.zeros((4, d, d))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float) - centre
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            m = known.astype(float)
            total += [m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x]
        yield pd.DataFrame({"totals": [total.ravel()]})

    sums = sum_over_tasks(numbers, products)
    n, s, q, p = sums.reshape(4, d, d) if len(sums) else np.zeros((4, d, d))
    spread = n * q - s * s
    flat = (spread <= 1e-12 * n * q) | (q <= 1e-20 * n * (1 + centre[:, None] ** 2))
    defined = ~(flat | flat.T)
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.abs(n * p - s * s.T) / np.sqrt(spread * spread.T)
    rows = [(i, j, columns[i], columns[j], float(r[i, j]) if defined[i, j] else None)
            for i in range(d) for j in range(i + 1, d)]
    return df.sparkSession.createDataFrame(
        rows, "position_a int, position_b int, column_a string, column_b string, abs_corr double")


def high_correlation_pairs(matrix: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Pairs at or above the threshold; ``drop_column`` is the second of each pair."""
    return matrix.where(F.col("abs_corr") >= threshold).select(
        "column_a", "column_b", "abs_corr", F.col("column_b").alias("drop_column"))


def drop_correlated(df: DataFrame, threshold: float = 0.9, columns: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Remove the second column of every high pair; returns the removed names."""
    pairs = high_correlation_pairs(correlation_matrix(df, columns), threshold)
    dropped = sorted({r["drop_column"] for r in pairs.collect()})
    return df.drop(*dropped), dropped


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long quality table ``(column, statistic, value)``.

    Everything but the NULL counts comes from one table of value counts per column: distinct values,
    zeros, extremes, moments and quartiles are weighted by those counts.
    """
    columns = columns or df.columns
    numbers = [c for c in numeric_columns(df) if c in columns]
    others = [c for c in columns if c not in numbers]
    base = df.agg(F.count("*").alias("rows"), *[F.count(F.col(c)).alias(f"known_{c}") for c in columns]).first()
    spark = df.sparkSession
    rows = []
    for c in columns:
        rows += [(c, "count", float(base[f"known_{c}"])), (c, "nulls", float(base["rows"] - base[f"known_{c}"]))]
    if numbers:
        counts = value_counts_long(df, numbers).persist(StorageLevel.MEMORY_AND_DISK)
        v, n = F.col("value"), F.col("n")
        first = counts.groupBy("column").agg(
            F.count("*").alias("distinct"), F.min("value").alias("min"), F.max("value").alias("max"),
            F.coalesce(F.sum(F.when(v == 0, n)), F.lit(0)).alias("zeros"),
            (F.sum(v * n) / F.sum(n)).alias("mean"), F.sum("n").alias("total"))
        centre = bounded(first)
        d = v - F.col("mean")
        moments = counts.join(centre.select("column", "mean", "total"), "column").groupBy("column").agg(
            (F.sum(n * d * d) / F.first("total")).alias("m2"), (F.sum(n * d * d * d) / F.first("total")).alias("m3"),
            (F.sum(n * d * d * d * d) / F.first("total")).alias("m4"), F.first("total").alias("total"))
        for r in centre.collect():
            rows += [(r["column"], s, float(r[s])) for s in ("distinct", "min", "max", "zeros", "mean")]
        for r in moments.collect():
            total, m2 = r["total"], r["m2"]
            if total > 1:
                rows.append((r["column"], "std", (m2 * total / (total - 1)) ** 0.5))
            if m2 > 0:
                rows += [(r["column"], "skewness", r["m3"] / m2 ** 1.5), (r["column"], "kurtosis", r["m4"] / m2 ** 2 - 3)]
        for c, (q1, q2, q3) in quantiles_of_counts(counts, [0.25, 0.5, 0.75]).items():
            rows += [(c, "q25", q1), (c, "q50", q2), (c, "q75", q3)]
        counts.unpersist()
    if others:
        rows += [(r["column"], "distinct", float(r["distinct"])) for r in distinct_counts(df, others).collect()]
    return spark.createDataFrame(rows, "column string, statistic string, value double")


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent values per column, ties by value.

    Spark applies the rank filter before the shuffle as well, so each task sends at most ``k`` rows per column.
    """
    counts = value_counts_long(df, columns, "string")
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def profile_alerts(stats: DataFrame, rows: int, high_cardinality: int = 50, pairs: DataFrame | None = None) -> DataFrame:
    """Warnings read off a profile: constant, missing, zeros, unique and high-cardinality columns, high correlation."""
    wide = stats.groupBy("column").pivot("statistic", ["count", "nulls", "distinct", "zeros"]).agg(F.first("value"))
    checks = {
        "constant": F.col("distinct") == 1, "missing": F.col("nulls") > 0, "zeros": F.col("zeros") > 0,
        "unique": (F.col("distinct") == F.col("count")) & (F.col("count") == rows),
        "high_cardinality": F.col("distinct") > high_cardinality,
    }
    marks = F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()])
    alerts = wide.select("column", F.explode(F.array_compact(marks)).alias("alert"))
    if pairs is not None:
        alerts = alerts.unionByName(pairs.select(F.col("column_b").alias("column"),
                                                 F.lit("high_correlation").alias("alert")).distinct())
    return alerts


def pivot_metrics(records: DataFrame, metrics: list[str]) -> DataFrame:
    """Long metric records to one row per (Model, Stage); metric names are declared, so no extra job."""
    wide = records.groupBy("Model", "Stage").pivot("Metric", metrics).agg(F.first("Value"))
    return wide.select("Model", "Stage", *[F.round(F.col(f"`{m}`"), 4).alias(m) for m in metrics])
