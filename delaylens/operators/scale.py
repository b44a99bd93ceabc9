"""Building blocks that keep results exact without gathering unbounded data in one place."""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import checkpointed

#: Largest fitted table that is sent to every executor.
BROADCAST_ROWS = 200_000
#: Rows per range partition a running total aims at, and most distinct values of an exact quantile's state.
WINDOW_ROWS = 1_000_000

_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, _FRACTIONAL + _INTEGRAL)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def complete_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows where every column has a value.

    One condition per column: the single n-column test behind ``dropna`` is repeated by the optimizer for
    every combination of columns that are renamed or scaled afterwards.
    """
    fractional = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    test = F.lit(True)
    for c in columns or df.columns:
        test = test & F.col(c).isNotNull()
        if c in fractional:
            test = test & ~F.isnan(c)
    return df.where(test)


def spread(df: DataFrame) -> DataFrame:
    """Persist rows that several fits will read, in at least as many partitions as there are cores.

    Only an input in fewer partitions than cores is shuffled; a large one keeps its partitions.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if kept.rdd.getNumPartitions() >= cores:
        return kept
    wider = kept.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
    wider.count()
    kept.unpersist()
    return wider


def sum_over_tasks(df: DataFrame, work, arrow: bool = False) -> np.ndarray:
    """Run ``work`` on the batches of every partition and add the returned arrays, position by position, on the cluster.

    ``work`` yields frames (with ``arrow``, record batches) with one array column ``totals``; only its length reaches
    the driver.
    """
    sent = (df.mapInArrow if arrow else df.mapInPandas)(work, "totals array<double>")
    summed = sent.select(F.posexplode("totals")).groupBy("pos").agg(F.sum("col").alias("v")).toPandas()
    return summed.sort_values("pos")["v"].to_numpy()


def bounded(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Evaluate a fitted table once and mark it for broadcast when its size is proven small.

    At most ``max_rows + 1`` rows reach the driver. A larger table is written to the checkpoint folder
    and stays distributed: joins with it shuffle, and adaptive execution splits hot keys.
    """
    with kept_meanwhile(table):
        local = small_copy(table, max_rows)
        return checkpointed(table) if local is None else F.broadcast(local)


@contextmanager
def kept_meanwhile(df: DataFrame):
    """Persist ``df`` inside the block so that a size check does not evaluate it twice."""
    mine = df.storageLevel == StorageLevel.NONE
    if mine:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        if mine:
            df.unpersist()


def small_copy(df: DataFrame, max_rows: int) -> DataFrame | None:
    """The rows as a local table, or None when there are more than ``max_rows``."""
    local = df.limit(max_rows + 1).toArrow()
    return df.sparkSession.createDataFrame(local, schema=df.schema) if local.num_rows <= max_rows else None


def running_totals(df: DataFrame, order: list[str], values: list[str], by: list[str] | None = None,
                   max_window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Add ``cum_<value>``: the sum over rows up to and including this one in ``order`` within ``by``.

    ``df`` must have one row per (``by``, ``order``). Small tables use one window. Larger ones are range
    partitioned and written out; each row then adds the total of the partitions before its own.
    """
    by = by or []
    with kept_meanwhile(df):
        local = small_copy(df, min(max_window_rows, BROADCAST_ROWS))
        if local is not None:
            window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
            return local.withColumns({f"cum_{v}": F.sum(v).over(window) for v in values})
        parts = max(2, math.ceil(4 * df.count() / max_window_rows))
        ranged = checkpointed(
            df.repartitionByRange(parts, *by, *order).withColumn("__part", F.spark_partition_id())
        )
    sums = ranged.groupBy(*by, "__part").agg(*[F.sum(v).alias(f"__sum_{v}") for v in values])
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by, "__part", *[F.coalesce(F.sum(f"__sum_{v}").over(before), F.lit(0)).alias(f"__before_{v}") for v in values]
    )
    within = Window.partitionBy(*by, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # NULL is a group like any other
    offsets = offsets.withColumnsRenamed({c: f"__by_{c}" for c in [*by, "__part"]})
    same = F.col("__part") == F.col("__by___part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    joined = ranged.join(bounded(offsets), same)
    return joined.withColumns(
        {f"cum_{v}": F.sum(v).over(within) + F.col(f"__before_{v}") for v in values}
    ).select(*df.columns, *[f"cum_{v}" for v in values])


def value_counts_long(df: DataFrame, columns: list[str], as_type: str = "double") -> DataFrame:
    """One row per (column, distinct non-NULL value) with its count ``n``, for all columns in one pass."""
    typed = df.select(*[F.col(c).cast(as_type).alias(c) for c in columns])
    if len(columns) == 1:
        only = columns[0]
        long = typed.select(F.lit(only).alias("column"), F.col(only).alias("value"))
    else:
        long = typed.unpivot([], columns, "column", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))


def quantiles_of_counts(counts: DataFrame, probabilities: list[float],
                        max_window_rows: int = WINDOW_ROWS) -> dict[str, list[float]]:
    """Linear-interpolated quantiles per column from a ``(column, value, n)`` table.

    Columns with few distinct values use the weighted ``percentile`` aggregate, whose state is one entry
    per distinct value. The others are ranked with ``running_totals`` and only the rows next to the
    wanted ranks are fetched.
    """
    sizes = {r["column"]: r for r in counts.groupBy("column").agg(
        F.count("*").alias("distinct"), F.sum("n").alias("rows")).collect()}
    small = [c for c, r in sizes.items() if r["distinct"] <= max_window_rows]
    result: dict[str, list[float]] = {}
    if small:
        probs = ", ".join(f"{p!r}D" for p in probabilities)
        fitted = counts.where(F.col("column").isin(small)).groupBy("column").agg(
            F.expr(f"percentile(value, array({probs}), n)").alias("q"))
        result.update({r["column"]: list(r["q"]) for r in fitted.collect()})
    for name in sizes.keys() - set(small):
        ranked = running_totals(counts.where(F.col("column") == name).select("value", "n"), ["value"], ["n"],
                                max_window_rows=max_window_rows)
        places = [p * (sizes[name]["rows"] - 1) for p in probabilities]
        wanted = sorted({r for place in places for r in (math.floor(place), math.ceil(place))})
        hit = F.lit(False)
        for rank in wanted:
            hit = hit | ((F.col("cum_n") - F.col("n") <= rank) & (F.col("cum_n") > rank))
        found = ranked.where(hit).select("value", "n", "cum_n").collect()
        at = {rank: next(r["value"] for r in found if r["cum_n"] - r["n"] <= rank < r["cum_n"]) for rank in wanted}
        result[name] = [
            at[math.floor(p)] + (p - math.floor(p)) * (at[math.ceil(p)] - at[math.floor(p)]) for p in places
        ]
    return result


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float],
                    max_window_rows: int = WINDOW_ROWS) -> dict[str, list[float]]:
    """Quantiles of several columns, NULLs ignored; an all-NULL column is missing from the result."""
    counts = value_counts_long(df, columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return quantiles_of_counts(counts, probabilities, max_window_rows)
    finally:
        counts.unpersist()


def approximate_quantiles(df: DataFrame, columns: list[str], probabilities: list[float],
                          accuracy: int = 10_000) -> dict[str, list[float]]:
    """Sketch quantiles of all columns in one aggregate; rank error at most 1 / ``accuracy``."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probabilities, accuracy).alias(c)
                   for c in columns]).first()
    return {c: list(row[c]) for c in columns if row[c] is not None}


def hash_uniform(key: str | list[str], seed: int | str) -> Column:
    """A reproducible 32-bit hash of the key, the same in every engine that has MD5."""
    keys = [key] if isinstance(key, str) else key
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def rank_cuts(df: DataFrame, key: str, strata: str, hashed: str, positions: Column) -> DataFrame:
    """The (hash, key) of the row at each wanted rank inside each stratum, one row per stratum.

    ``positions`` is an array of 1-based ranks as an expression of the stratum size ``size``. The 32-bit hash is taken
    by halves: counts per (stratum, upper 16 bits) find the bucket that holds a rank, counts per hash inside that bucket
    find the hash, counts per key with that hash the row. Every step sorts counts, at most 65,536 per cut, or the
    different keys of one hash; rows that share bucket, hash or key are never gathered.
    """
    bucket = F.shiftright(F.col(hashed), 16)
    per_bucket = df.groupBy(F.col(strata).alias("__stratum"), bucket.alias("__bucket")).agg(F.count("*").alias("n"))
    sized = F.sum("n").over(Window.partitionBy("__stratum"))
    counted = _ranked(per_bucket, ["__stratum"], "__bucket").withColumn("size", sized)
    targets = counted.select("__stratum", "__bucket", "n", "upto", F.posexplode(positions).alias("cut", "need"))
    targets = bounded(_holding(targets, "__stratum", "__bucket", "cut"))
    near = df.select(F.col(strata).alias("__s"), bucket.alias("__b"), F.col(hashed).alias("u"), F.col(key).alias("k"))
    near = near.join(targets, F.col("__s").eqNullSafe(F.col("__stratum")) & (F.col("__b") == F.col("__bucket")))
    per_key = near.groupBy("__stratum", "cut", "need", "u", "k").agg(F.count("*").alias("n"))
    per_hash = _ranked(per_key.groupBy("__stratum", "cut", "need", "u").agg(F.sum("n").alias("n")), ["__stratum", "cut"], "u")
    found = bounded(_holding(per_hash, "__stratum", "cut", "u"))
    found = found.withColumnsRenamed({"__stratum": "__s", "cut": "__cut", "u": "__u", "need": "__need"})
    same = F.col("__stratum").eqNullSafe(F.col("__s")) & (F.col("cut") == F.col("__cut")) & (F.col("u") == F.col("__u"))
    last = _ranked(per_key.join(found, same).drop("need").withColumnRenamed("__need", "need"), ["__stratum", "cut"], "k")
    return last.where((F.col("need") <= F.col("upto")) & (F.col("need") > F.col("upto") - F.col("n"))).groupBy("__stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("cut", F.struct("u", "k")))).alias("__cuts"))


def _ranked(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """``upto``: the rows up to and including each count."""
    return counts.withColumn("upto", F.sum("n").over(
        Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def _holding(ranked: DataFrame, *columns: str) -> DataFrame:
    """The counts that hold the rank ``need``, which then is the rank among their own rows."""
    start = F.col("upto") - F.col("n")
    return ranked.where((F.col("need") <= F.col("upto")) & (F.col("need") > start)).select(
        *columns, (F.col("need") - start).alias("need"))
