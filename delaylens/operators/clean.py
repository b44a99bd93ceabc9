"""Row filters, projections, casts and outlier rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.times import over_threshold
from .scale import approximate_quantiles, complete_rows, exact_quantiles, numeric_columns


def filter_not_cancelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("CANCELLED") == 0)


def filter_completed(df: DataFrame) -> DataFrame:
    return df.where((F.col("CANCELLED") == 0) & (F.col("DIVERTED") == 0))


def select_cancelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("CANCELLED") == 1)


def filter_delayed(df: DataFrame, delay: str = "ARR_DELAY", group: str = "AIRLINE") -> DataFrame:
    return df.where((F.col(delay) > 0) & F.col(group).isNotNull())


def exclude_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def keep_numeric(df: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Numeric columns (and ``keep``) in order, with the names of the dropped ones."""
    wanted = set(numeric_columns(df)) | set(keep or [])
    kept = [c for c in df.columns if c in wanted]
    return df.select(*kept), [c for c in df.columns if c not in wanted]


def fill_delay_causes(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=[c for c in columns if c in df.columns])


def drop_null_label(df: DataFrame, label: str) -> DataFrame:
    return df.dropna(subset=[label])


def drop_any_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return complete_rows(df, columns)


def non_null_counts(df: DataFrame) -> dict[str, int]:
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value, found in one pass over all columns."""
    return df.drop(*[c for c, n in non_null_counts(df).items() if n == 0])


def null_audit(df: DataFrame) -> DataFrame:
    """``(column, nulls)`` for every column from a single aggregate."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column", "nulls")


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text to double; unreadable text -> NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in df.columns})


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def binary_target(df: DataFrame, column: str, target: str, op: str = ">", threshold: float = 15.0,
                  null_as: int = 0) -> DataFrame:
    return df.withColumn(target, over_threshold(column, op, threshold, null_as))


@dataclass(frozen=True)
class Fence:
    """Outlier bounds of one column; ``inside`` keeps both ends, and drops NULL."""

    column: str
    low: float
    high: float

    def inside(self):
        return F.col(self.column).between(F.lit(self.low), F.lit(self.high))

    def outside(self):
        return (F.col(self.column) < self.low) | (F.col(self.column) > self.high)


def iqr_fences(df: DataFrame, columns: list[str], k: float, approx: bool = False) -> list[Fence]:
    """Quartile fences of several columns from one pass; columns without values have no fence."""
    quantiles = (approximate_quantiles if approx else exact_quantiles)(df, columns, [0.25, 0.75])
    fences = []
    for c in columns:
        if c in quantiles:
            q1, q3 = quantiles[c]
            fences.append(Fence(c, q1 - k * (q3 - q1), q3 + k * (q3 - q1)))
    return fences


def remove_outliers_iqr(df: DataFrame, column: str = "ARR_DELAY", k: float = 3.0, approx: bool = False) -> DataFrame:
    """Rows inside the fences; the bounds are literals, so the filter reaches the scan."""
    fences = iqr_fences(df, [column], k, approx)
    return df.where(fences[0].inside()) if fences else df.limit(0)


def select_outliers_iqr(df: DataFrame, column: str = "ARR_DELAY", k: float = 1.5, approx: bool = False) -> DataFrame:
    fences = iqr_fences(df, [column], k, approx)
    return df.where(fences[0].outside()) if fences else df.limit(0)


def remove_outliers_iqr_all(df: DataFrame, columns: list[str] | None = None, k: float = 1.5,
                            mode: str = "sequential", approx: bool = False) -> DataFrame:
    """Fences on every numeric column.

    ``sequential`` takes each column's quartiles on the rows that passed the earlier columns, one small
    job per column over the persisted measures; ``joint`` takes all quartiles on the input in one pass.
    """
    columns = columns or numeric_columns(df)
    if mode == "joint":
        fences = iqr_fences(df, columns, k, approx)
        return _inside_all(df, columns, fences)
    measures = df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    fences: list[Fence] = []
    try:
        passing = measures
        for c in columns:
            found = iqr_fences(passing, [c], k, approx)
            fences += found
            passing = passing.where(found[0].inside()) if found else passing.limit(0)
    finally:
        measures.unpersist()
    return _inside_all(df, columns, fences)


def _inside_all(df: DataFrame, columns: list[str], fences: list[Fence]) -> DataFrame:
    if len(fences) < len(columns):
        return df.limit(0)
    for fence in fences:
        df = df.where(fence.inside())
    return df


def schema_difference(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``(column, status, position)`` with status missing, extra, moved or same; two schemas, no data scan."""
    have, want = df.columns, expected.names
    rows = [(c, "missing" if c not in have else "same" if have.index(c) == i else "moved", i)
            for i, c in enumerate(want)]
    rows += [(c, "extra", i) for i, c in enumerate(have) if c not in want]
    return df.sparkSession.createDataFrame(rows, "column string, status string, position int")


def align_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Reorder to ``expected``, add absent columns as NULL and drop extra ones."""
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in expected
    ])


def low_cardinality_columns(df: DataFrame, low: int = 2, high: int = 49, columns: list[str] | None = None,
                            approx: bool = False) -> list[str]:
    from .report import distinct_counts

    found = distinct_counts(df, columns, approx=approx).where(F.col("distinct").between(low, high))
    names = {r["column"] for r in found.collect()}
    return [c for c in df.columns if c in names]


def select_features(df: DataFrame, features: list[str], label: str, drop_nulls: bool = True) -> DataFrame:
    chosen = df.select(*features, label)
    return complete_rows(chosen) if drop_nulls else chosen


def require(df: DataFrame, columns: list[str] | None = None, non_empty: bool = False, label: str | None = None,
            classes: int = 2) -> DataFrame:
    """Return ``df`` or raise when a column is missing, no row exists or the label has too few classes."""
    missing = [c for c in columns or [] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if non_empty and df.isEmpty():
        raise ValueError("the table has no rows")
    if label is not None:
        seen = df.where(F.col(label).isNotNull()).select(label).distinct().limit(classes).count()
        if seen < classes:
            raise ValueError(f"{label} has {seen} classes, {classes} needed")
    return df
