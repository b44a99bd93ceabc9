"""Encoders as fitted tables: ``fit`` returns a small DataFrame, ``apply`` joins it, unseen values are defined."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, functions as F

from .lookup import lookup_map
from .scale import WINDOW_ROWS, bounded, numeric_columns, running_totals

MISSING = "Missing"
NULL_CATEGORY = "\u0000null"


def fit_woe(df: DataFrame, columns: list[str], label: str, null_mode: str = "category",
            smoothing: float = 1.0) -> DataFrame:
    """Weight of evidence ``(column, category, woe)`` for all columns in one pass.

    ``ln`` of the smoothed share of positives over the smoothed share of negatives; a category seen once
    gets 0. NULL is a category of its own, or the text 'Missing' with ``null_mode="missing"``.
    """
    null = NULL_CATEGORY if null_mode == "category" else MISSING
    known = df.where(F.col(label).isNotNull())
    long = known.select(
        F.col(label).cast("bigint").alias("__y"), *[F.coalesce(F.col(c), F.lit(null)).alias(c) for c in columns]
    ).unpivot(["__y"], columns, "column", "category")
    stats = long.groupBy("column", "category").agg(F.count("*").alias("n"), F.sum("__y").alias("p"))
    stats = stats.join(
        stats.groupBy("column").agg(F.sum("p").alias("all_p"), F.sum(F.col("n") - F.col("p")).alias("all_n")), "column")
    a = F.lit(float(smoothing))
    share_p = (F.col("p") + a) / (F.col("all_p") + 2 * a)
    share_n = (F.col("n") - F.col("p") + a) / (F.col("all_n") + 2 * a)
    woe = F.when(F.col("n") == 1, 0.0).otherwise(F.log(share_p / share_n))
    return stats.select("column", "category", woe.alias("woe"))


def apply_woe(df: DataFrame, columns: list[str], fitted: DataFrame, null_mode: str = "category",
              drop: bool = True) -> DataFrame:
    """Add ``{column}_WOE`` (0 for unseen values) and drop the text columns."""
    null = NULL_CATEGORY if null_mode == "category" else MISSING
    table = bounded(fitted)
    for c in columns:
        keyed = df.withColumn("__category", F.coalesce(F.col(c), F.lit(null)))
        part = table.where(F.col("column") == c)
        df = lookup_map(keyed, "__category", part, {"woe": f"{c}_WOE"}, "category", {f"{c}_WOE": 0.0},
                        is_bounded=True).drop("__category")
    return df.drop(*columns) if drop else df


def woe_encode(df: DataFrame, columns: list[str], label: str, null_mode: str = "category",
               fit_on: DataFrame | None = None) -> DataFrame:
    fitted = fit_woe(df if fit_on is None else fit_on, columns, label, null_mode)
    return apply_woe(df, columns, fitted, null_mode)


def fit_categories(df: DataFrame, column: str, max_window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``(category, code)``: sorted distinct values numbered from 0, whatever their number."""
    distinct = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("category")).distinct()
    ranked = running_totals(distinct.withColumn("one", F.lit(1)), ["category"], ["one"],
                            max_window_rows=max_window_rows)
    return ranked.select("category", (F.col("cum_one") - 1).cast("bigint").alias("code"))


def label_encode(df: DataFrame, column: str, fitted: DataFrame | None = None, target: str | None = None,
                 unseen: int = -1, is_bounded: bool = False) -> DataFrame:
    """Replace the column by its code; unseen values and NULL get ``unseen``.

    ``is_bounded`` says that ``fitted`` already went through ``bounded``.
    """
    target = target or column
    fitted = fit_categories(df, column) if fitted is None else fitted
    keyed = df.withColumn("__category", F.col(column).cast("string"))
    out = lookup_map(keyed, "__category", fitted, {"code": "__found"}, "category", {"__found": unseen}, is_bounded)
    return out.withColumn(target, F.col("__found").cast("bigint")).drop("__category", "__found")


def ordinal_encode(df: DataFrame, column: str, order: list[str], target: str | None = None) -> DataFrame:
    """Position in a declared order; -1 outside it, NULL stays NULL."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column)) - 1
    return df.withColumn(target or column, place.cast("bigint"))


def one_hot(df: DataFrame, column: str, fitted: DataFrame | None = None, drop_first: bool = False,
            form: str = "columns", keep: bool = False) -> DataFrame:
    """The column as 0/1 values per category, all 0 for unseen values and NULL; ``drop_first`` leaves the first out.

    ``form`` alone decides the schema: ``columns`` adds one column per category, ``vector`` one sparse vector
    ``{column}_vec`` over the codes, for columns with so many categories that a wide table is of no use.
    """
    if form not in ("columns", "vector"):
        raise ValueError(f"form is 'columns' or 'vector', not {form!r}")
    fitted = fit_categories(df, column) if fitted is None else fitted
    if form == "vector":
        size = fitted.count()
        # the encoder drops its last place: that of unseen values, and of the first category if it is left out
        coded = label_encode(df, column, fitted, target="__code", unseen=-1 if drop_first else size)
        place = F.col("__code")
        if drop_first:
            place = F.when(place > 0, place - 1).otherwise(size - 1)
        last = float(size - 1 if drop_first else size)
        model = OneHotEncoder(inputCol="__code", outputCol=f"{column}_vec", handleInvalid="error", dropLast=True)
        span = df.sparkSession.createDataFrame([(last,)], "__code double")
        out = model.fit(span).transform(coded.withColumn("__code", place.cast("double"))).drop("__code")
    else:
        categories = [r["category"] for r in fitted.orderBy("code").collect()]  # as many as the columns asked for
        value = F.coalesce(F.col(column).cast("string"), F.lit(NULL_CATEGORY))
        out = df.withColumns({f"{column}_{v}": (value == v).cast("int") for v in categories[drop_first:]})
    return out if keep else out.drop(column)


def dummies_drop_first(df: DataFrame, columns: list[str], form: str = "columns") -> DataFrame:
    for c in columns:
        df = one_hot(df, c, drop_first=True, form=form)
    return df


def hot_place(vector: str | Column) -> Column:
    """The place of a vector's first 1, from 0; -1 without one. A sparse vector is never written out."""
    v = F.unwrap_udt(vector)
    at = F.array_position(v["values"], 1.0)
    return F.when(at == 0, -1).when(v["type"] == 0, F.get(v["indices"], (at - 1).cast("int"))).otherwise(at - 1)


def binary_width(fitted: DataFrame) -> int:
    """Bits needed for ordinals 1..n."""
    top = fitted.agg(F.max("code")).first()[0]
    return 0 if top is None else (int(top) + 1).bit_length()


def binary_encode(df: DataFrame, columns: list[str], fitted: dict[str, DataFrame] | None = None) -> DataFrame:
    """Ordinals 1..n by ascending category as bit columns, highest bit first; unseen values and NULL are all 0."""
    for c in columns:
        table = bounded((fitted or {}).get(c) if fitted and c in fitted else fit_categories(df, c))
        width = binary_width(table)
        coded = label_encode(df, c, table, target="__code", unseen=-1, is_bounded=True)
        ordinal = F.col("__code") + 1
        df = coded.withColumns({f"{c}_{j}": F.shiftright(ordinal, width - 1 - j).bitwiseAND(1).cast("int")
                                for j in range(width)}).drop("__code", c)
    return df


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation of each scaled column."""

    mean: dict[str, float]
    deviation: dict[str, float]


def scalable_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Numeric columns that are neither 0/1 flags nor sine/cosine columns; one aggregate decides."""
    candidates = [c for c in numeric_columns(df)
                  if c not in (exclude or []) and not c.endswith(("_SIN", "_COS"))]
    if not candidates:
        return []
    flags = df.agg(*[F.bool_and(F.col(c).isin(0, 1)).alias(c) for c in candidates]).first()
    return [c for c in candidates if not flags[c]]


def fit_standard(df: DataFrame, columns: list[str]) -> Scaling:
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    known = [c for c in columns if stats[f"m_{c}"] is not None]
    return Scaling({c: stats[f"m_{c}"] for c in known}, {c: stats[f"s_{c}"] or 1.0 for c in known})


def apply_standard(df: DataFrame, fitted: Scaling) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(fitted.deviation[c])
                           for c, m in fitted.mean.items()})


def standard_scale(df: DataFrame, columns: list[str] | None = None, exclude: list[str] | None = None,
                   fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; constant columns are only centred."""
    source = df if fit_on is None else fit_on
    columns = scalable_columns(source, exclude) if columns is None else columns
    return apply_standard(df, fit_standard(source, columns))


def impute_mean(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    source = df if fit_on is None else fit_on
    means = source.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c]))
                           for c in columns if means[c] is not None})
