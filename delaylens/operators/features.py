"""Derived columns and group-to-row features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import times as t
from .lookup import lookup_map
from .scale import bounded, complete_rows


def cyclical_minutes(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Sine/cosine of clock columns after filling NULL with the column mean, both of the rows in ``fit_on`` (all rows).

    Names containing TIME are HHMM: they get ``_MINUTES`` and a period of one day. Other columns are
    scaled by their own maximum. One aggregate serves all columns.
    """
    columns = [c for c in columns if c in df.columns]
    values = {c: F.col(c).try_cast("double") for c in columns}
    stats = (df if fit_on is None else fit_on).agg(*[F.avg(v).alias(f"mean_{c}") for c, v in values.items()],
                   *[F.max(v).alias(f"max_{c}") for c, v in values.items()]).first()
    filled, derived = {}, {}
    for c, v in values.items():
        mean = stats[f"mean_{c}"]
        filled[c] = v if mean is None else F.coalesce(v, F.lit(mean))
        if "TIME" in c.upper():
            name, position, period = f"{c}_MINUTES", t.hhmm_to_minutes(F.col(c)), float(t.DAY_MINUTES)
            derived[name] = position
        else:
            name, position = c, F.col(c)
            period = max(stats[f"max_{c}"] or 0.0, mean or 0.0)
            period = period if period > 0 else 1.0
        derived[f"{name}_SIN"], derived[f"{name}_COS"] = t.cyclical(position, period)
    return df.withColumns(filled).withColumns(derived)


def cyclical_hour_minute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Four columns per HHMM clock: sine and cosine of its hour (24) and of its minute (60); NULL stays NULL."""
    added = {}
    for c in columns:
        name = c.lower()
        added[f"{name}_hour_sin"], added[f"{name}_hour_cos"] = t.cyclical(t.hour_of_hhmm(c), 24.0)
        added[f"{name}_minute_sin"], added[f"{name}_minute_cos"] = t.cyclical(t.minute_of_hhmm(c), 60.0)
    return df.withColumns(added)


def weekday_features(df: DataFrame, date: str = "FL_DATE") -> DataFrame:
    return df.withColumns({"DAY_OF_WEEK": t.weekday(date), "IS_WEEKEND": t.is_weekend(date).cast("int")})


def day_name_features(df: DataFrame, columns: list[str]) -> DataFrame:
    added = {}
    for c in columns:
        added[f"{c}_day_name"] = t.day_name(c)
        added[f"{c}_is_weekend"] = t.is_weekend(c)
    return df.withColumns(added)


def date_parts(df: DataFrame, date: str = "FL_DATE", prefix: str = "FL_") -> DataFrame:
    d = F.col(date)
    return df.withColumns({f"{prefix}YEAR": F.year(d), f"{prefix}MONTH": F.month(d), f"{prefix}DAY": F.day(d),
                           f"{prefix}DOW": F.weekday(d)})


def split_city_state(df: DataFrame, columns: list[str], naming: str = "suffix") -> DataFrame:
    """Split "City, ST" at the first comma.

    ``suffix``: new ``X_CITY`` and ``X_STATE`` replace ``X``; ``overwrite``: ``X`` keeps the city and
    ``origin_state`` style columns are added.
    """
    for c in columns:
        if naming == "suffix":
            df = df.withColumns({f"{c}_CITY": t.city_part(c), f"{c}_STATE": t.state_part(c)}).drop(c)
        else:
            state = f"{c.lower().removesuffix('_city')}_state"
            df = df.withColumns({state: t.state_part(c), c: t.city_part(c)})
    return df


def elapsed_time_diff(df: DataFrame, actual: str = "ELAPSED_TIME", planned: str = "CRS_ELAPSED_TIME",
                      target: str = "ELAPSED_TIME_DIFF") -> DataFrame:
    """Actual minus planned duration on rows that have both; unchanged when a column is absent."""
    if actual not in df.columns or planned not in df.columns:
        return df
    a, p = F.col(actual).try_cast("double"), F.col(planned).try_cast("double")
    return df.withColumn(target, a - p).where(F.col(target).isNotNull())


def total_taxi_time(df: DataFrame, limit: float = 120.0, target: str = "TTT") -> DataFrame:
    return df.withColumn(target, t.clip_upper(F.col("TAXI_OUT") + F.col("TAXI_IN"), limit))


def airport_congestion(df: DataFrame, window: int = 60, date: str = "FL_DATE", place: str = "ORIGIN",
                       clock: str = "CRS_DEP_TIME", target: str = "RACI") -> DataFrame:
    """Rows of the same date and place whose clock is within ``window`` minutes, itself included.

    Rows are first counted per minute, so the sliding frame runs over at most one day of minutes per
    (date, place) whatever the number of rows, and the result is joined back: by broadcast when it is
    small, else by a shuffle on all three keys, where adaptive execution splits hot minutes. NULL keys count 0.
    """
    minute = t.hhmm_to_minutes(clock).cast("int")
    keys = df.select(F.col(date).alias("__d"), F.col(place).alias("__p"), minute.alias("__m"))
    per_minute = complete_rows(keys).groupBy("__d", "__p", "__m").agg(F.count("*").alias("__n"))
    frame = Window.partitionBy("__d", "__p").orderBy("__m").rangeBetween(-window, window)
    counts = bounded(per_minute.select("__d", "__p", "__m", F.sum("__n").over(frame).alias("__near")))
    keyed = df.withColumn("__minute", minute)
    joined = keyed.join(
        counts, (F.col(date) == F.col("__d")) & (F.col(place) == F.col("__p")) & (F.col("__minute") == F.col("__m")),
        "left")
    return joined.withColumn(target, F.coalesce(F.col("__near"), F.lit(0))).drop(
        "__d", "__p", "__m", "__near", "__minute")


def fit_delay_propensity(df: DataFrame, key: str, label: str) -> DataFrame:
    """Mean label per key, with the overall mean in the row whose key is NULL."""
    return _with_overall(df, key, F.avg(label).alias("score"))


def fit_delay_severity(df: DataFrame, key: str, delay: str = "ARR_DELAY") -> DataFrame:
    """Mean positive delay per key, with the overall mean in the row whose key is NULL."""
    return _with_overall(df.where(F.col(delay) > 0), key, F.avg(delay).alias("score"))


def _with_overall(df: DataFrame, key: str, *measures: Column) -> DataFrame:
    """Per-key and overall scores from one scan."""
    scores = df.rollup(key).agg(*measures, F.grouping_id().alias("__overall"))
    return scores.where((F.col("__overall") == 1) | F.col(key).isNotNull()).drop("__overall")


def apply_group_score(df: DataFrame, key: str, fitted: DataFrame, target: str) -> DataFrame:
    """Attach the score of each row's key; unseen and NULL keys get the overall score."""
    table = bounded(fitted)
    overall = table.where(F.col(key).isNull()).first()
    return lookup_map(df, key, table.where(F.col(key).isNotNull()), {"score": target},
                      defaults={target: overall["score"] if overall else None}, is_bounded=True)


def fit_fold_scores(df: DataFrame, key: str, value: Column, fold: str, folds: int) -> DataFrame:
    """The mean ``value`` per key over the rows outside each fold, as ``score_<fold>``, from one scan.

    The row whose key is NULL has the overall means.
    """
    return _with_overall(df, key, *[F.avg(F.when(F.col(fold) != i, value)).alias(f"score_{i}") for i in range(folds)])


def apply_fold_scores(df: DataFrame, key: str, fitted: DataFrame, target: str, folds: int) -> DataFrame:
    """Attach ``<target>_<fold>`` per fold: a model that holds the fold out sees nothing of that fold's values.

    A key without rows outside a fold gets the overall mean outside it.
    """
    table = bounded(fitted)
    overall = table.where(F.col(key).isNull()).first()
    names = {f"score_{i}": f"{target}_{i}" for i in range(folds)}
    return lookup_map(df, key, table.where(F.col(key).isNotNull()), names,
                      defaults={t: overall[s] if overall else None for s, t in names.items()}, is_bounded=True)


def delay_propensity(df: DataFrame, label: str, key: str = "ORIGIN", target: str = "ADP",
                     fit_on: DataFrame | None = None) -> DataFrame:
    return apply_group_score(df, key, fit_delay_propensity(df if fit_on is None else fit_on, key, label), target)


def delay_severity(df: DataFrame, key: str = "ORIGIN", delay: str = "ARR_DELAY", target: str = "HDS",
                   fit_on: DataFrame | None = None) -> DataFrame:
    return apply_group_score(df, key, fit_delay_severity(df if fit_on is None else fit_on, key, delay), target)


def with_time_slot(df: DataFrame, clock: str = "CRS_DEP_TIME", target: str = "TIME_SLOT") -> DataFrame:
    return df.withColumn(target, t.time_slot(t.hhmm_to_minutes(clock)))


def time_of_day_risk(df: DataFrame, label: str, clock: str = "CRS_DEP_TIME", target: str = "TODR",
                     fit_on: DataFrame | None = None) -> DataFrame:
    """Mean label of the row's six-hour slot."""
    fitted = fit_delay_propensity(with_time_slot(df if fit_on is None else fit_on, clock), "TIME_SLOT", label)
    return apply_group_score(with_time_slot(df, clock), "TIME_SLOT", fitted, target).drop("TIME_SLOT")
