"""Reproducible splits, folds and samples from a hash of the row key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scale import bounded, hash_uniform, kept_meanwhile, rank_cuts

SPAN = float(2 ** 32)
_U = "__u"


def _by_rank(df: DataFrame, key: str, strata: str, seed: int, positions, names: list[object], target: str) -> DataFrame:
    """Give each row the name of the first cut it does not exceed, the last name beyond all cuts."""
    hashed = df.withColumn(_U, hash_uniform(key, seed))
    slim = hashed.select(key, strata, _U)
    with kept_meanwhile(slim):  # read by both counting passes; the input itself is read once here, once below
        cuts = bounded(rank_cuts(slim, key, strata, _U, positions))
    me = F.struct(F.col(_U).alias("u"), F.col(key).alias("k"))
    choice = None
    for i, name in enumerate(names[:-1]):
        test = me <= F.col("__cuts")[i]
        choice = F.when(test, name) if choice is None else choice.when(test, name)
    joined = hashed.join(cuts, F.col(strata).eqNullSafe(F.col("__stratum")), "left")
    return joined.withColumn(target, choice.otherwise(names[-1])).drop(_U, "__stratum", "__cuts")


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.15, val: float = 0.15, seed: int = 42,
                     target: str = "split") -> DataFrame:
    """Column ``split``: per class the ``ceil(test * n)`` smallest hashes are test, then ``ceil(val * rest)`` val.

    The cuts are found by counting, so the rows themselves are never shuffled; equal keys share a side.
    """
    n_test = F.ceil(F.col("size") * F.lit(test))
    positions = F.array(n_test, n_test + F.ceil((F.col("size") - n_test) * F.lit(val)))
    if val == 0:
        positions = F.array(n_test)
    names = ["test", "val", "train"] if val else ["test", "train"]
    return _by_rank(df, key, label, seed, positions, names, target)


def split_or_two_way(df: DataFrame, label: str, key: str, test: float = 0.15, val: float = 0.15, seed: int = 42,
                     target: str = "split") -> DataFrame:
    """Stratified split; without a validation part when a side would have a single class."""
    done = stratified_split(df, label, key, test, val, seed, target)
    sides = done.groupBy(target).agg(F.count_distinct(label).alias("classes")).collect()
    if len(sides) == 3 and all(r["classes"] > 1 for r in sides):
        return done
    return stratified_split(df, label, key, test, 0.0, seed, target)


def random_split(df: DataFrame, key: str, test: float = 0.2, val: float = 0.25, seed: int = 42,
                 target: str = "split") -> DataFrame:
    """Hash thresholds: ``test`` of all rows, then ``val`` of the rest. A pure projection."""
    u = hash_uniform(key, seed) / F.lit(SPAN)
    edge = test + (1 - test) * val
    return df.withColumn(target, F.when(u < test, "test").when(u < edge, "val").otherwise("train"))


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, target: str = "fold") -> DataFrame:
    return df.withColumn(target, F.pmod(hash_uniform(key, seed), F.lit(k)).cast("int"))


def stratified_kfold(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     target: str = "fold") -> DataFrame:
    """Folds of equal class shares: the hash order of each class is cut into ``k`` runs of equal length."""
    positions = F.array(*[F.ceil(F.col("size") * F.lit(i) / F.lit(k)) for i in range(1, k)])
    return _by_rank(df, key, label, seed, positions, list(range(k)), target)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest hashes: a bounded top-k, no full sort."""
    return df.withColumn(_U, hash_uniform(key, seed)).orderBy(_U, key).limit(n).drop(_U)
