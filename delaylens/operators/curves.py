"""AUC and curves from a mergeable summary of scores, refined only where the curve's error is large.

A summary has one row ``(level, cell, lo, hi, p, n)`` per cell of a dyadic grid over [0, 1]: positives, negatives and the
extremes of the scores in it. The grid doesn't depend on the data, so summaries of days or of partitions can be stored
and added. Scores themselves are neither shuffled nor sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .evaluate import ratio

#: Bits of the first grid, bits more at each refinement, and the deepest level (2^-42 wide).
FIRST_BITS, STEP_BITS, MOST_LEVELS = 10, 4, 8
SUMMARY_SCHEMA = "level int, cell long, lo double, hi double, p long, n long"


def cell_of(score: Column, level: int) -> Column:
    """The cell of a score; -1 below 0, the one past the last from 1 on and for NaN. Exact: widths are powers of 2."""
    width = 1 << (FIRST_BITS + STEP_BITS * level)
    return (F.when(F.isnan(score) | (score >= 1), F.lit(width)).when(score < 0, F.lit(-1))
            .otherwise(F.floor(score * F.lit(float(width))))).cast("long")


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("level", "cell").agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.count_if(F.col("y") == 1).alias("p"),
                                             F.count_if(F.col("y") == 0).alias("n"))


def score_summary(df: DataFrame, label: str, score: str, tolerance: float = 1e-4) -> DataFrame:
    """The summary of labels 0 and 1 by score, refined until the AUC read from it is off by at most ``tolerance``.

    Pairs that meet in a cell of several scores may be ordered either way: they are the error, known exactly. Each
    round counts anew only the rows in the cells that carry most of it. A label of another value, or a NULL in label
    or score, leaves the row out. Scores below 0, or of 1 and more, share a cell each that can't be refined.
    The first grid has at most 1,026 cells, each refined cell 16; so many rows reach the driver.
    """
    spark = df.sparkSession
    rows = df.select(F.col(label).alias("y"), F.col(score).cast("double").alias("s")).where("y IN (0, 1) AND s IS NOT NULL")
    first = rows.withColumns({"level": F.lit(0), "cell": cell_of(F.col("s"), 0)})
    cells = {(r.level, r.cell): r for r in _counted(first).collect()}
    pairs = sum(r.p for r in cells.values()) * sum(r.n for r in cells.values())
    while True:
        error = {k: r.p * r.n / 2 / pairs for k, r in cells.items() if pairs and r.lo != r.hi}
        if sum(error.values()) <= tolerance:
            break
        rest, chosen = sum(error.values()), []
        for k in sorted(error, key=lambda k: (-error[k], k)):
            if rest <= tolerance / 2:
                break
            if k[0] < MOST_LEVELS and 0 <= k[1] < 1 << (FIRST_BITS + STEP_BITS * k[0]):
                chosen.append(k)
                rest -= error[k]
        if not chosen:
            break
        wanted = F.broadcast(spark.createDataFrame(chosen, "level int, cell long"))
        places = F.array(*[F.struct(F.lit(i).alias("level"), cell_of(F.col("s"), i).alias("cell"),
                                    cell_of(F.col("s"), i + 1).alias("child")) for i in sorted({k[0] for k in chosen})])
        near = rows.select("y", "s", F.inline(places)).join(wanted, ["level", "cell"])
        finer = near.select("y", "s", (F.col("level") + 1).alias("level"), F.col("child").alias("cell"))
        for k in chosen:
            del cells[k]
        cells.update({(r.level, r.cell): r for r in _counted(finer).collect()})
    return spark.createDataFrame([tuple(r) for r in cells.values()], SUMMARY_SCHEMA)


def merge_summaries(parts: list[DataFrame]) -> DataFrame:
    """One summary of all rows behind several. Where one has a cell whole that another refined, it stays whole."""
    every = reduce(DataFrame.unionByName, parts)
    held = every.select(F.col("level").alias("up_level"), F.col("cell").alias("up_cell")).distinct()
    above = F.expr(f"transform(sequence(0, level), i -> struct(i AS up_level, shiftright(cell, {STEP_BITS} * (level - i)) AS up_cell))")
    coarsest = every.select("level", "cell").distinct().select("level", "cell", F.inline(above)).join(
        held, ["up_level", "up_cell"]).groupBy("level", "cell").agg(F.min(F.struct("up_level", "up_cell")).alias("up"))
    return every.join(coarsest, ["level", "cell"]).groupBy(F.col("up.up_level").alias("level"), F.col("up.up_cell").alias("cell")).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("p").alias("p"), F.sum("n").alias("n"))


def _order() -> Column:
    return F.expr(f"shiftleft(cell, {STEP_BITS} * ({MOST_LEVELS} - level))")


def summary_auc(summary: DataFrame) -> DataFrame:
    """``(roc_auc, bound)``: the AUC with pairs inside a cell counted half, and how far off it is at most.
    NULLs without rows, 0 when a class is absent."""
    below = F.sum("n").over(Window.orderBy(_order()).rowsBetween(Window.unboundedPreceding, -1))
    ranked = summary.withColumn("below", F.coalesce(below, F.lit(0)))
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    pairs = F.sum(p) * F.sum(n)
    return ranked.agg(ratio(F.sum(p * (F.col("below") + n / 2)), pairs).alias("roc_auc"),
                      ratio(F.coalesce(F.sum(F.when(F.col("lo") != F.col("hi"), p * n / 2)), F.lit(0.0)), pairs).alias("bound"))


def summary_points(summary: DataFrame) -> DataFrame:
    """``(threshold, fpr, tpr, precision, recall)`` at the smallest score of each cell: points of the exact curves."""
    down = Window.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    ranked = summary.withColumn("at", _order()).select(
        F.col("lo").alias("threshold"), F.sum("p").over(down).alias("tp"), F.sum("n").over(down).alias("fp"),
        F.sum("p").over(whole).alias("P"), F.sum("n").over(whole).alias("N"))
    tp, fp = F.col("tp"), F.col("fp")
    return ranked.select("threshold", ratio(fp, F.col("N")).alias("fpr"), ratio(tp, F.col("P")).alias("tpr"),
                         ratio(tp, tp + fp).alias("precision"), ratio(tp, F.col("P")).alias("recall"))
