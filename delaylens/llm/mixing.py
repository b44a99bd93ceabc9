"""Mixing sources to target weights: hash histograms, a threshold per source, a filter without sorting."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import sent_if_small, words_of

#: Hash digits (base 16) by which each histogram refines the one before; together the 15 digits of the hash.
LEVELS = (3, 3, 9)
#: Weights by which the sources, in order of code points, share the mix.
WEIGHTS = (3, 1, 2)


def row_hash(docs: DataFrame, key: str, text: str) -> Column:
    """60 bits of an MD5 of key and text; only rows equal in both share it. NULL differs from an empty string."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    return F.conv(F.substring(F.md5(F.concat_ws("|", part(key), part(text))), 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add ``target`` to one row per source ``(source, source_size)``.

    The targets add up to ``share`` of all sizes, in proportion to the weights, but none exceeds ``most`` times its
    source. Resharing the excess ends where all sources that are not capped get the same words per unit of weight;
    that level follows from the sources in order of the level at which each is capped.
    """
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    rows = sources.withColumn("w", w).withColumn("cap", F.lit(most) * F.col("source_size"))
    rows = rows.withColumn("capped_at", F.col("cap") / F.col("w"))
    before = Window.orderBy("capped_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "budget": F.lit(share) * F.sum("source_size").over(everywhere),
        "full": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open_w": F.sum("w").over(everywhere) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
    })
    level = (F.col("budget") - F.col("full")) / F.col("open_w")
    # the level is that of the first source which isn't capped at its own; the levels of later ones are lower
    rows = rows.withColumn("level", F.when(level <= F.col("capped_at"), level))
    rows = rows.withColumn("level", F.max("level").over(everywhere))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w")))
    return rows.select("source", "source_size", target.alias("target"))


def thresholds(slim: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source the number of full ``rounds`` and the hash ``below`` which rows are taken once more.

    Budgets are met by nested histograms: sizes are summed per hash bucket, the bucket that holds the budget is found
    from the running total, and only its rows are counted again by the next digits. The last histogram has one bucket
    per hash value, and the end that lies nearer to the budget wins (the lower one in a tie).
    """
    size, t = F.col("source_size"), F.col("target")
    rounds = F.when(size > 0, F.floor(F.when(size > 0, t / size))).otherwise(F.lit(0)).cast("long")
    state = sources.withColumn("rounds", rounds).withColumn("need", t - F.col("rounds") * size)
    state = state.withColumn("prefix", F.lit(0).cast("long"))
    known = 0
    for digits in LEVELS:
        shift, above = 4 * (15 - known - digits), 4 * (15 - known)
        bucket = F.shiftright("h", shift)
        near = slim
        if known:
            edge = sent_if_small(state.select(F.col("source").alias("s"), F.col("prefix").alias("p")),
                                 F.octet_length("s") + 16)
            near = slim.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", above) == F.col("p")))
        histogram = near.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        state = state.select(F.col("source").alias("s"), "rounds", "need")
        counted = histogram.withColumn("upto", F.sum("n").over(upto)).join(state, F.col("source").eqNullSafe(F.col("s")))
        # the first bucket that passes the budget; sources whose rows all fit have none
        found = counted.where(F.col("upto") > F.col("need")).groupBy("source").agg(
            F.min(F.struct("bucket", "upto", "n", "need", "rounds")).alias("f"))
        state = found.select("source", "f.rounds", F.col("f.bucket").alias("prefix"), F.col("f.n").alias("n"),
                             (F.col("f.need") - F.col("f.upto") + F.col("f.n")).alias("need"))
        state = state.persist(StorageLevel.MEMORY_AND_DISK)  # one row per source
        known += digits
    nearer = F.col("n") - F.col("need") < F.col("need")
    return state.select("source", "rounds", (F.col("prefix") + nearer.cast("long")).alias("below"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_times`` (how often the mix takes it).

    A NULL text has size 0, a NULL source is a source of its own, ordered last. Rows equal in key and text share a
    hash and are taken together. ``mix_times`` depends on contents only, so reruns agree. No row is taken more than
    ceil(``most``) times. Columns whose names begin with ``mix_`` are replaced, others pass through.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if not c.startswith("mix_")])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sized = docs.select(*columns, F.size(words_of(F.col(text))).cast("long").alias("mix_size"),
                        row_hash(docs, key, text).alias("mix_hash"))
    slim = sized.select(F.col(source).alias("source"), F.col("mix_size").alias("size"), F.col("mix_hash").alias("h"))
    slim = slim.persist(StorageLevel.MEMORY_AND_DISK)  # three histograms read it; lost parts are computed again
    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = source_targets(totals, weights, share, most).persist(StorageLevel.MEMORY_AND_DISK)
    cuts = thresholds(slim, sources)
    table = sources.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        # without a threshold every row is taken as often as the whole source is
        F.coalesce("rounds", F.when(F.col("source_size") > 0, F.round(
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")))), F.lit(0)).cast("long").alias("mix_rounds"),
        F.coalesce("below", F.lit(0)).alias("mix_below"))
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    table = sent_if_small(table, F.coalesce(F.octet_length("mix_source"), F.lit(0)) + 40)
    joined = sized.join(table, F.col(source).eqNullSafe(F.col("mix_source")))
    times = F.col("mix_rounds") + (F.col("mix_hash") < F.col("mix_below")).cast("long")
    return joined.select(*columns, "mix_size", "mix_source_size", "mix_target", times.alias("mix_times"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns of ``docs``."""
    rows = mix(docs, **options).where("mix_times > 0")
    return rows.withColumn("mix_round", F.explode(F.sequence(F.lit(1).cast("long"), "mix_times"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    rows = mix(docs.select("doc_id", "text", "source"))
    return rows.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                       F.col("mix_target").alias("target"), (F.col("mix_times") * F.col("mix_size")).alias("taken"))


def check_sql(weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> str:
    """The digest in SQL, with a running total over all hashes in place of nested histograms."""
    w = " ".join(f"WHEN {i} THEN {float(x)}" for i, x in enumerate(weights))
    return f"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
        CAST('0x' || substr(md5(concat_ws('|', coalesce('=' || doc_id, '-'), coalesce('=' || text, '-'))), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {w} END::DOUBLE AS w, {most}::DOUBLE * source_size AS cap FROM s),
o AS (SELECT *, cap / w AS capped_at FROM w),
b AS (SELECT *, {share}::DOUBLE * sum(source_size) OVER () AS budget,
        coalesce(sum(cap) OVER u, 0) AS full_, sum(w) OVER () - coalesce(sum(w) OVER u, 0) AS open_w FROM o
        WINDOW u AS (ORDER BY capped_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max((budget - full_) / open_w) AS level FROM b WHERE (budget - full_) / open_w <= capped_at),
t AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target FROM b, l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS rounds FROM t),
n AS (SELECT *, target - rounds * source_size AS need FROM r),
hh AS (SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
c AS (SELECT source, h, n, sum(n) OVER (PARTITION BY source ORDER BY h) AS upto FROM hh),
e AS (SELECT c.source, min_by(h + CASE WHEN upto - need < need - upto + n THEN 1 ELSE 0 END, h) AS below
      FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source WHERE upto > need GROUP BY c.source)
SELECT doc_id, size, n.source_size, n.target,
       size * (CASE WHEN e.below IS NULL AND n.source_size > 0 THEN round(n.target / n.source_size) ELSE rounds END
               + CASE WHEN h < coalesce(e.below, 0) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source"""
