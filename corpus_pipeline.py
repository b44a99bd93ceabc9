"""A corpus made ready for training: the five stages in order, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.llm import jaccard_join, line_dedup, mixing, piece_sampling, quality_rules
from delaylens.llm.common import read_table, written

#: Rows of a batch that goes to Python; Spark's own 10,000 are tens of megabytes of text in every task.
BATCH_ROWS = 1000


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def few_at_once(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of ``BATCH_ROWS`` from here on; a batch lies in the JVM and in Python at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without lines that five or more share; ``n_chars`` follows the text."""
    few_at_once(spark)
    rows = line_dedup.without_repeats(docs).drop("ld_lines", "ld_dropped")
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, a similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document that is taken twice is there twice."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document in the mix."""
    few_at_once(spark)
    return piece_sampling.sampled(docs)


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", without_repeated_lines),
    ("jaccard_join", one_of_each_group),
    ("mix_sources", mixed_sources),
    ("piece_sampling", encoded),
]

#: The sampled segmentations can't be stated in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``; each result is written and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
