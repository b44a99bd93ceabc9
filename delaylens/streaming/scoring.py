"""Scoring files as they land."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.models import score


def landed_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def score_stream(source: DataFrame, model: Transformer, output: str, checkpoint: str, keep: list[str],
                 threshold: float = 0.5, once: bool = False) -> StreamingQuery:
    """Append scored rows as parquet. Stateless, so restarts continue from the checkpoint without loss or repeats."""
    scored = score(source, model, threshold).select(*keep, "probability_1", "predicted")
    writer = scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(output)


def score_records(records: DataFrame, model: Transformer, positive: str = "Delayed",
                  negative: str = "On Time") -> DataFrame:
    """Batch form of the one-record scorer: every record with its verdict in words."""
    scored = model.transform(records)
    verdict = F.when(F.col("prediction") == 1, positive).otherwise(negative)
    return scored.select(*records.columns, F.col("prediction").cast("int").alias("prediction"), verdict.alias("verdict"))
