"""What the operators share: word splitting, written intermediate tables, size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import short_lived_shuffles  # noqa: F401  (imported from here by the operators)
from ..sources.stores import remove_path, scratch_path

#: White space that ends a word: blank, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: Largest table that is sent to every executor, by its serialized size.
BROADCAST_BYTES = 16 << 20


def words_of(text: Column) -> Column:
    """The words of a text; none for NULL."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts lineage, survives lost executors, and gives the planner file sizes by which it decides on broadcasts.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def released(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned, once nothing reads them any more."""
    for df in tables:
        remove_path(df.sparkSession, df.written_to)


def small_enough(df: DataFrame, size: Column, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the bytes given by ``size`` per row add up to at most ``limit``."""
    return (df.agg(F.sum(size).alias("n")).first()["n"] or 0) <= limit


def sent_if_small(df: DataFrame, size: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast after its size was measured; else joins shuffle and split hot keys."""
    return F.broadcast(df) if small_enough(df, size, limit) else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def widened(df: DataFrame, **fields: str) -> T.StructType:
    """The schema of ``df`` with more fields at its end."""
    more = T.StructType.fromDDL(", ".join(f"`{n}` {kind}" for n, kind in fields.items()))
    return T.StructType([*df.schema.fields, *more.fields])


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts in ``column`` have about ``limit`` bytes, so that copies of them stay small."""
    rows = max(1, int(batch.num_rows * limit / max(1, batch.column(column).nbytes)))
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of fewer rows for jobs run inside the block; tasks with long texts need less memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
