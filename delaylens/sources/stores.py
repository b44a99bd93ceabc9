"""Sinks, landing and stores for models, fitted tables, parameters and metrics."""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

PARAMS_SCHEMA = "model string, params map<string,string>, saved_at timestamp"
LEDGER_SCHEMA = "study string, data string, params string, fold int, measures map<string,double>"
METRIC_SCHEMA = "run_id string, model string, stage string, metric string, value double, ts timestamp"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def latest_manifest(spark: SparkSession, folder: str) -> dict:
    """The manifest of the highest number, with that number; empty when there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_manifests")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return {}
    numbers = [int(f.getPath().getName()) for f in files.listStatus(root) if f.getPath().getName().isdigit()]
    if not numbers:
        return {}
    text = spark.read.text(f"{folder}/_manifests/{max(numbers)}", wholetext=True).first()[0]
    return json.loads(text) | {"number": max(numbers)}


def commit_manifest(spark: SparkSession, folder: str, content: dict, number: int) -> None:
    """Put manifest ``number`` in force by a rename; raises when another writer was first. Old ones are kept."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    draft, final = path(f"{folder}/_manifests/draft-{uuid.uuid4().hex}"), path(f"{folder}/_manifests/{number}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if files.exists(final) or not files.rename(draft, final):
        raise RuntimeError(f"manifest {number} of {folder} was written by another landing")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite", max_records: int = 5_000_000) -> str:
    """Write one file per task and partition value; nothing is merged into a single file."""
    writer = df.write.mode(mode).format(fmt).option("maxRecordsPerFile", max_records)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def land_dataset(spark: SparkSession, target: str, read: Callable[[], DataFrame], date: str = "FL_DATE",
                 partition: str = "FL_YEAR") -> str:
    """Write the source as parquet partitioned by year unless a finished copy is there; returns the folder."""
    if not path_exists(spark, f"{target}/_SUCCESS"):
        write_table(read().withColumn(partition, F.year(date)), target, partition_by=[partition])
    return target


# --- models and fitted tables ----------------------------------------------------------------------

def save_model(model, folder: str, name: str) -> str:
    path = f"{folder}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, folder: str, name: str):
    """The stored model of whatever class, or None."""
    path = f"{folder}/{name}"
    if not path_exists(spark, f"{path}/metadata"):
        return None
    return DefaultParamsReader.loadParamsInstance(path, spark)


def save_fitted(table: DataFrame, folder: str, name: str) -> str:
    return write_table(table, f"{folder}/{name}")


def load_fitted(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    path = f"{folder}/{name}"
    return spark.read.parquet(path) if path_exists(spark, f"{path}/_SUCCESS") else None


def settings_name(name: str, df: DataFrame, settings: dict) -> str:
    """A store name that changes with the schema and the settings."""
    text = json.dumps([df.schema.jsonValue(), settings], sort_keys=True, default=str)
    return f"{name}-{hashlib.md5(text.encode()).hexdigest()[:12]}"


def load_or_fit(train: DataFrame, folder: str, name: str, settings: dict, fit: Callable[[DataFrame], object]):
    """Reuse the stored model for this schema and these settings, else fit and store it. ``(model, reused)``."""
    full = settings_name(name, train, settings)
    model = load_model(train.sparkSession, folder, full)
    if model is not None:
        return model, True
    model = fit(train)
    save_model(model, folder, full)
    return model, False


# --- results of fits -------------------------------------------------------------------------------

def data_key(df: DataFrame) -> str:
    """A fingerprint of columns and rows, whatever their order or partitions; one pass."""
    plain = [vector_to_array(f"`{f.name}`") if isinstance(f.dataType, VectorUDT) else F.col(f"`{f.name}`") for f in df.schema]
    h = F.xxhash64(*plain)
    r = df.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    return hashlib.md5(json.dumps([df.schema.jsonValue(), r["n"], r["x"], str(r["s"])]).encode()).hexdigest()


def ledger_rows(spark: SparkSession, path: str, study: str, data: str) -> dict[tuple[str, int], dict[str, float]]:
    """Stored measures by (params, fold) of one study on one state of the data; as many as fits were paid for."""
    if not path_exists(spark, path):
        return {}
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(path).where((F.col("study") == study) & (F.col("data") == data))
    return {(r["params"], r["fold"]): r["measures"] for r in rows.collect()}


def append_ledger(spark: SparkSession, path: str, study: str, data: str, params: str, fold: int, measures: dict) -> None:
    """One entry in a folder of its own, so that concurrent fits and sessions don't share a commit."""
    row = spark.createDataFrame([(study, data, params, fold, measures)], LEDGER_SCHEMA)
    row.coalesce(1).write.parquet(f"{path}/entry={uuid.uuid4().hex}")


# --- parameters and metrics ------------------------------------------------------------------------

def save_best_params(spark: SparkSession, path: str, model: str, params: dict) -> None:
    row = spark.createDataFrame([(model, {k: str(v) for k, v in params.items()})],
                                "model string, params map<string,string>")
    append_best_params(row, path)


def append_best_params(rows: DataFrame, path: str) -> None:
    """Append ``(model, params)`` rows with the time of writing."""
    rows.withColumn("saved_at", F.current_timestamp()).write.mode("append").parquet(path)


def load_best_params(spark: SparkSession, path: str) -> DataFrame:
    """The latest parameters of every model."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PARAMS_SCHEMA).select("model", "params")
    rows = spark.read.schema(PARAMS_SCHEMA).parquet(path)
    return rows.groupBy("model").agg(F.max_by("params", "saved_at").alias("params"))


def get_best_params(spark: SparkSession, path: str, model: str) -> dict | None:
    row = load_best_params(spark, path).where(F.col("model") == model).first()
    return row["params"] if row else None


def log_metrics(records: DataFrame, path: str, run_id: str) -> None:
    """Append long metric records ``(Model, Stage, Metric, Value)`` to the run log."""
    records.select(
        F.lit(run_id).alias("run_id"), F.col("Model").alias("model"), F.col("Stage").alias("stage"),
        F.col("Metric").alias("metric"), F.col("Value").alias("value"), F.current_timestamp().alias("ts"),
    ).write.mode("append").partitionBy("run_id").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).parquet(path)
