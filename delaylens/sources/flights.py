"""The flights table: declared schema and scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .stores import commit_manifest, latest_manifest

DELAY_CAUSES = [
    "DELAY_DUE_CARRIER",
    "DELAY_DUE_WEATHER",
    "DELAY_DUE_NAS",
    "DELAY_DUE_SECURITY",
    "DELAY_DUE_LATE_AIRCRAFT",
]

_TEXT = T.StringType()
_INT = T.IntegerType()
_NUM = T.DoubleType()

FLIGHT_COLUMNS: dict[str, T.DataType] = {
    "FL_DATE": T.DateType(),
    "AIRLINE": _TEXT, "AIRLINE_DOT": _TEXT, "AIRLINE_CODE": _TEXT, "DOT_CODE": _INT, "FL_NUMBER": _INT,
    "ORIGIN": _TEXT, "ORIGIN_CITY": _TEXT, "DEST": _TEXT, "DEST_CITY": _TEXT,
    "CRS_DEP_TIME": _INT, "DEP_TIME": _NUM, "DEP_DELAY": _NUM, "TAXI_OUT": _NUM,
    "WHEELS_OFF": _NUM, "WHEELS_ON": _NUM, "TAXI_IN": _NUM, "CRS_ARR_TIME": _INT, "ARR_TIME": _NUM,
    "ARR_DELAY": _NUM, "CANCELLED": _NUM, "CANCELLATION_CODE": _TEXT, "DIVERTED": _NUM,
    "CRS_ELAPSED_TIME": _NUM, "ELAPSED_TIME": _NUM, "AIR_TIME": _NUM, "DISTANCE": _NUM,
    **{cause: _NUM for cause in DELAY_CAUSES},
}

CORRUPT = "_corrupt_record"


def flights_schema(key: str | None = None) -> T.StructType:
    """The declared schema, led by a text key column when ``key`` is given."""
    fields = [T.StructField(key, _TEXT)] if key else []
    fields += [T.StructField(name, kind) for name, kind in FLIGHT_COLUMNS.items()]
    return T.StructType(fields)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Keep a single missing marker: NaN in floating columns becomes NULL."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def read_flights(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                 keep_corrupt: bool = False) -> DataFrame:
    """Scan header CSV files with the declared schema; unreadable fields become NULL, never a failure."""
    schema = schema or flights_schema()
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("dateFormat", "yyyy-MM-dd")
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, _TEXT)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return nan_to_null(reader.schema(schema).csv(path))


def land_checked(spark: SparkSession, target: str, path: str | list[str], schema: T.StructType | None = None,
                 date: str = "FL_DATE", partition: str = "FL_YEAR") -> dict:
    """Land CSV files by year, with rows that don't fit the schema in a table of their own; returns the counts.

    One pass parses and routes; counts come from the files' footers. (An observed metric would make every later Spark ML
    model with a training summary unserializable: the session then holds a manager that can't be sent.) A row with an unreadable field, or without a readable date, goes with its raw
    text to quarantine. The landing takes effect by a new manifest: the years it holds replace those landed before as a
    whole, other years stay. A landing that broke off leaves the manifest, and so the data, as it was.
    """
    rows = read_flights(spark, path, schema, keep_corrupt=True)
    good = F.col(CORRUPT).isNull() & F.col(date).isNotNull()
    routed = rows.withColumns({"landed": good, partition: F.when(good, F.year(date))})
    version = f"part-{uuid.uuid4().hex}"
    routed.write.partitionBy("landed", partition).parquet(f"{target}/{version}")
    there = spark.read.schema(f"landed boolean, `{partition}` int").parquet(f"{target}/{version}")
    found = there.groupBy("landed", partition).agg(F.count("*").alias("n")).collect()  # a row per year
    years = [r[partition] for r in found if r["landed"]]
    before = latest_manifest(spark, target)
    held = {y: v for y, v in before.get("parts", {}).items() if int(y) not in years} | {str(y): version for y in years}
    counts = {"rows": sum(r["n"] for r in found), "quarantined": sum(r["n"] for r in found if not r["landed"])}
    aside = before.get("quarantine", []) + ([version] if counts["quarantined"] else [])
    commit_manifest(spark, target, {"parts": held, "quarantine": aside}, before.get("number", 0) + 1)
    return counts


def landed_rows(spark: SparkSession, target: str, schema: T.StructType | None = None, partition: str = "FL_YEAR") -> DataFrame:
    """The rows in force, with their ``partition``; the scan is limited to the years' folders."""
    full = T.StructType([*(schema or flights_schema()).fields, T.StructField("landed", T.BooleanType()), T.StructField(partition, T.IntegerType())])
    versions: dict[str, list[int]] = {}
    for year, version in latest_manifest(spark, target).get("parts", {}).items():
        versions.setdefault(version, []).append(int(year))
    out = spark.createDataFrame([], full)
    for version, years in sorted(versions.items()):
        rows = spark.read.schema(full).parquet(f"{target}/{version}")
        out = out.unionByName(rows.where(F.col("landed") & F.col(partition).isin(years)))
    return out.drop("landed")


def quarantined_rows(spark: SparkSession, target: str) -> DataFrame:
    """``(record, version)``: the raw text of every row that was set aside, NULL where only the date is missing."""
    out = spark.createDataFrame([], "record string, version string")
    for version in latest_manifest(spark, target).get("quarantine", []):
        rows = spark.read.schema(f"{CORRUPT} string, landed boolean").parquet(f"{target}/{version}").where(~F.col("landed"))
        out = out.unionByName(rows.select(F.col(CORRUPT).alias("record"), F.lit(version).alias("version")))
    return out
