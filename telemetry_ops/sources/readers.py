"""Batch readers. Schemas are explicit, and NaN becomes NULL on the way in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from telemetry_ops.functions import missing_to_null

TIMESTAMP_FORMAT = "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSSSSS][.SSS]"


def read_csv(spark: SparkSession, path, schema: StructType, timestamp_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """CSV with a header; a missing path is an error, raised when the plan is built."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    return missing_to_null(reader.option("timestampFormat", timestamp_format)
                           .option("timestampNTZFormat", timestamp_format).csv(path))


def read_parquet(spark: SparkSession, path, columns=None) -> DataFrame:
    df = spark.read.parquet(path)
    return missing_to_null(df.select(*columns) if columns else df)


def read_telemetry(spark: SparkSession, path: str, schema: StructType | None = None, columns=None) -> DataFrame:
    """Reader chosen by file extension; any other extension is an error."""
    name = path.rstrip("/").lower()
    if name.endswith(".parquet"):
        return read_parquet(spark, path, columns)
    if name.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV source needs a schema")
        df = read_csv(spark, path, schema)
        return df.select(*columns) if columns else df
    raise ValueError(f"unsupported file format: {path}")
