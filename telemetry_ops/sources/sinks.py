"""Sinks for telemetry, features, alerts and diagnoses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from telemetry_ops.operators.diagnose import report_md, risk_counts, summary_json
from telemetry_ops.sources.readers import read_csv


def _folder_bytes(spark: SparkSession, path: str) -> int:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def convert_to_parquet(spark: SparkSession, source: str, target: str, schema: StructType, time: str = "timestamp",
                       partition_by: str = "date") -> dict:
    """CSV to Parquet partitioned by day. Returns row count and sizes; rows are counted from the written files."""
    df = read_csv(spark, source, schema)
    days = df.withColumn(partition_by, F.to_date(time))
    # sorted inside each task, so a task holds one open file at a time, and a heavy day is not forced into one task
    days.sortWithinPartitions(partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(target)
    before, after = _folder_bytes(spark, source), _folder_bytes(spark, target)
    return {"rows": spark.read.parquet(target).count(), "csv_bytes": before, "parquet_bytes": after,
            "reduction_pct": round((1 - after / before) * 100, 1) if before else 0.0}


def write_features(df: DataFrame, path: str, key: str = "machine_id", mode: str = "append") -> None:
    """Feature matrix by machine; several tasks may write files of one machine."""
    df.sortWithinPartitions(key).write.mode(mode).partitionBy(key).parquet(path)


def alert_records(df: DataFrame, created_at, model_version: str = "1.0", threshold_used: str | None = None) -> DataFrame:
    """Alert rows from diagnosed rows. The id is a hash of machine, time and payload, so writing a row twice gives
    one id, and two predictions of one machine at one time have two."""
    raw = F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in (
        "report_md", "summary", "contributions", "top_contributors", "feature_group_impacts", "immediate_actions",
        "monitoring_focus")]))
    shap = F.to_json(F.struct(
        F.transform("top_contributors", lambda c: F.struct(
            c["feature"].alias("feature"), c["value"].alias("value"), c["contribution"].alias("shap_value"),
            c["direction"].alias("direction"))).alias("top_contributors"), "feature_group_impacts"))
    return df.select(
        F.xxhash64(F.col("machine_id"), F.col("timestamp").cast("string"), raw).alias("id"), "machine_id", "timestamp",
        F.col("failure_probability").alias("failure_prob"), "risk_level",
        F.col("primary_failure_mode").alias("root_cause"), "confidence", "report_md", raw.alias("raw_data"),
        shap.alias("shap_values"), F.lit(False).alias("acknowledged"),
        F.lit(None).cast("timestamp").alias("acknowledged_at"), F.lit(None).cast("string").alias("acknowledged_by"),
        F.lit(None).cast("boolean").alias("false_positive"), F.lit(None).cast("string").alias("action_taken"),
        F.lit(model_version).alias("model_version"), F.lit(threshold_used).cast("string").alias("threshold_used"),
        F.lit(created_at).alias("created_at"))


def append_alerts(df: DataFrame, path: str) -> None:
    """Append alert records, partitioned by the day they were created."""
    df.withColumn("date", F.to_date("created_at")).write.mode("append").partitionBy("date").parquet(path)


def write_diagnostics(diagnosed: DataFrame, path: str) -> None:
    """Summaries of all rows as JSON, reports of the rows that are not nominal, and the count per risk level."""
    ready = summary_json(diagnosed)
    ready.select(F.col("summary").alias("value")).write.mode("overwrite").text(f"{path}/summaries")
    (report_md(diagnosed).where(F.col("risk_level") != "nominal").select("machine_id", "timestamp", "report_md")
     .write.mode("overwrite").json(f"{path}/reports"))
    risk_counts(diagnosed).write.mode("overwrite").json(f"{path}/risk_counts")
