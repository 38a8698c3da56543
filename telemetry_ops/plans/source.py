"""Reader and sink queries; written files go to the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from telemetry_ops.config import SYSTEM_SCHEMA
from telemetry_ops.operators import diagnose as dg
from telemetry_ops.plans import diagnosis
from telemetry_ops.plans.common import SYSTEM_NAMES, r, rounded, sql, sql_time, text_time
from telemetry_ops.scratch import new_path
from telemetry_ops.sources import readers, sinks, telemetry as t, text

_SCHEMA = T.StructType([T.StructField("event_id", T.LongType())] + [
    f for f in SYSTEM_SCHEMA.fields if f.name in SYSTEM_NAMES])


def _scan(spark, d):
    df = readers.read_telemetry(spark, f"{d}/events.parquet", columns=["event_id", "event_type", "value"])
    return rounded(df)


def _as_csv(spark, d):
    path = new_path(spark, "system") + ".csv"
    df = t.system(spark, d).select("event_id", *[c for c in _SCHEMA.names if c != "event_id"])
    df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).write.option("header", True).csv(path)
    return path


def _visible(df):
    return rounded(df.select("event_id", text_time("timestamp").alias("timestamp"), "machine_id", "air_temperature_K",
                             "torque_Nm", "network_latency_ms", "machine_failure"))


def _csv(spark, d):
    return _visible(readers.read_telemetry(spark, _as_csv(spark, d), _SCHEMA))


def _converted(spark, d):
    target = new_path(spark, "converted") + ".parquet"
    sinks.convert_to_parquet(spark, _as_csv(spark, d), target, _SCHEMA)
    return _visible(readers.read_telemetry(spark, target))


def _features_by_machine(spark, d):
    path = new_path(spark, "features")
    sinks.write_features(t.system(spark, d).select("event_id", "machine_id", "torque_Nm", "tool_wear_min"), path)
    back = readers.read_parquet(spark, path)
    return rounded(back.select("event_id", "machine_id", "torque_Nm", "tool_wear_min"))


def _appended(spark, d):
    """Diagnosed rows appended as alerts and read back."""
    path = new_path(spark, "alerts")
    reported = dg.report_md(diagnosis._diagnosed(spark, d))
    records = sinks.alert_records(reported, F.col("timestamp"))
    sinks.append_alerts(records, path)
    back = readers.read_parquet(spark, path)
    return rounded(back.select(
        F.get_json_object("raw_data", "$.event_id").cast("long").alias("event_id"), "machine_id", "failure_prob",
        "risk_level", "root_cause", "confidence", "acknowledged",
        F.get_json_object("shap_values", "$.top_contributors[0].feature").alias("first_feature")))


def _log_lines(spark, d):
    """Documents as log files: one file per source, one line per document."""
    return spark.read.parquet(f"{d}/documents.parquet").select(
        F.col("source").alias("file"), F.col("doc_id").alias("block"), F.lit(0).alias("in_task"),
        F.col("n_chars").alias("bytes"), F.col("text").alias("line"))


def _log_profile(spark, d):
    return text.profile_lines(_log_lines(spark, d)).select("file", "bytes", "n_lines", "n_fields", "is_access_log",
                                                           F.size("sample").alias("n_sampled"))


_SEEN = f"SELECT event_id, {sql_time('timestamp')} AS timestamp, machine_id, " + r(
    "air_temperature_K", "torque_Nm", "network_latency_ms") + ", machine_failure FROM fx_system"

QUERIES = {
    "parquet_scan": (_scan, "SELECT event_id, event_type, round(value, 6) AS value FROM events"),
    "csv_scan": (_csv, sql(_SEEN, "fx_system")),
    "csv_to_parquet": (_converted, sql(_SEEN, "fx_system")),
    "feature_sink": (_features_by_machine, sql(
        f"SELECT event_id, machine_id, {r('torque_Nm', 'tool_wear_min')} FROM fx_system", "fx_system")),
    "alert_sink": (_appended, diagnosis._d(
        f"SELECT event_id, machine_id, {r('failure_probability AS failure_prob')}, risk_level, mode AS root_cause, "
        "confidence, false AS acknowledged, driver AS first_feature FROM done")),
    "log_profile": (_log_profile, (
        "SELECT source AS file, max(n_chars) AS bytes, count(*) AS n_lines, "
        "len(list_filter(string_split_regex(arg_min(text, doc_id), '[ \\t\\n\\f\\r\\x0B]+'), lambda w: w <> '')) AS n_fields, "
        "contains(arg_min(text, doc_id), ' - - [') OR contains(arg_min(text, doc_id), 'HTTP/') AS is_access_log, "
        "least(count(*), 5) AS n_sampled FROM documents GROUP BY source")),
}
