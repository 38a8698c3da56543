"""Telemetry, score, alert and contribution tables derived from an ``events`` table.

Each table is a list of SQL expressions over ``events``. They are plain enough to run unchanged in any SQL engine,
which lets a check run the same derivation elsewhere; only reading the JSON number ``k`` differs (``JSON_K``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

JSON_K = "CAST(get_json_object(props, '$.k') AS INT)"
_MACHINE = "concat('M', CAST(user_id % 5 + 1 AS STRING)) AS machine_id"

BASE = ["event_id", "ts", "user_id", "event_type", "value", "props"]

SYSTEM = [
    "event_id", "ts AS timestamp", _MACHINE,
    "CASE WHEN k % 10 < 6 THEN 'L' WHEN k % 10 < 9 THEN 'M' ELSE 'H' END AS product_type",
    "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 211 = 0 THEN 4e2 ELSE 2.95e2 + k * 1e-1 END"
    " AS air_temperature_K",
    "3.05e2 + k * 1e-1 + value * 1e-2 AS process_temperature_K",
    "1.2e3 + value * 4e0 AS rotational_speed_rpm",
    "2e1 + k * 6e-1 AS torque_Nm",
    "(event_id % 1250) * 2e-1 AS tool_wear_min",
    "1e1 + value * 1e-1 AS vibration_mm_s",
    "9e1 + k * 4e-1 AS pressure_psi",
    "value AS network_latency_ms",
    "5e0 + k * 2e-1 AS edge_processing_time_ms",
    "3e-1 + k * 5e-3 AS fuzzy_pid_output",
    "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS machine_failure",
]

# no row for sign-ups: these are the gaps that forward fill covers
APPLICATION = [
    "ts AS timestamp", _MACHINE,
    "5e1 + value * 2e0 AS api_response_latency_ms", "k * 1e-1 AS error_rate_pct", "k % 20 AS http_5xx_count",
    "1e2 - k * 5e-1 AS request_throughput_rps", "k AS queue_depth", "3e1 + k * 7e-1 AS cpu_utilization_pct",
    "4e1 + k * 5e-1 AS memory_utilization_pct", "k * 2e-2 AS packet_loss_pct",
    "1e0 + value * 5e-2 AS disk_io_wait_ms", "CASE WHEN value > 1.5e2 THEN 1 ELSE 0 END AS is_anomaly",
]
APPLICATION_FILTER = "event_type <> 'signup'"

SCORES = ["event_id", "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y", "least(value * 4e-3, 1e0) AS score"]

ALERTS = [
    "event_id AS id", _MACHINE, "ts AS created_at", "least(value * 4e-3, 1e0) AS failure_prob",
    "CASE WHEN value * 4e-3 >= 9e-1 THEN 'critical' WHEN value * 4e-3 >= 7e-1 THEN 'high'"
    " WHEN value * 4e-3 >= 4e-1 THEN 'moderate' WHEN value * 4e-3 >= 2e-1 THEN 'low' ELSE 'nominal' END AS risk_level",
    "CASE k % 7 WHEN 0 THEN 'mechanical_wear' WHEN 1 THEN 'thermal_overload' WHEN 2 THEN 'network_congestion'"
    " WHEN 3 THEN 'software_stress' WHEN 4 THEN 'power_anomaly' WHEN 5 THEN 'complex_pattern' END AS root_cause",
    "k % 2 = 0 AS acknowledged", "CASE WHEN k % 5 = 0 THEN NULL ELSE k % 3 = 0 END AS false_positive",
    "props AS raw_data",
]

ACKNOWLEDGEMENTS = [
    "event_id % 1000 AS alert_id", "ts AS acknowledged_at", "event_type AS acknowledged_by",
    "CASE WHEN k % 4 = 0 THEN '' ELSE concat('action-', CAST(k AS STRING)) END AS action_taken",
    "CASE WHEN k % 3 = 0 THEN NULL ELSE k % 2 = 0 END AS is_false_positive",
]
ACKNOWLEDGEMENTS_FILTER = "event_type = 'click'"

# one contribution column per feature; the long form has one row per (row_id, feature)
CONTRIBUTIONS = {
    "vibration_mm_s": "(k - 50) * 1e-2",
    "error_rate_pct_lag_1": "(value - 5e1) * 1e-2",
    "disk_io_wait_ms": "((event_id % 17) - 8) * 1e-1",
    "thermal_efficiency_idx": "((event_id % 11) - 5) * 1e-1",
}


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def base(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).selectExpr(*BASE, f"{JSON_K} AS k")


def spread(df: DataFrame, rid: str) -> DataFrame:
    """Rows dealt to all shuffle partitions by id: a file read in few large splits would leave costly row-local work to as
    few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rid)


def system(spark: SparkSession, folder: str) -> DataFrame:
    return base(spark, folder).selectExpr(*SYSTEM)


def application(spark: SparkSession, folder: str) -> DataFrame:
    return base(spark, folder).where(APPLICATION_FILTER).selectExpr(*APPLICATION)


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return base(spark, folder).selectExpr(*SCORES)


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return base(spark, folder).selectExpr(*ALERTS)


def acknowledgements(spark: SparkSession, folder: str) -> DataFrame:
    return base(spark, folder).where(ACKNOWLEDGEMENTS_FILTER).selectExpr(*ACKNOWLEDGEMENTS)


def contributions_wide(spark: SparkSession, folder: str) -> DataFrame:
    return base(spark, folder).selectExpr("event_id AS row_id", *[f"{e} AS {n}" for n, e in CONTRIBUTIONS.items()])


def contributions_long(spark: SparkSession, folder: str) -> DataFrame:
    return contributions_wide(spark, folder).unpivot("row_id", list(CONTRIBUTIONS), "feature", "contribution")


def minority_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return (spark.read.parquet(f"{folder}/embeddings.parquet")
            .selectExpr("vec_id", "label", "transform(embedding, x -> CAST(x AS DOUBLE)) AS vec"))
