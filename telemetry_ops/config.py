"""Settings of the telemetry domain: column lists, limits, windows and thresholds.

Operators take column names as arguments; the dataclasses here hold the defaults for hardware sensors joined with
application logs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---- fixed values: column groups ------------------------------------------------------------------------------------
HARDWARE_COLUMNS = (
    "air_temperature_K", "process_temperature_K", "torque_Nm", "rotational_speed_rpm", "vibration_mm_s",
    "pressure_psi", "tool_wear_min",
)
SOFTWARE_COLUMNS = (
    "api_response_latency_ms", "error_rate_pct", "cpu_utilization_pct", "memory_utilization_pct", "queue_depth",
    "disk_io_wait_ms",
)
LAG_COLUMNS = (
    "torque_Nm", "vibration_mm_s", "air_temperature_K", "tool_wear_min", "api_response_latency_ms", "error_rate_pct",
    "cpu_utilization_pct",
)
DRIFT_COLUMNS = (
    "air_temperature_K", "torque_Nm", "tool_wear_min", "network_latency_ms", "api_response_latency_ms",
    "error_rate_pct", "cpu_utilization_pct",
)
NOT_FEATURES = (
    "timestamp", "machine_id", "product_type", "machine_failure", "failure_TWF", "failure_HDF", "failure_PWF",
    "failure_OSF", "failure_RNF", "maintenance_status", "anomaly_score", "is_anomaly",
)

# ---- fixed values: physical limits (inclusive limits are valid) -----------------------------------------------------
SENSOR_BOUNDS = {
    "air_temperature_K": (250.0, 350.0),
    "process_temperature_K": (260.0, 380.0),
    "rotational_speed_rpm": (0.0, 5000.0),
    "torque_Nm": (0.0, 150.0),
    "tool_wear_min": (0.0, 300.0),
    "vibration_mm_s": (0.0, 100.0),
    "pressure_psi": (0.0, 200.0),
    "network_latency_ms": (0.0, 5000.0),
    "edge_processing_time_ms": (0.0, 300.0),
    "api_response_latency_ms": (0.0, 10000.0),
    "cpu_utilization_pct": (0.0, 100.0),
    "memory_utilization_pct": (0.0, 100.0),
    "error_rate_pct": (0.0, 100.0),
    "packet_loss_pct": (0.0, 100.0),
}
SIMPLE_GATE_BOUNDS = {
    "air_temperature_K": (250.0, 350.0),
    "rotational_speed_rpm": (0.0, 3000.0),
    "torque_Nm": (0.0, 100.0),
    "vibration_mm_s": (0.0, 50.0),
    "pressure_psi": (0.0, 200.0),
}

# ---- fixed values: usual operating ranges, for machines with little history -----------------------------------------
NORMAL_RANGES = {
    "air_temperature_K": (295.0, 315.0),
    "process_temperature_K": (305.0, 325.0),
    "torque_Nm": (20.0, 60.0),
    "rotational_speed_rpm": (1200.0, 1800.0),
    "vibration_mm_s": (10.0, 25.0),
    "pressure_psi": (90.0, 130.0),
    "tool_wear_min": (0.0, 200.0),
    "api_response_latency_ms": (50.0, 200.0),
    "error_rate_pct": (0.0, 5.0),
    "cpu_utilization_pct": (30.0, 80.0),
    "memory_utilization_pct": (40.0, 85.0),
    "queue_depth": (0.0, 50.0),
    "disk_io_wait_ms": (5.0, 20.0),
}


@dataclass(frozen=True)
class FieldRule:
    """One field of a prediction request: inclusive range, whether it must be present, value used when absent."""

    low: float | None = None
    high: float | None = None
    required: bool = False
    default: float | None = None


# ---- fixed values: prediction request ranges and defaults -----------------------------------------------------------
REQUEST_SYSTEM = {
    "machine_id": FieldRule(required=True),
    "air_temperature_K": FieldRule(200.0, 400.0, required=True),
    "process_temperature_K": FieldRule(200.0, 450.0, required=True),
    "rotational_speed_rpm": FieldRule(0.0, 5000.0, required=True),
    "torque_Nm": FieldRule(0.0, 200.0, required=True),
    "tool_wear_min": FieldRule(0.0, None, required=True),
    "vibration_mm_s": FieldRule(0.0, None, default=15.0),
    "pressure_psi": FieldRule(0.0, None, default=100.0),
    "network_latency_ms": FieldRule(0.0, None, default=20.0),
    "edge_processing_time_ms": FieldRule(0.0, None, default=15.0),
    "fuzzy_pid_output": FieldRule(0.0, 1.0, default=0.5),
}
REQUEST_APPLICATION = {
    "error_rate_pct": FieldRule(0.0, 100.0, default=5.0),
    "cpu_utilization_pct": FieldRule(0.0, 100.0, default=50.0),
    "memory_utilization_pct": FieldRule(0.0, 100.0, default=60.0),
    "disk_io_wait_ms": FieldRule(0.0, None, default=10.0),
    "packet_loss_pct": FieldRule(0.0, 100.0, default=0.1),
    "api_response_latency_ms": FieldRule(0.0, None, default=150.0),
    "http_5xx_count": FieldRule(0.0, None, default=0.0),
    "queue_depth": FieldRule(0.0, None, default=10.0),
    "request_throughput_rps": FieldRule(0.0, None, default=100.0),
}

# ---- fixed values: diagnosis domain knowledge -----------------------------------------------------------------------
FEATURE_GROUPS = {
    "mechanical": ("vibration_mm_s", "torque_Nm", "rotational_speed_rpm", "tool_wear_min", "pressure_psi"),
    "thermal": ("air_temperature_K", "process_temperature_K", "thermal_efficiency_idx"),
    "network": ("network_latency_ms", "packet_loss_pct", "api_response_latency_ms"),
    "software": (
        "error_rate_pct", "cpu_utilization_pct", "memory_utilization_pct", "disk_io_wait_ms", "queue_depth",
        "http_5xx_count",
    ),
    "power": ("power_anomaly_score", "fuzzy_pid_output"),
}
GROUP_MODES = {
    "mechanical": "mechanical_wear",
    "thermal": "thermal_overload",
    "network": "network_congestion",
    "software": "software_stress",
    "power": "power_anomaly",
}
RISK_LEVELS = ("critical", "high", "moderate", "low", "nominal")
ROOT_CAUSES = (
    "mechanical_wear", "thermal_overload", "network_congestion", "software_stress", "power_anomaly", "complex_pattern",
)
CONFIDENCES = ("high", "moderate", "low")
INDUSTRY_FALSE_POSITIVE_RATE = 54.0


@dataclass(frozen=True)
class QualityConfig:
    bounds: dict = field(default_factory=lambda: dict(SENSOR_BOUNDS))
    chunk_rows: int = 5000
    max_missing_pct: float = 5.0
    spike_multiplier: float = 3.0
    ema_alpha: float = 0.3


@dataclass(frozen=True)
class DriftConfig:
    columns: tuple = DRIFT_COLUMNS
    bins: int = 10
    threshold: float = 0.2
    epsilon: float = 1e-6


@dataclass(frozen=True)
class FeatureConfig:
    key: str = "machine_id"
    time: str = "timestamp"
    rid: str = "event_id"
    rolling_columns: tuple = HARDWARE_COLUMNS + SOFTWARE_COLUMNS
    fill_columns: tuple = SOFTWARE_COLUMNS
    windows: tuple = (6, 12, 36)
    lag_columns: tuple = LAG_COLUMNS
    lag_periods: tuple = (1, 2, 6)
    thermal_efficiency: bool = True
    error_stress: bool = True
    power_anomaly: bool = True
    wear_rate: bool = True
    # the upper quartile of torque that marks "stress": per machine, over all rows, per chunk, or a fixed number
    stress_scope: str = "machine"
    stress_fixed: float = 40.0
    # histories up to this many rows per machine stay in one group; longer ones are cut into blocks of block_rows
    max_group_rows: int = 200_000
    block_rows: int = 20_000

    @property
    def back(self) -> int:
        """Rows of history that any feature of a row can need."""
        return max(max(self.windows) - 1, max(self.lag_periods), 11)


@dataclass(frozen=True)
class TrainConfig:
    folds: int = 5
    seed: int = 42
    neighbours: int = 5
    minority_ratio: float = 0.5
    max_trees: int = 500
    max_depth: int = 6
    step_size: float = 0.05
    row_fraction: float = 0.8
    column_fraction: float = 0.7
    min_leaf_rows: int = 10
    min_gain: float = 0.0


def _columns(*pairs):
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_D, _I, _S, _TS = T.DoubleType(), T.IntegerType(), T.StringType(), T.TimestampType()

SYSTEM_SCHEMA = _columns(
    ("timestamp", _TS), ("machine_id", _S), ("product_type", _S), ("air_temperature_K", _D),
    ("process_temperature_K", _D), ("rotational_speed_rpm", _D), ("torque_Nm", _D), ("tool_wear_min", _D),
    ("vibration_mm_s", _D), ("pressure_psi", _D), ("network_latency_ms", _D), ("edge_processing_time_ms", _D),
    ("fuzzy_pid_output", _D), ("machine_failure", _I), ("failure_TWF", _I), ("failure_HDF", _I), ("failure_PWF", _I),
    ("failure_OSF", _I), ("failure_RNF", _I), ("maintenance_status", _S),
)
APPLICATION_SCHEMA = _columns(
    ("timestamp", _TS), ("machine_id", _S), ("api_response_latency_ms", _D), ("error_rate_pct", _D),
    ("http_5xx_count", _I), ("request_throughput_rps", _D), ("queue_depth", _I), ("cpu_utilization_pct", _D),
    ("memory_utilization_pct", _D), ("packet_loss_pct", _D), ("disk_io_wait_ms", _D), ("anomaly_score", _D),
    ("is_anomaly", _I), ("maintenance_status", _S),
)
REQUEST_SCHEMA = T.StructType([
    T.StructField("system", T.StructType(
        [T.StructField("timestamp", _S), T.StructField("machine_id", _S)]
        + [T.StructField(name, _D) for name in REQUEST_SYSTEM if name != "machine_id"])),
    T.StructField("application", T.StructType([T.StructField(name, _D) for name in REQUEST_APPLICATION])),
])
