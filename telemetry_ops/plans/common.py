"""Shared pieces of the named queries: derived tables in both engines, rounding, lists of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemetry_ops.config import HARDWARE_COLUMNS, LAG_COLUMNS, SOFTWARE_COLUMNS
from telemetry_ops.sources import telemetry as t

CHUNK = 1000
ROLLING = HARDWARE_COLUMNS + SOFTWARE_COLUMNS
SYSTEM_NAMES = [
    "timestamp", "machine_id", "product_type", "air_temperature_K", "process_temperature_K", "rotational_speed_rpm",
    "torque_Nm", "tool_wear_min", "vibration_mm_s", "pressure_psi", "network_latency_ms", "edge_processing_time_ms",
    "fuzzy_pid_output", "machine_failure",
]
SYSTEM_NUMERIC = [c for c in SYSTEM_NAMES if c not in ("timestamp", "machine_id", "product_type")]
SENSORS = ["air_temperature_K", "rotational_speed_rpm", "torque_Nm", "tool_wear_min", "vibration_mm_s", "pressure_psi"]
APPLICATION_NAMES = [
    "api_response_latency_ms", "error_rate_pct", "http_5xx_count", "request_throughput_rps", "queue_depth",
    "cpu_utilization_pct", "memory_utilization_pct", "packet_loss_pct", "disk_io_wait_ms", "is_anomaly",
]


def _view(columns, where=None):
    return f"SELECT {', '.join(columns)} FROM fx_base" + (f" WHERE {where}" if where else "")


_K = "CAST(json_extract_string(props, '$.k') AS INT)"
_HISTORY = "PARTITION BY machine_id ORDER BY timestamp, event_id"
_VIEWS = {
    "fx_base": f"SELECT {', '.join(t.BASE)}, {_K} AS k FROM events",
    "fx_system": _view(t.SYSTEM),
    "fx_app": _view(t.APPLICATION, t.APPLICATION_FILTER),
    "fx_scores": _view(t.SCORES),
    "fx_alerts": _view(t.ALERTS),
    "fx_acks": _view(t.ACKNOWLEDGEMENTS, t.ACKNOWLEDGEMENTS_FILTER),
    "fx_contribs": " UNION ALL ".join(
        f"SELECT event_id AS row_id, '{n}' AS feature, {e} AS contribution FROM fx_base"
        for n, e in t.CONTRIBUTIONS.items()),
    "fx_chunks": "SELECT *, row_number() OVER (ORDER BY timestamp, event_id) - 1 AS row_index, "
                 f"(row_number() OVER (ORDER BY timestamp, event_id) - 1) // {CHUNK} AS chunk_id FROM fx_system",
    "fx_aligned": "SELECT s.*, " + ", ".join(f"a.{c}" for c in APPLICATION_NAMES) +
                  " FROM fx_system s LEFT JOIN fx_app a ON s.timestamp = a.timestamp AND s.machine_id = a.machine_id",
    "fx_filled": "SELECT event_id, " + ", ".join(SYSTEM_NAMES) + ", " + ", ".join(
        f"last_value({c} IGNORE NULLS) OVER ({_HISTORY} ROWS UNBOUNDED PRECEDING) AS {c}" if c in SOFTWARE_COLUMNS
        else c for c in APPLICATION_NAMES) + " FROM fx_aligned",
}
_NEEDS = {"fx_chunks": ["fx_system"], "fx_aligned": ["fx_system", "fx_app"], "fx_filled": ["fx_aligned"]}


def sql(body: str, *views: str, **extra: str) -> str:
    """A SQL text with the derived tables it uses as common table expressions; ``extra`` adds named ones in order."""
    ordered = []

    def need(name):
        if name != "fx_base":
            for other in _NEEDS.get(name, ["fx_base"]):
                need(other)
        if name not in ordered:
            ordered.append(name)

    for v in views:
        need(v)
    parts = [f"{n} AS MATERIALIZED ({_VIEWS[n]})" for n in ordered]
    parts += [f"{n} AS MATERIALIZED ({text})" for n, text in extra.items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body


# Means of few-decimal readings often end exactly half-way between two rounded values, where the last bit of a sum (its
# order differs between engines) decides. Adding this first moves them off the tie; it is below the rounding step.
OFF_TIE = 1.23e-7


def _round(name: str, digits: int, nudge: float) -> Column:
    """Half away from zero on the scaled double, as the SQL engine does. Spark's ``round`` goes through a decimal text, which
    for a hundred columns costs more than the features themselves."""
    x, scale = f"`{name}`" + (f" + {nudge!r}D" if nudge else ""), f"{float(10 ** digits)!r}D"
    y = f"(({x}) * {scale})"
    return F.expr(f"CASE WHEN abs{y} < {2.0 ** 52!r}D THEN signum{y} * floor(abs{y} + 0.5D) / {scale} + 0D ELSE {x} END").alias(name)


def rounded(df: DataFrame, digits: int = 6, nudge: float = 0.0) -> DataFrame:
    """Round every double column."""
    return df.select(*[_round(c, digits, nudge) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def r(*columns: str, digits: int = 6, nudge: float = 0.0) -> str:
    """SQL twin of :func:`rounded` for the named columns (``expression AS name`` is allowed)."""
    out = []
    for c in columns:
        expr, _, name = c.rpartition(" AS ")
        out.append(f"round({expr or name}{f' + {nudge!r}' if nudge else ''}, {digits}) AS {name}")
    return ", ".join(out)


def with_chunks(spark, folder) -> DataFrame:
    from telemetry_ops.operators.scan import chunk_ids
    return chunk_ids(t.system(spark, folder), "timestamp", "event_id", CHUNK)


def text_time(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def sql_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


LAG_NAMES = list(LAG_COLUMNS)
HISTORY = _HISTORY


def draw(expression: str, seed: int) -> str:
    """SQL twin of the repeatable draw from a row id."""
    return f"((({expression}) % 2147483647) * 48271 + {seed * 69621 + 11}) % 2147483647"
