"""Alignment and feature queries."""

from __future__ import annotations

import dataclasses
import functools
import math

from pyspark.sql import functions as F

from telemetry_ops.config import LAG_COLUMNS, NORMAL_RANGES, SOFTWARE_COLUMNS, FeatureConfig
from telemetry_ops.operators import align as al, features as f, scan, serving
from telemetry_ops.plans.common import (
    APPLICATION_NAMES, CHUNK, HISTORY, LAG_NAMES, OFF_TIE, ROLLING, SYSTEM_NAMES, sql,
)
from telemetry_ops.plans import common
from telemetry_ops.scratch import written
from telemetry_ops.sources import telemetry as t

rounded = functools.partial(common.rounded, nudge=OFF_TIE)
r = functools.partial(common.r, nudge=OFF_TIE)
_CFG = FeatureConfig()
_ORDER = ("machine_id", "timestamp", "event_id")
_DERIVED = ["thermal_efficiency_idx", "instantaneous_power_W", "expected_power_W", "power_anomaly_score",
            "tool_wear_rate"]


def _aligned(spark, d):
    return al.align(t.system(spark, d), t.application(spark, d))


def _filled(spark, d):
    return al.forward_fill(_aligned(spark, d), *_ORDER, _CFG.fill_columns)


def _align(spark, d):
    return rounded(_aligned(spark, d).select("event_id", "machine_id", "torque_Nm", *APPLICATION_NAMES))


def _forward_fill(spark, d):
    return rounded(_filled(spark, d).select("event_id", *APPLICATION_NAMES))


def _forward_fill_blocks(spark, d):
    filled = al.forward_fill_blocks(_aligned(spark, d), *_ORDER, _CFG.fill_columns, block_rows=1000)
    return rounded(filled.select("event_id", *APPLICATION_NAMES))


def _in_blocks(spark, d, work):
    """``work(filled rows, key, order)`` on blocks with history, so that no window holds a whole machine."""
    cut = al.filled_history_blocks(_aligned(spark, d), *_ORDER, _CFG.fill_columns, _CFG.back, _CFG.block_rows)
    return work(cut, ["_block", "machine_id"], "_pos").where(~F.col("_ghost"))


def _rolling_mean(spark, d):
    df = _in_blocks(spark, d, lambda df, key, at: f.rolling(df, key, at, at, ROLLING))
    return rounded(df.select("event_id", *[c for c in df.columns if "_mean_" in c]))


def _rolling_std(spark, d):
    df = _in_blocks(spark, d, lambda df, key, at: f.rolling(df, key, at, at, ROLLING))
    return rounded(df.select("event_id", *[c for c in df.columns if "_std_" in c]))


def _lags(spark, d):
    df = _in_blocks(spark, d, lambda df, key, at: f.lags(df, key, at, at, LAG_NAMES))
    return rounded(df.select("event_id", *[c for c in df.columns if "_lag_" in c]))


def _cross(spark, d):
    df = _in_blocks(spark, d, lambda df, key, at: f.cross_domain(df, dataclasses.replace(
        _CFG, key=key, time=at, rid=at, error_stress=False)))
    df = f.with_stress_flag(df, _CFG, source=t.system(spark, d))
    return rounded(df.select("event_id", *_DERIVED, "error_under_stress"))


def _stress_scopes(spark, d):
    """The few columns the flags read are filled and numbered once; limits come from the raw table."""
    few = _aligned(spark, d).select(*_ORDER, "torque_Nm", "error_rate_pct")
    filled = al.forward_fill_blocks(few, *_ORDER, ["error_rate_pct"], _CFG.block_rows)
    chunks = written(scan.chunk_ids(t.system(spark, d).select(*_ORDER, "torque_Nm"), "timestamp", "event_id", CHUNK), "chunks")
    df = filled.join(chunks.select("event_id", "chunk_id"), "event_id")
    for scope in ("machine", "global", "chunk", "fixed"):
        df = f.with_stress_flag(df, _CFG, scope, source=chunks).withColumnRenamed("error_under_stress", f"stress_{scope}")
    return df.select("event_id", "stress_machine", "stress_global", "stress_chunk", "stress_fixed")


def _matrix_columns(df):
    return rounded(df.drop("timestamp"))


def _feature_matrix(spark, d):
    return _matrix_columns(f.feature_matrix(t.system(spark, d), t.application(spark, d), _CFG))


def _feature_matrix_blocks(spark, d):
    cfg = dataclasses.replace(_CFG, block_rows=1000)
    return _matrix_columns(f.feature_matrix(t.system(spark, d), t.application(spark, d), cfg, blocks=True))


def _latest(spark, d):
    df = serving.latest_features(_aligned(spark, d), _CFG, cold_start=False)
    return rounded(df.drop("timestamp"))


def _many_machines(spark, d):
    """The same telemetry on several thousand machines, most of them with fewer than six rows."""
    fine = F.concat(F.col("user_id").cast("string"), F.lit("-"), (F.col("k") % 20).cast("string")).alias("machine_id")
    own = lambda columns: [c for c in columns if not c.endswith("AS machine_id")]
    base = t.base(spark, d)
    keyed = base.select("*", fine)
    system = keyed.selectExpr("machine_id", *own(t.SYSTEM))
    app = keyed.where(t.APPLICATION_FILTER).selectExpr("machine_id", *own(t.APPLICATION))
    return al.align(system, app)


def _cold_start(spark, d):
    df = serving.latest_features(_many_machines(spark, d), _CFG)
    return rounded(df.select("machine_id", "event_id", "n_history", "tool_wear_rate", *[
        c for c in df.columns if "_std_" in c or "_lag_" in c]))


# ---- the same in SQL ------------------------------------------------------------------------------------------------

def _frame(k):
    return f"OVER ({HISTORY} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


_STATS = {(c, k, s): f"{fn}({c}) {_frame(k)} AS {c}_{s}_{k}"
          for c in ROLLING for k in (6, 12, 36) for s, fn in (("mean", "avg"), ("std", "stddev_samp"))}
_MEANS = [x for (_, _, s), x in _STATS.items() if s == "mean"]
_STDS = [x for (_, _, s), x in _STATS.items() if s == "std"]
_LAGS = [f"lag({c}, {p}) OVER ({HISTORY}) AS {c}_lag_{p}" for c in LAG_COLUMNS for p in (1, 2, 6)]
_POWER = f"(rotational_speed_rpm * torque_Nm * {2 * math.pi / 60!r}::DOUBLE)"
_EXPECTED = f"avg({_POWER}) {_frame(12)}"
_STEP = f"tool_wear_min - lag(tool_wear_min) OVER ({HISTORY})"
_CROSS = [
    "cpu_utilization_pct / (air_temperature_K + 1e-6) AS thermal_efficiency_idx",
    f"{_POWER} AS instantaneous_power_W", f"{_EXPECTED} AS expected_power_W",
    f"abs({_POWER} - {_EXPECTED}) / (abs({_EXPECTED}) + 1e-6) AS power_anomaly_score",
    f"CASE WHEN {_STEP} < 0 THEN 0.0 ELSE {_STEP} END AS tool_wear_rate",
]
_P75 = "SELECT machine_id, quantile_cont(torque_Nm, 0.75) AS p75 FROM fx_system GROUP BY machine_id"
_STRESS = "coalesce(error_rate_pct > 1 AND torque_Nm > {limit}, false)::INT"
_KEPT = [c for c in SYSTEM_NAMES if c != "timestamp"] + APPLICATION_NAMES
_NUMBERS = {"machine_id", "product_type", "machine_failure", "http_5xx_count", "is_anomaly"}
_PLAIN = ", ".join(c if c in _NUMBERS else r(c) for c in _KEPT)
_MATRIX = sql(
    f"SELECT event_id, {_PLAIN}, {r(*_MEANS, *_STDS, *_LAGS, *_CROSS)}, {_STRESS.format(limit='p75')} "
    "AS error_under_stress FROM fx_filled JOIN p USING (machine_id)", "fx_filled", p=_P75)

# serving: the last 36 rows of a machine, without forward fill
_RECENT = ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY timestamp DESC, event_id DESC) "
           "AS age, count(*) OVER (PARTITION BY machine_id) AS n_all FROM {source}) WHERE age <= 36")
_NAMES = {x.rpartition(" AS ")[2] for x in _MEANS + _STDS + _LAGS + _CROSS}
_LATEST_INNER = (f"SELECT *, {', '.join(_MEANS + _STDS + _LAGS + _CROSS)}, least(n_all, 36) AS n_history FROM recent")


def _serving_std(c, k):
    low, high = NORMAL_RANGES[c]
    out = f"greatest({c} - {high!r}::DOUBLE, {low!r}::DOUBLE - {c}, 0.0)"
    sev = f"({out} / ({high - low!r}::DOUBLE + 1e-6))"
    cold = (f"CASE WHEN {c} BETWEEN {low} AND {high} THEN abs({c}) * 0.02::DOUBLE WHEN {sev} > 2 THEN "
            f"abs({c}) * 0.4::DOUBLE + {out} * 0.3::DOUBLE WHEN {sev} > 1 THEN abs({c}) * 0.25::DOUBLE + {out} * "
            f"0.2::DOUBLE ELSE abs({c}) * 0.15::DOUBLE + {out} * 0.1::DOUBLE END * {1 + k / 36!r}::DOUBLE")
    return f"CASE WHEN n_history < 6 THEN {cold} ELSE coalesce({c}_std_{k}, 0.0) END AS {c}_std_{k}"


def _serving_lag(c, p):
    low, high = NORMAL_RANGES[c]
    return (f"CASE WHEN n_history > {p} THEN {c}_lag_{p} ELSE {c} * CASE WHEN {c} > {high} THEN {0.95 ** p!r}::DOUBLE "
            f"WHEN {c} < {low} THEN {1.05 ** p!r}::DOUBLE ELSE 1.0::DOUBLE END END AS {c}_lag_{p}")


_LATEST = sql(
    f"SELECT event_id, {_PLAIN}, n_history, {r(*sorted(x for x in _NAMES if '_mean_' in x or '_lag_' in x))}, "
    + r(*[f"coalesce({x}, 0.0) AS {x}" for x in sorted(_NAMES) if "_std_" in x]) + ", "
    + r("thermal_efficiency_idx", "instantaneous_power_W", "expected_power_W", "power_anomaly_score",
        "coalesce(tool_wear_rate, 0.0) AS tool_wear_rate")
    + f", {_STRESS.format(limit=40)} AS error_under_stress FROM history WHERE age = 1",
    "fx_aligned", recent=_RECENT.format(source="fx_aligned"), history=_LATEST_INNER)

_FINE = "concat(CAST(user_id AS STRING), '-', CAST(k % 20 AS STRING)) AS machine_id"


def _fine(columns):
    return ", ".join([_FINE] + [c for c in columns if not c.endswith("AS machine_id")])


_COLD = sql(
    "SELECT machine_id, event_id, n_history, "
    + r("CASE WHEN n_history < 2 THEN CASE WHEN tool_wear_min > 200 THEN 2.0 WHEN tool_wear_min > 100 THEN 1.0 "
        "ELSE 0.5 END ELSE coalesce(tool_wear_rate, 0.0) END AS tool_wear_rate",
        *[_serving_std(c, k) for c in ROLLING for k in (6, 12, 36)],
        *[_serving_lag(c, p) for c in LAG_COLUMNS for p in (1, 2, 6)])
    + " FROM history WHERE age = 1", "fx_base",
    s=f"SELECT {_fine(t.SYSTEM)} FROM fx_base",
    a=f"SELECT {_fine(t.APPLICATION)} FROM fx_base WHERE {t.APPLICATION_FILTER}",
    joined="SELECT s.*, " + ", ".join(f"a.{c}" for c in APPLICATION_NAMES)
           + " FROM s LEFT JOIN a ON s.timestamp = a.timestamp AND s.machine_id = a.machine_id",
    recent=_RECENT.format(source="joined"), history=_LATEST_INNER)

_APP = ", ".join(c if c in _NUMBERS else r(c) for c in APPLICATION_NAMES)
_FILL_SQL = sql(f"SELECT event_id, {_APP} FROM fx_filled", "fx_filled")

QUERIES = {
    "align": (_align, sql(f"SELECT event_id, machine_id, {r('torque_Nm')}, {_APP} FROM fx_aligned",
                          "fx_aligned")),
    "forward_fill": (_forward_fill, _FILL_SQL),
    "forward_fill_blocks": (_forward_fill_blocks, _FILL_SQL),
    "rolling_mean": (_rolling_mean, sql(f"SELECT event_id, {r(*_MEANS)} FROM fx_filled", "fx_filled")),
    "rolling_std": (_rolling_std, sql(f"SELECT event_id, {r(*_STDS)} FROM fx_filled", "fx_filled")),
    "lag_features": (_lags, sql(f"SELECT event_id, {r(*_LAGS)} FROM fx_filled", "fx_filled")),
    "cross_domain": (_cross, sql(
        f"SELECT event_id, {r(*_CROSS)}, {_STRESS.format(limit='p75')} AS error_under_stress "
        "FROM fx_filled JOIN p USING (machine_id)", "fx_filled", p=_P75)),
    "stress_scopes": (_stress_scopes, sql(
        f"SELECT event_id, {_STRESS.format(limit='p75')} AS stress_machine, "
        f"{_STRESS.format(limit='(SELECT quantile_cont(torque_Nm, 0.75) FROM fx_system)')} AS stress_global, "
        f"{_STRESS.format(limit='c75')} AS stress_chunk, {_STRESS.format(limit=40)} AS stress_fixed FROM fx_filled "
        "JOIN p USING (machine_id) JOIN (SELECT event_id, chunk_id FROM fx_chunks) USING (event_id) "
        "JOIN c USING (chunk_id)", "fx_filled", "fx_chunks", p=_P75,
        c="SELECT chunk_id, quantile_cont(torque_Nm, 0.75) AS c75 FROM fx_chunks GROUP BY chunk_id")),
    "feature_matrix": (_feature_matrix, _MATRIX),
    "feature_matrix_blocks": (_feature_matrix_blocks, _MATRIX),
    "latest_features": (_latest, _LATEST),
    "cold_start_features": (_cold_start, _COLD),
}
