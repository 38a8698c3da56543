"""Features of the newest row per machine, with stand-ins while a machine has little history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetry_ops.config import NORMAL_RANGES, FeatureConfig
from telemetry_ops.operators import features

_BUFFER = 36
_MIN_HISTORY = 6

# ---- fixed values: assumed deviation as a share of the value, plus a share of the distance from the usual range -----
INSIDE_SHARE = 0.02
VERY_FAR = (2, 0.4, 0.3)    # more than two range widths outside
FAR = (1, 0.25, 0.2)        # more than one
NEAR = (0.15, 0.1)
# ---- fixed values: assumed earlier value per step, above and below the usual range; assumed wear per step -----------
RISING, FALLING = 0.95, 1.05
WEAR_STEPS = ((200, 2.0), (100, 1.0), (None, 0.5))


def cold_std(column: str, window: int) -> Column:
    """Deviation assumed before six observations exist: small inside the usual range, growing with the distance.

    Written as SQL text: some forty of these are built per query, and one expression text is parsed much faster than
    thirty column calls each.
    """
    v, (low, high) = f"`{column}`", _range(column)
    outside = f"greatest({v} - {high}, {low} - {v}, 0D)"
    severity = f"{outside} / ({high} - {low} + 1e-6D)"
    far = lambda value_share, distance_share: (
        f"abs({v}) * {value_share!r}D + {outside} * {distance_share!r}D")
    return F.expr(
        f"(CASE WHEN {v} >= {low} AND {v} <= {high} THEN abs({v}) * {INSIDE_SHARE!r}D"
        f" WHEN {severity} > {VERY_FAR[0]} THEN {far(*VERY_FAR[1:])} WHEN {severity} > {FAR[0]} THEN {far(*FAR[1:])}"
        f" ELSE {far(*NEAR)} END) * {1 + window / _BUFFER!r}D")


def cold_lag(column: str, lag: int) -> Column:
    """Earlier value assumed when history is shorter than the lag: rising above the range, falling below it."""
    v, (low, high) = f"`{column}`", _range(column)
    return F.expr(f"{v} * CASE WHEN {v} > {high} THEN {RISING ** lag!r}D WHEN {v} < {low} THEN {FALLING ** lag!r}D "
                  "ELSE 1D END")


def cold_wear_rate(wear: Column) -> Column:
    (high, fast), (medium, usual), (_, slow) = WEAR_STEPS
    return F.when(wear > high, fast).when(wear > medium, usual).otherwise(slow)


def _range(column: str):
    """Usual range as SQL texts; a column without one gets 20 % either side of its value."""
    if column in NORMAL_RANGES:
        low, high = NORMAL_RANGES[column]
        return f"{low!r}D", f"{high!r}D"
    return f"(`{column}` * 0.8D)", f"(`{column}` * 1.2D)"


def latest_rows(df: DataFrame, cfg: FeatureConfig, n: int | None = None) -> DataFrame:
    """The last ``n`` rows per key (by default as many as the widest feature reads); the rank limit runs before the shuffle, so long histories are not moved."""
    n = n or max(_BUFFER, cfg.back + 1)
    newest = Window.partitionBy(cfg.key).orderBy(F.desc(cfg.time), F.desc(cfg.rid))
    return df.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= n)


def latest_features(df: DataFrame, cfg: FeatureConfig | None = None, cold_start: bool = True) -> DataFrame:
    """One row per machine from its latest rows, 36 or as many as the widest feature reads; ``n_history`` is how many there were.

    With ``cold_start`` fewer than six rows give assumed deviations, and too short a history assumed lags and wear
    rate; a deviation that cannot be computed is 0. Torque stress uses a fixed limit.
    """
    cfg = cfg or FeatureConfig()
    recent = latest_rows(df, cfg).withColumn(
        "n_history", F.count(F.lit(1)).over(Window.partitionBy(cfg.key)))
    return _finish(with_history_columns(recent, cfg).where(F.col("_age") == 1).drop("_age"), cfg, cold_start)


def with_history_columns(recent: DataFrame, cfg: FeatureConfig) -> DataFrame:
    order = (cfg.key, cfg.time, cfg.rid)
    wide = features.lags(features.rolling(recent, *order, cfg.rolling_columns, cfg.windows), *order, cfg.lag_columns,
                         cfg.lag_periods)
    w = Window.partitionBy(cfg.key).orderBy(cfg.time, cfg.rid)
    return wide.select(
        "*", features.power().alias("instantaneous_power_W"),
        F.avg(features.power()).over(w.rowsBetween(-11, 0)).alias("expected_power_W"),
        (F.col("tool_wear_min") - F.lag("tool_wear_min").over(w)).alias("_step"))


def stand_ins(df: DataFrame, cfg: FeatureConfig) -> dict[str, Column]:
    """Deviations and lags by name, assumed where ``n_history`` is too short; a deviation that cannot be computed is 0."""
    n, out = F.col("n_history"), {}
    for c in (c for c in cfg.rolling_columns if c in df.columns):
        for k in cfg.windows:
            out[f"{c}_std_{k}"] = F.when(n < _MIN_HISTORY, cold_std(c, k)).otherwise(
                F.coalesce(F.col(f"{c}_std_{k}"), F.lit(0.0)))
    for c in (c for c in cfg.lag_columns if c in df.columns):
        for p in cfg.lag_periods:
            out[f"{c}_lag_{p}"] = F.when(n > p, F.col(f"{c}_lag_{p}")).otherwise(cold_lag(c, p))
    return out


def with_stand_ins(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """The features of rows that carry ``n_history`` and the columns of :func:`with_history_columns`."""
    return _finish(df, cfg, True)


def _finish(last: DataFrame, cfg: FeatureConfig, cold_start: bool) -> DataFrame:
    n = F.col("n_history")
    replaced = stand_ins(last, cfg) if cold_start else {
        f"{c}_std_{k}": F.coalesce(F.col(f"{c}_std_{k}"), F.lit(0.0))
        for c in cfg.rolling_columns if c in last.columns for k in cfg.windows}
    rate = F.coalesce(F.greatest(F.col("_step"), F.lit(0.0)), F.lit(0.0))
    if cold_start:
        rate = F.when(n < 2, cold_wear_rate(F.col("tool_wear_min"))).otherwise(rate)
    expected = F.coalesce("expected_power_W", "instantaneous_power_W")
    replaced["expected_power_W"] = expected
    columns = [replaced[c].alias(c) if c in replaced else F.col(c) for c in last.columns if c != "_step"]
    return last.select(
        *columns, features.deviation(F.col("instantaneous_power_W"), expected).alias("power_anomaly_score"),
        rate.alias("tool_wear_rate"), features.thermal_efficiency().alias("thermal_efficiency_idx"),
        features.under_stress(F.lit(cfg.stress_fixed)).alias("error_under_stress"))
