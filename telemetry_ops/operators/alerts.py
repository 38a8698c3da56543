"""Alert listing, acknowledgement and fatigue reporting. "Now" is always an argument (``as_of``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemetry_ops.config import INDUSTRY_FALSE_POSITIVE_RATE, RISK_LEVELS
from telemetry_ops.functions import fixed_text, python_round, ratio

_HIGH = ("high", "critical")
_MAX_PAGE = 1000


def _since(as_of, **span) -> Column:
    """Start of a trailing period. ``as_of`` is a column, or a datetime."""
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return end - F.make_dt_interval(*[F.lit(span.get(k, 0)) for k in ("days", "hours", "minutes")])


def severity(risk) -> Column:
    return F.array_position(F.array(*map(F.lit, RISK_LEVELS)), F.col(risk) if isinstance(risk, str) else risk)


def list_alerts(df: DataFrame, machine=None, risk=None, limit: int = 100, offset: int = 0) -> DataFrame:
    """Newest first, with optional filters and paging; ties by id."""
    if not 1 <= limit <= _MAX_PAGE or offset < 0:
        raise ValueError(f"limit must be 1..{_MAX_PAGE} and offset not negative")
    if machine is not None:
        df = df.where(F.col("machine_id") == machine)
    if risk is not None:
        df = df.where(F.col("risk_level") == risk)
    return df.orderBy(F.desc("created_at"), F.desc("id")).offset(offset).limit(limit)


def get_alert(df: DataFrame, alert_id) -> DataFrame:
    return df.where(F.col("id") == alert_id)


def recent_alerts(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    return df.where(F.col("created_at") >= _since(as_of, days=days)).orderBy(F.desc("created_at"), F.desc("id"))


def recent_high_risk(df: DataFrame, n: int = 10) -> DataFrame:
    """The latest high or critical alerts with display texts."""
    return (df.where(F.col("risk_level").isin(*_HIGH)).orderBy(F.desc("created_at"), F.desc("id")).limit(n)
            .select("id", "created_at", "machine_id", "risk_level",
                    F.coalesce(F.initcap(F.replace(F.col("root_cause"), F.lit("_"), F.lit(" "))), F.lit("—"))
                    .alias("root_cause"),
                    F.concat(fixed_text(F.col("failure_prob") * 100, 1), F.lit("%")).alias("failure_probability"),
                    "acknowledged"))


def apply_acks(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """Alerts with their acknowledgement events applied.

    The latest event sets time and user; the latest non-empty action and the latest given label win, so an event
    without them does not erase earlier ones.
    """
    when = F.col("acknowledged_at")
    action = F.nullif(F.col("action_taken"), F.lit(""))
    latest = acks.groupBy(F.col("alert_id").alias("id")).agg(
        F.max(when).alias("_at"),
        F.max_by("acknowledged_by", when).alias("_by"),
        F.max_by(action, F.when(action.isNotNull(), when)).alias("_action"),
        F.max_by("is_false_positive", F.when(F.col("is_false_positive").isNotNull(), when)).alias("_label"))
    rest = [c for c in alerts.columns if c not in
            ("acknowledged", "acknowledged_at", "acknowledged_by", "action_taken", "false_positive")]
    old = lambda c: F.col(c) if c in alerts.columns else F.lit(None)
    return alerts.join(latest, "id", "left").select(
        *rest,
        (F.coalesce(old("acknowledged"), F.lit(False)) | F.col("_at").isNotNull()).alias("acknowledged"),
        F.coalesce(F.col("_at"), old("acknowledged_at")).alias("acknowledged_at"),
        F.coalesce(F.col("_by"), old("acknowledged_by")).alias("acknowledged_by"),
        F.coalesce(F.col("_action"), old("action_taken")).alias("action_taken"),
        F.coalesce(F.col("_label"), old("false_positive")).alias("false_positive"))


def fatigue_summary(df: DataFrame, as_of, days: int = 7, machine=None) -> DataFrame:
    """One row for the last ``days`` days; an empty period gives total 0. The rate is NULL only if nothing is labelled."""
    df = df.where(F.col("created_at") >= _since(as_of, days=days))
    if machine is not None:
        df = df.where(F.col("machine_id") == machine)
    by_risk = df.groupBy(F.coalesce("risk_level", F.lit("unknown")).alias("risk_level")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("acknowledged")).alias("ack"),
        F.count_if(F.col("false_positive")).alias("fp"), F.count("false_positive").alias("labelled"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return by_risk.agg(
        F.lit(days).alias("period_days"), total.alias("total_alerts"),
        python_round(total / days, 1).alias("alerts_per_day"),
        F.map_from_entries(F.collect_list(F.struct("risk_level", "n"))).alias("by_risk_level"),  # one per level
        F.coalesce(F.sum("ack"), F.lit(0)).alias("acknowledged_count"),
        F.coalesce(python_round(ratio(F.sum("ack"), F.sum("n")) * 100, 1), F.lit(0.0)).alias("acknowledgment_rate"),
        F.coalesce(F.sum("fp"), F.lit(0)).alias("false_positive_count"),
        python_round(ratio(F.sum("fp"), F.sum("labelled")) * 100, 1).alias("false_positive_rate"),
        F.lit(INDUSTRY_FALSE_POSITIVE_RATE).alias("benchmark_fp_rate"))


def cause_counts(df: DataFrame) -> DataFrame:
    """Per day, machine and root cause: alerts by risk level and review outcomes. All counts can be added up."""
    return df.groupBy(F.to_date("created_at").alias("date"), "machine_id", "root_cause").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("risk_level") == r).alias(f"{r}_count") for r in RISK_LEVELS],
        F.count_if(F.col("acknowledged")).alias("ack"), F.count_if(F.col("false_positive")).alias("fp"),
        F.count_if(~F.col("false_positive")).alias("tp"))


def daily_from_causes(per_cause: DataFrame) -> DataFrame:
    """Per day and machine, from :func:`cause_counts`."""
    causes = F.map_from_entries(F.collect_list(
        F.when(F.col("root_cause").isNotNull() & (F.col("n") > 0), F.struct("root_cause", "n"))))
    return per_cause.groupBy("date", "machine_id").agg(
        F.sum("n").alias("total_alerts"), *[F.sum(f"{r}_count").alias(f"{r}_count") for r in RISK_LEVELS],
        F.sum("ack").alias("acknowledged_count"), F.sum("fp").alias("false_positive_count"),
        F.sum("tp").alias("true_positive_count"), causes.alias("root_cause_distribution"))


def daily_fatigue(df: DataFrame) -> DataFrame:
    """Per day and machine: alerts by risk level, review outcomes and a map of root causes.

    Grouped by cause first, so the second step only adds up a few rows per day and machine.
    """
    return daily_from_causes(cause_counts(df))


def counters(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("risk_level").isin(*_HIGH)).alias("high_risk"),
                  F.count_if(F.col("acknowledged")).alias("acknowledged"))


def root_causes(df: DataFrame) -> DataFrame:
    return (df.where(F.col("root_cause").isNotNull()).groupBy("root_cause").agg(F.count(F.lit(1)).alias("n_alerts"))
            .orderBy(F.desc("n_alerts"), "root_cause"))


def risk_distribution(df: DataFrame) -> DataFrame:
    """Counts per risk level, most severe first."""
    return (df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n_alerts"))
            .withColumn("severity", severity("risk_level")).orderBy("severity"))


def hourly(df: DataFrame, as_of, hours: int = 24) -> DataFrame:
    return (df.where(F.col("created_at") >= _since(as_of, hours=hours))
            .groupBy(F.date_trunc("hour", "created_at").alias("hour"))
            .agg(F.count(F.lit(1)).alias("alert_count"), F.avg("failure_prob").alias("avg_probability"))
            .orderBy("hour"))


def observed_rates(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Share of labelled alerts that were false, and share of alerts acknowledged, in percent."""
    recent = df.where(F.col("created_at") >= _since(as_of, days=days))
    return recent.agg(
        (F.avg(F.col("false_positive").cast("double")) * 100).alias("observed_fp_rate"),
        F.coalesce(F.avg(F.col("acknowledged").cast("double")) * 100, F.lit(0.0)).alias("ack_rate"))


def search_contributions(df: DataFrame, feature: str, min_value: float, column: str = "shap_values") -> DataFrame:
    """Alerts whose contribution payload (JSON text or array) holds ``feature`` above ``min_value``."""
    payload = F.col(column)
    if dict(df.dtypes)[column] == "string":
        payload = F.from_json(payload, "struct<top_contributors: array<struct<feature: string, shap_value: double>>>")
        return df.where(F.exists(payload["top_contributors"],
                                 lambda c: (c["feature"] == feature) & (c["shap_value"] > min_value)))
    return df.where(F.exists(payload, lambda c: (c["feature"] == feature) & (c["contribution"] > min_value)))


def project_payload(df: DataFrame, paths: dict, column: str = "raw_data") -> DataFrame:
    """Add fields of a JSON payload: ``paths`` maps output names to (JSON path, type); a ``number`` is a double."""
    return df.select("*", *[F.get_json_object(column, p).try_cast("double" if kind == "number" else kind).alias(n)
                            for n, (p, kind) in paths.items()])
