"""Alert queries. "Now" is the newest alert's time."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_ops.config import RISK_LEVELS
from telemetry_ops.operators import alerts as a, explain, merged
from telemetry_ops.plans.common import OFF_TIE, r, rounded, sql, sql_time, text_time
from telemetry_ops.scratch import new_path
from telemetry_ops.sources import telemetry as t

_DAYS = 7


def _alerts(spark, d):
    df = t.alerts(spark, d)
    return df, df.agg(F.max("created_at")).scalar()


def _listing(spark, d):
    return rounded(a.list_alerts(t.alerts(spark, d), machine="M2", risk="low", limit=50, offset=20)
                   .select("id", "machine_id", "risk_level", "failure_prob"))


def _by_id(spark, d):
    return rounded(a.get_alert(t.alerts(spark, d), 77).select("id", "machine_id", "risk_level", "failure_prob"))


def _recent(spark, d):
    df, now = _alerts(spark, d)
    return a.recent_alerts(df, now, _DAYS).select("id", "machine_id", "risk_level", "root_cause", "acknowledged")


def _high_risk(spark, d):
    return a.recent_high_risk(t.alerts(spark, d)).drop("created_at")


def _acks(spark, d):
    done = a.apply_acks(t.alerts(spark, d), t.acknowledgements(spark, d))
    return done.select("id", "acknowledged", text_time("acknowledged_at").alias("acknowledged_at"), "acknowledged_by",
                       "action_taken", F.col("false_positive").cast("int").alias("false_positive"))


def _fatigue(spark, d):
    df, now = _alerts(spark, d)
    s = a.fatigue_summary(df, now, _DAYS)
    return s.select("period_days", "total_alerts", "alerts_per_day", *[
        F.coalesce(F.col("by_risk_level")[x], F.lit(0)).alias(f"n_{x}") for x in RISK_LEVELS],
        "acknowledged_count", "acknowledgment_rate", "false_positive_count", "false_positive_rate",
        "benchmark_fp_rate")


def _fatigue_machine(spark, d):
    df, now = _alerts(spark, d)
    return a.fatigue_summary(df, now, 30, "M3").drop("by_risk_level")


def _daily(spark, d):
    return _with_causes(a.daily_fatigue(t.alerts(spark, d)))


def _maintained(spark, d):
    """The daily table after alerts and acknowledgements came in two batches each, one of them twice."""
    path, alerts, acks = new_path(spark, "daily"), t.alerts(spark, d), t.acknowledgements(spark, d)
    early = F.pmod(F.xxhash64("acknowledged_at"), F.lit(2)) == 0
    merged.add_alerts(path, alerts.where("id % 2 = 0"), 0)
    merged.add_acknowledgements(path, alerts.where("id % 2 = 0"), acks.limit(0), acks.where(early & (F.col("alert_id") % 2 == 0)), 1)
    for _ in range(2):
        merged.add_alerts(path, alerts.where("id % 2 <> 0"), 2)
    merged.add_acknowledgements(path, alerts, acks.where(early & (F.col("alert_id") % 2 == 0)),
                                acks.where(~(early & (F.col("alert_id") % 2 == 0))), 3)
    return _with_causes(merged.daily(spark, path, alerts))


def _with_causes(s):
    causes = F.array_join(F.array_sort(F.transform(F.map_entries("root_cause_distribution"), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string")))), ",")
    return s.withColumn("root_causes", causes).drop("root_cause_distribution").withColumn(
        "date", F.col("date").cast("string"))


def _counters(spark, d):
    return a.counters(t.alerts(spark, d))


def _causes(spark, d):
    return a.root_causes(t.alerts(spark, d))


def _risks(spark, d):
    return a.risk_distribution(t.alerts(spark, d))


def _hourly(spark, d):
    df, now = _alerts(spark, d)
    return rounded(a.hourly(df, now, 24).withColumn("hour", text_time("hour")), nudge=OFF_TIE)


def _rates(spark, d):
    df, now = _alerts(spark, d)
    return rounded(a.observed_rates(df, now, _DAYS))


def _search(spark, d):
    wide = t.contributions_wide(spark, d)
    payload = wide.select("row_id", F.to_json(F.struct(F.transform(
        explain.contribution_array(wide, {c: F.col(c) for c in t.CONTRIBUTIONS}), lambda c: F.struct(
            c["feature"].alias("feature"), c["contribution"].alias("shap_value"))).alias("top_contributors")))
        .alias("shap_values"))
    return a.search_contributions(payload, "vibration_mm_s", 0.3).select("row_id")


def _payload(spark, d):
    return a.project_payload(t.alerts(spark, d), {"k": ("$.k", "int")}).select("id", "k")


_SINCE = "created_at >= (SELECT max(created_at) FROM fx_alerts) - INTERVAL {} "
_SUMMARY = (
    "SELECT {days} AS period_days, count(*) AS total_alerts, round(count(*) / {days}.0, 1)::DOUBLE AS alerts_per_day, "
    "{risks} count(*) FILTER (acknowledged) AS acknowledged_count, "
    "round(count(*) FILTER (acknowledged)::DOUBLE / count(*) * 100, 1) AS acknowledgment_rate, "
    "count(*) FILTER (false_positive) AS false_positive_count, "
    "round(count(*) FILTER (false_positive)::DOUBLE / count(false_positive) * 100, 1) AS false_positive_rate, "
    "54.0::DOUBLE AS benchmark_fp_rate FROM fx_alerts WHERE {where}")
_BY_RISK = "".join(f"count(*) FILTER (risk_level = '{x}') AS n_{x}, " for x in RISK_LEVELS)
_SEVERITY = "CASE risk_level " + " ".join(f"WHEN '{x}' THEN {i + 1}" for i, x in enumerate(RISK_LEVELS)) + " END"

_DAILY = (
        "SELECT m.*, c.root_causes FROM (SELECT CAST(created_at AS DATE)::VARCHAR AS date, machine_id, count(*) AS "
        "total_alerts, " + "".join(f"count(*) FILTER (risk_level = '{x}') AS {x}_count, " for x in RISK_LEVELS)
        + "count(*) FILTER (acknowledged) AS acknowledged_count, count(*) FILTER (false_positive) AS "
        "false_positive_count, count(*) FILTER (NOT false_positive) AS true_positive_count FROM {alerts} GROUP BY 1, 2) m "
        "JOIN (SELECT date, machine_id, coalesce(string_agg(root_cause || '=' || n, ',' ORDER BY root_cause), '') AS "
        "root_causes FROM (SELECT CAST(created_at AS DATE)::VARCHAR AS date, machine_id, root_cause, count(*) AS n "
        "FROM {alerts} GROUP BY 1, 2, 3) GROUP BY 1, 2) c USING (date, machine_id)")
_ACKED = (
    "SELECT a.* REPLACE (a.acknowledged OR k.at IS NOT NULL AS acknowledged, coalesce(k.label, a.false_positive) AS "
    "false_positive) FROM fx_alerts a LEFT JOIN (SELECT alert_id, max(acknowledged_at) AS at, arg_max(is_false_positive, "
    "acknowledged_at) FILTER (is_false_positive IS NOT NULL) AS label FROM fx_acks GROUP BY alert_id) k ON k.alert_id = a.id")

QUERIES = {
    "alert_listing": (_listing, sql(
        f"SELECT id, machine_id, risk_level, {r('failure_prob')} FROM fx_alerts WHERE machine_id = 'M2' AND "
        "risk_level = 'low' ORDER BY created_at DESC, id DESC LIMIT 50 OFFSET 20", "fx_alerts")),
    "alert_by_id": (_by_id, sql(
        f"SELECT id, machine_id, risk_level, {r('failure_prob')} FROM fx_alerts WHERE id = 77", "fx_alerts")),
    "recent_alerts": (_recent, sql(
        "SELECT id, machine_id, risk_level, root_cause, acknowledged FROM fx_alerts WHERE "
        + _SINCE.format("7 days"), "fx_alerts")),
    "recent_high_risk": (_high_risk, sql(
        "SELECT id, machine_id, risk_level, CASE root_cause WHEN 'mechanical_wear' THEN 'Mechanical Wear' WHEN "
        "'thermal_overload' THEN 'Thermal Overload' WHEN 'network_congestion' THEN 'Network Congestion' WHEN "
        "'software_stress' THEN 'Software Stress' WHEN 'power_anomaly' THEN 'Power Anomaly' WHEN 'complex_pattern' "
        "THEN 'Complex Pattern' ELSE '—' END AS root_cause, printf('%.1f', failure_prob * 100) || '%' AS "
        "failure_probability, acknowledged FROM fx_alerts WHERE risk_level IN ('high', 'critical') "
        "ORDER BY created_at DESC, id DESC LIMIT 10", "fx_alerts")),
    "apply_acknowledgements": (_acks, sql(
        f"SELECT a.id, a.acknowledged OR k.at IS NOT NULL AS acknowledged, {sql_time('k.at')} AS acknowledged_at, "
        "k.who AS acknowledged_by, k.action AS action_taken, coalesce(k.label, a.false_positive)::INT AS false_positive "
        "FROM fx_alerts a LEFT JOIN (SELECT alert_id, max(acknowledged_at) AS at, arg_max(acknowledged_by, "
        "acknowledged_at) AS who, arg_max(action_taken, acknowledged_at) FILTER (action_taken <> '') AS action, "
        "arg_max(is_false_positive, acknowledged_at) FILTER (is_false_positive IS NOT NULL) AS label FROM fx_acks "
        "GROUP BY alert_id) k ON k.alert_id = a.id", "fx_alerts", "fx_acks")),
    "fatigue_summary": (_fatigue, sql(
        _SUMMARY.format(days=7, risks=_BY_RISK, where=_SINCE.format("7 days")), "fx_alerts")),
    "fatigue_by_machine": (_fatigue_machine, sql(
        _SUMMARY.format(days=30, risks="", where=_SINCE.format("30 days") + "AND machine_id = 'M3'"), "fx_alerts")),
    "daily_fatigue": (_daily, sql(_DAILY.format(alerts="fx_alerts"), "fx_alerts")),
    "daily_fatigue_maintained": (_maintained, sql(_DAILY.format(alerts="acked"), "fx_alerts", "fx_acks", acked=_ACKED)),
    "alert_counters": (_counters, sql(
        "SELECT count(*) AS total, count(*) FILTER (risk_level IN ('high', 'critical')) AS high_risk, "
        "count(*) FILTER (acknowledged) AS acknowledged FROM fx_alerts", "fx_alerts")),
    "root_cause_distribution": (_causes, sql(
        "SELECT root_cause, count(*) AS n_alerts FROM fx_alerts WHERE root_cause IS NOT NULL GROUP BY 1", "fx_alerts")),
    "risk_distribution": (_risks, sql(
        f"SELECT risk_level, count(*) AS n_alerts, {_SEVERITY} AS severity FROM fx_alerts GROUP BY 1", "fx_alerts")),
    "hourly_alerts": (_hourly, sql(
        f"SELECT {sql_time(chr(39).join(['date_trunc(', 'hour', ', created_at)']))} AS hour, count(*) AS alert_count, "
        f"{r('avg(failure_prob) AS avg_probability', nudge=OFF_TIE)} FROM fx_alerts WHERE {_SINCE.format('24 hours')} "
        "GROUP BY date_trunc('hour', created_at)", "fx_alerts")),
    "observed_rates": (_rates, sql(
        "SELECT round(avg(false_positive::INT) * 100, 6) AS observed_fp_rate, round(avg(acknowledged::INT) * 100, 6) "
        f"AS ack_rate FROM fx_alerts WHERE {_SINCE.format('7 days')}", "fx_alerts")),
    "contribution_search": (_search, sql(
        "SELECT row_id FROM fx_contribs WHERE feature = 'vibration_mm_s' AND contribution > 0.3::DOUBLE",
        "fx_contribs")),
    "payload_projection": (_payload, sql(
        "SELECT id, CAST(json_extract_string(raw_data, '$.k') AS INT) AS k FROM fx_alerts", "fx_alerts")),
}
