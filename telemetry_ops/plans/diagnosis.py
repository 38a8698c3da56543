"""Explanation and diagnosis queries over telemetry with given contributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_ops.config import FEATURE_GROUPS, REQUEST_APPLICATION, REQUEST_SYSTEM
from telemetry_ops.operators import diagnose as dg, explain as ex, validate as va
from telemetry_ops.plans.common import SYSTEM_NUMERIC, draw, r, rounded, sql
from telemetry_ops.sources import telemetry as t

# contributions are multiples of 1/64, so sums are exact and ties are real ties in any engine
_NAMES = [
    "vibration_mm_s", "tool_wear_min", "torque_Nm_mean_6", "disk_io_wait_ms", "error_rate_pct_lag_1",
    "cpu_utilization_pct", "network_latency_ms", "packet_loss_pct", "air_temperature_K", "thermal_efficiency_idx",
    "power_anomaly_score", "fuzzy_pid_output", "queue_depth_std_12", "tool_wear_rate",
]
_CONTRIBS = {n: f"(((event_id * {7 + 4 * i} + k * {3 + 2 * i}) % {23 + 6 * i}) - {11 + 3 * i}) * 0.015625e0"
             for i, n in enumerate(_NAMES)}
_PROBABILITY = "least(value * 4e-3, 1e0) AS failure_probability"
_READINGS = [c for c in t.APPLICATION if " AS timestamp" not in c and "AS machine_id" not in c]


def _input(spark, d):
    base = t.spread(t.base(spark, d), "event_id")
    df = base.selectExpr("k", "value", *t.SYSTEM, *_READINGS, _PROBABILITY)
    return df.withColumn("contributions", ex.contribution_array(df, _CONTRIBS)).drop("k", "value")


def _risk(spark, d):
    return _input(spark, d).select("event_id", dg.risk_level("failure_probability").alias("risk_level"))


def _mechanics(spark, d):
    return rounded(dg.mechanic_scores(_input(spark, d)).select("event_id", *[m for m, _, _ in dg.MECHANICS]))


def _mode(spark, d):
    return dg.failure_mode(dg.mechanic_scores(_input(spark, d))).select(
        "event_id", "primary_failure_mode", "root_cause_summary", "confidence")


def _diagnosed(spark, d):
    return dg.diagnose_table(_input(spark, d))


def _recommend(spark, d):
    return _diagnosed(spark, d).select(
        "event_id", "risk_level", "primary_failure_mode", F.array_join("immediate_actions", " | ").alias("actions"),
        F.array_join("monitoring_focus", " | ").alias("monitoring"))


def _summaries(spark, d):
    read = lambda p: F.get_json_object("summary", "$." + p)
    return dg.summary_json(_diagnosed(spark, d)).select(
        "event_id", read("machine_id").alias("machine_id"), read("risk_level").alias("risk_level"),
        read("failure_probability").cast("double").alias("failure_probability"), read("root_cause").alias("root_cause"),
        read("action").alias("action"), F.array_join(F.from_json(read("top_features"), "array<string>"), ",")
        .alias("top_features"))


def _reports(spark, d):
    return dg.report_md(_diagnosed(spark, d)).select("event_id", "report_md")


def _counts(spark, d):
    return dg.risk_counts(_diagnosed(spark, d))


def _top(spark, d):
    df = _input(spark, d).select("event_id", F.posexplode(ex.top_contributors("contributions", 10)).alias("pos", "c"))
    return rounded(df.select("event_id", (F.col("pos") + 1).alias("place"), "c.feature", "c.value", "c.contribution",
                             "c.direction"))


def _groups(spark, d):
    df = _input(spark, d).withColumn("g", ex.group_impacts())
    return rounded(df.select("event_id", *[F.col("g")[g].alias(g) for g in FEATURE_GROUPS]))


def _groups_long(spark, d):
    return rounded(ex.group_impacts_long(t.contributions_long(spark, d), "row_id"))


def _importance(spark, d):
    return rounded(ex.global_importance(t.contributions_long(spark, d)))


def _top_features(spark, d):
    long = t.contributions_long(spark, d)
    return rounded(ex.top_features(ex.global_importance(long), n=15))


# fixed answers of different shapes, chosen per row, with values from the row
_ANSWER = (
    "CASE k % 6 WHEN 0 THEN concat('Answer\n```json\n{\"risk_level\": \"HIGH\", \"root_cause\": \"Thermal_Overload\", "
    "\"confidence\": \"Low\", \"recommended_action\": \"check ', CAST(k AS STRING), '\"}\n```\n## Report ', "
    "CAST(event_id AS STRING)) "
    "WHEN 1 THEN '```json\n{\"risk_level\": \"severe\", \"root_cause\": \"gremlins\", \"confidence\": \"high\"}\n```' "
    "WHEN 2 THEN '```json\n{\"risk_level\": \"high\", \"root_cause\": \n```\ntail' "
    "WHEN 3 THEN concat('no block\n# Heading ', CAST(k AS STRING), '\nbody') "
    "WHEN 4 THEN '```json\n{\"recommended_action\": \"\", \"confidence\": \"moderate\"}\n```  ' "
    "ELSE 'plain words' END AS answer")
_FALLBACK = ["CASE WHEN k > 50 THEN 'critical' ELSE 'low' END AS f_risk", "'software_stress' AS f_cause",
             "'low' AS f_confidence", "concat('do ', CAST(k % 3 AS STRING)) AS f_action", "'none' AS f_report"]


def _responses(spark, d):
    escaped = _ANSWER.replace("\\", "\\\\").replace("\n", "\\n")
    df = t.base(spark, d).selectExpr("event_id", escaped, *_FALLBACK)
    parsed = dg.parse_responses(df, "answer", {
        "risk_level": "f_risk", "root_cause": "f_cause", "confidence": "f_confidence",
        "recommended_action": "f_action", "report": "f_report"})
    return parsed.select("event_id", *[c for c in parsed.columns if c.startswith("parsed_")])


def _requests(spark, d):
    """Requests as nested JSON texts; some readings are missing or out of range."""
    df = t.base(spark, d).selectExpr("k", *t.SYSTEM, *_READINGS)
    system = [c for c in REQUEST_SYSTEM if c != "machine_id"]
    df = df.withColumn("torque_Nm", F.when(F.col("k") % 17 == 0, None).otherwise(F.col("torque_Nm"))) \
        .withColumn("process_temperature_K", F.col("process_temperature_K") + F.when(F.col("k") > 95, 150).otherwise(0))
    request = F.to_json(F.struct(
        F.struct("machine_id", *system).alias("system"), F.struct(*REQUEST_APPLICATION).alias("application")))
    return df.select("event_id", request.alias("request"))


def _rejects(spark, d):
    _, rejects = va.validate_rows(va.parse_requests(_requests(spark, d)))
    return rejects.select("event_id", F.array_join("violations", "; ").alias("violations"))


def _valid(spark, d):
    valid, _ = va.validate_rows(va.parse_requests(_requests(spark, d)))
    return rounded(valid.select("event_id", "machine_id", "air_temperature_K", "torque_Nm", "cpu_utilization_pct"))


def _types(spark, d):
    """Requests whose tool wear is no number, not a number, a number as text, or absent."""
    wear = "CASE k % 4 WHEN 0 THEN '\"abc\"' WHEN 1 THEN 'NaN' WHEN 2 THEN '\"12.5\"' ELSE 'null' END"
    start = ('{"system": {"machine_id": "M1", "air_temperature_K": 300, "process_temperature_K": 310, '
             '"rotational_speed_rpm": 1500, "torque_Nm": "40.5", "tool_wear_min": ')
    df = t.base(spark, d).select("event_id", F.concat(F.lit(start), F.expr(wear), F.lit("}, \"application\": {}}"))
                                 .alias("request"))
    return va.with_violations(va.parse_requests(df)).select(
        "event_id", "torque_Nm", "tool_wear_min", F.array_join("violations", "; ").alias("violations"))


# times as requests give them: with Z, with an offset, without a zone, no time, nothing
_TIME = ("CASE k % 5 WHEN 0 THEN concat('2024-01-', lpad(CAST(k % 28 + 1 AS STRING), 2, '0'), 'T10:00:00Z') "
         "WHEN 1 THEN '2024-03-05T23:30:00+02:00' WHEN 2 THEN '2024-03-05 07:08:09' WHEN 3 THEN 'soon' END")


def _times(spark, d):
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    df = t.base(spark, d).selectExpr("event_id", f"{_TIME} AS text")
    return df.select("event_id", F.date_format(va.request_time("text", now), "yyyy-MM-dd HH:mm:ss").alias("requested_at"))


def _defaults(spark, d):
    df = t.base(spark, d).selectExpr("event_id", "CASE WHEN k % 7 = 0 THEN NULL WHEN k % 7 = 1 THEN 0e0 "
                                     "ELSE value END AS network_latency_ms")
    zero = va.apply_defaults(df, va.request_defaults(), True).withColumnRenamed("network_latency_ms", "zero_replaced")
    return rounded(va.apply_defaults(df, va.request_defaults()).join(zero, "event_id"))


def _features(spark, d):
    return rounded(va.select_features(t.system(spark, d)))


_MODEL = ["torque_Nm", "not_there", "air_temperature_K", "tool_wear_min"]


def _conform(spark, d):
    return rounded(va.conform(t.system(spark, d), _MODEL, keep=["event_id"]))


def _numeric(spark, d):
    return rounded(va.numeric_only(t.system(spark, d)))


def _sample(spark, d):
    df = t.system(spark, d)
    one = df.where(F.col("machine_id") == "M1").select("event_id", "machine_failure", F.lit("slice").alias("part"))
    drawn = va.sample_by_label(df, "machine_failure", 20, "event_id").select(
        "event_id", "machine_failure", F.lit("drawn").alias("part"))
    any_rows = va.sample_rows(df, 30, "event_id", seed=7).select("event_id", F.lit("any").alias("part"))
    return va.append(one, drawn, any_rows)


# ---- the same in SQL ------------------------------------------------------------------------------------------------

_IN = "SELECT k, value, " + ", ".join([*t.SYSTEM, *_READINGS, _PROBABILITY]) + " FROM fx_base"
_LONG = " UNION ALL ".join(
    f"SELECT event_id, {i} AS idx, '{n}' AS feature, "
    + (f"{n}::DOUBLE" if n in SYSTEM_NUMERIC or n in ("disk_io_wait_ms", "cpu_utilization_pct", "packet_loss_pct")
       else "NULL::DOUBLE") + f" AS val, {e} AS c FROM i" for i, (n, e) in enumerate(_CONTRIBS.items()))
_RANKED = "SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY abs(c) DESC, idx) AS place FROM long"
_GROUP = ", ".join(f"coalesce(sum(c) FILTER (regexp_matches(feature, '{'|'.join(names)}')), 0.0) AS {g}"
                   for g, names in FEATURE_GROUPS.items())
_PER_ROW = (f"SELECT event_id, sum(abs(c)) AS total, sum(abs(c)) FILTER (place <= 5) AS top5, {_GROUP}, "
            "max(CASE WHEN place = 1 THEN feature END) AS driver, "
            "bool_or(place <= 5 AND (feature LIKE '%vibration%' OR feature LIKE '%disk%')) AS named, "
            "string_agg(feature, ',' ORDER BY place) FILTER (place <= 3) AS top3 FROM ranked GROUP BY event_id")
_LEVEL = ("CASE WHEN failure_probability >= 0.9 THEN 'critical' WHEN failure_probability >= 0.7 THEN 'high' WHEN "
          "failure_probability >= 0.4 THEN 'moderate' WHEN failure_probability >= 0.2 THEN 'low' ELSE 'nominal' END")
_SCORES = (
    "SELECT i.*, p.* EXCLUDE (event_id), "
    "CASE WHEN torque_Nm * tool_wear_min > 3000 * 0.8 THEN least(torque_Nm * tool_wear_min / 3000, 2.0::DOUBLE) END "
    "AS torque_wear_interaction, "
    "CASE WHEN air_temperature_K > 310 * 0.95 AND network_latency_ms > 50 * 0.8 THEN (air_temperature_K / 310) * "
    "(network_latency_ms / 50) END AS thermal_throttle, "
    "CASE WHEN vibration_mm_s > 25 * 0.8 AND named THEN vibration_mm_s / 25 END AS vibration_cascade, "
    "CASE WHEN error_rate_pct > 5 * 0.8 AND cpu_utilization_pct > 80 * 0.8 THEN (error_rate_pct / 5) * "
    "(cpu_utilization_pct / 80) END AS error_storm FROM i JOIN p USING (event_id)")
_BEST = "greatest(torque_wear_interaction, thermal_throttle, vibration_cascade, error_storm)"
_WIN = ("CASE WHEN torque_wear_interaction = best THEN 1 WHEN thermal_throttle = best THEN 2 "
        "WHEN vibration_cascade = best THEN 3 WHEN error_storm = best THEN 4 END")
_TOPGROUP = ("CASE greatest(abs(mechanical), abs(thermal), abs(network), abs(software), abs(power)) "
             + " ".join(f"WHEN abs({g}) THEN '{g}'" for g in FEATURE_GROUPS) + " END")
_D = {
    "i": _IN, "long": _LONG, "ranked": _RANKED, "p": _PER_ROW, "scored": _SCORES,
    "best": f"SELECT *, {_BEST} AS best, {_TOPGROUP} AS domain, {_LEVEL} AS risk_level FROM scored",
    "won": f"SELECT *, {_WIN} AS win, total > 0 AND top5 / total < 0.5 AS spread FROM best",
    "done": "SELECT *, CASE win WHEN 1 THEN 'mechanical_wear' WHEN 2 THEN 'thermal_overload' WHEN 3 THEN "
            "'mechanical_wear' WHEN 4 THEN 'software_stress' ELSE CASE WHEN spread THEN 'complex_pattern' ELSE CASE "
            "domain WHEN 'mechanical' THEN 'mechanical_wear' WHEN 'thermal' THEN 'thermal_overload' WHEN 'network' THEN "
            "'network_congestion' WHEN 'software' THEN 'software_stress' ELSE 'power_anomaly' END END END AS mode, "
            "CASE WHEN best > 1.5 THEN 'high' WHEN best > 1.0 THEN 'moderate' WHEN best IS NOT NULL OR spread THEN "
            "'low' ELSE 'moderate' END AS confidence FROM won",
}


def _d(body, *more):
    return sql(body, "fx_base", **_D)


_ACTIONS = (
    "list_filter([CASE risk_level WHEN 'critical' THEN '⚠️ CRITICAL: Consider immediate production pause for "
    "inspection' WHEN 'high' THEN 'Schedule maintenance within 24 hours' END, "
    "CASE WHEN mode = 'mechanical_wear' AND driver LIKE '%tool_wear%' THEN "
    "printf('Replace tooling immediately (current wear: %.0f min)', tool_wear_min) END, "
    "CASE WHEN mode = 'mechanical_wear' AND driver LIKE '%vibration%' THEN "
    "printf('Inspect bearing assembly (vibration: %.1f mm/s)', vibration_mm_s) END, "
    "CASE WHEN mode = 'mechanical_wear' AND driver LIKE '%torque%' THEN 'Check spindle alignment and lubrication' END, "
    "CASE WHEN mode = 'thermal_overload' THEN printf('Increase cooling airflow (current: %.1f°C)', "
    "coalesce(air_temperature_K, 300) - 273) END, "
    "CASE WHEN mode = 'thermal_overload' AND network_latency_ms > 30 THEN 'Check edge controller thermal paste and "
    "fans' END, "
    "CASE WHEN mode = 'network_congestion' THEN printf('Check network switch and cables (latency: %.1fms)', "
    "network_latency_ms) END, "
    "CASE WHEN mode = 'network_congestion' AND packet_loss_pct > 0.5 THEN 'Investigate packet loss source - possible "
    "EMI interference' END, "
    "CASE WHEN mode = 'software_stress' AND error_rate_pct > 3 THEN printf('Review application logs for error_rate "
    "spike (%.1f%%)', error_rate_pct) END, "
    "CASE WHEN mode = 'software_stress' AND cpu_utilization_pct > 80 THEN printf('Scale compute resources or optimize "
    "workload (CPU: %.0f%%)', cpu_utilization_pct) END, "
    "CASE WHEN mode = 'power_anomaly' THEN 'Check power supply unit and voltage regulators' END, "
    "CASE WHEN mode = 'power_anomaly' THEN 'Inspect motor drive electronics' END, "
    "CASE WHEN mode = 'complex_pattern' THEN 'Schedule comprehensive system diagnostic' END, "
    "CASE WHEN mode = 'complex_pattern' THEN 'Collect extended sensor data for pattern analysis' END], "
    "lambda x: x IS NOT NULL)")
_ACTIONS = (f"CASE WHEN len({_ACTIONS}) = 0 THEN ['Continue monitoring - no specific action required'] "
            f"ELSE {_ACTIONS} END")
_FOCUS = "CASE mode " + " ".join(f"WHEN '{m}' THEN '{' | '.join(x)}'" for m, x in dg.MONITORING.items()) + " END"
_TEXT = ("CASE win " + " ".join(f"WHEN {i + 1} THEN '{text}'" for i, (_, _, text) in enumerate(dg.MECHANICS))
         + f" ELSE CASE WHEN spread THEN '{dg.COMPLEX_TEXT}' ELSE 'Elevated ' || domain || "
         "' indicators detected. Primary driver: ' || driver END END")

_EVIDENCE = (
    "SELECT event_id, string_agg(place || '. ' || feature || coalesce(' = ' || printf('%.3f', val), '') || CASE WHEN c > 0 "
    "THEN ' raises' ELSE ' lowers' END || ' the margin by ' || printf('%.3f', abs(c)), chr(10) ORDER BY place) "
    "AS evidence FROM ranked WHERE place <= 5 GROUP BY event_id")
_IMPACTS = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN abs({g}) > 0.01 THEN '{g} ' || printf('%+.3f', {g}) END" for g in FEATURE_GROUPS) + ")"
_BULLETS = "array_to_string(list_transform({list}, lambda x: '* ' || x), chr(10))"
_WATCH = "CASE mode " + " ".join(
    f"WHEN '{m}' THEN chr(10) || '## To watch' || chr(10) || '" + "' || chr(10) || '".join(f"* {y}" for y in x) + "'"
    for m, x in dg.MONITORING.items() if x) + " END"
_REPORT = (
    "SELECT event_id, concat_ws(chr(10), '# ' || coalesce(machine_id, 'unknown machine') || ', ' || "
    "strftime(timestamp, '%Y-%m-%d %H:%M:%S'), chr(10) || '## To do', " + _BULLETS.format(list=_ACTIONS) + f", {_WATCH}, "
    "chr(10) || '## Finding' || chr(10) || risk_level || ' risk, failure probability ' || "
    "printf('%.1f', failure_probability * 100) || ' %; ' || mode || ', confidence ' || confidence || '.', " + _TEXT + ", "
    "chr(10) || '## Evidence', evidence, 'By domain: ' || coalesce(nullif(" + _IMPACTS + ", ''), 'none')) AS report_md "
    "FROM done JOIN evidence USING (event_id)")


def _violations_sql():
    reasons = []
    for name, rule in {**REQUEST_SYSTEM, **REQUEST_APPLICATION}.items():
        if rule.required:
            reasons.append(f"CASE WHEN {name} IS NULL THEN '{name}: missing' END")
        if rule.low is not None:
            reasons.append(f"CASE WHEN {name} < {rule.low} THEN '{name}: below {rule.low:g}' END")
        if rule.high is not None:
            reasons.append(f"CASE WHEN {name} > {rule.high} THEN '{name}: above {rule.high:g}' END")
    return f"concat_ws('; ', {', '.join(reasons)})"


_REQ = ("SELECT * REPLACE (CASE WHEN k % 17 = 0 THEN NULL ELSE torque_Nm END AS torque_Nm, process_temperature_K + "
        f"CASE WHEN k > 95 THEN 150 ELSE 0 END AS process_temperature_K) FROM ({_IN})")
_CHECKED = f"SELECT *, {_violations_sql()} AS violations FROM req"
_JSON = "SELECT *, regexp_extract(answer, '```json\\s*([\\s\\S]*?)\\s*```', 1) AS js FROM a"
_J = ("SELECT *, CASE WHEN js <> '' AND json_valid(js) THEN js END AS good, regexp_matches(answer, '```json\\s*([\\s\\S]*?)"
      "\\s*```') AS has FROM j0")
_FIELD = "lower(json_extract_string(good, '$.{f}'))"


def _picked(field, allowed, fallback):
    names = ", ".join(f"'{a}'" for a in allowed)
    value = _FIELD.format(f=field)
    return f"CASE WHEN {value} IN ({names}) THEN {value} ELSE {fallback} END AS parsed_{field}"


QUERIES = {
    "risk_level": (_risk, sql(f"SELECT event_id, {_LEVEL} AS risk_level FROM i", "fx_base", i=_IN)),
    "failure_mechanics": (_mechanics, _d(f"SELECT event_id, {r(*[m for m, _, _ in dg.MECHANICS])} FROM scored")),
    "failure_mode": (_mode, _d(f"SELECT event_id, mode AS primary_failure_mode, {_TEXT} AS root_cause_summary, "
                               "confidence FROM done")),
    "recommendations": (_recommend, _d(
        f"SELECT event_id, risk_level, mode AS primary_failure_mode, array_to_string({_ACTIONS}, ' | ') AS actions, "
        f"{_FOCUS} AS monitoring FROM done")),
    "diagnosis_summary": (_summaries, _d(
        "SELECT event_id, machine_id, risk_level, printf('%.4f', failure_probability)::DOUBLE AS failure_probability, "
        f"mode AS root_cause, ({_ACTIONS})[1] AS action, top3 AS top_features FROM done")),
    "diagnosis_reports": (_reports, sql(_REPORT, "fx_base", **_D, evidence=_EVIDENCE)),
    "diagnosis_risk_counts": (_counts, _d("SELECT risk_level, count(*) AS n_rows FROM done GROUP BY risk_level")),
    "top_contributors": (_top, _d(
        f"SELECT event_id, place, feature, {r('val AS value', 'c AS contribution')}, CASE WHEN c > 0 THEN "
        "'increases_risk' ELSE 'decreases_risk' END AS direction FROM ranked WHERE place <= 10")),
    "group_impacts": (_groups, _d(f"SELECT event_id, {r(*FEATURE_GROUPS)} FROM p")),
    "group_impacts_long": (_groups_long, sql(
        " UNION ALL ".join(f"SELECT row_id, '{g}' AS domain, round(sum(contribution), 6) AS impact FROM fx_contribs "
                           f"WHERE regexp_matches(feature, '{'|'.join(n)}') GROUP BY row_id"
                           for g, n in FEATURE_GROUPS.items()), "fx_contribs")),
    "global_importance": (_importance, sql(
        "SELECT feature, round(avg(abs(contribution)), 6) AS importance FROM fx_contribs GROUP BY feature",
        "fx_contribs")),
    "top_features": (_top_features, sql(
        "SELECT feature, round(importance, 6) AS importance, floor(importance / max(importance) OVER () * 30)::INT AS "
        "bar FROM (SELECT feature, avg(abs(contribution)) AS importance FROM fx_contribs GROUP BY feature) "
        "ORDER BY importance DESC LIMIT 15", "fx_contribs")),
    "response_parsing": (_responses, sql(
        "SELECT event_id, " + ", ".join([
            _picked("risk_level", dg.RISK_LEVELS, "f_risk"), _picked("root_cause", dg.ROOT_CAUSES, "f_cause"),
            _picked("confidence", dg.CONFIDENCES, "f_confidence")])
        + ", coalesce(nullif(json_extract_string(good, '$.recommended_action'), ''), f_action) AS parsed_action, "
        "coalesce(nullif(CASE WHEN has THEN trim(regexp_extract(answer, '```json\\s*([\\s\\S]*?)\\s*```([\\s\\S]*)', 2), "
        "E' \\t\\n\\r') ELSE regexp_extract(answer, '(#{1,3}\\s+[\\s\\S]*)', 1) END, ''), f_report) AS parsed_report FROM j",
        "fx_base", a=f"SELECT event_id, {_ANSWER}, {', '.join(_FALLBACK)} FROM fx_base", j0=_JSON, j=_J)),
    "request_types": (_types, sql(
        "SELECT event_id, 40.5::DOUBLE AS torque_Nm, CASE WHEN k % 4 = 2 THEN 12.5::DOUBLE END AS tool_wear_min, "
        "CASE WHEN k % 4 < 2 THEN 'tool_wear_min: wrong type' WHEN k % 4 = 3 THEN 'tool_wear_min: missing' ELSE '' "
        "END AS violations FROM fx_base", "fx_base")),
    "request_time": (_times, sql(
        "SELECT event_id, strftime(coalesce(TRY_CAST(regexp_replace(text, '(Z|[+-][0-9:]{5})$', '') AS TIMESTAMP) - coalesce(TRY_CAST("
        "regexp_extract(text, 'T.*([+-][0-9]{2}):[0-9]{2}$', 1) AS INT), 0) * INTERVAL 1 hour, TIMESTAMP '2024-06-01 00:00:00'), "
        "'%Y-%m-%d %H:%M:%S') AS requested_at FROM x", "fx_base", x=f"SELECT event_id, {_TIME} AS text FROM fx_base")),
    "request_rejects": (_rejects, sql("SELECT event_id, violations FROM checked WHERE violations <> ''", "fx_base",
                                      req=_REQ, checked=_CHECKED)),
    "request_valid": (_valid, sql(
        f"SELECT event_id, machine_id, {r('air_temperature_K', 'torque_Nm', 'cpu_utilization_pct')} FROM checked "
        "WHERE violations = ''", "fx_base", req=_REQ, checked=_CHECKED)),
    "request_defaults": (_defaults, sql(
        "SELECT event_id, round(coalesce(v, 20.0), 6) AS network_latency_ms, round(coalesce(nullif(v, 0), 20.0), 6) AS "
        "zero_replaced FROM (SELECT event_id, CASE WHEN k % 7 = 0 THEN NULL WHEN k % 7 = 1 THEN 0e0 ELSE value END AS v "
        "FROM fx_base)", "fx_base")),
    "feature_selection": (_features, sql(
        "SELECT event_id, " + r(*[c for c in SYSTEM_NUMERIC if c != "machine_failure"]) + " FROM fx_system",
        "fx_system")),
    "schema_conform": (_conform, sql(
        "SELECT event_id, " + r("torque_Nm", "0.0::DOUBLE AS not_there", "coalesce(air_temperature_K, 0.0) AS "
                                "air_temperature_K", "tool_wear_min") + " FROM fx_system", "fx_system")),
    "numeric_projection": (_numeric, sql(
        "SELECT event_id, machine_failure, " + r(*[c for c in SYSTEM_NUMERIC if c != "machine_failure"])
        + " FROM fx_system", "fx_system")),
    "label_samples": (_sample, sql(
        "SELECT event_id, machine_failure, 'slice' AS part FROM fx_system WHERE machine_id = 'M1' UNION ALL "
        "SELECT event_id, machine_failure, 'drawn' AS part FROM fx_system QUALIFY row_number() OVER (PARTITION BY "
        f"machine_failure ORDER BY {draw('event_id', 42)}, event_id) <= 20 UNION ALL SELECT event_id, NULL, 'any' FROM "
        f"(SELECT event_id FROM fx_system ORDER BY {draw('event_id', 7)}, event_id LIMIT 30)", "fx_system")),
}
