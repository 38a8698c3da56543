"""Edge cases of alerts, evaluation, diagnosis and validation."""

import datetime

import pytest
from pyspark.sql import functions as F

from telemetry_ops.operators import alerts as a, diagnose as dg, evaluate as e, explain as ex, validate as va

NOW = datetime.datetime(2024, 1, 8)
ALERT = "id long, machine_id string, created_at timestamp, failure_prob double, risk_level string, root_cause string, " \
        "acknowledged boolean, false_positive boolean"


def _alert(i, fp=None, days=1, **more):
    row = {"id": i, "machine_id": "M1", "created_at": NOW - datetime.timedelta(days=days), "failure_prob": 0.5,
           "risk_level": "high", "root_cause": None, "acknowledged": False, "false_positive": fp, **more}
    return tuple(row.values())


def test_empty_period(spark):
    row = a.fatigue_summary(spark.createDataFrame([_alert(1, days=30)], ALERT), NOW).first()
    assert row["total_alerts"] == 0 and row["by_risk_level"] == {} and row["false_positive_rate"] is None


def test_no_false_positives_is_a_rate_of_zero(spark):
    row = a.fatigue_summary(spark.createDataFrame([_alert(1, False), _alert(2)], ALERT), NOW).first()
    assert row["false_positive_rate"] == 0.0 and row["by_risk_level"] == {"high": 2}
    unlabelled = a.fatigue_summary(spark.createDataFrame([_alert(1)], ALERT), NOW).first()
    assert unlabelled["false_positive_rate"] is None


def test_acknowledgements_keep_earlier_details(spark):
    rows = spark.createDataFrame([_alert(1), _alert(2, True)], ALERT)
    at = lambda h: NOW + datetime.timedelta(hours=h)
    acks = spark.createDataFrame([(1, at(1), "ann", "fixed", True), (1, at(2), "bob", "", None)],
                                 "alert_id long, acknowledged_at timestamp, acknowledged_by string, "
                                 "action_taken string, is_false_positive boolean")
    got = {r["id"]: r for r in a.apply_acks(rows, acks).collect()}
    assert (got[1]["acknowledged_by"], got[1]["action_taken"], got[1]["false_positive"]) == ("bob", "fixed", True)
    assert not got[2]["acknowledged"] and got[2]["false_positive"] is True


def test_paging_limits(spark):
    df = spark.createDataFrame([_alert(i) for i in range(5)], ALERT)
    assert [r["id"] for r in a.list_alerts(df, limit=2, offset=1).collect()] == [3, 2]
    for bad in ({"limit": 0}, {"limit": 1001}, {"offset": -1}):
        with pytest.raises(ValueError):
            a.list_alerts(df, **bad)


def test_one_tied_score(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 0)], "s double, y int")
    points = e.pr_curve(df, "s", "y").collect()
    assert len(points) == 1 and points[0]["tp"] == 1 and points[0]["fp"] == 2
    assert e.average_precision(e.pr_curve(df, "s", "y")).first()[0] == pytest.approx(1 / 3)


def test_average_precision_by_hand(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "s double, y int")
    assert e.average_precision(e.pr_curve(df, "s", "y")).first()[0] == pytest.approx(0.8333333, abs=1e-6)


def test_single_class(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "s double, y int")
    assert e.confusion(df, "s", "y", 0.15).first()["recall_pct"] is None
    assert all(r["recall"] is None for r in e.pr_curve(df, "s", "y").collect())


def test_risk_limits(spark):
    ps = [0.1999, 0.2, 0.4, 0.7, 0.9, None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "i int, p double")
    got = [r[0] for r in df.orderBy("i").select(dg.risk_level("p")).collect()]
    assert got == ["nominal", "low", "moderate", "high", "critical", None]


def _scored(spark, contributions, **readings):
    columns = {"torque_Nm": 10.0, "tool_wear_min": 10.0, "air_temperature_K": 280.0, "network_latency_ms": 1.0,
               "vibration_mm_s": 1.0, "disk_io_wait_ms": 1.0, "error_rate_pct": 0.0, "cpu_utilization_pct": 1.0,
               "packet_loss_pct": 0.0, "failure_probability": 0.95, **readings}
    df = spark.createDataFrame([("M1", NOW, *columns.values())], "machine_id string, timestamp timestamp, "
                               + ", ".join(f"{c} double" for c in columns))
    return dg.diagnose_table(df.withColumn("contributions", ex.contribution_array(
        df, {k: F.lit(float(v)) for k, v in contributions.items()}))).first()


def test_first_mechanic_wins_ties(spark):
    row = _scored(spark, {"torque_Nm": 1}, torque_Nm=30.0, tool_wear_min=100.0, error_rate_pct=5.0, cpu_utilization_pct=80.0)
    assert row["primary_failure_mode"] == "mechanical_wear" and row["confidence"] == "low"
    assert row["immediate_actions"][0].startswith("⚠️ CRITICAL")
    assert "Check spindle alignment and lubrication" in row["immediate_actions"]


def test_vibration_needs_a_named_contributor(spark):
    assert _scored(spark, {"queue_depth": 1}, vibration_mm_s=30.0)["primary_failure_mode"] == "software_stress"
    row = _scored(spark, {"vibration_mm_s_std_6": 1}, vibration_mm_s=30.0)
    assert row["primary_failure_mode"] == "mechanical_wear" and row["confidence"] == "moderate"


def test_spread_contributions_are_a_complex_pattern(spark):
    row = _scored(spark, {f"f{i}": 1 for i in range(12)})
    assert row["primary_failure_mode"] == "complex_pattern" and row["confidence"] == "low"
    assert len(row["immediate_actions"]) == 3


def test_actions_are_never_empty(spark):
    row = _scored(spark, {"error_rate_pct": 1}, failure_probability=0.1)
    assert row["immediate_actions"] == ["Continue monitoring - no specific action required"]


def test_report_text(spark):
    df = spark.createDataFrame([(1,)], "x int")
    row = _scored(spark, {"air_temperature_K": 1, "packet_loss_pct": -0.5}, air_temperature_K=300.0,
                  network_latency_ms=60.0)
    full = spark.createDataFrame([row])
    text = dg.report_md(full).first()["report_md"]
    assert "critical risk, failure probability 95.0 %" in text and "* ⚠️ CRITICAL" in text
    assert "1. air_temperature_K = 300.000 raises the margin by 1.000" in text
    assert "2. packet_loss_pct" in text and "lowers the margin by 0.500" in text and "thermal +1.000" in text
    assert "Increase cooling airflow (current: 27.0°C)" in text and df.count() == 1


def test_requests_that_are_not_json_are_rejected(spark):
    good = '{"system": {"machine_id": "M1", "air_temperature_K": 300, "process_temperature_K": 310, ' \
           '"rotational_speed_rpm": 1500, "torque_Nm": 40, "tool_wear_min": 5}, "application": {}}'
    hot = good.replace('"air_temperature_K": 300', '"air_temperature_K": 500')
    df = spark.createDataFrame([(1, good), (2, hot), (3, "{oops"), (4, None)], "id int, request string")
    valid, rejects = va.validate_rows(va.parse_requests(df))
    assert [r["id"] for r in valid.collect()] == [1]
    reasons = {r["id"]: r["violations"] for r in rejects.collect()}
    assert reasons[2] == ["air_temperature_K: above 400"] and len(reasons[3]) == 6 and len(reasons[4]) == 6
    filled = va.apply_defaults(valid, va.request_defaults()).first()
    assert filled["vibration_mm_s"] == 15.0 and filled["queue_depth"] == 10.0
