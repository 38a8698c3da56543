"""NULL keys, other parameters and awkward values that the test tables do not hold."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telemetry_ops.config import FeatureConfig
from telemetry_ops.operators import alerts, anomaly, drift, evaluate, quality, scan, serving, validate

_START = datetime(2024, 1, 1)


def _series(spark, machines, n):
    return spark.createDataFrame(
        [(i, _START + timedelta(minutes=i), machines[i % len(machines)], float(i % 7), int(i % 40 == 39))
         for i in range(n)], "event_id long, timestamp timestamp, machine_id string, torque_Nm double, y int")


def test_percentiles_keep_the_null_group_at_every_size(spark):
    df = _series(spark, ["a", None, "b"], 90)
    few, many = (sorted(map(repr, scan.exact_percentiles(df, "machine_id", "torque_Nm", {"m": 0.75}, max_distinct=m)
                            .collect())) for m in (10**6, 2))
    assert few == many and len(few) == 3


def test_moving_average_is_exact_for_any_alpha(spark):
    medians = [float((i * 37) % 101) for i in range(400)]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(medians)], "chunk_id long, network_latency_ms double")
    for alpha in (0.01, 0.3, 1.0):
        want = medians[0]
        for m in medians[1:]:
            want = alpha * m + (1 - alpha) * want
        got = quality.latency_ema(df, "chunk_id", "network_latency_ms", alpha).where("chunk_id = 399").first()["ema"]
        assert got == pytest.approx(want, abs=1e-9)


def test_ramp_keeps_rows_without_a_machine(spark):
    df = _series(spark, ["a", None], 120)
    got = anomaly.failure_ramp(df, "machine_id", "timestamp", "event_id", "y", back=5, block_rows=50)
    assert got.count() == 120 and got.where("machine_id IS NULL AND ramp > 0").count() > 0


def test_summary_with_a_missing_risk_level(spark):
    df = spark.createDataFrame([(None, True, None, "a"), ("high", False, True, "a")],
                               "risk_level string, acknowledged boolean, false_positive boolean, machine_id string"
                               ).withColumn("created_at", F.lit(_START))
    row = alerts.fatigue_summary(df, F.lit(_START)).first()
    assert row["total_alerts"] == 2 and row["by_risk_level"] == {"unknown": 1, "high": 1}


def test_payload_numbers(spark):
    df = spark.createDataFrame([('{"x": 12.5}',), ('{"x": -3}',), ('{"x": 12345678901}',), ('{"x": "no"}',)],
                               "raw_data string")
    got = [r["n"] for r in alerts.project_payload(df, {"n": ("$.x", "number")}).collect()]
    assert got == [12.5, -3.0, 12345678901.0, None]


def test_serving_history_follows_the_windows(spark):
    cfg = FeatureConfig(windows=(72,))
    df = _series(spark, ["a"], 100)
    assert serving.latest_rows(df, cfg).count() == 72


def test_requests_of_wrong_type(spark):
    fixed = ('"machine_id": "M1", "air_temperature_K": 300, "process_temperature_K": 310, "rotational_speed_rpm": 1500')
    more = ['"torque_Nm": "40.5", "tool_wear_min": 5', '"torque_Nm": 40, "tool_wear_min": NaN',
            '"torque_Nm": 40, "tool_wear_min": 5, "vibration_mm_s": "abc"', '"torque_Nm": 40, "tool_wear_min": {}']
    df = spark.createDataFrame([(i, f'{{"system": {{{fixed}, {m}}}}}') for i, m in enumerate(more)] + [(9, "no JSON")],
                               "i int, request string")
    valid, rejects = validate.validate_rows(validate.parse_requests(df))
    assert [(r["i"], r["torque_Nm"]) for r in valid.collect()] == [(0, 40.5)]
    reasons = {r["i"]: r["violations"] for r in rejects.collect()}
    assert reasons.pop(9)[0] == "machine_id: missing"
    assert reasons == {1: ["tool_wear_min: wrong type"], 2: ["vibration_mm_s: wrong type"],
                       3: ["tool_wear_min: wrong type"]}


def test_drift_keeps_a_column_without_values(spark):
    df = spark.range(20).selectExpr("id % 2 AS chunk", "double(id) AS a", "IF(id % 2 = 0, NULL, double(id)) AS b")
    base = drift.baseline(df.where("chunk = 0"), ["a", "b"])
    scores = drift.drift_status(drift.psi(df, "chunk", base, ["a", "b"], baseline_chunk=0))
    got = {(r["chunk"], r["column"]): (r["psi"], r["status"]) for r in scores.collect()}
    assert got[0, "b"] == got[1, "b"] == (None, None)
    assert got[0, "a"] == (0.0, "OK") and got[1, "a"][0] is not None


def test_cost_optimum_looks_at_every_threshold(spark):
    # of 200 thresholds only the 102nd separates the classes; a sweep of every fourth steps over it
    df = spark.range(200).selectExpr("id / 200e0 AS score", "int(id >= 101) AS y")
    curve = evaluate.pr_curve(df, "score", "y")
    best = evaluate.cost_optimum(evaluate.cost_sweep(curve, points=None)).first()
    assert (best["tp"], best["fp"], best["fn"]) == (99, 0, 0)
    assert evaluate.cost_optimum(evaluate.cost_sweep(curve)).first()["cost"] > 0
