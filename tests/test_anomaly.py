import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_ops.operators import anomaly as an
from telemetry_ops.plans.common import SENSORS
from telemetry_ops.sources import telemetry as t


def test_reconstruction_error_matches_numpy(spark, tiny):
    healthy = F.col("machine_failure") == 0
    scaled = an.standardise(t.system(spark, tiny), SENSORS, healthy)
    got = an.reconstruction_error(scaled, SENSORS, healthy, k=2).select(
        "event_id", "machine_failure", *SENSORS, "reconstruction_error").toPandas()
    x = got[SENSORS].fillna(0.0).to_numpy()
    ok = x[got["machine_failure"] == 0]
    _, vectors = np.linalg.eigh(np.cov(ok.T))
    main = vectors[:, -2:]
    want = ((x - x @ main @ main.T) ** 2).mean(axis=1)
    assert np.allclose(got["reconstruction_error"], want, atol=1e-8)


def test_constant_column_is_not_divided_by_zero(spark):
    df = spark.createDataFrame([(0, 5.0), (0, 5.0), (1, 7.0)], "y int, x double")
    assert sorted(r["x"] for r in an.standardise(df, ["x"], F.col("y") == 0).collect()) == [0.0, 0.0, 2.0]


def test_ramp_at_the_start_of_a_series(spark):
    rows = [(i, "A", i, 1 if i in (4, 30) else 0) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, machine_id string, timestamp int, y int")
    got = {r["event_id"]: r["ramp"] for r in an.failure_ramp(
        df, "machine_id", "timestamp", "event_id", "y", block_rows=20).collect()}
    want = [0.0] * 40
    for f in (4, 30):
        start = max(0, f - 18)
        for w in range(start, f):
            want[w] = max(want[w], (w - start) / (f - start))
        want[f] = 1.0
    assert [got[i] for i in range(40)] == pytest.approx(want)


def test_scores_are_clipped(spark):
    df = spark.createDataFrame([(2.0, None), (0.2, 300.0)], "ramp double, tool_wear_min double")
    rows = sorted((r["anomaly_score"], r["is_anomaly"]) for r in an.composite_score(df).collect())
    assert rows == [(pytest.approx(0.42), 0), (1.0, 1)]
