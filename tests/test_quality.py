import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_ops.config import QualityConfig
from telemetry_ops.operators import drift, quality as q


def _chunks(spark, medians):
    rows = [(c, m) for c, m in enumerate(medians) for _ in range(2)]
    return spark.createDataFrame(rows, "chunk_id long, network_latency_ms double")


def test_ema_keeps_its_value_over_empty_chunks(spark):
    got = q.latency_ema(_chunks(spark, [None, 10.0, None, 20.0, None]), "chunk_id", "network_latency_ms")
    rows = {r["chunk_id"]: (r["ema"], r["ema_before"]) for r in got.collect()}
    assert rows[0] == (None, None) and rows[1] == (10.0, None) and rows[2] == (10.0, 10.0)
    assert rows[3] == (pytest.approx(13.0), 10.0) and rows[4][0] == pytest.approx(13.0)


def test_ema_over_many_blocks(spark):
    medians = [float((i * 37) % 101) for i in range(9000)]
    df = spark.createDataFrame(list(enumerate(medians)), "chunk_id long, network_latency_ms double")
    got = {r["chunk_id"]: r["ema"] for r in q.latency_ema(df, "chunk_id", "network_latency_ms").collect()}
    ema = None
    for i, m in enumerate(medians):
        ema = m if ema is None else 0.3 * m + 0.7 * ema
        assert abs(got[i] - ema) < 1e-9


def test_first_chunk_never_spikes_and_flags_are_a_union(spark):
    df = spark.createDataFrame(
        [(1, 0, 10.0, 300.0), (2, 0, 10.0, None), (3, 1, 31.0, 400.0), (4, 1, 30.0, 300.0), (5, 1, None, 250.0)],
        "id long, chunk_id long, network_latency_ms double, air_temperature_K double")
    flagged = q.quality_flag(df, "chunk_id", columns=["network_latency_ms", "air_temperature_K"])
    assert {r["id"]: r["_quality_flag"] for r in flagged.collect()} == {1: 0, 2: 1, 3: 6, 4: 0, 5: 1}
    report = {r["chunk_id"]: r for r in q.quality_report(
        flagged, "chunk_id", ["network_latency_ms", "air_temperature_K"], QualityConfig()).collect()}
    assert report[0]["missing_counts"] == {"air_temperature_K": 1} and report[0]["out_of_bounds_counts"] == {}
    assert report[0]["quality_score"] == pytest.approx(1 - 1 / 6) and not report[0]["passed"]
    assert report[1]["latency_spikes"] == 1 and report[1]["out_of_bounds_counts"] == {"air_temperature_K": 1}


def test_report_line(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0)], "chunk_id long, torque_Nm double").withColumn("n_spikes", F.lit(0))
    line = q.report_summary(q.quality_report(df, "chunk_id", ["torque_Nm"])).first()["summary"]
    assert line == "[PASS] Chunk 0: score=1.000 | clean"


def _psi(spark, base, now, bins=10):
    df = spark.createDataFrame([(0, v) for v in base] + [(1, v) for v in now], "chunk_id long, x double")
    table = drift.baseline(df.where("chunk_id = 0"), ["x"], bins)
    return {r["chunk_id"]: r["psi"] for r in drift.psi(df, "chunk_id", table, ["x"], bins).collect()}


def _numpy_psi(base, now, bins=10):
    counts, edges = np.histogram(base, bins=bins)
    share = lambda c: (c + 1e-6) / (c.sum() + 1e-6 * len(c))
    e, a = share(counts), share(np.histogram(now, bins=edges)[0])
    return round(float(np.sum((a - e) * np.log(a / e))), 6)


@pytest.mark.parametrize("base,now", [
    ([float(i) for i in range(100)], [float(i) * 0.7 for i in range(80)]),
    ([float(i) for i in range(11)], [10.0, 10.0, 0.0, -5.0, 99.0]),      # top edge and values outside
    ([3.0] * 20, [3.0, 3.2, 2.4, 3.5]),                                  # constant baseline
    ([0.1 * i for i in range(50)], [500.0, 600.0]),                      # nothing inside the range
])
def test_psi_matches_numpy(spark, base, now):
    got = _psi(spark, base, now)
    assert got[0] == 0.0
    assert got[1] == pytest.approx(_numpy_psi(np.array(base), np.array(now)), abs=1e-6)


def test_status_limits(spark):
    df = spark.createDataFrame([(0.0999,), (0.1,), (0.2,), (0.2001,)], "psi double")
    got = [(r["status"], r["retrain"]) for r in drift.drift_status(df).orderBy("psi").collect()]
    assert got == [("OK", False), ("MONITOR", False), ("DRIFT!", False), ("DRIFT!", True)]
