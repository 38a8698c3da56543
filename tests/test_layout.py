"""How queries lay out their work: no window over a whole machine, no table worked through again, no few large splits."""

import dataclasses

import duckdb
import numpy as np
from pyspark.sql import Window, functions as F

from telemetry_ops.config import FeatureConfig
from telemetry_ops.operators import scoring, serving
from telemetry_ops.plans import diagnosis, feature
from telemetry_ops.plans.common import rounded
from telemetry_ops.sources import telemetry


def _windows(df):
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return [line for line in lines if "Window [" in line]


def test_windows_run_in_blocks(spark, tiny):
    for query in ("rolling_mean", "rolling_std", "lag_features", "cross_domain"):
        windows = _windows(feature.QUERIES[query][0](spark, tiny))
        # over rows by block; by machine only over one row per block
        assert windows and not any("[timestamp#" in line for line in windows), query


def test_stress_limits_read_what_was_prepared_once(spark, tiny):
    assert not any("events.parquet" in path for path in feature.QUERIES["stress_scopes"][0](spark, tiny).inputFiles())


def test_rows_are_spread_before_they_are_diagnosed(spark, tiny):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert diagnosis._input(spark, tiny).rdd.getNumPartitions() == tasks > 1


def test_rounding_is_that_of_the_other_engine(spark):
    values = [s * (i * 1e-6 + h) for i in (0, 1, 7, 123, 99_999, 10**9, 10**16) for h in (0.0, 5e-7, 4.9e-7, 5.1e-7) for s in (1, -1)]
    values += [float(i) * 5e-7 for i in range(1, 4000, 2)] + [1e300, -1e300, float("inf")]
    got = [r["x"] for r in rounded(spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)).collect()]
    want = [r[0] for r in duckdb.execute("SELECT round(unnest(?::DOUBLE[]), 6)", [values]).fetchall()]
    assert got == want
    assert rounded(spark.createDataFrame([(None,)], "x double")).first()["x"] is None


def test_request_history_needs_no_window_over_a_machine(spark, tiny):
    valid = telemetry.system(spark, tiny).join(telemetry.application(spark, tiny).drop("machine_id", "timestamp").limit(1))
    made = scoring.request_features(valid)
    assert not _windows(made) or not any("[timestamp#" in line for line in _windows(made))
    blocks = scoring.request_features(valid, dataclasses.replace(FeatureConfig(), max_group_rows=10, block_rows=50))
    order = Window.partitionBy("machine_id").orderBy("timestamp", "event_id")
    plain = serving.with_stand_ins(serving.with_history_columns(valid.withColumn(
        "n_history", F.row_number().over(order)), FeatureConfig()), FeatureConfig()).toPandas().set_index("event_id").sort_index()
    for df in (made, blocks):
        got = df.toPandas().set_index("event_id").sort_index()
        assert set(got.columns) == set(plain.columns) and got["n_history"].tolist() == plain["n_history"].tolist()
        for c in plain.columns:
            if plain[c].dtype.kind == "f":
                assert np.allclose(got[c].astype(float), plain[c].astype(float), equal_nan=True, atol=1e-6), c
