"""Physical plans: no single-task sort of raw rows, no cross joins, pruned and filtered scans, one shuffle for windows."""

import re

import pytest
from pyspark.sql import functions as F

from telemetry_ops.config import FeatureConfig
from telemetry_ops.operators import align as al, alerts, diagnose, drift, evaluate, features as f, quality, scan, serving
from telemetry_ops.plans import diagnosis
from telemetry_ops.plans.common import SYSTEM_NAMES
from telemetry_ops.sources import readers, telemetry as t


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _cases(spark, d):
    system, app = t.system(spark, d), t.application(spark, d)
    chunks = scan.chunk_ids(system, "timestamp", "event_id", 100)
    scores = t.scores(spark, d)
    return {
        "matrix": f.feature_matrix(system, app, blocks=False),
        "matrix_blocks": f.feature_matrix(system, app, blocks=True),
        "chunks": chunks,
        "flags": quality.quality_flag(chunks, "chunk_id", columns=SYSTEM_NAMES),
        "psi": drift.psi(chunks, "chunk_id", drift.baseline(chunks.where("chunk_id = 0"), ["torque_Nm"]), ["torque_Nm"]),
        "curve": evaluate.pr_curve(scores, "score", "y"),
        "thresholds": evaluate.thresholds(evaluate.pr_curve(scores, "score", "y")),
        "diagnosis": diagnose.diagnose_table(diagnosis._input(spark, d)),
        "latest": serving.latest_features(al.align(system, app)),
        "daily": alerts.daily_fatigue(t.alerts(spark, d)),
        "acks": alerts.apply_acks(t.alerts(spark, d), t.acknowledgements(spark, d)),
    }


@pytest.fixture(scope="module")
def plans(spark, tiny):
    return {name: plan(df) for name, df in _cases(spark, tiny).items()}


def test_no_cross_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_single_task_steps_hold_one_row_per_block(plans):
    """A single-partition window may only sort partition or block totals, never rows."""
    for name, text in plans.items():
        for line in re.findall(r"Window \[[^\n]*", text):
            spec = re.search(r"windowspecdefinition\(([^)]*)", line)
            assert spec is None or not re.match(r"(timestamp|event_id|threshold|_pos)#", spec.group(1)), (name, line)


def test_python_only_where_needed(plans):
    for name, text in plans.items():
        python = [w for w in ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas") if w in text]
        assert not python, name
        assert ("FlatMapGroupsInArrow" in text) == name.startswith("matrix"), name


def test_row_local_diagnosis_has_no_shuffle(plans):
    assert "Exchange" not in plans["diagnosis"]


def test_windows_share_one_shuffle(spark, tiny):
    order = ("machine_id", "timestamp", "event_id")
    cfg = FeatureConfig()
    df = f.lags(f.rolling(t.system(spark, tiny), *order, cfg.rolling_columns), *order, cfg.lag_columns)
    text = plan(df)
    assert text.count("Exchange hashpartitioning") == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_latest_rows_are_limited_before_the_shuffle(plans):
    assert "WindowGroupLimit" in plans["latest"] and "Partial" in plans["latest"]


def test_scan_is_pruned_and_filtered(spark, tiny):
    df = readers.read_parquet(spark, f"{tiny}/events.parquet", ["event_id", "value"]).where(F.col("event_id") > 5)
    text = plan(df)
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
    assert "GreaterThan(event_id,5)" in text


def test_listing_is_a_top_k(spark, tiny):
    assert "TakeOrderedAndProject" in plan(alerts.list_alerts(t.alerts(spark, tiny), limit=10))
