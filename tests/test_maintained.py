"""Maintained tables and stateful streams against recomputation from scratch."""

import dataclasses
import datetime
import glob
import os
import random

import numpy as np
from pyspark.sql import Window, functions as F

from telemetry_ops.config import FeatureConfig
from telemetry_ops.operators import alerts as al, drift, merged, quality as q, serving
from telemetry_ops.plans import feature as feature_plans
from telemetry_ops.plans.common import SYSTEM_NAMES
from telemetry_ops.sources import telemetry as t
from telemetry_ops.streaming import pipelines as s, stateful


def _rows(df):
    return sorted((tuple(sorted(x.items()) if isinstance(x, dict) else x for x in r) for r in df.collect()), key=repr)


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_daily_rollup_equals_a_recomputation_after_any_changes(spark, tmp_path):
    path, rng = str(tmp_path / "daily"), random.Random(2)
    alerts = spark.createDataFrame(
        [(i, None if i % 17 == 0 else f"2024-01-{1 + i % 5:02d} 10:00:00", rng.choice(["M1", "M2", None]), rng.choice(["high", "low", None]),
          rng.choice(["thermal", None, "wear"]), False, None) for i in range(120)],
        "id long, created_at string, machine_id string, risk_level string, root_cause string, acknowledged boolean, "
        "false_positive boolean").withColumn("created_at", F.col("created_at").cast("timestamp"))

    def acks(*events):
        return spark.createDataFrame([(i, at, "u", None, label) for i, at, label in events],
                                     "alert_id long, acknowledged_at string, acknowledged_by string, action_taken string, "
                                     "is_false_positive boolean")

    first, rest = alerts.where("id < 60"), alerts.where("id >= 60")
    none = acks((1, "2024-02-01", None)).limit(0)
    one = acks((3, "2024-02-01", True), (4, "2024-02-01", False), (5, "2024-02-01", None))
    two = acks((3, "2024-02-02", False), (70, "2024-02-02", True), (17, "2024-02-02", True))
    steps = [(lambda b: merged.add_alerts(path, first, b), first, none),
             (lambda b: merged.add_acknowledgements(path, first, none, one, b), first, one),
             (lambda b: merged.add_alerts(path, rest, b), alerts, one),
             (lambda b: merged.add_acknowledgements(path, alerts, one, two, b), alerts, one.union(two))]
    for batch, (step, seen, acked) in enumerate(steps):
        for _ in range(2):  # the second time is a replay
            step(batch)
            assert _rows(merged.daily(spark, path, alerts)) == _rows(al.daily_fatigue(al.apply_acks(seen, acked)))
    before = _files(path)
    merged.add_alerts(path, alerts.where("id = 1"), 9)
    after = _files(path)
    changed = {f for f in after if before.get(f) != after[f]}
    assert changed and all("date=2024-01-02" in f for f in changed) and len(after) == len(before) == 6


def test_drift_follows_the_stream_and_replays_change_nothing(spark, tiny, tmp_path):
    system = t.system(spark, tiny)
    base = drift.baseline(system.where("event_id % 2 = 0"), ["torque_Nm", "vibration_mm_s"])
    base.write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    counts, emitted, incoming = (str(tmp_path / n) for n in ("counts", "emitted", "incoming"))
    sink = s.drift_sink(base, counts, emitted)
    for part in range(3):  # days come in any order
        system.where(f"event_id % 3 = {part}").coalesce(1).write.mode("append").parquet(incoming)
        s.run_into(s.stream_source(spark, incoming, system.schema), sink, str(tmp_path / "progress"))
    want = _rows(s.drift_from_counts(s.bin_counts(system, base, "1 day"), base))
    got = s.latest_drift(spark.read.parquet(emitted)).select("window_start", "column", "psi")
    assert _rows(got) == want and len(want) > 4
    sink(system.where("event_id % 3 = 2"), 2)
    assert _rows(s.latest_drift(spark.read.parquet(emitted)).select("window_start", "column", "psi")) == want
    held = spark.read.parquet(counts)
    assert held.agg(F.sum("n")).first()[0] == held.select("column").distinct().count() * system.count()
    sink(system.limit(1), 3)  # only the window of this row is emitted
    assert spark.read.parquet(emitted).where("batch = 3").select("window_start").distinct().count() == 1


def test_streamed_gate_equals_the_batch_report(spark, tiny, tmp_path):
    system = t.system(spark, tiny).withColumn("network_latency_ms", F.when(F.col("event_id") % 7 == 0, F.col(
        "network_latency_ms") * 9).when(F.col("event_id") % 11 != 0, F.col("network_latency_ms")))
    incoming, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    days = [r[0] for r in system.select(F.to_date("timestamp").alias("d")).distinct().orderBy("d").collect()]
    for lo, hi in ((0, 3), (3, 6), (6, len(days))):  # three runs, resumed from the checkpoint
        system.where(F.to_date("timestamp").isin(days[lo:hi])).coalesce(1).write.mode("append").parquet(incoming)
        with stateful.rocksdb(spark):
            s.run_available(stateful.stream_gate(s.stream_source(spark, incoming, system.schema), SYSTEM_NAMES, "1 day"),
                            out, progress)
    got = spark.read.parquet(out).drop("batch")
    chunked = system.withColumn("window_start", F.date_trunc("day", "timestamp"))
    numbered = chunked.withColumn("chunk", F.dense_rank().over(Window.orderBy("window_start")) - 1)
    flagged = q.flag_spikes(numbered, "chunk")
    report = q.quality_report(flagged, "chunk", SYSTEM_NAMES).join(
        numbered.select("chunk", "window_start").distinct(), "chunk").drop("chunk")
    end = system.agg(F.max("timestamp") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    want = report.where(F.col("window_start") + F.expr("INTERVAL 1 DAY") <= F.lit(end)).select(got.columns)
    rounded = lambda df: _rows(df.withColumn("quality_score", F.round("quality_score", 9)))
    assert rounded(got) == rounded(want) and got.agg(F.sum("latency_spikes")).first()[0] > 0


def test_streamed_history_waits_for_the_watermark_and_counts_late_rows(spark, tiny, tmp_path):
    cfg = dataclasses.replace(FeatureConfig(), fill_columns=(), stress_scope="fixed")
    whole = feature_plans._many_machines(spark, tiny).where("event_id % 4 = 0").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))
    path = str(tmp_path / "table")
    whole.write.parquet(path)
    whole = spark.read.parquet(path)
    half, end = whole.agg(F.percentile_approx("timestamp", 0.5), F.max("timestamp")).first()
    late = whole.where((F.col("timestamp") < half - datetime.timedelta(days=1)) & (F.col("event_id") % 10 == 0))
    late_ids = [r[0] for r in late.select("event_id").collect()]
    parts = [whole.where((F.col("timestamp") <= half) & ~F.col("event_id").isin(late_ids)),
             whole.where(F.col("timestamp") > half).unionByName(late)]
    incoming, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    dropped = 0
    for part in parts:
        part.orderBy(F.xxhash64("event_id")).coalesce(1).write.mode("append").parquet(incoming)
        with stateful.rocksdb(spark):
            query = s.run_available(stateful.stream_history(s.stream_source(spark, incoming, whole.schema), cfg, slice_rows=7),
                                    out, progress)
        dropped += s.late_rows(query)
    assert dropped == len(late_ids) > 0
    w = Window.partitionBy("machine_id").orderBy("timestamp", "event_id")
    on_time = whole.where(~F.col("event_id").isin(late_ids)).withColumn("n_history", F.row_number().over(w))
    want = serving._finish(serving.with_history_columns(on_time, cfg), cfg, True).where(
        F.col("timestamp") <= F.lit(end - datetime.timedelta(minutes=10)))
    got = spark.read.parquet(out).drop("batch").toPandas().sort_values("event_id").reset_index(drop=True)
    want = want.toPandas().sort_values("event_id").reset_index(drop=True)
    assert got["event_id"].tolist() == want["event_id"].tolist() and (got["n_history"] < 6).any()
    for c in got.columns:
        if got[c].dtype.kind == "f":
            assert np.allclose(got[c].astype(float), want[c].astype(float), equal_nan=True), c
