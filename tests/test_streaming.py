import dataclasses
import shutil

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telemetry_ops.config import FeatureConfig
from telemetry_ops.operators import align as al, features as f
from telemetry_ops.operators.scan import positions
from telemetry_ops.sources import telemetry as t
from telemetry_ops.streaming import pipelines as s, stateful

CFG = dataclasses.replace(FeatureConfig(), stress_scope="fixed")


def _write_part(df, lo, hi, path):
    df.where((F.col("_pos") >= lo) & (F.col("_pos") < hi)).drop("_pos").coalesce(1).write.mode("append").parquet(path)


def test_features_survive_a_restart(spark, tiny, tmp_path):
    """Two runs over a growing folder, resumed from the checkpoint, equal the batch features."""
    aligned = al.align(t.system(spark, tiny), t.application(spark, tiny))
    placed = positions(aligned, ["timestamp", "event_id"], "_pos")
    incoming, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for lo, hi in ((0, 300), (300, 550), (550, 1000)):
        _write_part(placed, lo, hi, incoming)
        stream = s.stream_features(s.stream_source(spark, incoming, aligned.schema), CFG)
        s.run_available(stream, out, progress)
    got = spark.read.parquet(out).drop("batch").toPandas().sort_values("event_id").reset_index(drop=True)
    want = f.feature_matrix(t.system(spark, tiny), t.application(spark, tiny), CFG).toPandas() \
        .sort_values("event_id").reset_index(drop=True)
    assert len(got) == 1000
    for c in got.columns:
        if got[c].dtype.kind == "f":
            assert np.allclose(got[c].astype(float), want[c].astype(float), equal_nan=True), c


def test_replayed_batch_is_not_added_twice(spark, tmp_path):
    write = s.idempotent_sink(str(tmp_path))
    write(spark.range(5).toDF("id"), 0)
    write(spark.range(5).toDF("id"), 0)
    write(spark.range(5, 8).toDF("id"), 1)
    assert spark.read.parquet(str(tmp_path)).count() == 8


def test_late_rows_are_left_out_of_closed_windows(spark, tmp_path):
    incoming, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = lambda *x: spark.createDataFrame(x, "id long, created_at string, failure_prob double").withColumn(
        "created_at", F.col("created_at").cast("timestamp"))
    stream = lambda: s.stream_hourly(s.stream_source(
        spark, incoming, rows((1, "2024-01-01 00:00:00", 0.0)).schema))
    for part in (rows((1, "2024-01-01 00:10:00", 0.2), (2, "2024-01-01 03:00:00", 0.4)),
                 rows((3, "2024-01-01 00:20:00", 0.9), (4, "2024-01-01 05:00:00", 0.4))):
        part.coalesce(1).write.mode("append").parquet(incoming)
        s.run_available(stream(), out, progress)
    got = {str(r["hour"]): r["alert_count"] for r in spark.read.parquet(out).collect()}
    assert got["2024-01-01 00:00:00"] == 1 and got["2024-01-01 03:00:00"] == 1


def test_aligned_stream_keeps_rows_without_a_partner(spark, tmp_path):
    stamp = lambda df: df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows = [(i, f"2024-01-01 {i:02d}:00:00", "M1") for i in range(10)]
    system = stamp(spark.createDataFrame(rows, "event_id long, timestamp string, machine_id string"))
    app = stamp(spark.createDataFrame([(t_, m, float(i)) for i, t_, m in rows if i % 2 == 0],
                                      "timestamp string, machine_id string, error_rate_pct double"))
    streams = []
    for name, df in (("system", system), ("app", app)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        streams.append(s.stream_source(spark, str(tmp_path / name), df.schema))
    s.run_available(s.stream_align(*streams), str(tmp_path / "out"), str(tmp_path / "progress"))
    got = {r["event_id"]: r["error_rate_pct"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # all partners are found; rows without one appear once the watermark (08:00 less 10 minutes) has passed them
    assert {i: v for i, v in got.items() if v is not None} == {i: float(i) for i in range(0, 10, 2)}
    assert {i for i, v in got.items() if v is None} == {1, 3, 5, 7}


class _Store:
    """The states and timers a processor asks for, in memory."""

    def __init__(self):
        self.timers, self.reads = [], 0

    def getMapState(self, *_):
        store, held = self, {}

        class Entries:
            updateValue = staticmethod(lambda key, value: held.__setitem__(key, value))
            removeKey = staticmethod(lambda key: held.pop(key))

            @staticmethod
            def iterator():
                store.reads += 1
                return iter(list(held.items()))
        return Entries

    def getValueState(self, *_):
        held = []

        class Value:
            exists = staticmethod(lambda: bool(held))
            get = staticmethod(lambda: held[-1])
            update = staticmethod(lambda value: held.append(value))
            clear = staticmethod(held.clear)
        return Value

    def registerTimer(self, at):
        self.timers.append(at)


def test_waiting_rows_are_read_once_when_the_watermark_moves():
    """Forty deliveries, one timer, one read; rows beyond the watermark go on waiting."""
    store = _Store()
    waiting = stateful._Waiting(store, "at")
    for i in range(40):
        at = pa.array([1_000_000 * (i * 10 + j) for j in range(10)], pa.timestamp("us"))
        waiting.add(pa.table({"at": at, "x": pa.array(range(10))}))
    assert store.timers == [1]
    taken = waiting.take(1, 155_000_000)
    assert sum(t.num_rows for t in taken) == 155 and store.reads == 1 and store.timers == [1, 160_001, 155_001]
    assert waiting.take(160_001, 999_000_000) == [] and store.reads == 1  # replaced by an earlier one
    assert sum(t.num_rows for t in waiting.take(155_001, 999_000_000)) == 245 and store.reads == 2


def test_features_of_a_large_delivery_are_made_in_slices(spark, tiny, monkeypatch):
    """No call works on more than ``SLICE_ROWS`` new rows, however many a machine delivers at once."""
    plan = s.History(al.align(t.system(spark, tiny), t.application(spark, tiny)), CFG)
    rows = plan.base.where("machine_id = 'M1'").toPandas()
    parts = [plan.packed(rows.iloc[100:]), plan.packed(rows.iloc[:100])]
    frames = list(plan.slices(parts, 30))
    assert parts == [] and max(map(len, frames)) == 30 and sum(map(len, frames)) == len(rows)
    ids = np.concatenate([x["event_id"] for x in frames])
    assert ids.tolist() == rows.sort_values(["timestamp", "event_id"])["event_id"].tolist()
