"""What keeps the large runs of scoring, cross-validation and streaming within time, disk and memory."""

import json

import numpy as np
import pytest

from pyspark.sql import functions as F

from telemetry_ops.operators import align as al, explain, smote, validate
from telemetry_ops.sources import telemetry as t
from telemetry_ops.streaming import pipelines as s, stateful


def test_a_request_is_read_once_for_all_its_checks(spark):
    """Copied into every check, the list of wrong types took ten times as long as all the rest."""
    system = {"machine_id": "M1", "air_temperature_K": 300, "process_temperature_K": 310, "rotational_speed_rpm": 1500,
              "torque_Nm": "x", "tool_wear_min": "12.5"}
    df = spark.createDataFrame([(1, json.dumps({"system": system, "application": {}})), (2, "no JSON"), (3, None)],
                               "event_id long, request string")
    parsed = validate.parse_requests(df)
    valid, rejects = validate.validate_rows(parsed)
    fields = len(parsed.columns)
    for part in (valid, rejects):
        assert part._jdf.queryExecution().optimizedPlan().toString().count("try_cast(") <= 2 * fields
    got = {r["event_id"]: r for r in rejects.collect()}
    assert set(got) == {1, 2, 3} and valid.count() == 0
    assert got[1]["wrong_types"] == ["torque_Nm"] and got[1]["tool_wear_min"] == 12.5
    assert "torque_Nm: wrong type" in got[1]["violations"] and "torque_Nm: missing" in got[2]["violations"]


def test_known_features_change_no_group_sum(spark):
    names = ["torque_Nm_mean_6", "vibration_mm_s", "torque_Nm_x_queue_depth", "nothing", None, "packet_loss_pct_lag_1", "", "torque_Nm"]
    rows = [(i, [(n, float(k), (i + 1) * 0.1 * (k - 3)) for k, n in enumerate(names)]) for i in range(3)] + [(9, []), (10, None)]
    df = spark.createDataFrame(rows, f"id long, contributions {explain.CONTRIBUTIONS}")
    plain = df.select("id", explain.group_impacts().alias("g")).collect()
    assert plain[0]["g"]["software"] != 0 and plain[0]["g"]["thermal"] == 0
    for known in (["torque_Nm_mean_6", "nothing"], ["torque_Nm"], [n for n in names if n]):
        quick = df.select("id", explain.group_impacts(known=known).alias("g"))
        assert quick.collect() == plain


@pytest.mark.parametrize("hot", [False, True])
def test_a_delivery_too_large_to_sort_is_never_held(spark, tiny, monkeypatch, hot):
    """Tables come one at a time, out of order; spans of time go on, with missing times last."""
    monkeypatch.setattr(s, "SORT_ROWS", 40)
    plan = s.History(al.align(t.system(spark, tiny), t.application(spark, tiny)), s.FeatureConfig(stress_scope="fixed"))
    rows = plan.base.where("machine_id = 'M1'").toPandas()
    if hot:
        rows.loc[rows.index[:90], "timestamp"] = rows["timestamp"].iloc[60]
    rows.loc[rows.index[5], "timestamp"] = None
    mixed, sizes, concat = rows.sample(frac=1, random_state=3), [], s.pa.concat_tables
    monkeypatch.setattr(s.pa, "concat_tables", lambda parts, **_: pytest.fail("all tables were held"))
    monkeypatch.setattr(plan, "_frames", lambda table, n, f=plan._frames: (sizes.append(table.num_rows), f(table, n))[1])
    frames = list(plan.slices((plan.packed(mixed.iloc[i:i + 25]) for i in range(0, len(mixed), 25)), 15))
    monkeypatch.setattr(s.pa, "concat_tables", concat)
    assert max(map(len, frames)) <= 15 and max(sizes) <= (130 if hot else 40) and len(sizes) > 2
    ids = np.concatenate([x["event_id"] for x in frames])
    assert ids.tolist() == rows.sort_values(["timestamp", "event_id"])["event_id"].tolist()


def test_waiting_blocks_are_asked_for_one_by_one():
    """An iterator over the state is sent thousands of entries, and so all rows of a machine, at once."""
    held, timers, values = {}, [], {}

    class Blocks:
        updateValue = staticmethod(held.__setitem__)
        removeKey = staticmethod(held.pop)
        getValue = staticmethod(held.__getitem__)
        keys = staticmethod(lambda: iter(list(held)))
        iterator = staticmethod(lambda: pytest.fail("all blocks were asked for"))

    class Handle:
        getMapState = staticmethod(lambda *_: Blocks)
        registerTimer = staticmethod(timers.append)

        @staticmethod
        def getValueState(name, _):
            class Value:
                exists = staticmethod(lambda: name in values)
                get = staticmethod(lambda: values[name])
                update = staticmethod(lambda x: values.__setitem__(name, x))
                clear = staticmethod(lambda: values.pop(name))
            return Value

    waiting = stateful._Waiting(Handle, "at")
    for i in range(5):
        waiting.add(s.pa.table({"at": s.pa.array([1_000_000 * (i * 10 + j) for j in range(10)], s.pa.timestamp("us"))}))
    assert sum(x.num_rows for x in waiting.take_in_turn(1, 25_000_000)) == 25 and timers == [1, 30_001, 25_001]
    assert list(waiting.take_in_turn(30_001, 99_000_000)) == []
    assert sum(x.num_rows for x in waiting.take_in_turn(25_001, 99_000_000)) == 25 and not held


def test_many_groups_meet_in_rounds(spark, monkeypatch):
    """A round sends a row to few groups, and what was found before counts on; copies are among the rows."""
    df = spark.range(240).select(F.col("id"), F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.pmod(
        F.xxhash64(F.col("id") % 230, i), F.lit(997)).cast("double")).alias("vec"))
    order = ("id", "rank")
    whole = smote.knn(df, "id", "vec", 3, block_rows=1000).orderBy(*order).collect()
    monkeypatch.setattr(smote, "_GROUP_BYTES", 8 * 4 * 20)
    monkeypatch.setattr(smote, "_GROUPS", 4)
    sent, write = [], smote.written
    monkeypatch.setattr(smote, "written", lambda out, name="table", keep=False: (sent.append(name), write(out, name, keep))[1])
    assert smote.knn(df, "id", "vec", 3, block_rows=10).orderBy(*order).collect() == whole and len(whole) == 720
    assert sent.count("near") >= 3
