import datetime
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from telemetry_ops import scratch
from telemetry_ops.config import SYSTEM_SCHEMA, TrainConfig
from telemetry_ops.operators import diagnose as dg, train
from telemetry_ops.plans import diagnosis
from telemetry_ops.sources import artifacts, readers, sinks, telemetry as t, text


def test_csv_values(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("timestamp,machine_id,product_type,air_temperature_K\n"
                    "2024-01-01 00:05:00,M1,L,301.5\n2024-01-01T00:10:00,M1,L,NaN\nnot a time,M2,,\n")
    schema = type(SYSTEM_SCHEMA)(SYSTEM_SCHEMA.fields[:4])
    rows = readers.read_telemetry(spark, str(path), schema).collect()
    assert rows[0]["timestamp"] == datetime.datetime(2024, 1, 1, 0, 5) and rows[0]["air_temperature_K"] == 301.5
    assert rows[1]["timestamp"] == datetime.datetime(2024, 1, 1, 0, 10) and rows[1]["air_temperature_K"] is None
    assert rows[2]["timestamp"] is None and rows[2]["air_temperature_K"] is None


def test_bad_sources_are_errors(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_csv(spark, str(tmp_path / "absent.csv"), SYSTEM_SCHEMA)
    with pytest.raises(ValueError):
        readers.read_telemetry(spark, "x.json", SYSTEM_SCHEMA)
    with pytest.raises(ValueError):
        readers.read_telemetry(spark, "x.csv")


def test_conversion_report(spark, tiny, tmp_path):
    df = t.system(spark, tiny).drop("event_id")
    source, target = str(tmp_path / "in.csv"), str(tmp_path / "out.parquet")
    df.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).write.option("header", True).csv(source)
    schema = type(SYSTEM_SCHEMA)([f for f in SYSTEM_SCHEMA.fields if f.name in df.columns])
    report = sinks.convert_to_parquet(spark, source, target, schema)
    assert report["rows"] == 1000 and report["csv_bytes"] > 0 and report["parquet_bytes"] > 0
    assert "date" in spark.read.parquet(target).columns


def test_diagnosis_files(spark, tiny, tmp_path):
    diagnosed = dg.diagnose_table(diagnosis._input(spark, tiny))
    sinks.write_diagnostics(diagnosed, str(tmp_path))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "summaries")).collect()]
    assert len(lines) == 1000 and {"timestamp", "machine_id", "action", "top_features"} <= set(lines[0])
    reports = spark.read.json(str(tmp_path / "reports"))
    assert reports.count() == diagnosed.where("risk_level <> 'nominal'").count()
    assert sum(r["n_rows"] for r in spark.read.json(str(tmp_path / "risk_counts")).collect()) == 1000


def test_alert_ids_come_from_content(spark, tiny):
    reported = dg.report_md(dg.diagnose_table(diagnosis._input(spark, tiny)))
    ids = [sorted(r["id"] for r in sinks.alert_records(reported, F.col("timestamp")).select("id").collect())
           for _ in range(2)]
    assert ids[0] == ids[1]


def test_log_files(spark, tmp_path):
    (tmp_path / "access.log").write_text('10.0.0.1 - - [01/Jan/2024] "GET / HTTP/1.1" 200\nsecond\n')
    (tmp_path / "app.log").write_text("one two three\n" + "x" * 300 + "\n" + "l\n" * 8)
    (tmp_path / "app copy.log").write_text("ignored\n")
    rows = {r["file"]: r for r in text.profile_text(spark, str(tmp_path / "*.log")).collect()}
    assert set(rows) == {"access.log", "app.log"}
    assert rows["access.log"]["is_access_log"] and not rows["app.log"]["is_access_log"]
    assert rows["app.log"]["n_lines"] == 10 and rows["app.log"]["n_fields"] == 3
    assert len(rows["app.log"]["sample"]) == 5 and rows["app.log"]["sample"][1] == "x" * 200


def test_artifacts_round_trip(spark, tiny, tmp_path):
    df = train.with_vector(t.system(spark, tiny), ["torque_Nm", "tool_wear_min"])
    model = train.fit_boosted(df, "machine_failure", TrainConfig(max_trees=2, max_depth=2))
    artifacts.save_artifacts(spark, {"model": model, "names": ["torque_Nm", "tool_wear_min"], "metrics": {"f1": 0.5},
                                     "importance": spark.createDataFrame([("a", 1.0)], "feature string, x double")},
                             str(tmp_path))
    assert artifacts.load_list(spark, str(tmp_path), "names") == ["torque_Nm", "tool_wear_min"]
    assert artifacts.load_table(spark, str(tmp_path), "metrics").first()["f1"] == 0.5
    assert artifacts.load_table(spark, str(tmp_path), "importance").count() == 1
    assert artifacts.load_model(GBTClassificationModel, str(tmp_path)).getNumTrees == 2


def _session(master, folder):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder or default),
                           sparkContext=SimpleNamespace(master=master))


def test_shared_folder_setting():
    assert scratch.shared_folder(_session("yarn", "hdfs://shared/")) == "hdfs://shared"
    with pytest.raises(RuntimeError):
        scratch.shared_folder(_session("yarn", None))
    assert scratch.shared_folder(_session("local[2]", None)) == scratch.shared_folder(_session("local[2]", None))


def test_written_tables_can_be_dropped(spark):
    table = scratch.written(spark.range(3))
    assert table.count() == 3
    folder = table.inputFiles()[0].rsplit("/", 2)[0].removeprefix("file:").replace("///", "/")
    assert os.path.isdir(folder)
    scratch.drop_written(spark)
    assert not os.path.isdir(folder)
