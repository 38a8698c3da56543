"""Headline timings. Prints one JSON line.

``BENCH_SF_DIR`` names the test data, ``BENCH_CPUS`` the number of local cores. The telemetry tables are derived and
written once, untimed, because the timed operators read telemetry tables. Every query runs once to warm up; the
figure is the median of three further runs, each executing the whole result.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession, functions as F

from telemetry_ops.operators import alerts, diagnose, drift, evaluate, features, quality, scan, serving
from telemetry_ops.plans import diagnosis
from telemetry_ops.plans.common import SYSTEM_NAMES
from telemetry_ops.config import DRIFT_COLUMNS
from telemetry_ops.sources import telemetry as t


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"{work}/shared")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    def table(name, df):
        df.repartition(int(cpus)).write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    system, app = table("system", t.system(spark, folder)), table("app", t.application(spark, folder))
    scores, alert_rows = table("scores", t.scores(spark, folder)), table("alerts", t.alerts(spark, folder))
    scored = table("scored", diagnosis._input(spark, folder))
    chunks = table("chunks", scan.chunk_ids(system, "timestamp", "event_id", 5000))
    now = alert_rows.agg(F.max("created_at")).first()[0]
    rows = system.count()

    def report():
        flagged = quality.quality_flag(chunks, "chunk_id", columns=SYSTEM_NAMES)
        return quality.quality_report(flagged, "chunk_id", SYSTEM_NAMES)

    runs = {
        "feature_matrix": lambda: features.feature_matrix(system, app),
        "feature_matrix_blocks": lambda: features.feature_matrix(system, app, blocks=True),
        "latest_features": lambda: serving.latest_features(system.join(app, ["timestamp", "machine_id"], "left")),
        "chunk_ids": lambda: scan.chunk_ids(system, "timestamp", "event_id", 5000),
        "quality_report": report,
        "drift_psi": lambda: drift.psi(chunks, "chunk_id", drift.baseline(chunks.where("chunk_id = 0"), DRIFT_COLUMNS),
                                       DRIFT_COLUMNS, baseline_chunk=0),
        "pr_curve": lambda: evaluate.pr_curve(scores, "score", "y"),
        "evaluation_summary": lambda: evaluate.evaluation_summary(scores, "score", "y"),
        "fatigue_summary": lambda: alerts.fatigue_summary(alert_rows, now),
        "daily_fatigue": lambda: alerts.daily_fatigue(alert_rows),
        "diagnose_table": lambda: diagnose.diagnose_table(scored),
    }
    seconds = {}
    for name, run in runs.items():
        times = []
        for _ in range(4):
            start = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")), "cpus": int(cpus), "telemetry_rows": rows,
        "feature_rows_per_sec": round(rows / seconds["feature_matrix"])}))
    spark.stop()


if __name__ == "__main__":
    main()
