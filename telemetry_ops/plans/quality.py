"""Quality and drift queries over sensor rows in chunks of consecutive rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_ops.config import DRIFT_COLUMNS, SENSOR_BOUNDS, SIMPLE_GATE_BOUNDS, QualityConfig
from telemetry_ops.operators import drift, quality as q, scan
from telemetry_ops.plans.common import OFF_TIE, SYSTEM_NAMES, r, rounded, sql, sql_time, text_time, with_chunks
from telemetry_ops.sources import telemetry as t

_BOUNDS = {c: b for c, b in SENSOR_BOUNDS.items() if c in SYSTEM_NAMES}
_DRIFT = [c for c in DRIFT_COLUMNS if c in SYSTEM_NAMES]
_CFG = QualityConfig()


def _chunk_ids(spark, d):
    return with_chunks(spark, d).select("event_id", "row_index", "chunk_id")


def _chunk_metadata(spark, d):
    m = scan.chunk_metadata(with_chunks(spark, d), "timestamp")
    return m.select("chunk_id", text_time("first_time").alias("first_time"), text_time("last_time").alias("last_time"),
                    "n_rows")


def _flag_missing(spark, d):
    return q.flag_missing(t.system(spark, d), SYSTEM_NAMES).select("event_id", "missing_flag")


def _flag_bounds(spark, d):
    return q.flag_bounds(t.system(spark, d), SENSOR_BOUNDS).select("event_id", "bounds_flag")


def _ema(spark, d):
    return rounded(q.latency_ema(with_chunks(spark, d), "chunk_id", "network_latency_ms"))


def _flag_spikes(spark, d):
    return q.flag_spikes(with_chunks(spark, d), "chunk_id").select("event_id", "chunk_id", "spike_flag")


def _flagged(spark, d):
    return q.quality_flag(with_chunks(spark, d), "chunk_id", _CFG, SYSTEM_NAMES)


def _quality_flag(spark, d):
    return _flagged(spark, d).select("event_id", "_quality_flag")


def _report(spark, d):
    return q.quality_report(_flagged(spark, d), "chunk_id", SYSTEM_NAMES, _CFG)


def _quality_report(spark, d):
    report = _report(spark, d)
    return rounded(report.select(
        "chunk_id", "total_rows", F.col("missing_counts")["air_temperature_K"].alias("missing_air"),
        F.size("missing_counts").alias("columns_missing"),
        F.col("out_of_bounds_counts")["air_temperature_K"].alias("outside_air"),
        F.size("out_of_bounds_counts").alias("columns_outside"), "latency_spikes", "quality_score", "passed"))


def _report_summary(spark, d):
    return q.report_summary(_report(spark, d)).select("chunk_id", "summary")


def _simple_gate(spark, d):
    return rounded(q.simple_gate(t.system(spark, d), SIMPLE_GATE_BOUNDS, SYSTEM_NAMES))


def _base(chunks):
    return drift.baseline(chunks.where("chunk_id = 0"), _DRIFT)


def _baseline(spark, d):
    base = _base(with_chunks(spark, d))
    pairs = base.select("column", F.posexplode(F.arrays_zip(F.slice("edges", 1, 10).alias("edge"),
                                                            F.col("proportions").alias("p"))).alias("bin", "x"))
    return rounded(pairs.select("column", "bin", F.col("x.edge").alias("low_edge"), F.col("x.p").alias("proportion")))


def _psi_scores(spark, d):
    chunks = with_chunks(spark, d)
    return drift.psi(chunks, "chunk_id", _base(chunks), _DRIFT, baseline_chunk=0)


def _psi(spark, d):
    return rounded(_psi_scores(spark, d))


def _status(spark, d):
    return drift.drift_status(_psi_scores(spark, d)).select("chunk_id", "column", "status", "retrain")


def _progression(spark, d):
    return rounded(drift.drift_progression(_psi_scores(spark, d)), nudge=OFF_TIE)


def _halves(spark, d):
    placed = scan.positions(t.system(spark, d), ["timestamp", "event_id"], "row_index")
    half = placed.agg(F.floor(F.count(F.lit(1)) / 2)).scalar()
    return rounded(drift.psi_halves(placed, ["process_temperature_K", "vibration_mm_s", "torque_Nm"],
                                    F.col("row_index") >= half))


# ---- the same in SQL ------------------------------------------------------------------------------------------------

_MISSING = " OR ".join(f"{c} IS NULL" for c in SYSTEM_NAMES)
_OUTSIDE = {c: f"coalesce({c} < {lo} OR {c} > {hi}, false)" for c, (lo, hi) in _BOUNDS.items()}
_ANY_OUTSIDE = " OR ".join(_OUTSIDE.values())
_MED = "SELECT chunk_id, median(network_latency_ms) AS m FROM fx_chunks GROUP BY chunk_id"
_E = ("SELECT chunk_id, m AS ema FROM med WHERE chunk_id = 0 UNION ALL "
      "SELECT med.chunk_id, 0.3::DOUBLE * med.m + 0.7::DOUBLE * e.ema FROM e JOIN med ON med.chunk_id = e.chunk_id + 1")
_SPIKED = ("SELECT c.*, coalesce(c.network_latency_ms > 3 * e.ema, false) AS spike FROM fx_chunks c "
           "LEFT JOIN e ON e.chunk_id = c.chunk_id - 1")


def _ema_sql(body, **extra):
    text = sql(body, "fx_chunks", med=_MED, e=_E, **extra)
    return text.replace("e AS MATERIALIZED (SELECT chunk_id, m AS ema", "e AS (SELECT chunk_id, m AS ema")


_ISSUES = "{m} AS missing, {o} AS outside".format(
    m=" + ".join(f"count(*) FILTER ({c} IS NULL)" for c in SYSTEM_NAMES),
    o=" + ".join(f"count(*) FILTER ({x})" for x in _OUTSIDE.values()))
_REP = (f"SELECT chunk_id, count(*) AS total_rows, {_ISSUES}, count(*) FILTER (spike) AS spikes, "
        "count(*) FILTER (air_temperature_K IS NULL) AS missing_air, "
        f"count(*) FILTER ({_OUTSIDE['air_temperature_K']}) AS outside_air, "
        + " + ".join(f"(count(*) FILTER ({c} IS NULL) > 0)::INT" for c in SYSTEM_NAMES) + " AS columns_missing, "
        + " + ".join(f"(count(*) FILTER ({x}) > 0)::INT" for x in _OUTSIDE.values()) + " AS columns_outside, "
        + "greatest(" + ", ".join(f"count(*) FILTER ({c} IS NULL)" for c in SYSTEM_NAMES) + ") AS worst "
        "FROM spiked GROUP BY chunk_id")
_SCORE = f"1.0::DOUBLE - least((missing + outside + spikes)::DOUBLE / (total_rows * {len(SYSTEM_NAMES) + 1}), 1.0)"
_PASS = "worst::DOUBLE / total_rows * 100 <= 5"


def _bins_sql(source, ids, columns, base):
    """Long form of ``columns`` with the bin by comparison against edges; ``base`` selects the baseline rows."""
    steps = " + ".join(f"(v >= lo + step * {i}.0::DOUBLE)::INT" for i in range(1, 10))
    id_list = "".join(f"{i}, " for i in ids)
    return {
        "long": " UNION ALL ".join(f"SELECT {id_list}'{c}' AS col, {c}::DOUBLE AS v FROM {source}" for c in columns),
        "span": f"SELECT col, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 10.0::DOUBLE AS step FROM long "
                f"WHERE {base} GROUP BY col",
        "binned": f"SELECT {id_list}col, CASE WHEN v >= lo AND v <= hi THEN {steps} ELSE -1 END AS bin "
                  "FROM long JOIN span USING (col)",
        "bins": "SELECT unnest(range(10)) AS bin",
    }


_CHUNK_BINS = _bins_sql("fx_chunks", ["chunk_id"], _DRIFT, "chunk_id = 0")
_SHARES = {
    "counted": "SELECT chunk_id, col, bin, count(*) AS n FROM binned GROUP BY ALL",
    "groups": "SELECT chunk_id, col, coalesce(sum(n) FILTER (bin >= 0), 0)::DOUBLE AS total FROM counted GROUP BY ALL",
    "shares": "SELECT g.chunk_id, g.col, b.bin, (coalesce(c.n, 0) + 1e-6) / (g.total + 1e-6 * 10) AS p FROM groups g "
              "CROSS JOIN bins b LEFT JOIN counted c ON c.chunk_id = g.chunk_id AND c.col = g.col AND c.bin = b.bin",
    "psi": "SELECT a.chunk_id, a.col, CASE WHEN a.chunk_id = 0 THEN 0.0::DOUBLE ELSE "
           "round(sum((a.p - e.p) * ln(a.p / e.p)), 6) END AS psi FROM shares a JOIN shares e "
           "ON e.chunk_id = 0 AND e.col = a.col AND e.bin = a.bin GROUP BY a.chunk_id, a.col",
}
_HALF_BINS = _bins_sql("placed", ["later"], ["process_temperature_K", "vibration_mm_s", "torque_Nm"], "NOT later")

QUERIES = {
    "chunk_ids": (_chunk_ids, sql("SELECT event_id, row_index, chunk_id FROM fx_chunks", "fx_chunks")),
    "chunk_metadata": (_chunk_metadata, sql(
        f"SELECT chunk_id, {sql_time('min(timestamp)')} AS first_time, {sql_time('max(timestamp)')} AS last_time, "
        "count(*) AS n_rows FROM fx_chunks GROUP BY chunk_id", "fx_chunks")),
    "flag_missing": (_flag_missing, sql(
        f"SELECT event_id, CASE WHEN {_MISSING} THEN 1 ELSE 0 END AS missing_flag FROM fx_system", "fx_system")),
    "flag_bounds": (_flag_bounds, sql(
        f"SELECT event_id, CASE WHEN {_ANY_OUTSIDE} THEN 2 ELSE 0 END AS bounds_flag FROM fx_system", "fx_system")),
    "latency_ema": (_ema, _ema_sql(
        f"SELECT med.chunk_id, {r('med.m AS median', 'e.ema AS ema', 'b.ema AS ema_before')} FROM med JOIN e "
        "ON e.chunk_id = med.chunk_id LEFT JOIN e b ON b.chunk_id = med.chunk_id - 1")),
    "flag_spikes": (_flag_spikes, _ema_sql(
        "SELECT event_id, chunk_id, CASE WHEN spike THEN 4 ELSE 0 END AS spike_flag FROM spiked", spiked=_SPIKED)),
    "quality_flag": (_quality_flag, _ema_sql(
        f"SELECT event_id, (CASE WHEN {_MISSING} THEN 1 ELSE 0 END) | (CASE WHEN {_ANY_OUTSIDE} THEN 2 ELSE 0 END) "
        "| (CASE WHEN spike THEN 4 ELSE 0 END) AS _quality_flag FROM spiked", spiked=_SPIKED)),
    "quality_report": (_quality_report, _ema_sql(
        "SELECT chunk_id, total_rows, nullif(missing_air, 0) AS missing_air, columns_missing, "
        "nullif(outside_air, 0) AS outside_air, columns_outside, spikes AS latency_spikes, "
        f"round({_SCORE}, 6) AS quality_score, {_PASS} AS passed FROM rep", spiked=_SPIKED, rep=_REP)),
    "report_summary": (_report_summary, _ema_sql(
        f"SELECT chunk_id, printf('[%s] Chunk %d: score=%.3f | %s', CASE WHEN {_PASS} THEN 'PASS' ELSE 'FLAG' END, "
        f"chunk_id, {_SCORE}, CASE WHEN missing + outside + spikes = 0 THEN 'clean' ELSE concat_ws(', ', "
        "CASE WHEN missing > 0 THEN 'missing=' || missing END, CASE WHEN outside > 0 THEN 'out_of_bounds=' || outside "
        "END, CASE WHEN spikes > 0 THEN 'latency_spikes=' || spikes END) END) AS summary FROM rep",
        spiked=_SPIKED, rep=_REP)),
    "simple_gate": (_simple_gate, sql(
        "SELECT round(mp, 6) AS missing_pct, mp < 5 AS missing_ok, round(op, 6) AS oob_pct, op < 2 AS oob_ok, "
        "mp < 5 AND op < 2 AS passed FROM (SELECT ({m})::DOUBLE / (count(*) * {n}) * 100 AS mp, "
        "({o})::DOUBLE / (count(*) * {b}) * 100 AS op FROM fx_system)".format(
            m=" + ".join(f"count(*) FILTER ({c} IS NULL)" for c in SYSTEM_NAMES), n=len(SYSTEM_NAMES),
            o=" + ".join(f"count(*) FILTER ({c} < {lo} OR {c} > {hi})" for c, (lo, hi) in SIMPLE_GATE_BOUNDS.items()),
            b=len(SIMPLE_GATE_BOUNDS)), "fx_system")),
    "drift_baseline": (_baseline, sql(
        "SELECT s.col AS column, s.bin::INT AS bin, round(lo + step * s.bin::DOUBLE, 6) AS low_edge, "
        "round(p, 6) AS proportion FROM shares s JOIN span USING (col) WHERE chunk_id = 0", "fx_chunks",
        **_CHUNK_BINS, **{k: v for k, v in _SHARES.items() if k != "psi"})),
    "drift_psi": (_psi, sql("SELECT chunk_id, col AS column, round(psi, 6) AS psi FROM psi", "fx_chunks",
                            **_CHUNK_BINS, **_SHARES)),
    "drift_status": (_status, sql(
        "SELECT chunk_id, col AS column, CASE WHEN psi < 0.1 THEN 'OK' WHEN psi < 0.2 THEN 'MONITOR' ELSE 'DRIFT!' END "
        "AS status, psi > 0.2 AS retrain FROM psi", "fx_chunks", **_CHUNK_BINS, **_SHARES)),
    "drift_progression": (_progression, sql(
        f"SELECT col AS column, {r('early AS early_psi', 'late AS late_psi', nudge=OFF_TIE)}, late > early AS rising FROM "
        "(SELECT col, avg(psi) FILTER (chunk_id < 5) AS early, "
        "avg(psi) FILTER (chunk_id > (SELECT max(chunk_id) FROM psi) - 5) AS late FROM psi GROUP BY col)",
        "fx_chunks", **_CHUNK_BINS, **_SHARES)),
    "drift_halves": (_halves, sql(
        "SELECT col AS column, round(sum((a - e) * ln(a / e)), 6) AS psi FROM (SELECT t.col, b.bin, "
        "t.later, "
        "max(CASE WHEN t.later THEN coalesce(x.n, 0)::DOUBLE / t.n + 1e-6 END) OVER w AS a, "
        "max(CASE WHEN NOT t.later THEN coalesce(x.n, 0)::DOUBLE / t.n + 1e-6 END) OVER w AS e FROM totals t "
        "CROSS JOIN bins b LEFT JOIN counted x ON x.later = t.later AND x.col = t.col AND x.bin = b.bin "
        "WINDOW w AS (PARTITION BY t.col, b.bin)) WHERE later GROUP BY col", "fx_system",
        placed="SELECT *, row_number() OVER (ORDER BY timestamp, event_id) - 1 >= (SELECT count(*) // 2 FROM "
               "fx_system) AS later FROM fx_system", **_HALF_BINS,
        counted="SELECT later, col, bin, count(*) AS n FROM binned GROUP BY ALL",
        totals="SELECT later, col, count(*) AS n FROM binned GROUP BY ALL")),
}
