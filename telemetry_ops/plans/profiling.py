"""Table profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_ops.operators import drift, profile as p
from telemetry_ops.plans.common import SENSORS, SYSTEM_NAMES, SYSTEM_NUMERIC, r, rounded, sql
from telemetry_ops.sources import telemetry as t

_LABEL = "machine_failure"
_KIND = {"timestamp": "timestamp_ntz", "machine_id": "string", "product_type": "string", _LABEL: "int"}


def _balance(spark, d):
    return rounded(p.class_balance(t.system(spark, d), _LABEL))


def _describe(spark, d):
    return rounded(p.describe(t.system(spark, d), SENSORS), 5)


def _nulls(spark, d):
    return p.null_profile(t.system(spark, d).select(*SYSTEM_NAMES))


def _means(spark, d):
    return rounded(p.compare_means(t.system(spark, d), _LABEL, SENSORS))


def _correlation(spark, d):
    return rounded(p.label_correlation(t.system(spark, d), _LABEL, SYSTEM_NUMERIC))


def _histogram(spark, d):
    return drift.class_histogram(t.system(spark, d), _LABEL, "vibration_mm_s", 30)


def _histogram_all(spark, d):
    df = t.system(spark, d).withColumn("all_rows", F.lit(0))
    return drift.class_histogram(df, "all_rows", "rotational_speed_rpm", 50).select("bin", "n_rows")


def _validate(spark, d):
    return rounded(p.validate_features(t.system(spark, d), SYSTEM_NUMERIC), 4)


def _shape(spark, d):
    return rounded(p.matrix_shape(t.system(spark, d).select(*SYSTEM_NAMES)))


def _each(columns, template):
    return " UNION ALL ".join("SELECT " + template.format(c=c) + " FROM fx_system" for c in columns)


def _histogram_sql(column, bins, label):
    inner = "SELECT {l} AS lab, {c} AS v, min({c}) OVER () AS lo, (max({c}) OVER () - min({c}) OVER ()) / {b}.0::DOUBLE " \
            "AS step FROM fx_system".format(l=label, c=column, b=bins)
    return f"SELECT lab, (SELECT count(*) FROM range(1, {bins}) g(i) WHERE v >= lo + step * i)::INT AS bin FROM ({inner})"


QUERIES = {
    "class_balance": (_balance, sql(
        f"SELECT p AS positives, n AS negatives, round(p * 100.0::DOUBLE / (p + n), 6) AS positive_pct, "
        "round(n::DOUBLE / greatest(p, 1), 6) AS imbalance_ratio FROM (SELECT "
        f"count(*) FILTER ({_LABEL} = 1) AS p, count(*) FILTER ({_LABEL} = 0) AS n FROM fx_system)", "fx_system")),
    "describe": (_describe, sql(_each(SENSORS, "'{c}' AS column, count({c}) AS count, " + r(
        "avg({c}) AS mean", "stddev_samp({c}) AS std", "min({c}) AS min", "max({c}) AS max",
        "quantile_cont({c}, 0.25) AS p25", "quantile_cont({c}, 0.5) AS p50", "quantile_cont({c}, 0.75) AS p75",
        digits=5)), "fx_system")),
    "null_profile": (_nulls, sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) FILTER ({c} IS NULL) AS n_missing, count(*) AS n_rows, "
        f"'{_KIND.get(c, 'double')}' AS dtype FROM fx_system" for c in SYSTEM_NAMES), "fx_system")),
    "compare_means": (_means, sql(
        "SELECT col AS column, round(h, 6) AS healthy_mean, round(f, 6) AS failure_mean, "
        "round((f - h) / h * 100, 6) AS difference_pct FROM (" + _each(
            SENSORS, f"'{{c}}' AS col, avg({{c}}) FILTER ({_LABEL} = 0) AS h, avg({{c}}) FILTER ({_LABEL} = 1) AS f")
        + ")", "fx_system")),
    "label_correlation": (_correlation, sql(_each(
        [c for c in SYSTEM_NUMERIC if c != _LABEL],
        f"'{{c}}' AS column, round(corr({{c}}, {_LABEL}), 6) AS correlation"), "fx_system")),
    "class_histogram": (_histogram, sql(
        f"SELECT lab AS {_LABEL}, bin, count(*) AS n_rows FROM b GROUP BY ALL", "fx_system",
        b=_histogram_sql("vibration_mm_s", 30, _LABEL))),
    "value_histogram": (_histogram_all, sql(
        "SELECT bin, count(*) AS n_rows FROM b GROUP BY ALL", "fx_system",
        b=_histogram_sql("rotational_speed_rpm", 50, "0"))),
    "validate_features": (_validate, sql(_each(
        SYSTEM_NUMERIC, "'{c}' AS column, round(var_samp({c}), 4) AS variance, count({c}) AS non_null"), "fx_system")),
    "matrix_shape": (_shape, sql(
        f"SELECT count(*) AS n_rows, {len(SYSTEM_NAMES)} AS n_columns, round(("
        + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in SYSTEM_NAMES)
        + f") * 100.0::DOUBLE / (count(*) * {len(SYSTEM_NAMES)}), 6) AS missing_pct FROM fx_system", "fx_system")),
}
