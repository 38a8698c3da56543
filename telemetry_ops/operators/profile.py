"""Descriptive profiles of a table: class balance, statistics, missing values, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from telemetry_ops.functions import ratio
from telemetry_ops.operators.scan import exact_percentiles


def _stacked(row: DataFrame, columns, fields) -> DataFrame:
    """Turn one row of structs (one per column) into one row per column."""
    return row.unpivot([], list(columns), "column", "_s").select("column", *[F.col(f"_s.{f}").alias(f) for f in fields])


def numeric_columns(df: DataFrame):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))
    return counts.select("positives", "negatives",
                         ratio(F.col("positives") * 100, F.col("positives") + F.col("negatives")).alias("positive_pct"),
                         ratio(F.col("negatives"), F.greatest("positives", F.lit(1))).alias("imbalance_ratio"))


def describe(df: DataFrame, columns) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column."""
    columns = list(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    basic = _stacked(numbers.agg(*[F.struct(
        F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"),
        F.max(c).alias("max")).alias(c) for c in columns]), columns, ["count", "mean", "std", "min", "max"])
    long = numbers.unpivot([], columns, "column", "value")
    quartiles = exact_percentiles(long, "column", "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return basic.join(quartiles, "column", "left")


def null_profile(df: DataFrame) -> DataFrame:
    """Type and number of missing values per column."""
    kinds = F.create_map(*[x for c, t in df.dtypes for x in (F.lit(c), F.lit(t))])
    missing = df.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("n_missing"),
                                F.count(F.lit(1)).alias("n_rows")).alias(c) for c in df.columns])
    return _stacked(missing, df.columns, ["n_missing", "n_rows"]).withColumn("dtype", kinds[F.col("column")])


def compare_means(df: DataFrame, label: str, columns) -> DataFrame:
    """Mean of each column for healthy and failing rows, and the difference in percent of the healthy mean."""
    columns = list(columns)
    means = df.agg(*[F.struct(F.avg(F.when(F.col(label) == 0, F.col(c))).alias("healthy_mean"),
                              F.avg(F.when(F.col(label) == 1, F.col(c))).alias("failure_mean")).alias(c)
                     for c in columns])
    return _stacked(means, columns, ["healthy_mean", "failure_mean"]).withColumn(
        "difference_pct", F.try_divide(F.col("failure_mean") - F.col("healthy_mean"), F.col("healthy_mean")) * 100)


def label_correlation(df: DataFrame, label: str, columns=None) -> DataFrame:
    """Pearson correlation of every numeric column with the label, over rows where both are present."""
    columns = [c for c in (columns or numeric_columns(df)) if c != label]
    row = df.agg(*[F.corr(c, label).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "correlation")


def validate_features(df: DataFrame, columns=None) -> DataFrame:
    """Per column: variance and number of values."""
    columns = list(columns or numeric_columns(df))
    return _stacked(df.agg(*[F.struct(F.var_samp(c).alias("variance"), F.count(c).alias("non_null")).alias(c)
                             for c in columns]), columns, ["variance", "non_null"])


def matrix_shape(df: DataFrame) -> DataFrame:
    """One row: rows, columns and the share of missing cells."""
    missing = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"),
                  ratio(missing * 100, F.count(F.lit(1)) * len(df.columns)).alias("missing_pct"))
