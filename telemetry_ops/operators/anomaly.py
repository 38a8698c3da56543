"""Unsupervised anomaly scores and label derivations."""

from __future__ import annotations

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetry_ops.functions import band, lcg
from telemetry_ops.operators.scan import halo, join_null_safe, positions, small_side


def healthy_split(df: DataFrame, label: str, rid: str, fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """Healthy rows with ``is_train``, decided per row by a key computed from its id."""
    return df.where(F.col(label) == 0).withColumn("is_train", lcg(rid, seed) < F.lit(int(2147483647 * fraction)))


def standardise(df: DataFrame, columns, where: Column) -> DataFrame:
    """(x - mean) / population deviation, both taken over the rows of ``where``; a constant column divides by 1."""
    columns = list(columns)
    fitted = df.where(where).agg(*[x for c in columns for x in (
        F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))])
    stats = fitted.first().asDict()  # two numbers per column
    scaled = lambda c: (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)
    wanted = set(columns)
    return df.select(*[scaled(c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def reconstruction_error(df: DataFrame, columns, where: Column, k: int = 16, name: str = "reconstruction_error"):
    """Mean squared error of each row after projecting onto the ``k`` main directions of the rows of ``where``.

    Columns must be standardised over ``where``; NULL counts as the mean. Directions are orthonormal, so the error is
    the squared length lost by the projection and no matrix has to be rebuilt per row.
    """
    columns = list(columns)
    filled = df.select("*", *[F.coalesce(F.col(c), F.lit(0.0)).alias(f"_x_{c}") for c in columns])
    assembled = VectorAssembler(inputCols=[f"_x_{c}" for c in columns], outputCol="_v").transform(filled)
    model = PCA(k=min(k, len(columns)), inputCol="_v", outputCol="_p").fit(assembled.where(where))
    length = lambda v: F.aggregate(vector_to_array(v), F.lit(0.0), lambda a, x: a + x * x)
    error = F.greatest(length(F.col("_v")) - length(F.col("_p")), F.lit(0.0)) / len(columns)
    return model.transform(assembled).select(*df.columns, error.alias(name))


def normalise(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Min-max scaling with 1e-8 added to the range."""
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    return df.withColumn(name or column, (F.col(column) - lo) / (hi - lo + 1e-8))


def separation(df: DataFrame, score: str, label: str) -> DataFrame:
    """Distance of the class means in deviations of the healthy class, with a verdict."""
    ok, bad = F.when(F.col(label) == 0, F.col(score)), F.when(F.col(label) == 1, F.col(score))
    d = (F.col("failure_mean") - F.col("healthy_mean")) / (F.col("healthy_std") + 1e-8)
    return (df.agg(F.avg(ok).alias("healthy_mean"), F.stddev_pop(ok).alias("healthy_std"),
                   F.avg(bad).alias("failure_mean"), F.stddev_pop(bad).alias("failure_std"))
            .withColumn("separation", d)
            .withColumn("verdict", F.when(d > 1.0, "STRONG").when(d > 0.5, "MODERATE").otherwise("WEAK")))


def failure_ramp(df: DataFrame, key: str, time: str, rid: str, label: str, back: int = 18,
                 block_rows: int = 500_000) -> DataFrame:
    """``ramp``: how far a row lies in the window of up to ``back`` rows before a failure, 1.0 at the failure itself.

    The window of a failure starts at the series start if that is nearer, so its progress is (distance from start) /
    (window length); of several failures ahead the highest progress counts. Looking ahead is looking back in reversed
    row order, so the same overlapping blocks serve here, and no key has to fit in one task.
    """
    placed = positions(df, [key, time, rid], "_pos")
    starts = placed.groupBy(key).agg(F.min("_pos").alias("_start"))
    placed = join_null_safe(placed, small_side(starts), key, "inner")
    top = placed.agg(F.max("_pos")).scalar()
    cut = halo(placed.withColumn("_rev", top - F.col("_pos")), "_rev", back, block_rows)
    ahead = (Window.partitionBy("_block", key).orderBy("_rev").rowsBetween(-back, -1))
    failures = F.collect_list(F.when(F.col(label) == 1, F.col("_pos"))).over(ahead)  # at most ``back`` entries
    here = F.col("_pos")
    floor = lambda f: F.greatest(F.col("_start"), f - back)
    best = F.aggregate(failures, F.lit(0.0),
                       lambda acc, f: F.greatest(acc, (here - floor(f)) / (f - floor(f))))
    ramped = cut.withColumn("_ahead", best).where("NOT _ghost")
    return ramped.select(*df.columns, F.when(F.col(label) == 1, F.lit(1.0)).otherwise(F.col("_ahead")).alias("ramp"))


def status_label(df: DataFrame, ramp: str, label: str, name: str = "maintenance_status") -> DataFrame:
    return df.withColumn(name, F.when(F.col(label) == 1, "Failure").when(F.col(ramp) > 0.6, "Warning")
                         .when(F.col(ramp) > 0, "Degrading").otherwise("Normal"))


# fixed values: component weights (wear / 250 * 0.35, error rate / 40 * 0.3, network latency / 130 * 0.2, flag * 0.85)
COMPOSITE_WEIGHTS = {"ramp": 1.0, "tool_wear_min": 0.35 / 250, "error_rate_pct": 0.3 / 40,
                     "network_latency_ms": 0.2 / 130, "software_only": 0.85}


def composite_score(df: DataFrame, weights: dict | None = None, limit: float = 0.55) -> DataFrame:
    """``anomaly_score``: the largest weighted component, clipped to [0, 1]; ``is_anomaly`` above ``limit``."""
    weights = weights or COMPOSITE_WEIGHTS
    parts = [F.col(c) * w for c, w in weights.items() if c in df.columns]
    score = F.least(F.greatest(F.lit(0.0), F.lit(0.0), *parts), F.lit(1.0))
    return df.withColumn("anomaly_score", score).withColumn("is_anomaly", (score > limit).cast("int"))
