"""Tables of additive counts that are kept up to date by merging what a batch adds, in the parts it touches only.

A part (a day, a window) is one partition folder. A batch adds its counts to the parts it holds rows of; those are replaced one
by one (``partitionOverwriteMode=dynamic``), the files of all others stay as they are. Each part remembers the last
batch it took in, so a batch that is run again, even after only some of its parts were replaced, is added once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetry_ops.operators.alerts import apply_acks, cause_counts, daily_from_causes
from telemetry_ops.scratch import written

_BATCH = "_batch"


def stored(spark: SparkSession, path: str, like: DataFrame, part: str) -> DataFrame:
    """The counts at ``path``; none if nothing was merged yet."""
    table = like.withColumn(_BATCH, F.lit(None).cast("long"))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return table.limit(0)
    return spark.read.schema(table.schema).parquet(path).select(table.columns)


def _among(part: str, values: list) -> Column:
    """Whether a part is one of few values, NULL included; prunes partitions."""
    known = [v for v in values if v is not None]
    found = F.coalesce(F.col(part).isin(known), F.lit(False)) if known else F.lit(False)
    return found | F.col(part).isNull() if len(known) < len(values) else found


def merge_counts(path: str, delta: DataFrame, part: str, keys: list[str], sums: list[str],
                 batch_id: int | None = None) -> DataFrame:
    """Add ``delta`` (part, keys, sums) to the table at ``path`` and return the new rows of the parts it touched.

    With ``batch_id`` a part that has taken in this batch or a later one is left as it is. Rows whose counts all fell to 0
    stay. The values of ``part`` a batch touches are collected: a batch should span days, not years of windows.
    """
    spark = delta.sparkSession
    delta = delta.groupBy(part, *keys).agg(*[F.sum(c).cast("long").alias(c) for c in sums])
    delta = written(delta, "delta")
    touched = [row[0] for row in delta.select(part).distinct().collect()]
    is_touched = _among(part, touched)
    before = left = stored(spark, path, delta, part).where(is_touched)
    fresh = delta
    if batch_id is not None:
        done = [row[0] for row in before.where(F.col(_BATCH) >= batch_id).select(part).distinct().collect()]
        fresh, left = delta.where(~_among(part, done)), before.where(~_among(part, done))
    merged = left.unionByName(fresh.withColumn(_BATCH, F.lit(batch_id).cast("long"))).groupBy(part, *keys).agg(
        *[F.sum(c).alias(c) for c in sums], F.max(_BATCH).alias(_BATCH))
    merged = written(merged, "merged")  # read and written tables are never the same files
    # a part goes to one task per writer, so that it is one file
    merged.repartition(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    return stored(spark, path, delta, part).where(is_touched).drop(_BATCH)


_DAY = "date"


def _added(alerts: DataFrame, sign: int):
    counts = cause_counts(alerts)
    keys = [_DAY, "machine_id", "root_cause"]
    return counts.select(*keys, *[(F.col(c) * sign).alias(c) for c in counts.columns if c not in keys])


def _merge_days(path: str, delta: DataFrame, batch_id) -> DataFrame:
    keys = ["machine_id", "root_cause"]
    return merge_counts(path, delta, _DAY, keys, [c for c in delta.columns if c not in (_DAY, *keys)], batch_id)


def add_alerts(path: str, alerts: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Count new alerts into the daily table at ``path``; returns the daily rows of the days touched."""
    return daily_from_causes(_merge_days(path, _added(alerts, 1), batch_id))


def add_acknowledgements(path: str, alerts: DataFrame, earlier: DataFrame, acks: DataFrame,
                         batch_id: int | None = None) -> DataFrame:
    """Count new acknowledgements into the days of their alerts, however old.

    ``alerts`` are all alerts as first stored, ``earlier`` the acknowledgements counted before. Only the alerts named by
    ``acks`` are looked at: what they counted for is taken off, what they count for now is added.
    """
    ids = acks.select(F.col("alert_id").alias("id")).distinct()
    named = written(alerts.join(ids, "id", "left_semi"), "named")
    of_named = earlier.join(ids.select(F.col("id").alias("alert_id")), "alert_id", "left_semi")
    before = apply_acks(named, of_named)
    after = apply_acks(named, of_named.unionByName(acks))
    return daily_from_causes(_merge_days(path, _added(before, -1).unionByName(_added(after, 1)), batch_id))


def daily(spark: SparkSession, path: str, alerts: DataFrame) -> DataFrame:
    """The maintained table as :func:`~telemetry_ops.operators.alerts.daily_fatigue` gives it."""
    return daily_from_causes(stored(spark, path, cause_counts(alerts), _DAY).drop(_BATCH))
