"""Profile of raw log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def read_lines(spark: SparkSession, path) -> DataFrame:
    """(file, offset order, line) for every line; files whose name contains ``copy`` are duplicates and are skipped."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("bytes"), F.col("value").alias("line"))
    numbered = lines.withColumn("in_task", F.monotonically_increasing_id())
    return numbered.where(~F.lower("file").contains("copy"))


def profile_lines(lines: DataFrame, sample: int = 5) -> DataFrame:
    """Per file: lines, first ``sample`` lines (200 characters each), fields of the first line, access-log guess.

    Counting and picking the first lines are separate, so only ``sample`` lines per file and task are ever moved.
    """
    order = Window.partitionBy("file").orderBy("block", "in_task")
    first = (lines.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)
             .groupBy("file").agg(F.sort_array(F.collect_list(F.struct("n", "line"))).alias("s")))
    head = F.element_at("s", 1)["line"]
    counts = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines"), F.max("bytes").alias("bytes"))
    return counts.join(first, "file").select(
        "file", "bytes", "n_lines", F.transform("s", lambda x: F.substring(x["line"], 1, 200)).alias("sample"),
        F.size(F.filter(F.split(F.trim(head), r"\s+"), lambda w: w != "")).alias("n_fields"),
        (head.contains(" - - [") | head.contains("HTTP/")).alias("is_access_log"))


def profile_text(spark: SparkSession, path) -> DataFrame:
    return profile_lines(read_lines(spark, path))
