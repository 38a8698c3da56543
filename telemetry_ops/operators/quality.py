"""Data-quality flags per row and reports per chunk. Rows are flagged, never dropped.

Flag bits: 1 = a value is missing, 2 = a reading is outside its physical limits, 4 = a latency spike.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetry_ops.config import SIMPLE_GATE_BOUNDS, QualityConfig
from telemetry_ops.functions import python_round
from telemetry_ops.functions.scalar import any_of
from telemetry_ops.operators.scan import block_of, running, small_side

_FOLD = 128  # medians of a block of the moving average
_EMA_BLOCK = 4096


def is_outside(column: str, low: float, high: float) -> Column:
    return F.coalesce((F.col(column) < low) | (F.col(column) > high), F.lit(False))


def missing_bit(columns) -> Column:
    return F.when(any_of(F.col(c).isNull() for c in columns), 1).otherwise(0)


def bounds_bit(df: DataFrame, bounds) -> Column:
    return F.when(any_of(is_outside(c, *b) for c, b in bounds.items() if c in df.columns), 2).otherwise(0)


def flag_missing(df: DataFrame, columns=None, name: str = "missing_flag") -> DataFrame:
    return df.withColumn(name, missing_bit(columns or df.columns))


def flag_bounds(df: DataFrame, bounds, name: str = "bounds_flag") -> DataFrame:
    return df.withColumn(name, bounds_bit(df, bounds))


def latency_columns(df: DataFrame):
    return [c for c in df.columns if "latency" in c.lower()]


def latency_ema(df: DataFrame, chunk: str, column: str, alpha: float = 0.3) -> DataFrame:
    """Per chunk: median of ``column``, the moving average after the chunk (``ema``) and before it (``ema_before``).

    The average starts at the first median and then mixes ``alpha`` of each new one; a chunk without values keeps it.
    The recurrence is linear, so it is exact for any ``alpha``: medians are numbered without the empty chunks and cut
    into blocks; inside a block the average is weight * (average before the block) + value, and what enters each block
    is carried through a table with one row per block.
    """
    medians = df.groupBy(chunk).agg(F.median(column).alias("median"))  # a chunk has a fixed number of rows
    present = running(medians.withColumn("_one", F.when(F.col("median").isNotNull(), 1).otherwise(0)),
                      chunk, sums={"_nth": "_one"}, block_rows=_EMA_BLOCK)
    known = present.where("_one = 1").withColumn("_nth", F.col("_nth") - 1)
    known = known.withColumn("_part", block_of("_nth", _FOLD))
    upto = Window.partitionBy("_part").orderBy("_nth").rowsBetween(Window.unboundedPreceding, 0)
    recent = F.collect_list("median").over(upto)  # at most ``_FOLD`` entries
    inside = known.withColumn("_value", F.aggregate(recent, F.lit(0.0), lambda acc, m: alpha * m + (1 - alpha) * acc)
                              ).withColumn("_weight", F.pow(F.lit(1 - alpha), F.size(recent)))
    ends = inside.groupBy("_part").agg(F.max_by("_value", "_nth").alias("b"), F.max_by("_weight", "_nth").alias("a"),
                                       F.min_by("median", "_nth").alias("first"))

    def carry(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("_part")
        before, now = [], blocks["first"].iloc[0]
        for a, b in zip(blocks["a"], blocks["b"]):
            before.append(now)
            now = a * now + b
        return pd.DataFrame({"_part": blocks["_part"], "_before": before})

    # one row per block of the chunk table
    entering = ends.withColumn("_all", F.lit(True)).groupBy("_all").applyInPandas(carry, "_part long, _before double")
    folded = inside.join(entering, "_part").select(
        chunk, (F.col("_weight") * F.col("_before") + F.col("_value")).alias("_ema"))
    state = running(medians.join(folded, chunk, "left"), chunk, lasts={"ema": "_ema"}, block_rows=_EMA_BLOCK)
    after = state.select(chunk, "median", "ema")
    shifted = after.select((F.col(chunk) + 1).alias(chunk), F.col("ema").alias("ema_before"))
    return after.join(shifted, chunk, "left")


def flag_spikes(df: DataFrame, chunk: str, columns=None, alpha: float = 0.3, multiplier: float = 3.0,
                name: str = "spike_flag") -> DataFrame:
    """Bit 4 where a latency exceeds ``multiplier`` times the average known before its chunk; adds ``n_spikes``."""
    columns = columns if columns is not None else latency_columns(df)
    out = df
    for c in columns:
        limits = latency_ema(df, chunk, c, alpha).select(chunk, F.col("ema_before").alias(f"_ema_{c}"))
        out = out.join(small_side(limits), chunk, "left")
    spikes = [F.coalesce(F.col(c) > F.lit(multiplier) * F.col(f"_ema_{c}"), F.lit(False)).cast("int") for c in columns]
    count = reduce(lambda a, b: a + b, spikes, F.lit(0))
    return (out.withColumn("n_spikes", count).withColumn(name, F.when(count > 0, 4).otherwise(0))
            .drop(*[f"_ema_{c}" for c in columns]))


def quality_flag(df: DataFrame, chunk: str, cfg: QualityConfig | None = None, columns=None) -> DataFrame:
    """Add ``_quality_flag``, the bitwise OR of the three checks. ``columns`` are the ones checked for missing values."""
    cfg = cfg or QualityConfig()
    checked = [c for c in (columns or df.columns) if c != chunk]
    spiked = flag_spikes(df, chunk, latency_columns(df), cfg.ema_alpha, cfg.spike_multiplier, "_spike")
    combined = missing_bit(checked).bitwiseOR(bounds_bit(df, cfg.bounds)).bitwiseOR(F.col("_spike"))
    return spiked.withColumn("_quality_flag", combined).drop("_spike")


def quality_report(flagged: DataFrame, chunk: str, columns, cfg: QualityConfig | None = None) -> DataFrame:
    """One row per chunk from rows that carry ``n_spikes``: counts by column (only above 0), score, passed.

    The score counts issues against rows x (columns + 1): the flag column is part of the denominator.
    """
    cfg = cfg or QualityConfig()
    columns = list(columns)
    bounded = [c for c in cfg.bounds if c in columns]
    per_chunk = flagged.groupBy(chunk).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_m_{c}") for c in columns],
        *[F.count_if(is_outside(c, *cfg.bounds[c])).alias(f"_o_{c}") for c in bounded],
        F.sum("n_spikes").cast("long").alias("latency_spikes"))

    def counts(prefix, names):
        if not names:
            return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
        pairs = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(prefix + n) for n in names]))
        return F.map_filter(pairs, lambda _, v: v > 0)

    def total(name):
        return F.aggregate(F.map_values(name), F.lit(0).cast("long"), lambda a, v: a + v)

    worst = F.greatest(F.lit(0), F.lit(0), *[F.col(f"_m_{c}") for c in columns])
    issues = total("missing_counts") + total("out_of_bounds_counts") + F.col("latency_spikes")
    return (per_chunk
            .withColumn("missing_counts", counts("_m_", columns))
            .withColumn("out_of_bounds_counts", counts("_o_", bounded))
            .select(
                chunk, "total_rows", "missing_counts", "out_of_bounds_counts", "latency_spikes",
                (1.0 - F.least(issues / (F.col("total_rows") * (len(columns) + 1)), F.lit(1.0))).alias("quality_score"),
                (worst / F.col("total_rows") * 100 <= cfg.max_missing_pct).alias("passed")))


def report_summary(report: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """One text line per report."""
    def total(name):
        return F.aggregate(F.map_values(name), F.lit(0).cast("long"), lambda a, v: a + v)

    issues = F.concat_ws(
        ", ",
        F.when(total("missing_counts") > 0, F.concat(F.lit("missing="), total("missing_counts").cast("string"))),
        F.when(total("out_of_bounds_counts") > 0,
               F.concat(F.lit("out_of_bounds="), total("out_of_bounds_counts").cast("string"))),
        F.when(F.col("latency_spikes") > 0, F.concat(F.lit("latency_spikes="), F.col("latency_spikes").cast("string"))))
    line = F.format_string(
        "[%s] Chunk %d: score=%.3f | %s", F.when(F.col("passed"), "PASS").otherwise("FLAG"), F.col(chunk),
        python_round(F.col("quality_score"), 3), F.when(issues == "", F.lit("clean")).otherwise(issues))
    return report.withColumn("summary", line)


def simple_gate(df: DataFrame, bounds=None, columns=None) -> DataFrame:
    """One row: share of missing cells (must be under 5 %) and of out-of-range readings (under 2 %)."""
    bounds = bounds or SIMPLE_GATE_BOUNDS
    columns = list(columns or df.columns)
    cells = df.agg(
        F.count(F.lit(1)).alias("n"),
        reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in columns]).alias("missing"),
        reduce(lambda a, b: a + b, [F.count_if(is_outside(c, *b)) for c, b in bounds.items() if c in df.columns],
               F.lit(0)).alias("outside"))
    missing = F.col("missing") / (F.col("n") * len(columns)) * 100
    outside = F.col("outside") / (F.col("n") * len(bounds)) * 100
    return cells.select(missing.alias("missing_pct"), (missing < 5).alias("missing_ok"), outside.alias("oob_pct"),
                        (outside < 2).alias("oob_ok"), ((missing < 5) & (outside < 2)).alias("passed"))
