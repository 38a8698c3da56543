"""Distribution drift against a baseline: equal-width histograms and the population stability index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetry_ops.functions import band


def edges(low: Column, high: Column, bins: int) -> Column:
    """``bins + 1`` equal-width edges; a constant column gets a unit-wide range around its value."""
    lo = F.when(low == high, low - 0.5).otherwise(low)
    hi = F.when(low == high, high + 0.5).otherwise(high)
    step = (hi - lo) / F.lit(float(bins))
    return F.when(low.isNotNull(), F.array(*[lo + step * F.lit(float(i)) for i in range(bins)], hi))


def bin_index(value: Column, edge: Column, bins: int) -> Column:
    """0-based bin by comparison with the edges; the last bin is closed, values outside the range give -1.

    The arithmetic guess is corrected against the edges themselves, so rounding never moves a value over an edge.
    """
    lo, hi = F.element_at(edge, 1), F.element_at(edge, bins + 1)
    guess = F.floor((value - lo) / (hi - lo) * bins)
    guess = F.least(F.greatest(guess, F.lit(0)), F.lit(bins - 1)).cast("int")
    below = value < F.element_at(edge, guess + 1)
    above = (guess < bins - 1) & (value >= F.element_at(edge, F.least(guess + 2, F.lit(bins + 1))))
    exact = F.when(below, guess - 1).when(above, guess + 1).otherwise(guess)
    return F.when((value >= lo) & (value <= hi), exact).otherwise(F.lit(-1))


def _long(df: DataFrame, ids, columns) -> DataFrame:
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(ids), list(columns), "column", "value")


def _bin_counts(df: DataFrame, ids, columns, ranges: DataFrame, bins: int) -> DataFrame:
    """Per id and column: map bin -> count, in-range total and row count. ``ranges`` has one row per column."""
    binned = _long(df, ids, columns).join(F.broadcast(ranges), "column").select(
        *ids, "column", F.when(F.col("value").isNull(), -1)
        .otherwise(bin_index(F.col("value"), F.col("edges"), bins)).alias("bin"))
    counted = binned.groupBy(*ids, "column", "bin").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*ids, "column").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"),  # at most bins + 1 entries
        F.sum(F.when(F.col("bin") >= 0, F.col("n")).otherwise(0)).alias("in_range"),
        F.sum("n").alias("rows"))


def shares(bins: int, epsilon: float) -> Column:
    total = F.col("in_range") + F.lit(epsilon) * bins
    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)),
                       lambda b: (F.coalesce(F.try_element_at("counts", b), F.lit(0)) + F.lit(epsilon)) / total)


def baseline(df: DataFrame, columns, bins: int = 10, epsilon: float = 1e-6) -> DataFrame:
    """Edges and smoothed proportions per column: (column, edges, proportions). One row per configured column.

    Both are NULL for a column without values, and so is its stability index.
    """
    columns = [c for c in columns if c in df.columns]
    spans = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).agg(
        *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns])
    ranges = spans.unpivot([], columns, "column", "span").select(
        "column", edges(F.col("span.lo"), F.col("span.hi"), bins).alias("edges"))
    counts = _bin_counts(df, [], columns, ranges, bins)
    return counts.join(F.broadcast(ranges), "column").select(
        "column", "edges", F.when(F.col("edges").isNotNull(), shares(bins, epsilon)).alias("proportions"))


def psi_value(actual: Column, expected: Column) -> Column:
    terms = F.zip_with(actual, expected, lambda a, e: (a - e) * F.ln(a / e))
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def psi(df: DataFrame, chunk: str, base: DataFrame, columns, bins: int = 10, epsilon: float = 1e-6,
        baseline_chunk=None) -> DataFrame:
    """Stability index per (chunk, column), rounded to 6 digits. Values outside the baseline range do not count.

    ``base`` is the table made by :func:`baseline`; the chunk it was made from scores 0.
    """
    columns = [c for c in columns if c in df.columns]
    base = F.broadcast(base)  # one row per configured column
    counts = _bin_counts(df, [chunk], columns, base.select("column", "edges"), bins)
    score = F.bround(psi_value(shares(bins, epsilon), F.col("proportions")), 6)
    if baseline_chunk is not None:
        score = F.when((F.col(chunk) == baseline_chunk) & F.col("proportions").isNotNull(), F.lit(0.0)).otherwise(score)
    return counts.join(base, "column").select(chunk, "column", score.alias("psi"))


def psi_halves(df: DataFrame, columns, is_current: Column, bins: int = 10, epsilon: float = 1e-6) -> DataFrame:
    """Stability index of the rows where ``is_current`` against the others; shares are of *all* rows of each half."""
    halves = df.withColumn("_current", is_current)
    columns = list(columns)
    spans = halves.where("NOT _current").select(*[F.col(c).cast("double").alias(c) for c in columns]).agg(
        *[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns])
    ranges = spans.unpivot([], columns, "column", "span").select(
        "column", edges(F.col("span.lo"), F.col("span.hi"), bins).alias("edges"))
    counts = _bin_counts(halves, ["_current"], columns, ranges, bins)
    share = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)),
        lambda b: F.coalesce(F.try_element_at("counts", b), F.lit(0)) / F.col("rows") + F.lit(epsilon))
    sides = counts.select("column", "_current", share.alias("share")).groupBy("column").agg(
        F.max(F.when(~F.col("_current"), F.col("share"))).alias("_before"),
        F.max(F.when(F.col("_current"), F.col("share"))).alias("_after"))
    return sides.select("column", psi_value(F.col("_after"), F.col("_before")).alias("psi"))


def drift_status(scores: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Status band (below 0.1 OK, below 0.2 MONITOR, else DRIFT!) and the strict retrain signal; NULL without an index."""
    status = F.when(F.col("psi").isNotNull(), band(F.col("psi"), [(0.2, "DRIFT!"), (0.1, "MONITOR")], "OK"))
    return scores.select("*", status.alias("status"),
                         (F.col("psi") > threshold).alias("retrain"))


def drift_progression(scores: DataFrame, chunk: str = "chunk_id", n: int = 5) -> DataFrame:
    """Per column: mean index of the first and of the last ``n`` chunks, and whether it rose. Chunk numbers are dense."""
    span = scores.agg(F.min(chunk).alias("lo"), F.max(chunk).alias("hi"))
    first, last = span.select("lo").scalar(), span.select("hi").scalar()
    means = scores.groupBy("column").agg(
        F.avg(F.when(F.col(chunk) < first + n, F.col("psi"))).alias("early_psi"),
        F.avg(F.when(F.col(chunk) > last - n, F.col("psi"))).alias("late_psi"))
    return means.withColumn("rising", F.col("late_psi") > F.col("early_psi"))


def class_histogram(df: DataFrame, label: str, column: str, bins: int) -> DataFrame:
    """Counts per (label, bin) over bins that span the whole column, for comparing classes."""
    span = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    step = F.when(lo == hi, F.lit(1.0 / bins)).otherwise((hi - lo) / float(bins))
    start = F.when(lo == hi, lo - 0.5).otherwise(lo)
    index = F.least(F.greatest(F.floor((F.col(column) - start) / step), F.lit(0)), F.lit(bins - 1))
    at = lambda i: start + step * i.cast("double")
    index = F.when(F.col(column) < at(index), index - 1).when(
        (index < bins - 1) & (F.col(column) >= at(index + 1)), index + 1).otherwise(index)
    return (df.where(F.col(column).isNotNull()).groupBy(label, index.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n_rows")))
