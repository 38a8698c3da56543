"""Global order without a single-task window: positions, running totals and overlapping blocks.

A key, a day or a score may hold a large part of all rows, so nothing here partitions by such a value. Rows are
range-partitioned by a *total* order (ending in a row id), which splits any hot value, and a position counted from
that layout cuts the table into blocks of equal size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetry_ops.scratch import written

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits
BLOCK_ROWS = 500_000


def _cols(names):
    return [F.col(n) if isinstance(n, str) else n for n in names]


def positions(df: DataFrame, order, name: str = "pos", partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of every row in the total order ``order`` (its last column must make rows distinct).

    One range shuffle, one written table, then a lookup of one offset per partition. Without ``partitions`` adaptive
    execution may merge small neighbouring ranges, which keeps their order.
    """
    order = _cols(order)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    laid_out = (ranged.sortWithinPartitions(*order)
                .withColumn("_row", F.monotonically_increasing_id()))
    laid_out = written(laid_out, "ordered")
    part = F.shiftright("_row", _ROW_BITS)
    sizes = laid_out.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (laid_out.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
            .drop("_row", "_part", "_offset"))


def block_of(pos, block_rows: int) -> Column:
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(pos / F.lit(block_rows)).cast("long")


def running(df: DataFrame, pos: str, sums: dict | None = None, lasts: dict | None = None,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Inclusive running sums and running last non-null values over a dense position column.

    ``sums`` and ``lasts`` map output names to columns. Rows are windowed inside blocks of ``block_rows`` positions;
    the totals of earlier blocks come from a table with one row per block.
    """
    sums, lasts = dict(sums or {}), dict(lasts or {})
    df = df.withColumn("_block", block_of(pos, block_rows))
    totals = df.groupBy("_block").agg(
        *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()],
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(pos))).alias(f"_t_{n}") for n, c in lasts.items()])
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    carried = totals.select(
        "_block",
        *[F.sum(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_t_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in lasts])
    inside = Window.partitionBy("_block").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    local = df.select(
        "*",
        *[F.sum(c).over(inside).alias(f"_l_{n}") for n, c in sums.items()],
        *[F.last(c, ignorenulls=True).over(inside).alias(f"_l_{n}") for n, c in lasts.items()])
    keep = [c for c in df.columns if c != "_block" and c not in sums and c not in lasts]
    return local.join(carried, "_block", "left").select(
        *keep,
        *[F.when(F.col(f"_c_{n}").isNull(), F.col(f"_l_{n}"))
          .otherwise(F.col(f"_c_{n}") + F.coalesce(F.col(f"_l_{n}"), F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in lasts])


def halo(df: DataFrame, pos: str, back: int, block_rows: int) -> DataFrame:
    """Cut rows into blocks by position and copy the last ``back`` rows of each block into the next one.

    Adds ``_block`` and ``_ghost`` (true for the copies). A trailing frame of up to ``back + 1`` rows computed inside
    a block equals the frame over the whole table, for every row that is not a ghost.
    """
    if block_rows < back:
        raise ValueError("block_rows must be at least the number of rows looked back")
    own = block_of(pos, block_rows)
    near_end = F.pmod(F.col(pos), F.lit(block_rows)) >= block_rows - back
    targets = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    return (df.withColumn("_own", own).withColumn("_block", F.explode(targets))
            .withColumn("_ghost", F.col("_block") != F.col("_own")).drop("_own"))


def chunk_ids(df: DataFrame, time: str, rid: str, size: int = 5000) -> DataFrame:
    """Chunks of ``size`` consecutive rows in (time, row id) order: adds ``row_index`` and ``chunk_id``."""
    return positions(df, [time, rid], "row_index").withColumn("chunk_id", block_of("row_index", size))


def chunk_metadata(df: DataFrame, time: str, chunk: str = "chunk_id") -> DataFrame:
    return df.groupBy(chunk).agg(
        F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count(F.lit(1)).alias("n_rows"))


def small_side(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Write ``df`` and mark it for broadcast only if it has at most ``max_rows`` rows; else leave the join to Spark."""
    df = written(df, "side")
    return F.broadcast(df) if df.count() <= max_rows else df


def join_null_safe(df: DataFrame, side: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL, keeping the key columns of ``df``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    renamed = side.select(*[F.col(c).alias(f"_side_{c}") if c in keys else F.col(c) for c in side.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_side_{k}"))
    return df.join(renamed, same, how).drop(*[f"_side_{k}" for k in keys])


def exact_percentiles(df: DataFrame, group, value: str, probabilities: dict, max_distinct: int = 1_000_000,
                      weight: str | None = None) -> DataFrame:
    """Exact percentiles (linear interpolation) of ``value`` per group, for groups of any size.

    Equal values are counted together before the shuffle. When no group has more than ``max_distinct`` distinct values
    the built-in ``percentile`` reads those counts. Beyond that, the counts are ordered by (group, value) and the rows
    that cover the wanted ranks are picked, so no task holds the values of a whole group. ``probabilities`` maps
    output names to numbers in [0, 1]. NULL values are ignored.
    """
    group = [group] if isinstance(group, str) else list(group)
    counts = (df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).cast("double").alias("_v"))
              .agg((F.sum(weight) if weight else F.count(F.lit(1))).cast("long").alias("_n")))
    if df.count() <= max_distinct or (
            counts.groupBy(*group).agg(F.count(F.lit(1)).alias("d")).agg(F.max("d")).first()[0] or 0) <= max_distinct:
        return counts.groupBy(*group).agg(*[F.percentile("_v", float(p), F.col("_n")).alias(name)
                                            for name, p in probabilities.items()])
    placed = running(positions(counts, [*group, "_v"], "_pos"), "_pos", sums={"_upto": "_n"})
    if group:
        # the last running total of a group closes it; its first row starts at that total minus the group's size
        ends = placed.groupBy(*group).agg(F.max("_upto").alias("_end"), F.sum("_n").alias("_total"))
        placed = join_null_safe(placed, small_side(ends), group, "inner")
    else:
        total = counts.agg(F.sum("_n")).scalar()
        placed = placed.withColumn("_end", total).withColumn("_total", total)
    first = F.col("_upto") - F.col("_n") - (F.col("_end") - F.col("_total"))
    last = first + F.col("_n") - 1
    aggregates, covered = [], F.lit(False)
    for name, p in probabilities.items():
        rank = (F.col("_total") - 1) * F.lit(float(p))
        low, high = F.floor(rank), F.ceil(rank)
        has_low, has_high = (first <= low) & (last >= low), (first <= high) & (last >= high)
        covered = covered | has_low | has_high
        lo, hi = F.max(F.when(has_low, F.col("_v"))), F.max(F.when(has_high, F.col("_v")))
        aggregates.append((lo + (hi - lo) * F.max(rank - F.floor(rank))).alias(name))
    return placed.where(covered).groupBy(*group).agg(*aggregates)
