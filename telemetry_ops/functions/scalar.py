"""Scalar helpers, all built from Spark's own column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

_MODULUS = 2147483647


def lcg(id_column, seed: int) -> Column:
    """Repeatable pseudo-random integer in [0, 2^31 - 1) drawn from a row's own id."""
    c = F.col(id_column) if isinstance(id_column, str) else id_column
    base = F.pmod(c.cast("long"), F.lit(_MODULUS))
    return F.pmod(base * F.lit(48271) + F.lit(seed * 69621 + 11), F.lit(_MODULUS))


def nan_to_null(column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(c), c)


def missing_to_null(df: DataFrame) -> DataFrame:
    """NULL is the only missing value: turn NaN into NULL in every floating column."""
    return df.select(*[
        nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double; NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def band(column: Column, steps, otherwise) -> Column:
    """First label whose lower limit the value reaches; ``steps`` are (limit, label) from high to low."""
    expr = None
    for limit, label in steps:
        expr = (F if expr is None else expr).when(column >= F.lit(limit), F.lit(label))
    return F.when(column.isNotNull(), expr.otherwise(F.lit(otherwise)))


def python_round(column: Column, digits: int) -> Column:
    """Round half to even on the exact binary value, as Python's ``round`` and ``format`` do.

    Spark rounds the shortest decimal text of a double, so 0.35 (stored just below) would go up. The product with the
    power of ten is therefore taken together with its rounding error (splitting the double in two exact halves), and
    only a product that is exactly half-way is decided by that error or by evenness.
    """
    scale = float(10 ** digits)
    x = column.cast("double")
    spread = x * F.lit(134217729.0)
    high = spread - (spread - x)
    low = x - high
    product = x * F.lit(scale)
    error = (high * F.lit(scale) - product) + low * F.lit(scale)
    floor = F.floor(product).cast("double")
    fraction = product - floor
    up = F.when(fraction != 0.5, fraction > 0.5).when(error != 0.0, error > 0.0).otherwise(floor % 2 != 0)
    return F.when(F.abs(product) < F.lit(2.0 ** 50), (floor + F.when(up, 1.0).otherwise(0.0)) / scale).otherwise(x)


def fixed_text(column: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, rounded as Python formats floats."""
    return F.format_string(f"%.{digits}f", python_round(column, digits))


def signed_text(column: Column, digits: int) -> Column:
    return F.format_string(f"%+.{digits}f", python_round(column, digits))
