"""Helpers the operators share: table access, folds, and Arrow maps that hold a bounded slice of texts at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from telemetry_ops.scratch import written

__all__ = ["arrow_type", "by_size", "fold", "map_texts", "slices", "table", "with_row_ids", "written"]

BROADCAST_ITEMS = 200_000  # rows, or list entries, that a join's smaller side may have to be sent to every task

_ARROW = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(),
          T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.BooleanType(): pa.bool_()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text (remainder 0)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def with_row_ids(df: DataFrame, name: str, label: str = "rows") -> DataFrame:
    """Add a unique row id and write the table, so that every later reader sees the same ids."""
    return written(df.withColumn(name, F.monotonically_increasing_id()), label)


def by_size(side: DataFrame, weight: Column | int = 1, most: int = BROADCAST_ITEMS) -> DataFrame:
    """Write the smaller side of a join and mark it for broadcast if its weights add up to at most ``most``.

    Beyond that the mark is left out and the join shuffles, so nothing is broadcast whose size was not counted.
    """
    side = written(side, "side")
    total = side.agg(F.coalesce(F.sum(weight if isinstance(weight, Column) else F.lit(weight)), F.lit(0))).first()[0]
    return F.broadcast(side) if total <= most else side


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return _ARROW[kind]


def slices(batch: pa.RecordBatch, text: int, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of at most ``rows`` rows and about ``size`` bytes of the text column (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and (i - start >= rows or held + n > size):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield batch.slice(start)


def map_texts(df: DataFrame, text: str, keys: list[str], fields: list[tuple[str, T.DataType]],
              make: Callable[[], Callable[[list[bytes]], dict]], rows: int = 512, size: int = 4 << 20) -> DataFrame:
    """``keys`` of every row plus ``fields`` computed from its whole text (UTF-8; a null text is empty).

    ``make`` runs once in each task and returns a function from a slice of texts to one list per field, in row order.
    Other columns of ``df`` are not read, so their names cannot clash.
    """
    schema = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys]
                          + [T.StructField(n, kind) for n, kind in fields])
    names = [f.name for f in schema]
    kinds = [arrow_type(kind) for _, kind in fields]
    asked = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    source = df.select(*asked, F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    at = len(keys)

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, at, rows, size):
                out = work(part.column(at).to_pylist())
                made = [pa.array(out[n], kind) for (n, _), kind in zip(fields, kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(at)), *made], names=names)

    return source.mapInArrow(run, schema)
