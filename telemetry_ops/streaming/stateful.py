"""Streams whose state needs event-time timers: the quality gate by window, and history features by machine.

Both keep their state in RocksDB (:func:`rocksdb`) and act when the watermark passes a time, so rows may come in any
order until then; later ones are left out and counted by ``pipelines.late_rows``.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from telemetry_ops.config import FeatureConfig, QualityConfig
from telemetry_ops.operators.quality import is_outside, latency_columns
from telemetry_ops.operators.serving import cold_wear_rate, stand_ins
from telemetry_ops.streaming.pipelines import SLICE_ROWS, WATERMARK, History, arrow_column

_SETTING = "spark.sql.streaming.stateStore.providerClass"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """Timers and several states per key need this store; a query keeps the one it was started with."""
    before = spark.conf.get(_SETTING, None)
    spark.conf.set(_SETTING, _STORE)
    try:
        yield
    finally:
        spark.conf.unset(_SETTING) if before is None else spark.conf.set(_SETTING, before)


def weighted_median(values: np.ndarray, counts: np.ndarray) -> float:
    """Median of values that occur so many times each."""
    order = np.argsort(values)
    values, upto = values[order], np.cumsum(counts[order])
    low, high = (upto[-1] - 1) // 2, upto[-1] // 2
    return float((values[np.searchsorted(upto, low, "right")] + values[np.searchsorted(upto, high, "right")]) / 2)


class _Waiting:
    """Rows of one key that wait for the watermark, as Arrow blocks: a state entry holds thousands of rows, not one.

    One timer is due at a time, at the earliest row. When it expires all rows the watermark has passed are taken, so the rows
    are read once per move of the watermark, whatever the number of their times.
    """

    def __init__(self, handle, time: str):
        self.handle, self.time = handle, time
        self.blocks = handle.getMapState("blocks", "n long", "first long, rows binary")
        self.due = handle.getValueState("due", "at long")
        self.last = handle.getValueState("last", "n long")

    def _times(self, table: pa.Table) -> np.ndarray:
        return table.column(self.time).cast(pa.int64()).to_numpy()  # microseconds

    def add(self, table: pa.Table) -> None:
        if not table.num_rows:
            return
        first, n = int(self._times(table).min()), self.last.get()[0] + 1 if self.last.exists() else 0
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self.blocks.updateValue((n,), (first, sink.getvalue().to_pybytes()))
        self.last.update((n,))
        self._wake(first)

    def _wake(self, first: int) -> None:
        at = first // 1000 + 1
        if not self.due.exists() or at < self.due.get()[0]:
            self.handle.registerTimer(at)
            self.due.update((at,))

    def take(self, expired: int, limit: int) -> list[pa.Table]:
        """The rows before ``limit`` (microseconds); nothing for a timer that an earlier one replaced."""
        return list(self._passed(self.blocks.iterator, expired, limit))

    def take_in_turn(self, expired: int, limit: int):
        """As :meth:`take`, a table at a time: a block is asked for by its number, as an iterator over the state is sent
        thousands of entries at once. All must be taken."""
        return self._passed(lambda: ((n, self.blocks.getValue(n)) for n in list(self.blocks.keys())), expired, limit)

    def _passed(self, entries, expired: int, limit: int):
        if not self.due.exists() or expired != self.due.get()[0]:
            return
        limit, done, left, next_due = max(expired * 1000, limit), [], [], None
        for key, (first, rows) in entries():
            if first >= limit:
                next_due = first if next_due is None else min(first, next_due)
                continue
            table = pa.ipc.open_stream(bytes(rows)).read_all()
            ready = self._times(table) < limit
            left.append(table.filter(pa.array(~ready)))
            done.append(key)
            yield table if ready.all() else table.filter(pa.array(ready))
        for key in done:
            self.blocks.removeKey(key)
        self.due.clear()
        if next_due is not None:
            self._wake(next_due)
        if left:
            self.add(pa.concat_tables(left))


class _Gate(StatefulProcessor):
    """Per column: the moving average of window medians, and the value counts of windows that are not yet closed."""

    FIELDS = T.StructType().add("at", "timestamp").add("value", "double").add("n", "long").add("missing", "long").add("outside", "long")

    def __init__(self, alpha: float, multiplier: float):
        self.alpha, self.multiplier = alpha, multiplier

    def init(self, handle) -> None:
        self.handle = handle
        self.average = handle.getValueState("average", "ema double")
        self.open = _Waiting(handle, "at")

    def handleInputRows(self, key, rows, timerValues):
        for part in rows:
            self.open.add(pa.table([arrow_column(part[f.name], f.dataType) for f in self.FIELDS], names=self.FIELDS.names))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        taken = self.open.take(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() * 1000)
        if not taken:
            return
        held, out = pa.concat_tables(taken).to_pandas(), []
        for at, window in held.groupby("at", sort=True):
            average = self.average.get()[0] if self.average.exists() else None
            known = window[window["value"].notna()]
            values, counts = known["value"].to_numpy(float), known["n"].to_numpy("int64")
            spikes = 0 if average is None else int(counts[values > self.multiplier * average].sum())
            out.append((key[0], at, int(window["n"].sum()), int(window["missing"].sum()), int(window["outside"].sum()), spikes))
            if len(values):
                median = weighted_median(values, counts)
                self.average.update((median if average is None else self.alpha * median + (1 - self.alpha) * average,))
        yield pd.DataFrame(out, columns=["column", "at", "rows", "missing", "outside", "spikes"])

    def close(self) -> None:
        pass


def stream_gate(df: DataFrame, columns, window: str = "1 hour", watermark: str = WATERMARK,
                cfg: QualityConfig | None = None) -> DataFrame:
    """The quality report of every event-time window, once it is final: counts by column, latency spikes, score, passed.

    Three stateful steps in one stream. Values are counted by window, column and value (other than latencies by column only), so
    the state is spread over keys; per column, closed windows are taken in order by timers, spikes are the
    values above the average known before their window, and the average is moved on; the columns of a window are put
    together again. Equals the batch report with windows for chunks.
    """
    cfg = cfg or QualityConfig()
    columns = list(columns)
    spiky = [c for c in latency_columns(df) if c in columns]

    def item(c):
        value = F.col(c).cast("double") if c in spiky else F.lit(None).cast("double")
        outside = is_outside(c, *cfg.bounds[c]).cast("int") if c in cfg.bounds else F.lit(0)
        return F.struct(F.lit(c).alias("column"), value.alias("value"), F.col(c).isNull().cast("int").alias("missing"),
                        F.coalesce(outside, F.lit(0)).alias("outside"))

    long = df.withWatermark("timestamp", watermark).select("timestamp", F.explode(F.array(*map(item, columns))).alias("i"))
    counts = long.groupBy(F.window("timestamp", window).alias("w"), "i.column", "i.value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("i.missing").alias("missing"), F.sum("i.outside").alias("outside"))
    judged = counts.select(F.window_time("w").alias("at"), "column", "value", "n", "missing", "outside").groupBy(
        "column").transformWithStateInPandas(
        _Gate(cfg.ema_alpha, cfg.spike_multiplier),
        "column string, at timestamp, rows long, missing long, outside long, spikes long", "append", "EventTime",
        eventTimeColumnName="at")

    def by_column(name):
        return F.map_filter(F.map_from_entries(F.collect_list(F.struct("column", name))), lambda _, n: n > 0)

    whole = judged.groupBy(F.window("at", window).alias("w")).agg(
        F.max("rows").alias("total_rows"), by_column("missing").alias("missing_counts"),
        by_column("outside").alias("out_of_bounds_counts"), F.sum("spikes").alias("latency_spikes"),
        F.sum(F.col("missing") + F.col("outside") + F.col("spikes")).alias("issues"), F.max("missing").alias("worst"))
    return whole.select(
        F.col("w.start").alias("window_start"), "total_rows", "missing_counts", "out_of_bounds_counts", "latency_spikes",
        (1.0 - F.least(F.col("issues") / (F.col("total_rows") * (len(columns) + 1)), F.lit(1.0))).alias("quality_score"),
        (F.col("worst") / F.col("total_rows") * 100 <= cfg.max_missing_pct).alias("passed"))


class _Rows(StatefulProcessor):
    """Per machine: its last 36 rows, how many there were, and the rows that still wait for the watermark."""

    def __init__(self, plan: History, slice_rows: int):
        self.plan, self.slice_rows = plan, slice_rows

    def init(self, handle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "x array<double>")
        self.seen = handle.getValueState("seen", "n long")
        self.waiting = _Waiting(handle, self.plan.cfg.time)

    def handleInputRows(self, key, rows, timerValues):
        for part in rows:
            self.waiting.add(self.plan.packed(part))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # a row is final at the watermark itself
        ready = self.waiting.take_in_turn(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() * 1000 + 1)
        kept, seen = [], 0
        for i, rows in enumerate(self.plan.slices(ready, self.slice_rows)):
            if not i:
                kept, seen = [r[0] for r in self.recent.get()], self.seen.get()[0] if self.seen.exists() else 0
            out, kept = self.plan.advance(rows, kept)
            out["n_history"] = np.arange(seen + 1, seen + len(out) + 1)
            seen += len(out)
            yield out[[*self.plan.passthrough, "n_history", *self.plan.made]]
        if kept:
            self.recent.put([(row,) for row in kept])
            self.seen.update((seen,))

    def close(self) -> None:
        pass


def stream_history(df: DataFrame, cfg: FeatureConfig | None = None, watermark: str = WATERMARK, cold_start: bool = True,
                   slice_rows: int = SLICE_ROWS) -> DataFrame:
    """History features in event-time order: a row is final once the watermark has passed it.

    Rows of a machine wait in state until then, so they may come in any order; a row after the watermark is left out and
    counted. ``n_history`` numbers a machine's rows; with ``cold_start`` its first rows get the stand-ins of the serving
    features. A call works on at most ``slice_rows`` rows at a time. State: 36 rows a machine, and the rows of the
    watermark's span.
    """
    plan = History(df, cfg or FeatureConfig(stress_scope="fixed"))
    base, plan.base = plan.base, None  # tasks are sent the rest
    schema = T.StructType([*plan.fields, T.StructField("n_history", T.LongType()),
                           *[T.StructField(n, T.DoubleType()) for n in plan.made]])
    done = plan.finished(base.withWatermark(plan.cfg.time, watermark).groupBy(plan.cfg.key).transformWithStateInPandas(
        _Rows(plan, slice_rows), schema, "append", "EventTime"), ["n_history"])
    if not cold_start:
        return done
    replaced = stand_ins(done, plan.cfg)
    rate = F.when(F.col("n_history") < 2, cold_wear_rate(F.col("tool_wear_min"))).otherwise(
        F.coalesce("tool_wear_rate", F.lit(0.0)))
    return done.withColumns({**replaced, "tool_wear_rate": rate})
