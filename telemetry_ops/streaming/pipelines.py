"""Streams of telemetry: flags, reports, features, drift and alert counts.

Event time is ``timestamp``; rows later than the watermark are left out. Within a micro-batch the rows of a key are
taken in (time, row id) order, and per-key state holds a fixed number of rows.
"""

from __future__ import annotations

import itertools
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from telemetry_ops.config import DriftConfig, FeatureConfig, QualityConfig
from telemetry_ops.functions import missing_to_null
from telemetry_ops.operators import features
from telemetry_ops.operators.drift import bin_index, psi_value, shares
from telemetry_ops.operators.merged import merge_counts
from telemetry_ops.operators.scan import exact_percentiles
from telemetry_ops.operators.quality import bounds_bit, is_outside, missing_bit

WATERMARK = "10 minutes"
SLICE_ROWS = 5000  # rows whose features are made at a time
SORT_ROWS = 50_000  # rows of a machine that a task sorts in memory; more are first ordered through a file


def stream_source(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet",
                  files_per_trigger: int = 1) -> DataFrame:
    """A folder of files as a stream of bounded micro-batches; event time becomes ``timestamp`` in the session zone."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    df = (reader.option("header", True).csv(path) if kind == "csv" else reader.parquet(path))
    df = missing_to_null(df)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp")) if "timestamp" in df.columns else df


def stream_flags(df: DataFrame, columns, cfg: QualityConfig | None = None) -> DataFrame:
    """Missing and out-of-bounds bits per row; stateless."""
    cfg = cfg or QualityConfig()
    return df.withColumn("_quality_flag", missing_bit(columns).bitwiseOR(bounds_bit(df, cfg.bounds)))


def stream_quality(df: DataFrame, columns, window: str = "1 hour", watermark: str = WATERMARK,
                   cfg: QualityConfig | None = None) -> DataFrame:
    """One report row per event-time window, emitted once the window is final."""
    cfg = cfg or QualityConfig()
    bounded = [c for c in cfg.bounds if c in columns]
    missing = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in columns), F.lit(0))
    outside = sum((is_outside(c, *cfg.bounds[c]).cast("int") for c in bounded), F.lit(0))
    return (df.withWatermark("timestamp", watermark).groupBy(F.window("timestamp", window).alias("w")).agg(
        F.count(F.lit(1)).alias("total_rows"), F.sum(missing).alias("missing"), F.sum(outside).alias("out_of_bounds"))
        .select(F.col("w.start").alias("window_start"), "total_rows", "missing", "out_of_bounds"))


def stream_value_counts(df: DataFrame, column: str, window: str = "1 hour", watermark: str = WATERMARK) -> DataFrame:
    """How often each value occurs per window. The state is spread over values, so no task holds a whole window."""
    return (df.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", window).alias("w"), F.col(column).cast("double").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "value", "n"))


def medians(counts: DataFrame) -> DataFrame:
    """Exact median per finished window from its value counts."""
    return exact_percentiles(counts, "window_start", "value", {"median_latency": 0.5}, weight="n")


def stream_ema(reports: DataFrame, stream_name: str, alpha: float = 0.3) -> DataFrame:
    """Moving average of the median latency over consecutive windows; the state is one number."""
    def fold(key, batches, state):
        average = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values("window_start")
        before, after = [], []
        for median in rows["median_latency"]:
            before.append(average)
            if median is not None and not np.isnan(median):
                average = median if average is None else alpha * median + (1 - alpha) * average
            after.append(average)
        if average is not None:
            state.update((float(average),))
        yield pd.DataFrame({"stream": key[0], "window_start": rows["window_start"].to_numpy(),
                            "ema_before": pd.Series(before, dtype="float64").to_numpy(),
                            "ema": pd.Series(after, dtype="float64").to_numpy()})

    keyed = reports.select(F.lit(stream_name).alias("stream"), "window_start", "median_latency")
    return keyed.groupBy("stream").applyInPandasWithState(
        fold, "stream string, window_start timestamp, ema_before double, ema double", "ema double", "append",
        "NoTimeout")


def arrow_column(values: pd.Series, kind: T.DataType) -> pa.Array:
    """A pandas column as the Arrow column of its Spark type."""
    if isinstance(kind, T.IntegralType):
        return pc.cast(pa.array(values, from_pandas=True), pa.int64())
    if isinstance(kind, T.TimestampType):
        return pc.cast(pa.array(values, from_pandas=True), pa.timestamp("us"))
    plain = {T.DoubleType: pa.float64(), T.StringType: pa.string(), T.BooleanType: pa.bool_()}.get(type(kind))
    return pa.array(values, plain, from_pandas=True)


def _used_up(parts):
    """The tables of a list, each let go of as it is taken, or of an iterator."""
    if not isinstance(parts, list):
        yield from parts
        return
    parts.reverse()
    while parts:
        yield parts.pop()


def _starts(batches):
    """Each batch with its first row's number."""
    start = 0
    for batch in batches:
        yield start, batch
        start += batch.num_rows


class History:
    """How history features of one machine go on from its kept rows to new ones; shared by the streaming forms."""

    def __init__(self, df: DataFrame, cfg: FeatureConfig):
        self.cfg = cfg
        self.fill = [c for c in cfg.fill_columns if c in df.columns]
        self.columns = [c for c in cfg.rolling_columns if c in df.columns]
        self.lagged = [c for c in cfg.lag_columns if c in df.columns]
        numeric = set(self.columns) | set(self.fill)
        self.base = df.select(*[F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in df.columns]) \
            .withColumn(features.POWER, features.power())
        self.passthrough = self.base.columns
        periods = sorted({*cfg.lag_periods, 1})
        lag_all = self.lagged + ([] if "tool_wear_min" in self.lagged else ["tool_wear_min"])
        self.keep = sorted(numeric | set(lag_all) | {features.POWER})
        self.function = features.history_function(
            "_one", "_pos", "_pos", self.fill, [(self.columns, tuple(cfg.windows)), ([features.POWER], (12,))], lag_all, periods,
            self.keep)
        self.names = [f"{c}_{s}_{k}" for c in self.columns for k in cfg.windows for s in ("mean", "std")]
        self.made = [*self.names, *[f"{features.POWER}_{s}_12" for s in ("mean", "std")],
                     *[f"{c}_lag_{p}" for c in lag_all for p in periods]]
        self.fields = list(self.base.schema.fields)

    def packed(self, part: pd.DataFrame) -> pa.Table:
        """Rows as typed columns; pandas turns whole numbers beside missing ones into floats."""
        return pa.table([arrow_column(part[f.name], f.dataType) for f in self.fields], names=self.passthrough)

    def slices(self, parts, rows: int = SLICE_ROWS):
        """Tables of one machine, as frames of at most so many rows in (time, row id) order. ``parts`` is used up, one table at a
        time; beyond ``SORT_ROWS`` rows no more than those are held, and 16 bytes for each row."""
        left, held, n = _used_up(parts), [], 0
        for table in left:
            held.append(table)
            n += table.num_rows
            if n > SORT_ROWS:
                yield from self._through_file(itertools.chain(_used_up(held), left), rows)
                return
        if n:
            yield from self._frames(pa.concat_tables(_used_up(held)), rows)

    def _order(self, table: pa.Table):
        return pc.sort_indices(table, [(self.cfg.time, "ascending"), (self.cfg.rid, "ascending")])

    def _frames(self, table: pa.Table, rows: int):
        table = table.combine_chunks()
        order = self._order(table)
        for start in range(0, len(order), rows):
            yield table.take(order[start:start + rows]).to_pandas()

    def _through_file(self, tables, rows: int):
        """As :meth:`slices`, a span of time after the other: every table is written in order, and each span is a piece of it.
        Rows of one time stay together."""
        with tempfile.TemporaryDirectory() as folder:
            path, times, writer = f"{folder}/rows", [], None
            with pa.OSFile(path, "wb") as sink:
                for table in tables:
                    if not table.num_rows:
                        continue
                    table = table.take(self._order(table)).combine_chunks()
                    writer = writer or pa.ipc.new_file(sink, table.schema)
                    writer.write_table(table)
                    at = pc.fill_null(table.column(self.cfg.time).cast(pa.int64()), np.iinfo("int64").max)  # missing: last
                    times += [at.to_numpy()[i:i + b.num_rows] for i, b in _starts(table.to_batches())]
                writer.close()
            cuts = np.unique(np.sort(np.concatenate(times))[SORT_ROWS::SORT_ROWS])
            edges = [np.concatenate([[0], np.searchsorted(at, cuts), [len(at)]]) for at in times]
            with pa.memory_map(path) as source:
                reader = pa.ipc.open_file(source)
                batches = [reader.get_batch(i) for i in range(reader.num_record_batches)]
                for k in range(len(cuts) + 1):
                    span = [b.slice(e[k], e[k + 1] - e[k]) for b, e in zip(batches, edges, strict=True) if e[k] < e[k + 1]]
                    if span:
                        yield from self._frames(pa.Table.from_batches(span), rows)

    def advance(self, new: pd.DataFrame, kept: list) -> tuple[pd.DataFrame, list]:
        """``new`` (in order) with its features, and the rows to keep; ``kept`` are the rows before."""
        old = pd.DataFrame(kept, columns=self.keep, dtype="float64")
        both = pd.concat([old, new], ignore_index=True)[self.passthrough]
        filled = both[self.keep].copy()
        if self.fill:
            filled[self.fill] = filled[self.fill].ffill()
        table = pa.Table.from_pandas(both[self.keep].astype("float64"), preserve_index=False)
        table = table.append_column("_one", pa.array(np.zeros(len(both), "int64")))
        table = table.append_column("_pos", pa.array(np.arange(len(both))))
        fresh = self.function(table).to_pandas().iloc[len(old):].reset_index(drop=True)
        rows = pd.concat([new[[c for c in new.columns if c not in fresh.columns]].reset_index(drop=True), fresh], axis=1)
        tail = filled.tail(self.cfg.back + 1).astype(object)
        return rows, tail.where(tail.notna(), None).to_numpy().tolist()

    def finished(self, done: DataFrame, keep=()) -> DataFrame:
        expected = F.col(f"{features.POWER}_mean_12")
        return done.select(
            *self.passthrough, *keep, *self.names, *[f"{c}_lag_{p}" for c in self.lagged for p in self.cfg.lag_periods],
            expected.alias("expected_power_W"),
            features.deviation(F.col(features.POWER), expected).alias("power_anomaly_score"),
            features.wear_step(F.col("tool_wear_min"), F.col("tool_wear_min_lag_1")).alias("tool_wear_rate"),
            features.thermal_efficiency().alias("thermal_efficiency_idx"),
            features.under_stress(F.lit(self.cfg.stress_fixed)).alias("error_under_stress"))


def stream_features(df: DataFrame, cfg: FeatureConfig | None = None) -> DataFrame:
    """History features per machine; the state keeps the last 36 rows of each machine, with forward-filled values.

    ``df`` is the aligned telemetry. Emits every row once, with the same columns as the batch features (stress uses
    the fixed limit). Rows that arrive before an already processed time are treated as newest, never re-emitted. Of a
    machine's rows in a micro-batch a task sorts ``SORT_ROWS`` at a time, as typed columns; features are made ``SLICE_ROWS`` rows at a time.
    """
    plan = History(df, cfg or FeatureConfig(stress_scope="fixed"))
    schema = T.StructType(plan.fields + [T.StructField(n, T.DoubleType()) for n in plan.made])
    state_schema = T.StructType([T.StructField("rows", T.ArrayType(T.ArrayType(T.DoubleType())))])
    base, plan.base = plan.base, None  # tasks are sent the rest

    def step(key, batches, state):
        tail = state.get[0] if state.exists else []
        for new in plan.slices(plan.packed(part) for part in batches):
            rows, tail = plan.advance(new, tail)
            state.update((tail,))
            yield rows[schema.names]

    return plan.finished(base.groupBy(plan.cfg.key).applyInPandasWithState(step, schema, state_schema, "append", "NoTimeout"))


def bin_counts(df: DataFrame, base: DataFrame, window: str, cfg: DriftConfig | None = None) -> DataFrame:
    """Bin counts per window and column against a saved baseline (a static table of one row per column)."""
    cfg = cfg or DriftConfig()
    columns = [c for c in cfg.columns if c in df.columns]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                for c in columns]))
    start = F.date_format(F.window("timestamp", window)["start"], "yyyy-MM-dd HH:mm:ss").alias("window_start")
    long = df.select(start, pairs.alias("p")).select("window_start", "p.*")
    binned = long.join(F.broadcast(base.select("column", "edges")), "column").withColumn(
        "bin", F.when(F.col("value").isNull(), -1).otherwise(bin_index(F.col("value"), F.col("edges"), cfg.bins)))
    return binned.groupBy("window_start", "column", "bin").agg(F.count(F.lit(1)).alias("n"))


def drift_from_counts(counts: DataFrame, base: DataFrame, cfg: DriftConfig | None = None) -> DataFrame:
    """Stability index per window and column from bin counts."""
    cfg = cfg or DriftConfig()
    per = counts.groupBy("window_start", "column").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"),
        F.sum(F.when(F.col("bin") >= 0, F.col("n")).otherwise(0)).alias("in_range"))
    return per.join(F.broadcast(base), "column").select(
        "window_start", "column",
        F.bround(psi_value(shares(cfg.bins, cfg.epsilon), F.col("proportions")), 6).alias("psi"))


def drift_sink(base: DataFrame, counts_path: str, emitted_path: str, window: str = "1 day",
               cfg: DriftConfig | None = None):
    """``foreachBatch`` function that keeps drift up to date while rows arrive.

    A batch's bin counts are merged into the table at ``counts_path``, and the stability index of the windows the batch
    touched, and of no others, is emitted to the batch's own folder. Rows may come late by any time: they reopen their
    window. A batch that is replayed adds nothing and emits the same rows again.
    """
    emit = idempotent_sink(emitted_path)

    def step(df: DataFrame, batch_id: int) -> None:
        touched = merge_counts(counts_path, bin_counts(df, base, window, cfg), "window_start", ["column", "bin"], ["n"],
                               batch_id)
        emit(drift_from_counts(touched, base, cfg), batch_id)
    return step


def latest_drift(emitted: DataFrame) -> DataFrame:
    """The last index emitted for each window and column."""
    return emitted.groupBy("window_start", "column").agg(F.max_by("psi", "batch").alias("psi"))


def stream_hourly(alerts: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Alerts and mean probability per hour of creation."""
    return (alerts.withWatermark("created_at", watermark).groupBy(F.window("created_at", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("alert_count"), F.avg("failure_prob").alias("avg_probability"))
            .select(F.col("w.start").alias("hour"), "alert_count", "avg_probability"))


def stream_align(system: DataFrame, application: DataFrame, key: str = "machine_id",
                 watermark: str = WATERMARK) -> DataFrame:
    """Left outer join of both streams on (time, machine); a row without a partner is emitted after the watermark."""
    new = [c for c in application.columns if c not in system.columns]
    left = system.withWatermark("timestamp", watermark)
    right = application.withWatermark("timestamp", watermark).select(
        F.col("timestamp").alias("_t"), F.col(key).alias("_k"), *new)
    return left.join(right, (F.col("timestamp") == F.col("_t")) & (F.col(key) == F.col("_k")), "leftOuter") \
        .drop("_t", "_k")


def without_repeats(alerts: DataFrame, rid: str = "id", time: str = "created_at",
                    watermark: str = WATERMARK) -> DataFrame:
    """Alerts with repeated deliveries of one id dropped; an id is remembered until the watermark has passed it."""
    return alerts.withWatermark(time, watermark).dropDuplicatesWithinWatermark([rid])


def idempotent_sink(path: str):
    """``foreachBatch`` function: a batch that is replayed replaces its own folder instead of being added again."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Process what is there now into an idempotent Parquet sink and stop."""
    return run_into(df, idempotent_sink(path), checkpoint, mode)


def run_into(df: DataFrame, sink, checkpoint: str, mode: str = "append"):
    """Process what is there now by a ``foreachBatch`` function and stop."""
    query = (df.writeStream.foreachBatch(sink).outputMode(mode)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def late_rows(query) -> int:
    """Rows the stateful steps of a query left out because they came after the watermark, over its recent batches."""
    return sum(int(state["numRowsDroppedByWatermark"]) for progress in query.recentProgress
               for state in progress["stateOperators"])
