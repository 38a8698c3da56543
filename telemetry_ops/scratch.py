"""Tables written to shared storage to cut lineage, so that a lost executor never changes or repeats earlier work."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_TAG = "telemetry_ops-" + uuid.uuid4().hex


_local_folder: str | None = None
_passing: list[list] = []  # (session, path) of what is written inside each open ``dropped_after``


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode, where it may be unset."""
    global _local_folder
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
        _local_folder = _local_folder or tempfile.mkdtemp(prefix="telemetry_ops-")
        folder = _local_folder
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{_TAG}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str = "table", keep: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the table read back.

    Preferred to ``checkpoint()`` because later readers prune columns and push filters. ``keep``: a table written inside
    :func:`dropped_after` outlives it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if _passing and not keep:
        _passing[-1].append((spark, path))
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(df: DataFrame) -> None:
    """Delete a table as it came from :func:`written`; nothing may read it later."""
    _delete(df.sparkSession, df.written_to)


@contextlib.contextmanager
def dropped_after():
    """Delete, at the end, every table written inside by :func:`written`: no DataFrame made there may be read later."""
    paths: list = []
    _passing.append(paths)
    try:
        yield
    finally:
        _passing.remove(paths)
        for spark, path in paths:
            _delete(spark, path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """What a query inside shuffles is deleted when it ends, not when the driver's garbage happens to be collected."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def drop_written(spark: SparkSession) -> None:
    """Delete every table this process wrote with :func:`written`."""
    _delete(spark, f"{shared_folder(spark)}/{_TAG}")
