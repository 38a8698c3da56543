"""Saved models and metric tables: each artifact is a Spark table or a Spark ML model under one folder."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, Row, SparkSession

MODEL = "model"


def save_artifacts(spark: SparkSession, artifacts: dict, folder: str) -> None:
    """Save models with their own writer, DataFrames as JSON tables, and plain dicts or lists as one-table JSON."""
    for name, value in artifacts.items():
        path = f"{folder}/{name}"
        if isinstance(value, MLWritable):
            value.write().overwrite().save(path)
        elif isinstance(value, DataFrame):
            value.write.mode("overwrite").json(path)
        else:
            rows = [Row(**value)] if isinstance(value, dict) else [Row(position=i, value=v) for i, v in enumerate(value)]
            spark.createDataFrame(rows).write.mode("overwrite").json(path)


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.json(f"{folder}/{name}")


def load_list(spark: SparkSession, folder: str, name: str) -> list:
    """A saved list, e.g. the feature names of a model, in its saved order."""
    return [r["value"] for r in load_table(spark, folder, name).orderBy("position").collect()]


def load_model(model_class, folder: str, name: str = MODEL):
    return model_class.load(f"{folder}/{name}")
