"""Saving, loading and finding fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind=PipelineModel):
    return kind.load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whichever file system its scheme names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
