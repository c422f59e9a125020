"""Preconditions of the jobs: all are tried, and one error names every failure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phrasegrove.operators.quality import missing_columns
from phrasegrove.params import ClusterParams
from phrasegrove.sources.models import path_exists
from phrasegrove.sources.tables import table_exists


class PreconditionError(ValueError):
    pass


def not_empty(df: DataFrame, label: str) -> list[str]:
    return [f"{label} has no rows"] if df.isEmpty() else []


def has_columns(df: DataFrame, columns: list[str], label: str) -> list[str]:
    missing = missing_columns(df, columns)
    return [f"{label} lacks columns {missing}; it has {df.columns}"] if missing else []


def usable_table(spark: SparkSession, name: str, columns: list[str]) -> list[str]:
    """The table exists, has the columns and has rows."""
    if not table_exists(spark, name):
        return [f"table {name} does not exist"]
    df = spark.table(name)
    return has_columns(df, columns, name) + not_empty(df, name)


def level_order(params: ClusterParams) -> list[str]:
    if params.k_n1 > params.k_n2 > params.k_n3 > 1:
        return []
    return [f"cluster numbers must fall from level to level and exceed 1: {params.level_ks}"]


def model_present(spark: SparkSession, path: str) -> list[str]:
    try:
        return [] if path_exists(spark, path) else [f"no model at {path}"]
    except Exception as error:
        return [f"cannot look up {path}: {error}"]


def path_usable(spark: SparkSession, path: str) -> list[str]:
    """Whether the file system of ``path`` answers; the path itself may not exist yet."""
    try:
        path_exists(spark, path)
        return []
    except Exception as error:
        return [f"cannot reach {path}: {error}"]


def require(*findings: list[str]) -> None:
    failures = [text for found in findings for text in found]
    if failures:
        raise PreconditionError("; ".join(failures))
