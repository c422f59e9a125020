"""Data checks as expressions and one-pass reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.functions.vectors import is_valid_embedding


def split_valid(df: DataFrame, vec_col: str, dims: int) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable embedding, and the rest for quarantine."""
    valid = is_valid_embedding(vec_col, dims)
    return df.where(valid), df.where(~valid)


def embedding_report(df: DataFrame, vec_col: str, dims: int) -> DataFrame:
    """``(n_dims, n_rows, n_valid, n_invalid)`` per array size; a null array has size null."""
    valid = is_valid_embedding(vec_col, dims)
    size = F.when(F.col(vec_col).isNotNull(), F.size(vec_col)).alias("n_dims")
    return df.groupBy(size).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(~valid).alias("n_invalid"),
    )


def assignment_report(df: DataFrame, cluster_col: str) -> DataFrame:
    """One row: rows, rows without a cluster, smallest and largest id, clusters in use."""
    cluster = F.col(cluster_col)
    per_cluster = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("n"))
    return per_cluster.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(cluster.isNull(), F.col("n"))), F.lit(0)).alias("n_unassigned"),
        F.min(cluster).alias("min_cluster"),
        F.max(cluster).alias("max_cluster"),
        F.count(cluster).alias("n_clusters"),
    )


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]
