"""Column-level vector helpers."""

from __future__ import annotations

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_valid_embedding(column: str, dims: int) -> Column:
    """True for an array of exactly ``dims`` elements with no null and no NaN among them.

    ``array_contains`` answers null for an array that holds a null, so one test covers both,
    and it stays in generated code where a lambda over the elements would not.
    """
    clean = F.array_contains(column, F.lit(float("nan")).cast("float")) == F.lit(False)
    return F.coalesce((F.size(column) == dims) & clean, F.lit(False))


def with_vector(df: DataFrame, array_col: str, vector_col: str) -> DataFrame:
    """Add the dense-vector form of an array column. Rows must be valid embeddings."""
    return df.withColumn(vector_col, array_to_vector(array_col))


def with_array(df: DataFrame, vector_col: str, array_col: str, kind: str = "float") -> DataFrame:
    return df.withColumn(array_col, vector_to_array(vector_col).cast(f"array<{kind}>"))


def l2_normalize(df: DataFrame, array_col: str, output_col: str) -> DataFrame:
    """Add ``array_col`` scaled to unit length as ``array<double>``; a zero vector stays zero."""
    unit = Normalizer(inputCol="_dense", outputCol="_unit", p=2.0)
    return (
        unit.transform(with_vector(df, array_col, "_dense"))
        .withColumn(output_col, vector_to_array("_unit"))
        .drop("_dense", "_unit")
    )


def squared_distance(left: str, right: str) -> Column:
    """Squared Euclidean distance of two array columns of the same row."""
    gaps = F.zip_with(
        left, right, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)
    )
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)
