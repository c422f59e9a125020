"""Declared table schemas, and the projection that makes a frame fit one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_LEVELS = (1, 2, 3)

# The tables' columns, their order, types and nullability.


def _col(name, kind, required=False):
    return StructField(name, kind, not required)


RAW = StructType([_col("id", StringType()), _col("frase", StringType())])

EMBEDDINGS = StructType(
    [
        _col("id", StringType(), True),
        _col("frase", StringType(), True),
        _col("embedding", ArrayType(FloatType()), True),
        _col("created_at", TimestampType(), True),
    ]
)

OUTPUT = StructType(
    EMBEDDINGS.fields[:3]
    + [
        field
        for n in _LEVELS
        for field in (
            _col(f"cluster_n{n}", IntegerType()),
            _col(f"nome_n{n}", StringType()),
            _col(f"dor_n{n}", StringType()),
        )
    ]
    + [_col("processed_at", TimestampType(), True)]
)

# What a job could not use; not one of the fixed schemas.
QUARANTINE = StructType(
    [
        _col("id", StringType()),
        _col("frase", StringType()),
        _col("embedding", ArrayType(FloatType())),
        _col("reason", StringType(), True),
        _col("processed_at", TimestampType(), True),
    ]
)

# Vectors of texts by the SHA-256 of the text; not one of the fixed schemas.
DIGESTS = StructType(
    [
        _col("digest", StringType(), True),
        _col("embedding", ArrayType(FloatType()), True),
        _col("created_at", TimestampType(), True),
    ]
)

# Ids that had no text, with the number of their raw rows then; not one of the fixed schemas.
TEXTLESS = StructType(
    [_col("id", StringType(), True), _col("raw", LongType(), True), _col("created_at", TimestampType(), True)]
)

MAPPING = StructType([_col(f"cluster_n{n}", IntegerType(), True) for n in _LEVELS])

NAMES = StructType(
    [
        _col("cluster_id", IntegerType(), True),
        _col("nivel", IntegerType(), True),
        _col("nome", StringType()),
        _col("dor", StringType()),
        _col("trained_at", TimestampType(), True),
    ]
)

METRICS = StructType(
    [_col("run_id", StringType(), True), _col("trained_at", TimestampType(), True)]
    + [_col(f"k_n{n}", IntegerType()) for n in _LEVELS]
    + [_col(f"silhouette_n{n}", FloatType()) for n in _LEVELS]
    + [_col(f"inertia_n{n}", FloatType()) for n in _LEVELS]
    + [_col("total_records", LongType()), _col("pca_dims", IntegerType())]
)


def conform(df: DataFrame, schema: StructType, *extra: str) -> DataFrame:
    """Select, order and cast to ``schema``; a nullable column that is missing becomes null.

    ``extra`` names columns to keep behind the declared ones, such as a partition column.
    """
    missing = [f.name for f in schema if not f.nullable and f.name not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    declared = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return df.select(*declared, *extra)
