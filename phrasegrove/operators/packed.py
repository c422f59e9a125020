"""Packed partial results of tasks, added up in a tree of two shuffles.

A task turns its rows into one packed row per key (a cluster, a tile), in numpy on Arrow batches. The
first shuffle deals these by key and piece, a piece being one of ``PIECES`` shares of the tasks, so
that a key all tasks have is no single group; the second deals by key alone. Each merge reads a
partition as a stream and holds one packed row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Merge = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

# About the root of the number of tasks that a large scan has.
PIECES = 64


def merged(
    parts: DataFrame,
    keys: list[str],
    merge: Merge,
    last: Merge | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """``parts`` merged by key; ``merge`` adds up the rows of a key that it meets.

    It gets batches with the columns of ``parts`` and gives such batches back. ``last``, if given,
    takes its place in the second step and gives rows of ``schema``.
    """
    pieces = parts.withColumn("_piece", F.spark_partition_id() % PIECES).repartition(*keys, "_piece")
    halfway = pieces.select(*(f"`{name}`" for name in parts.columns)).mapInArrow(merge, parts.schema)
    return halfway.repartition(*keys).mapInArrow(last or merge, schema or parts.schema)
