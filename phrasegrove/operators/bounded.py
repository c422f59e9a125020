"""Small sides of an operation, costly functions, and keys that many rows share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.sources.shared import stored

# Bytes of a vector table that a task compares its points with at a time.
BLOCK_BYTES = 32 << 20

# Key pieces a hot key is spread over in a shuffle.
SALTS = 64

# A key with at least this share of a sample is hot, so at most 1,000 keys are. A sample of
# fewer rows, or a key with fewer of them, says nothing.
HOT_SHARE = 0.001
HOT_SAMPLE_ROWS = 1000
HOT_KEY_ROWS = 10


def pin(df: DataFrame) -> DataFrame:
    """Evaluate a frame once: it is written first and read from there ever after."""
    return stored(df, "pin")


def ship_blocks(
    small: DataFrame, key: str, prepare: Callable[[pa.Table], object], block_bytes: int | None = None
) -> list[Broadcast]:
    """The rows of a vector table sorted by ``key``, as broadcasts of at most ``BLOCK_BYTES`` each.

    Such a table has k x dims numbers, as the fitted model has that comes from the driver anyway;
    Spark refuses to fetch more than ``spark.driver.maxResultSize``.
    """
    table = small.toArrow().sort_by(key)
    rows = max(1, (block_bytes or BLOCK_BYTES) * table.num_rows // max(1, table.nbytes))
    context = small.sparkSession.sparkContext
    starts = range(0, max(1, table.num_rows), rows)
    return [context.broadcast(prepare(table.slice(at, rows).combine_chunks())) for at in starts]


def each_block(shipped: list[Broadcast]) -> Iterator:
    """The blocks' contents one after the other; of several, a task holds one at a time."""
    for block in shipped:
        yield block.value
        if len(shipped) > 1:
            vars(block).pop("_value", None)


def once(function):
    """Have a costly function run once per row.

    Of a deterministic one the optimizer puts a copy below every filter on its result, and
    both run. This keeps such filters above it.
    """
    return function.asNondeterministic()


def left_join_dimension(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join with a dimension that has one row per key.

    Spark broadcasts the dimension when its size allows; otherwise the skew join splits the
    facts of a large cluster.
    """
    return facts.join(dimension, key, "left")


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, fraction: float = 0.01) -> list:
    """Keys, null among them, that hold at least ``share`` of a sample of the rows.

    They only steer how work is spread; no result depends on them. At most 1/share keys can
    qualify. Only the key column is read.
    """
    counts = (
        df.select(key)
        .sample(fraction, seed=42)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total, top = counts.agg(F.sum("n"), F.max("n")).first()
    if not total or total < HOT_SAMPLE_ROWS:
        return []
    floor = max(HOT_KEY_ROWS, share * total)
    if top < floor:
        return []
    return [row[0] for row in counts.where(F.col("n") >= floor).take(int(1 / share) + 1)]
