"""Finding what is new: anti-join on ids, reconciliation, stable choice, batch numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from phrasegrove.functions.heaps import Nearest
from phrasegrove.operators.bounded import SALTS, hot_keys
from phrasegrove.operators.packed import merged

# Hex digits of the id's digest that order the batches: 16^4 = 65,536 buckets.
BUCKET_DIGITS = 4


def existing_ids(table: DataFrame, id_col: str = "id") -> DataFrame:
    return table.select(id_col).distinct()


def new_phrases(raw: DataFrame, existing: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows of ``raw`` whose id is not in ``existing``; copies and null ids stay.

    Rows with a null id match nothing, so they pass by the join and are not shuffled. An id that
    holds a large share of ``raw`` is spread over several tasks. The pieces are dealt out by row
    position, since hot rows may be copies of one another.
    """
    known = existing_ids(existing, id_col).where(F.col(id_col).isNotNull())
    named, nameless = raw.where(F.col(id_col).isNotNull()), raw.where(F.col(id_col).isNull())
    hot = [value for value in hot_keys(raw, id_col) if value is not None]
    if not hot:
        return named.join(known, id_col, "left_anti").unionByName(nameless)
    is_hot = F.col(id_col).isin(hot)
    position = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    pieces = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return (
        named.withColumn("_at", position)
        .withColumn("_piece", F.when(is_hot, F.col("_at")).otherwise(0))
        .join(known.withColumn("_piece", F.explode(pieces)), [id_col, "_piece"], "left_anti")
        .drop("_at", "_piece")
        .unionByName(nameless)
    )


def new_rows(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """One raw row per id of ``ids``, the distinct new ids found from the id columns.

    The ids go to the raw scan: broadcast when they are few, else as the smaller side of a join.
    What old phrases say is never grouped, and copies fall away before the grouping's shuffle.
    """
    return first_per_id(raw.join(ids.select("id"), "id", "left_semi"))


def first_per_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per id: the smallest by the other columns. Copies are dropped before the shuffle."""
    others = [c for c in df.columns if c != id_col]
    chosen = df.groupBy(id_col).agg(F.min(F.struct(*others)).alias("_row"))
    return chosen.select(id_col, "_row.*").select(*df.columns)


def rows_per_id(
    raw: DataFrame, existing: DataFrame, id_col: str = "id", textless: DataFrame | None = None
) -> DataFrame:
    """``(id, raw, known, settled)``: number of raw rows, whether the id is embedded, and how many
    raw rows it had when ``textless`` ``(id, raw)`` last recorded that none of them has a text.

    All sides are summed per id in one aggregate over the id columns alone; there is no join
    a frequent id could skew. Null is an id of its own and is never known.
    """

    def marks(df: DataFrame, key: str, raw_rows: Column | int, known: int, settled: Column | int) -> DataFrame:
        numbers = {"raw": raw_rows, "known": known, "settled": settled}
        as_columns = (F.lit(value).cast("long").alias(name) for name, value in numbers.items())
        return df.select(F.col(key).alias("id"), *as_columns)

    every = marks(raw, id_col, 1, 0, 0).unionByName(
        marks(existing.where(F.col(id_col).isNotNull()), id_col, 0, 1, 0)
    )
    if textless is not None:
        every = every.unionByName(marks(textless, "id", 0, 0, F.col("raw")))
    return every.groupBy("id").agg(
        F.sum("raw").alias("raw"), F.max("known").cast("int").alias("known"), F.max("settled").alias("settled")
    )


def is_new():
    """Of ``rows_per_id`` rows: an id with phrases, more than when it was found without a text, but
    no embedding."""
    return (F.col("known") == 0) & F.col("id").isNotNull() & (F.col("raw") > F.col("settled"))


def _total(value):
    return F.coalesce(F.sum(value), F.lit(0)).cast("long")


def reconcile(raw: DataFrame, existing: DataFrame, id_col: str = "id") -> DataFrame:
    """One row of counts: raw rows, those embedded, those new, existing ids, and existing ids
    and new rows together."""
    return (
        rows_per_id(raw, existing, id_col)
        .agg(
            _total(F.col("raw")).alias("total_raw"),
            _total(F.when(F.col("known") == 1, F.col("raw"))).alias("already_embedded"),
            _total(F.when(F.col("known") == 0, F.col("raw"))).alias("new_phrases"),
            _total(F.col("known")).alias("existing_ids"),
        )
        .withColumn("cumulative", F.col("existing_ids") + F.col("new_phrases"))
    )


def increment(raw: DataFrame, existing: DataFrame, id_col: str = "id") -> DataFrame:
    """One row: raw rows, those without an id, those embedded, and distinct new ids."""
    return increment_counts(rows_per_id(raw, existing, id_col))


def increment_counts(per_id: DataFrame) -> DataFrame:
    return per_id.agg(
        _total(F.col("raw")).alias("total_raw"),
        _total(F.when(F.col("id").isNull(), F.col("raw"))).alias("without_id"),
        _total(F.when(F.col("known") == 1, F.col("raw"))).alias("already_embedded"),
        F.count_if(is_new()).alias("new_ids"),
    )


def day_embeddings(stored_rows: DataFrame, fresh: DataFrame, id_col: str = "id") -> DataFrame:
    """The day's stored embeddings and the new ones together, each id once.

    Of an id in both the stored row stays; columns that one side lacks are null there.
    """
    more = fresh.join(existing_ids(stored_rows, id_col), id_col, "left_anti")
    return stored_rows.unionByName(more, allowMissingColumns=True)


def number_batches(
    df: DataFrame, batch_size: int, id_col: str = "id", digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Add ``batch_no``: ids in batches of exactly ``batch_size``, but for the last one.

    Ids are ordered by a digest bucket, then by value. Rows are counted within their bucket
    and start where the earlier buckets end, so no task sees more than a bucket; the running
    sum runs over the 16^digits bucket counts only. Ids must be unique.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(id_col).cast("string")), 1, digits))
    ends = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", (F.sum("_n").over(ends) - F.col("_n")).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(id_col)) - 1
    return (
        bucketed.withColumn("_place", place)
        .join(F.broadcast(starts), "_bucket")
        .withColumn("batch_no", F.floor((F.col("_start") + F.col("_place")) / batch_size))
        .drop("_bucket", "_place", "_start")
    )


def hash_sample(df: DataFrame, fraction: float, id_col: str = "id") -> DataFrame:
    """Keep about ``fraction`` of the ids, always the same ones however the rows are partitioned."""
    if fraction >= 1:
        return df
    bound = format(int(fraction * (1 << 32)), "08x")
    return df.where(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8) < bound)


def exact_sample(df: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """The rows of exactly ``n`` ids (of all, if fewer), always the same ones however the rows lie.

    These are the ids with the smallest digests. Tasks keep their n smallest digests, the tasks'
    are merged in two steps, and the largest one left is the bound that filters the rows; no row is
    counted first, and no row moves. Null ids are left out.
    """
    draw = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 15), 16, 10).cast("long")
    drawn = df.where(F.col(id_col).isNotNull()).withColumn("_draw", draw)
    order = Nearest(n, "_all", "_draw", "_id", distinct=True)
    ids = drawn.select(F.lit(0).alias("_all"), "_draw", F.col(id_col).cast("string").alias("_id"))
    schema = StructType([*ids.schema, StructField("position", IntegerType(), False)])
    kept = merged(ids.mapInArrow(order.partial, ids.schema), ["_all"], order.partial, order.numbered, schema)
    last = kept.agg(F.max(F.struct("_draw", "_id")).alias("last")).first()["last"]
    if last is None:
        return df.limit(0)
    within = (F.col("_draw") < last["_draw"]) | (
        (F.col("_draw") == last["_draw"]) & (F.col(id_col).cast("string") <= last["_id"])
    )
    return drawn.where(within).drop("_draw")
