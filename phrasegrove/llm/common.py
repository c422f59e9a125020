"""Small helpers that several operators share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phrasegrove.functions.memory import give_back
from phrasegrove.sources.shared import fresh_path

#: The white space of the contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: A word of the contracts, as a pattern that Java, Python and RE2 read alike.
WORD = "[^\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and go on from the written rows."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Shipped:
    """A file at a path of the driver, sent to the workers once; its size is fixed."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            content = file.read()
        self.key = hashlib.sha256(content).hexdigest()
        self.data = spark.sparkContext.broadcast(content)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts, null read as empty."""
    return ["" if text is None else text for text in batch.column(column).to_pylist()]


def free_name(taken: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores put before it until no column has that name.

    Spark resolves names without regard to case, so case does not tell names apart here.
    """
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted = "_" + wanted
    return wanted


#: Bytes of a batch's source column that are worked on at a time, about.
SLICE_BYTES = 4 << 20


#: What operators keep in this worker from task to task: how to drop it, by operator.
_kept: dict[str, Callable[[], object]] = {}


def keeps(operator: str, drop: Callable[[], object]) -> None:
    """Note that ``operator`` keeps something in this worker, which ``drop`` clears."""
    _kept[operator] = drop


def slices(
    batches: Iterator[pa.RecordBatch], column: str, slice_bytes: int = SLICE_BYTES, operator: str = ""
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``slice_bytes``, so that long texts do not add up.

    Workers go from one operator's tasks to another's: what others than ``operator`` keep is dropped.
    """
    for other in [name for name in _kept if name != operator]:
        _kept.pop(other)()
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, batch.num_rows * slice_bytes // max(1, batch.column(column).nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch  # else it stays while the next one is read
        give_back()


def lists_of(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """The column's arrays as numpy arrays, null read as empty."""
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0))
    ends = np.cumsum(sizes)
    return [flat[end - size : end] for end, size in zip(ends, sizes)]


def add_columns(
    df: DataFrame,
    column: str,
    added: str,
    make: Callable[[list], dict[str, pa.Array]],
    as_arrays: bool = False,
    keep: bool = True,
    slice_bytes: int = SLICE_BYTES,
    operator: str = "",
    done: Callable[[], object] | None = None,
) -> DataFrame:
    """``df`` with columns computed from the texts (or arrays) of ``column``, batch by batch.

    ``added`` is their schema in DDL; a column of the same name is replaced. Rows keep their
    order and their other columns; without ``keep``, ``column`` itself is left out. It is sent to the
    task once in any case. ``done`` is called when a task ends, to drop what it gathered: an executor has
    more workers than running tasks, and takes them in turn.
    """
    extra = T.StructType.fromDDL(added)
    gone = {field.name.lower() for field in extra} | (set() if keep else {column.lower()})
    kept = [field for field in df.schema if field.name.lower() not in gone]
    names = [field.name.lower() for field in kept]
    rows = df.select(*(f"`{field.name}`" for field in kept))
    source = column
    if column.lower() not in names:
        source = free_name([*df.columns, *(field.name for field in extra)], "_source")
        rows = df.withColumn(source, F.col(column)).select(*rows.columns, source)
    place = names.index(column.lower()) if column.lower() in names else len(kept)
    sent = rows.columns[place]
    schema = T.StructType([*kept, *extra])
    read = lists_of if as_arrays else texts_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in slices(batches, sent, slice_bytes, operator):
                made = make(read(batch, sent))
                arrays = [*batch.columns[: len(kept)], *(made[field.name] for field in extra)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
                del batch, made, arrays
        finally:
            if done:
                done()
                give_back()

    return rows.mapInArrow(run, schema)


def running_sum(df: DataFrame, key: str, chunk: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the earlier rows of a key, in two steps by ``chunk``."""
    before = F.sum("_s").over(Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1))
    starts = df.groupBy(key, chunk).agg(F.sum(value).alias("_s"))
    starts = starts.select(F.col(key), F.col(chunk), F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.sum(value).over(
        Window.partitionBy(key, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = df.withColumn("_inside", F.coalesce(inside, F.lit(0)))
    return rows.join(starts, [key, chunk]).withColumn(name, F.col("_start") + F.col("_inside")).drop("_start", "_inside")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def planes(values: np.ndarray) -> bytes:
    """The bytes of an integer array, first all lowest bytes, then all next ones.

    Bytes that are the same in all values stand together and the shuffle's compression
    removes them.
    """
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    flat = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(flat.T).view(dtype).ravel()
