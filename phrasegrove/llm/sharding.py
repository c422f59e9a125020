"""K-d tree sharding by weighted medians. DataFrame operations only.

A node of the tree holds rows and the number of shards they are for. It is split along its widest
metadata dimension (ranges are taken relative to those of the whole table, the first one among equals)
at the weighted median, or the quantile that fits an odd number of shards, of the rows in order of that
dimension and then of id. A row goes to the left when the middle of its bytes in that order lies
at or before the cut. Splitting ends with one shard a node, that is when leaves have the target
bytes; all nodes of a level are split together.

A median is found without sorting. The rows of a node are summed by buckets of equal width along the
dimension, and the bucket that holds the cut is looked into by the next round, until it holds a single
row; where its rows are equal in the dimension, the next rounds go by the parts of the id, then by a
hash of the row, then by the row's number. So a value that a third of all rows has is no
group that one task gets. What a round leaves are some numbers per node, in tables that are written.

Slots follow from one sort by ranges over (shard, id, row): a row's place in its range plus the rows
of its shard in the ranges before.

Defined cases: a null text has size 8, as an empty one; nulls of a metadata column come last in it;
null ids come last; repeated rows are rows like others and may be parted; shards may stay empty when
there are fewer rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phrasegrove.llm.common import stored

#: Buckets of a node in a round, at most, and of all nodes of a level, about.
BUCKETS = 1 << 14
LEVEL_BUCKETS = 1 << 18
#: Bytes that a document costs besides its text. Fixed value of the contract.
OVERHEAD = 8
LAST = (1 << 63) - 1
#: Leading bytes of a string that make its coordinate.
PREFIX = 7

#: What orders the rows of a node: the dimension, id in two parts, hash, number of the row.
KEYS = ["k0", "k1", "k2", "k3", "k4"]


def coordinate(column: Column | str) -> Column:
    """A string as a number that keeps the order of its first bytes; null comes last."""
    digits = F.rpad(F.hex(F.substring(F.encode(F.col(column), "utf-8"), 1, PREFIX)), 2 * PREFIX, "0")
    return F.coalesce(F.conv(digits, 16, 10).cast("bigint"), F.lit(1 << 8 * PREFIX))


def _pick(index: Column, values: list[Column]) -> Column:
    out = F.when(index == 0, values[0])
    for k, value in enumerate(values[1:], 1):
        out = out.when(index == k, value)
    return out


def _share(total: Column, part: Column, whole: Column) -> Column:
    """``total * part div whole`` without the product."""
    return F.call_function("div", total, whole) * part + F.call_function("div", total % whole * part, whole)


def _first_states(rows: DataFrame, names: list[str]) -> DataFrame:
    """A row per node that is still to be split: its dimension, cut and the window of the search."""
    extremes = [f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]
    whole = rows.agg(*(F.max(c).alias(f"top_{c}") for c in names), *(F.min(c).alias(f"low_{c}") for c in names))
    nodes = rows.where("shards > 1").groupBy("node", "shards").agg(F.sum("size").alias("total"), *extremes)
    nodes = nodes.join(F.broadcast(whole))  # one row
    widths = F.array(
        *(
            F.coalesce(
                (F.col(f"max_{c}") - F.col(f"min_{c}")) / F.nullif(F.col(f"top_{c}") - F.col(f"low_{c}"), F.lit(0)),
                F.lit(0.0),
            )
            for c in names
        )
    )
    nodes = nodes.withColumn("widths", widths)
    dim = (F.array_position("widths", F.array_max("widths")) - 1).cast("int")
    left = F.floor(F.col("shards") / 2)
    return nodes.withColumn("dim", dim).select(
        "node",
        "dim",
        _share(F.col("total"), left, F.col("shards")).alias("cut"),
        F.lit(0).alias("at"),
        *(F.lit(LAST).alias(f"f_{k}") for k in KEYS),
        _pick(F.col("dim"), [F.col(f"min_{c}") for c in names]).alias("lo"),
        _pick(F.col("dim"), [F.col(f"max_{c}") for c in names]).alias("hi"),
        F.lit(0).cast("bigint").alias("before"),
        F.lit(False).alias("found"),
    )


def _keyed(rows: DataFrame, states: DataFrame, names: list[str]) -> DataFrame:
    """The rows of the states' nodes with the keys of their node's order."""
    return rows.join(states, "node").withColumn("k0", _pick(F.col("dim"), [F.col(c) for c in names]))


def _refined(rows: DataFrame, states: DataFrame, names: list[str], buckets: int) -> DataFrame:
    """The states of the unfinished nodes after one more round."""
    keyed = _keyed(rows, states, names)
    for k, key in enumerate(KEYS[:-1]):
        keyed = keyed.where((F.col("at") <= k) | (F.col(key) == F.col(f"f_{key}")))
    value = _pick(F.col("at"), [F.col(key) for key in KEYS])
    width = F.call_function("div", F.col("hi") - F.col("lo"), F.lit(buckets)) + 1
    keyed = keyed.withColumn("value", value).where("value between lo and hi")
    keyed = keyed.withColumn("bucket", F.call_function("div", F.col("value") - F.col("lo"), width))
    sums = keyed.groupBy("node", "bucket").agg(
        F.sum("size").alias("bytes"),
        F.count(F.lit(1)).alias("n"),
        F.max("value").alias("top"),
        *(F.min(key).alias(f"min_{key}") for key in KEYS),
        *(F.max(key).alias(f"max_{key}") for key in KEYS),
    )
    upto = Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.join(states, "node").withColumn("start", F.col("before") + F.coalesce(F.sum("bytes").over(upto), F.lit(0)))
    end = F.col("start") + F.col("bytes")
    held = F.struct("start", "bytes", "n", *(f"min_{key}" for key in KEYS), *(f"max_{key}" for key in KEYS))
    per_node = sums.groupBy("node").agg(
        F.max(F.when((F.col("start") < F.col("cut")) & (end > F.col("cut")), held)).alias("held"),
        F.max(F.when(end <= F.col("cut"), F.col("top"))).alias("left_top"),
    )
    new = states.join(per_node, "node")
    at = F.col("at")
    low, high = ([F.col(f"held.{end}_{key}") for key in KEYS] for end in ("min", "max"))
    # The cut lies between two buckets, or the bucket that holds it has one row.
    between = F.col("held").isNull()
    single = F.col("held.n") == 1
    middle = 2 * F.col("held.start") + F.col("held.bytes") <= 2 * F.col("cut")
    edge = F.when(between, F.coalesce("left_top", F.col("lo") - 1)).otherwise(
        _pick(at, low) - F.when(middle, 0).otherwise(1)
    )
    done = between | single
    # Otherwise the search goes on in the first key from ``at`` on in which the bucket's rows differ.
    following = F.coalesce(*(F.when((at <= k) & (low[k] < high[k]), F.lit(k)) for k in range(len(KEYS))))
    fixed = [
        F.when(F.lit(k) < at, F.col(f"f_{key}"))
        .when(done & (at == k), edge)
        .when(~done & (F.lit(k) < following), low[k])
        .otherwise(F.lit(LAST))
        .alias(f"f_{key}")
        for k, key in enumerate(KEYS)
    ]
    return new.select(
        "node",
        "dim",
        "cut",
        F.when(done, at).otherwise(following).alias("at"),
        *fixed,
        F.when(done, F.col("lo")).otherwise(_pick(following, low)).alias("lo"),
        F.when(done, F.col("hi")).otherwise(_pick(following, high)).alias("hi"),
        F.when(done, F.col("before")).otherwise(F.col("held.start")).alias("before"),
        done.alias("found"),
    )


def medians(rows: DataFrame, names: list[str], nodes: int) -> DataFrame:
    """``(node, dim, f_k0, ...)``: the last key that goes to the left, for each node with shards to split."""
    buckets = max(64, min(BUCKETS, LEVEL_BUCKETS // nodes))
    states = stored(_first_states(rows, names), "nodes")
    found = []
    while not states.isEmpty():
        states = stored(_refined(rows, states, names, buckets), "round")
        found.append(states.where("found"))
        states = states.where("not found")
    cuts = states if not found else found[0]
    for part in found[1:]:
        cuts = cuts.union(part)
    return cuts.select("node", "dim", *(f"f_{key}" for key in KEYS))


def split(rows: DataFrame, names: list[str], nodes: int) -> DataFrame:
    """The rows with the node and the shards of the next level."""
    columns = rows.columns
    cuts = stored(medians(rows, names, nodes), "cuts")
    keyed = rows.join(cuts, "node", "left").withColumn("k0", _pick(F.col("dim"), [F.col(c) for c in names]))
    left = F.struct(*KEYS) <= F.struct(*(F.col(f"f_{key}").alias(key) for key in KEYS))
    half = F.floor(F.col("shards") / 2).cast("int")
    node = F.when(F.col("shards") == 1, F.col("node")).when(left, F.col("node")).otherwise(F.col("node") + half)
    shards = F.when(F.col("shards") == 1, 1).when(left, half).otherwise(F.col("shards") - half)
    keyed = keyed.withColumns({"node": node.cast("int"), "shards": shards.cast("int")})
    return stored(keyed.select(*columns), "level")


def slots(rows: DataFrame) -> DataFrame:
    """The rows with ``slot``, their place within ``node`` in order of the id."""
    order = ["node", *KEYS[1:]]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()), "places")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    starts = placed.groupBy("node", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    upto = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("earlier", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    slot = F.col("place") - F.col("first") + F.col("earlier")
    return placed.join(starts.drop("n"), ["node", "part"]).withColumn("slot", slot)


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    metadata: tuple[str, ...] = ("source", "lang"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    ``shards`` is a number, or follows from ``target_bytes``. The dimensions are the size and the
    string columns of ``metadata``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = ["m0", *(f"m{k}" for k in range(1, len(metadata) + 1))]
    id_ = F.col(id_col).cast("bigint")
    rows = docs.select(
        id_.alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        *(coordinate(c).alias(f"m{k}") for k, c in enumerate(metadata, 1)),
        F.coalesce(F.shiftright(id_, 32), F.lit(1 << 31)).alias("k1"),
        F.coalesce(id_.bitwiseAND(F.lit((1 << 32) - 1)), F.lit(0)).alias("k2"),
        F.shiftrightunsigned(F.xxhash64(text, *metadata), 1).alias("k3"),
        F.monotonically_increasing_id().alias("k4"),
    )
    rows = stored(rows.withColumn("m0", F.col("size")), "sizes")
    if shards is None:
        shards = max(1, math.ceil((rows.agg(F.sum("size")).first()[0] or 0) / target_bytes))
    rows = rows.withColumns({"node": F.lit(0), "shards": F.lit(shards)})
    most, nodes = shards, 1
    while most > 1:
        rows = split(rows, names, nodes)
        most, nodes = most - most // 2, 2 * nodes
    return slots(rows).select("doc_id", "size", "text_crc32", F.col("node").alias("shard"), "slot")
