"""Near-duplicate vectors by randomly rotated binary codes with stored correction factors.

A unit vector is rotated into ``bits`` dimensions by a fixed random rotation; the signs are its
code. The code stands for the unit vector of its signs, whose inner product with the rotated
vector is stored as the correction factor. For another vector y, the inner product of the code
with the rotated y, over the factor, is an unbiased estimate of the cosine, and its error has a
known bound that shrinks with the square root of the bits. Pairs whose upper bound reaches
the threshold are computed exactly, in double precision; only these can link.

Pairs are looked for where ``width`` neighbouring bits of the codes are equal, at ``bands``
places. The width grows with the logarithm of the rows, and the bands follow from the chance that
two vectors just at the threshold share no band, at most ``1 - RECALL``. A pair that meets in
several bands counts in the first. Tasks give back a row per vector with its number of links and
one link to a smaller vector of its group, not the pairs. A band's group of more than ``TILE``
vectors is cut into tiles, and every two tiles meet in a group of their own.

Equal vectors are one class with a weight from the start. Defined cases: vectors that are null, zero
or hold null or non-finite components link with nothing, nor do vectors of different length; a null id
takes part, and the smallest id of a component is one that is not null, if any; repeated rows are
vectors like others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phrasegrove.llm.common import lists_of, stored
from phrasegrove.llm.components import components

#: Chance that a pair just at the threshold is met in some band.
RECALL = 0.999
#: Width of the confidence interval, in units of the estimate's spread.
SPREAD = 5.0
#: Vectors that meet pair by pair in one group, and rows a task gets at a time, about.
TILE = 2048
GROUP_ROWS = 8192
SEED = 20


def banding(rows: int, threshold: float) -> tuple[int, int]:
    """Width and number of the bands."""
    width = max(8, math.ceil(math.log2(max(2, rows))))
    agree = (1 - math.acos(threshold) / math.pi) ** width
    return width, math.ceil(math.log(1 - RECALL) / math.log(1 - agree))


@lru_cache(maxsize=4)
def rotation(bits: int, dims: int) -> np.ndarray:
    """``dims`` orthonormal columns in ``bits`` dimensions."""
    bits = max(bits, dims)
    normal = np.random.default_rng([SEED, bits, dims]).normal(size=(bits, dims))
    q, r = np.linalg.qr(normal)
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large and very small components keep their squares.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def encode(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (a row of 0 and 1 each) and correction factors of unit vectors."""
    rotated = vectors @ rotation(bits, vectors.shape[1]).T
    return rotated > 0, np.abs(rotated).sum(axis=1) / math.sqrt(rotated.shape[1])


def estimators(codes: np.ndarray, factors: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors whose inner product with a unit vector estimates the cosine, and the bounds' widths."""
    turn = rotation(codes.shape[1], dims)
    signs = np.where(codes, 1.0, -1.0) / math.sqrt(codes.shape[1])
    spread = np.sqrt(np.maximum(0, 1 - factors**2)) / factors / math.sqrt(max(1, codes.shape[1] - 1))
    return (signs @ turn) / factors[:, None], SPREAD * spread


def _codes(df: DataFrame, width: int, bands: int) -> DataFrame:
    """Add ``code`` (packed bits), ``factor`` and ``keys`` (a number per band) to ``(.., vec)``."""
    extra = T.StructType.fromDDL("code binary, factor double, keys array<bigint>")
    schema = T.StructType([*df.schema, *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = lists_of(batch, "vec")
            codes, factors, keys = [None] * len(rows), np.zeros(len(rows)), [None] * len(rows)
            sizes = np.array([len(r) for r in rows])
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                bits, factor = encode(unit(np.stack([rows[i] for i in at]).astype(np.float64)), width * bands)
                bands_of = bits[:, : width * bands].reshape(len(at), bands, width)
                numbers = bands_of @ (1 << np.arange(width, dtype=np.int64))
                packed = np.packbits(bits, axis=1)
                for j, i in enumerate(at):
                    codes[i], factors[i], keys[i] = packed[j].tobytes(), factor[j], numbers[j].tolist()
            made = [pa.array(codes, pa.binary()), pa.array(factors), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return df.mapInArrow(run, schema)


def _join_roots(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of linked places; roots are the smallest places."""
    while len(i):
        a, b = parent[i], parent[j]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        apart = parent[i] != parent[j]
        i, j = i[apart], j[apart]


def link_group(table: pa.Table, width: int, bands: int, threshold: float) -> pa.Table:
    """``(c, links, root)`` of the vectors that link in one group of rows of a band."""
    table = table.combine_chunks()
    number = table["c"].to_numpy()
    weight = table["m"].to_numpy()
    key, mine, dims = table["key"].to_numpy(), table["mine"].to_numpy(), table["dims"].to_numpy()
    order = np.lexsort((number, key, dims))
    band = table["band"][0].as_py()
    across = table["lo"][0].as_py() != table["hi"][0].as_py()
    rows = lists_of(table.to_batches()[0], "vec")
    codes = table["code"].to_pylist()
    factors = table["factor"].to_numpy()
    links, parent = np.zeros(len(number), np.int64), np.arange(len(number))
    for size in np.unique(dims):
        at = order[dims[order] == size]
        vectors = unit(np.stack([rows[i] for i in at]).astype(np.float64))
        bits = np.unpackbits(np.frombuffer(b"".join(codes[i] for i in at), np.uint8).reshape(len(at), -1), axis=1)
        bits = bits[:, : max(width * bands, int(size))].astype(bool)
        guess, spread = estimators(bits, factors[at], int(size))
        guess, query = guess.astype(np.float32), vectors.astype(np.float32)
        bits = bits[:, : width * bands].reshape(len(at), bands, width)
        keys, tile = key[at], mine[at]
        for step in range(1, len(at)):
            i = np.flatnonzero(keys[step:] == keys[:-step])
            if not len(i):
                break  # equal keys stand together
            j = i + step
            if across:
                other = tile[i] != tile[j]
                i, j = i[other], j[other]
            estimate = np.einsum("pd,pd->p", guess[i], query[j])
            near = estimate + spread[i] >= threshold - 1e-5
            i, j = i[near], j[near]
            exact = np.einsum("pd,pd->p", vectors[i], vectors[j])
            near = exact >= threshold
            i, j = i[near], j[near]
            first = (bits[i] == bits[j]).all(axis=2).argmax(axis=1) == band
            i, j = at[i[first]], at[j[first]]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            _join_roots(parent, i, j)
    some = links > 0
    return pa.table({"c": number[some], "links": links[some], "root": number[parent[some]]})


def near_vectors(df: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.coalesce(~bad & F.exists("vec", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("valid", valid)
    width, bands = banding(df.count(), threshold)
    classes = rows.where("valid").groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"))
    classes = classes.withColumn("c", F.monotonically_increasing_id()).withColumn("dims", F.size("vec"))
    classes = stored(_codes(classes, width, bands), "codes")

    placed = classes.select("c", "m", "dims", "vec", "code", "factor", F.posexplode("keys").alias("band", "key"))
    place = ["dims", "band", "key"]
    crowds = placed.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TILE)
    tiles = F.coalesce(F.ceil(F.col("n") / TILE), F.lit(1)).cast("int")
    placed = placed.join(crowds, place, "left").withColumn("tiles", tiles)
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("c"), "tiles").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    shift = max(0, width - max(0, math.ceil(math.log2(max(1, classes.count()) / GROUP_ROWS))))
    part = F.when(F.col("tiles") > 1, F.col("key")).otherwise(F.shiftright("key", shift))
    placed = placed.withColumns(
        {"part": part, "hot": F.col("tiles") > 1, "lo": F.least("mine", "other"), "hi": F.greatest("mine", "other")}
    ).drop("n", "tiles", "other")
    found = placed.groupBy("band", "hot", "part", "lo", "hi").applyInArrow(
        lambda table: link_group(table, width, bands, threshold), "c bigint, links bigint, root bigint"
    )
    found = stored(found, "links")
    linked = found.groupBy("c").agg(F.sum("links").alias("links"))
    joined = components(found, "c", "root")

    keyed = classes.select("c", "rep", "m", "vec")
    keyed = keyed.join(linked, "c", "left").join(joined.withColumnRenamed("node", "c"), "c", "left")
    keyed = keyed.withColumn("component", F.coalesce("component", "c"))
    least = keyed.groupBy("component").agg(F.min("rep").alias("component_id"))
    keyed = keyed.join(least, "component").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id", F.lit(True).alias("valid")
    )
    out = rows.join(keyed, ["vec", "valid"], "left")
    component = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
