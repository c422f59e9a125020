"""Exact dedup by a minimal perfect hash over the distinct digests of history.

``build_index`` turns the groups of a historical table into an index: the digests are dealt to
buckets, and each bucket gets a minimal perfect hash (a cascade of bit arrays in which only
digests that collide with no other are set; a digest's slot is the rank of its bit). A slot holds
the full digest and the locator of the group's winner. ``merge`` looks other groups up: the hash
gives a slot for any digest, the 32 bytes stored there tell members from others. Members are
merged with their slot, nonmembers stay groups of their own.

Defined cases: a null text counts as empty; texts equal after deleting white space are one group;
of equal texts the one with the most code points stays, then the smallest id (a null id last);
repeated rows are members like others; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phrasegrove.llm.common import SPACES, mix64, stored, text_or_empty

#: Distinct digests of one bucket, about; a bucket is built and probed by one task.
BUCKET_KEYS = 1 << 15
#: Bits per digest that is still to be placed, at each level of the cascade.
GAMMA = 2.0

GROUPS = "digest binary, keep_length bigint, keep_id bigint, n bigint"
INDEX = "bucket int, sizes array<int>, bits binary, digests binary, lengths array<bigint>, ids array<bigint>, counts array<bigint>"


def normalized(column: str) -> Column:
    return F.translate(text_or_empty(column), SPACES, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, length)``: SHA-256 of the normalised text, code points of the original."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(normalized(text_col), 256)).alias("digest"),
        F.length(text_or_empty(text_col)).cast("bigint").alias("length"),
    )


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the winner's locator and the number of rows (aggregated map-side)."""
    best = F.min(F.struct((-F.col("length")).alias("l"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("i")))
    return rows.groupBy("digest").agg(best.alias("b"), F.count(F.lit(1)).alias("n")).select(
        "digest", (-F.col("b.l")).alias("keep_length"), F.col("b.i").alias("keep_id"), "n"
    )


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def _positions(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    mixed = mix64(keys[:, 0] ^ mix64(keys[:, 1] + salt))
    return (mixed % np.uint64(size)).astype(np.int64)


def build_slots(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and all their bits, for distinct digests as rows of four integers."""
    sizes, bits, left, level = [], [], keys, 0
    while len(left):
        size = max(8, int(GAMMA * len(left)))
        at = _positions(left, level, size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
        level += 1
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def find_slots(keys: np.ndarray, sizes, bits: np.ndarray) -> np.ndarray:
    """The slot of each digest; -1 where no level has its bit (surely no member)."""
    rank = np.cumsum(bits) - 1
    slot, open_, start = np.full(len(keys), -1), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = _positions(keys[open_], level, size) + start
        hit = bits[at]
        slot[open_[hit]] = rank[at[hit]]
        open_, start = open_[~hit], start + size
    return slot


def _as_keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(-1, 4)


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The index of a table of groups, one row per bucket."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        keys = _as_keys(part.digest)
        sizes, bits = build_slots(keys)
        order = np.argsort(find_slots(keys, sizes, bits))
        ids = part.keep_id.astype("Int64").iloc[order]
        row = {
            "bucket": int(part.bucket.iloc[0]),
            "sizes": sizes,
            "bits": np.packbits(bits).tobytes(),
            "digests": keys[order].tobytes(),
            "lengths": part.keep_length.to_numpy()[order].tolist(),
            "ids": [None if pd.isna(x) else int(x) for x in ids],
            "counts": part.n.to_numpy()[order].tolist(),
        }
        return pd.DataFrame([row])

    return history.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInPandas(build, INDEX)


def merge(index: DataFrame, fresh: DataFrame, buckets: int) -> DataFrame:
    """All groups of index and ``fresh`` together, each digest once.

    ``member`` tells whether history held the digest.
    """

    def probe(slots: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        out = new[["digest", "keep_length", "keep_id", "n"]].assign(member=False)
        if not len(slots):
            return out
        row = slots.iloc[0]
        stored_keys = np.frombuffer(row.digests, np.uint64).reshape(-1, 4)
        held = pd.DataFrame(
            {
                "digest": [k.tobytes() for k in stored_keys],
                "keep_length": list(row.lengths),
                "keep_id": pd.array([None if pd.isna(x) else int(x) for x in row.ids], "Int64"),
                "n": list(row.counts),
                "member": True,
            }
        )
        if not len(new):
            return held
        keys = _as_keys(new.digest)
        bits = np.unpackbits(np.frombuffer(row.bits, np.uint8), count=int(sum(row.sizes))).astype(bool)
        slot = find_slots(keys, row.sizes, bits)
        member = slot >= 0
        member[member] = (stored_keys[slot[member]] == keys[member]).all(axis=1)
        at, hits = slot[member], out[member]
        old = held.iloc[at]
        inf = np.iinfo(np.int64).max
        old_id, new_id = old.keep_id.fillna(inf).to_numpy(), hits.keep_id.astype("Int64").fillna(inf).to_numpy()
        longer = hits.keep_length.to_numpy() > old.keep_length.to_numpy()
        tied = hits.keep_length.to_numpy() == old.keep_length.to_numpy()
        better = longer | (tied & (new_id < old_id))
        ids, lengths, counts = held.keep_id.array, held.keep_length.to_numpy().copy(), held.n.to_numpy().copy()
        ids[at[better]] = hits.keep_id.astype("Int64").array[better]
        lengths[at[better]] = hits.keep_length.to_numpy()[better]
        counts[at] += hits.n.to_numpy()
        held = held.assign(keep_id=ids, keep_length=lengths, n=counts)
        rest = out[~member].assign(keep_id=lambda f: f.keep_id.astype("Int64"))
        return pd.concat([held, rest], ignore_index=True)

    new = fresh.withColumn("bucket", _bucket(buckets))
    return index.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInPandas(probe, GROUPS + ", member boolean")


def exact_dedup(history: DataFrame, fresh: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of both tables: ``doc_id, keep_id, group_size, kept, text_sha256, historical``.

    ``kept`` marks the winner's row; of repeated rows with the winner's id all are marked.
    Texts are digested once and not shuffled; what moves is 48 bytes a row. The join that
    brings a group's result to its rows is a plain one, so a group with very many rows is split
    by the skew join.
    """
    old = digests(history, id_col, text_col).withColumn("historical", F.lit(True))
    rows = stored(old.union(digests(fresh, id_col, text_col).withColumn("historical", F.lit(False))), "digests")
    past = stored(groups(rows.where("historical")), "history")
    buckets = max(1, -(-past.count() // BUCKET_KEYS))
    index = stored(build_index(past, buckets), "index")
    merged = merge(index, groups(rows.where("not historical")), buckets)
    return rows.join(merged, "digest").select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "historical",
    )
