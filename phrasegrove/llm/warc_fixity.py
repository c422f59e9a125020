"""Fixity audit of archive replicas by Merkle trees over records and offset ranges.

A manifest has a row per record: file, offset, length and SHA-256 of the record's bytes. Its tree:
level 0 hashes the records that begin in each range of ``RANGE`` bytes, in order of their offsets;
every further level hashes ``FAN`` neighbouring nodes, up to one root per file. Two replicas are
compared at the roots; only children of nodes that differ are compared further, and only records
of ranges that differ are compared one by one. A node gathers at most ``FAN`` children, a range
what begins in ``RANGE`` bytes (a record has over 90), so no task holds a file.

Defined cases: a null url or body is empty; a null id is an id (its records are one file);
repeated rows are records of their own; equal replicas, empty ones and a replica without a file
work; extra columns are ignored. A record present on one side only is ``missing`` or ``added``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phrasegrove.llm.common import running_sum, stored

#: Bytes of an offset range, and children of a node.
RANGE = 1 << 16
FAN = 16
#: Ids that share a file.
FILE_IDS = 1000


def warc_record(url: Column, body: Column) -> Column:
    """The record's bytes, as text: header fields, an empty line, the body, two line ends."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def place(records: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Add ``file`` and ``offset`` to rows with ``digest`` and ``length``.

    Within a file records stand by the MD5 of their id, then by digest. Offsets are sums in two
    steps, so the records of one id, or of none, may be any number.
    """
    file = F.coalesce(F.floor(F.col(id_col) / FILE_IDS), F.lit(-1)).cast("bigint")
    spot = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = records.withColumn("file", file).withColumn("spot", F.concat(spot, "digest"))
    rows = rows.withColumn("chunk", F.concat(F.substring("spot", 1, 2), F.substring("digest", 1, 2)))
    order = [F.col("spot"), F.col("length")]
    return running_sum(rows, "file", "chunk", order, F.col("length"), "offset").drop("spot", "chunk")


def ranges(manifest: DataFrame) -> DataFrame:
    """Level 0: ``(file, at, hash)`` of each range in which a record begins."""
    leaf = F.struct("offset", "length", "digest")
    listed = F.transform(F.array_sort(F.collect_list(leaf)), lambda r: F.concat_ws(":", r["offset"], r["length"], r["digest"]))
    at = F.floor(F.col("offset") / RANGE).cast("bigint")
    rows = manifest.groupBy("file", at.alias("at")).agg(listed.alias("l"))
    return rows.select("file", "at", F.sha2(F.concat_ws("|", "l"), 256).alias("hash"))


def parents(nodes: DataFrame) -> DataFrame:
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda n: F.concat_ws(":", n["at"], n["hash"]))
    up = nodes.groupBy("file", F.floor(F.col("at") / FAN).cast("bigint").alias("at")).agg(listed.alias("l"))
    return up.select("file", "at", F.sha2(F.concat_ws("|", "l"), 256).alias("hash"))


def tree(manifest: DataFrame, levels: int) -> list[DataFrame]:
    """The levels of a manifest's trees, ranges first, roots last."""
    nodes = [stored(ranges(manifest), "ranges")]
    for _ in range(levels - 1):
        nodes.append(parents(nodes[-1]))
    return nodes


def height(*manifests: DataFrame) -> int:
    """Levels until every file has a single node."""
    tops = [m.agg(F.max("offset")).first()[0] or 0 for m in manifests]
    nodes, levels = max(tops) // RANGE + 1, 1
    while nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose hash is not the same on both sides."""
    left = a.select(*keys, F.col("hash").alias("x"))
    return left.join(b.select(*keys, F.col("hash").alias("y")), keys, "full").where("not x <=> y").select(*keys)


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(file, offset, status, a_digest, b_digest)`` of the records that differ.

    ``status`` is ``changed``, ``missing`` (not in ``b``) or ``added`` (not in ``a``).
    """
    levels = height(a, b)
    tree_a, tree_b = tree(a, levels), tree(b, levels)
    bad = _differing(tree_a[-1], tree_b[-1], ["file", "at"])
    for level in reversed(range(levels - 1)):
        under = bad.select("file", F.col("at").alias("up"))

        def below(nodes: DataFrame) -> DataFrame:
            rows = nodes.withColumn("up", F.floor(F.col("at") / FAN).cast("bigint"))
            return rows.join(under, ["file", "up"], "left_semi")

        bad = _differing(below(tree_a[level]), below(tree_b[level]), ["file", "at"])

    def suspects(manifest: DataFrame) -> DataFrame:
        rows = manifest.withColumn("at", F.floor(F.col("offset") / RANGE).cast("bigint"))
        rows = rows.join(bad, ["file", "at"], "left_semi")
        return rows.select("file", "offset", F.concat_ws(":", "length", "digest").alias("hash"), "digest")

    one, two = suspects(a), suspects(b)
    both = one.select("file", "offset", F.col("hash").alias("x"), F.col("digest").alias("a_digest")).join(
        two.select("file", "offset", F.col("hash").alias("y"), F.col("digest").alias("b_digest")),
        ["file", "offset"],
        "full",
    )
    status = F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "added").otherwise("changed")
    return both.where("not x <=> y").select("file", "offset", status.alias("status"), "a_digest", "b_digest")
