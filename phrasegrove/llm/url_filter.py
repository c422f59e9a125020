"""URL verdicts: a blocked Bloom filter before an exact hash join. DataFrame operations only.

The list holds rules (host and path prefix with a verdict, for the host and its subdomains) and
whole canonical URLs that are blocked. Both are keyed by ``host || path``. A URL has as its keys
every suffix of its host at a dot with every prefix of its path that is as long as some rule's
path, and its own canonical form. The filter has a fixed number of 256-bit blocks; a key sets two
bits in each of the four words of one block. Its table is broadcast: ``BLOCKS`` rows of 36 bytes
at most, whatever the list's size. Keys that pass go to an exact join with the list, so a
false positive costs a row in a shuffle and nothing else; a longer list only makes more of them.

Each distinct (host, path) is judged once and joined back, and hot hosts and rules are plain
joins that the skew join can split.

Defined cases: null or no ``://``: host and path empty, so no rule fits; the longest fitting rule
wins, of equally long ones ``allow``; no rule: ``block`` if the canonical URL is listed (an empty one never is), else
``allow``; repeated rows are judged alike; empty tables and an empty list work; only the named
columns are read.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of the filter, a bound on the rows that are broadcast.
BLOCKS = 1 << 16
WORDS = 4


def host_and_path(url: str) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _block(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCKS)).cast("int")


def _masks(key: str) -> list[Column]:
    bit = "shiftleft(1L, cast(shiftright(xxhash64(`{0}`, 1), {1}) & 63 as int))"
    return [F.expr(f"{bit.format(key, 12 * w)} | {bit.format(key, 12 * w + 6)}") for w in range(WORDS)]


def build_filter(keys: DataFrame) -> DataFrame:
    """``(block, w0..w3)``: the blocks that have any bit set, from a column ``key``."""
    words = [mask.alias(f"w{i}") for i, mask in enumerate(_masks("key"))]
    rows = keys.where("key is not null").select(_block("key").alias("block"), *words)
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))


def may_hold(rows: DataFrame, bloom: DataFrame, out: str) -> DataFrame:
    """Add ``out``: whether the row's ``key`` may be in the filter; false is certain."""
    masks = _masks("key")
    test = " and ".join(f"(w{i} & m{i}) = m{i}" for i in range(WORDS))
    found = rows.withColumns({f"m{i}": m for i, m in enumerate(masks)}).withColumn("block", _block("key"))
    found = found.join(F.broadcast(bloom), "block", "left")
    return found.select(*rows.columns, F.coalesce(F.expr(test), F.lit(False)).alias(out))


def passing(rows: DataFrame, bloom: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be in the filter."""
    return may_hold(rows, bloom, "_held").where("_held").drop("_held")


def candidates(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """``(host, path, key, whole)``: all keys of each distinct URL."""
    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    rules = urls.withColumn("suffix", F.explode(suffixes))
    cuts = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    rules = rules.withColumn("cut", F.explode(cuts)).select(
        "host", "path", F.concat("suffix", F.expr("substring(path, 1, cut)")).alias("key"), F.lit(False).alias("whole")
    )
    return rules.union(urls.select("host", "path", F.concat("host", "path").alias("key"), F.lit(True).alias("whole")))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``.

    ``rules`` has ``(verdict, host, path)``, ``listed`` has ``(host, path)`` of blocked URLs.
    """
    split = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = host_and_path("url")
    split = split.select("page_id", host.alias("host"), path.alias("path"))
    entries = rules.select(F.concat("host", "path").alias("key"), F.length("path").alias("cut"), F.col("verdict"))
    entries = entries.groupBy("key", "cut").agg(F.min("verdict").alias("entry"))
    # As many numbers as there are different lengths of rule paths.
    lengths = sorted(r.cut for r in entries.select("cut").distinct().collect() if r.cut is not None)
    exact = entries.select("key", "entry", F.lit(False).alias("whole")).dropDuplicates(["key"]).union(
        listed.select(F.concat("host", "path").alias("key")).where("key <> ''").distinct().select(
            "key", F.lit("block").alias("entry"), F.lit(True).alias("whole")
        )
    )
    urls = split.where("host <> '' or path <> ''").select("host", "path").distinct()
    maybe = passing(candidates(urls, lengths), build_filter(exact))
    hits = maybe.join(exact, ["key", "whole"])
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct("key", "entry"), F.when(~F.col("whole"), F.length("key"))).alias("r"),
        F.bool_or("whole").alias("blocked"),
    )
    return split.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("r.key").alias("rule"),
        F.coalesce("r.entry", F.when(F.col("blocked"), "block"), F.lit("allow")).alias("verdict"),
    )
