"""K-d tree shards against a plain recursive splitting of sorted rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from phrasegrove.llm import sharding
from phrasegrove.llm.queries import op12_kd_sharding

SCHEMA = "doc_id bigint, text string, lang string, source string"


def place(text):
    return 1 << 56 if text is None else int.from_bytes(text.encode()[:7].ljust(7, b"\0"), "big")


def brute(rows, shards):
    """Sorted lists in place of histograms."""
    points = []
    for doc_id, text, lang, source in rows:
        size = len((text or "").encode()) + 8
        points.append((size, (size, place(source), place(lang)), (doc_id is None, doc_id or 0)))
    if not points:
        return {}
    ranges = [max(p[1][d] for p in points) - min(p[1][d] for p in points) for d in range(3)]
    out = {}

    def go(members, first, n):
        if n == 1 or not members:
            for k, p in enumerate(sorted(members, key=lambda p: p[2])):
                out.setdefault((p[2], p[0]), []).append((first, k))
            return
        wide = [
            (max(p[1][d] for p in members) - min(p[1][d] for p in members)) / ranges[d] if ranges[d] else 0
            for d in range(3)
        ]
        dim = wide.index(max(wide))
        cut = sum(p[0] for p in members) * (n // 2) // n
        before, left, right = 0, [], []
        for p in sorted(members, key=lambda p: (p[1][dim], p[2])):
            (left if 2 * before + p[0] <= 2 * cut else right).append(p)
            before += p[0]
        go(left, first, n // 2)
        go(right, first + n // 2, n - n // 2)

    go(points, 0, shards)
    return out


def shards_of(spark, rows, shards, partitions=7):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    return sharding.kd_shards(df, shards).collect()


def test_against_sorted_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKETS", 8)
    monkeypatch.setattr(sharding, "LEVEL_BUCKETS", 8)
    rng = random.Random(1)
    rows = [
        (i * 3 + (1 << 33) * (i % 2), "ä" * int(rng.paretovariate(0.7)) if i % 9 else "same", rng.choice(["en", "de", None]), f"s{rng.randrange(40)}")
        for i in range(400)
    ]
    got = shards_of(spark, rows, 7)
    want = brute(rows, 7)
    assert len(got) == 400
    for row in got:
        key = ((row["doc_id"] is None, row["doc_id"] or 0), row["size"])
        assert [(row["shard"], row["slot"])] == want[key]


def test_a_third_of_the_rows_alike_is_parted(spark):
    """Rows that are equal in all columns, id included, go by their number."""
    rows = [(None, "copy of a text", "en", "hot")] * 300 + [(i, f"text {i}", "en", "hot") for i in range(600)]
    got = shards_of(spark, rows, 6)
    bytes_of, slots = {}, {}
    for row in got:
        bytes_of[row["shard"]] = bytes_of.get(row["shard"], 0) + row["size"]
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert len(got) == 900 and len(bytes_of) == 6
    assert max(bytes_of.values()) - min(bytes_of.values()) <= 4 * 22
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_target_bytes(spark):
    rows = [(i, "x" * 92, "en", "a") for i in range(64)]
    df = spark.createDataFrame(rows, SCHEMA)
    sizes = sharding.kd_shards(df, target_bytes=800).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(sizes) == 8 and {r["b"] for r in sizes} == {800}


def test_edge_rows(clashing_docs, spark):
    docs = clashing_docs.withColumns({c: F.lit(5) for c in ("node", "shards", "k0", "m0", "place", "slot", "part")})
    got = sharding.kd_shards(docs, 5).collect()
    source = docs.select("doc_id", "text").collect()
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (r["doc_id"] or 0, len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in source
    )
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sharding.kd_shards(spark.createDataFrame([], SCHEMA), 24).count() == 0
    assert sharding.kd_shards(spark.createDataFrame([], SCHEMA), target_bytes=100).count() == 0
    one = sharding.kd_shards(spark.createDataFrame([(1, "a", None, None)], SCHEMA), 24).collect()
    assert [(r["size"], r["slot"]) for r in one] == [(9, 0)]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_is_near_equal_and_native(spark, sf):
    out = op12_kd_sharding(spark, f"/root/testdata/{sf}")
    assert out.columns == ["doc_id", "size", "text_crc32", "shard", "slot", "law", "grown_shard"]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    longest = out.agg(F.max("size")).first()[0]
    sums = [r["b"] for r in out.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    mean = sum(sums) / 24
    assert len(sums) == 24 and all(abs(s - mean) <= longest for s in sums)
    if sf == "sf0.1":
        assert all(abs(s - mean) <= 0.02 * mean for s in sums)
