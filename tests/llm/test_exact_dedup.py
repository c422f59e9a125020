import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from phrasegrove.llm import exact_dedup as ed


def brute(rows):
    groups = {}
    for i, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(norm, []).append((-len(text or ""), i is None, i))
    out = []
    for i, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        keep = min(groups[norm])[2]
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(history, fresh):
    got = ed.exact_dedup(history, fresh).drop("historical").collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("parts", ["doc_id % 2 = 0", "true", "false", "doc_id < 5"])
def test_every_split_gives_the_whole_answer(clashing_docs, parts):
    old = F.coalesce(F.expr(parts), F.lit(False))
    want = brute([(r.doc_id, r.text) for r in clashing_docs.select("doc_id", "text").collect()])
    assert result(clashing_docs.where(old), clashing_docs.where(~old)) == want


def test_empty(edge_docs):
    none = edge_docs.where("false")
    assert result(none, none) == []


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 30_000):
        keys = rng.integers(0, 2**63, (n, 4), dtype=np.uint64)
        sizes, bits = ed.build_slots(keys)
        assert sorted(ed.find_slots(keys, sizes, bits)) == list(range(n))


def test_many_buckets_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(ed, "BUCKET_KEYS", 16)
    rows = [(i, "same text" if i % 3 == 0 else f"text {i // 2}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(docs.where("doc_id < 500"), docs.where("doc_id >= 500")) == brute(rows)
