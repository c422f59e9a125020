"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from phrasegrove.llm import lexical_search
from phrasegrove.llm.queries import op13_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=50):
    held = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    held = [(i, Counter(words), len(words)) for i, words in held if words]
    total, length = len(held), sum(n for *_, n in held)
    df = Counter(term for _, counts, _ in held for term in counts)
    out = []
    for item, text in items:
        words = set(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, counts, n in held:
            m = 100 - 50 + (50 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * ((10**9 * counts[w]) // (1000 * counts[w] + 20 * m))
                for w in words
                if w in counts
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        scores.sort(key=lambda x: x[:3])
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(scores[:top], 1)]
    return out


def plain(df):
    return [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def words_of(rng, n, vocabulary):
    return " ".join(f"w{int(vocabulary * rng.random() ** 3)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """A third of the documents are copies of one, some ids repeat or are null."""
    rng = random.Random(2)
    docs = [(i, words_of(rng, rng.randrange(1, 60), 300)) for i in range(600)]
    docs += [(1000 + i, "W1 w7; w9 w250 w299 common") for i in range(300)]
    docs += [(None, "w1 w7 w9"), (5, "w1 w2 w3"), (5, "w1 w2 w3"), (7, None), (8, ""), (9, "--- !"), (10, "x" * 70000 + " w7")]
    rng.shuffle(docs)
    items = [(i, words_of(rng, rng.randrange(1, 30), 320)) for i in range(25)]
    items += [(90, None), (91, " ?? "), (92, "unknown terms alone"), (93, "W7 w7 w7"), (93, "W7 w7 w7"), (None, "w9 w299")]
    return docs, items


@pytest.mark.parametrize("postings,block,wave", [(1 << 20, 1 << 21, 48), (700, 300, 3)])
def test_against_scores_of_all_documents(spark, corpus, monkeypatch, postings, block, wave):
    monkeypatch.setattr(lexical_search, "SEGMENT_POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical_search, "WAVE", wave)
    docs, items = corpus
    documents = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    documents = documents.withColumns({c: F.lit(1) for c in ("n", "terms", "counts", "no", "rank", "score", "piece")})
    queries = spark.createDataFrame(items, "item_id bigint, text string")
    for top in (50, 3):
        assert ordered(plain(lexical_search.search(documents, queries, top))) == ordered(brute(docs, items, top))


def test_intervals_are_pruned():
    """Few documents are scored when the terms tell them apart."""
    rng = np.random.default_rng(5)
    n, vocabulary = 20_000, 2_000
    sizes = rng.integers(5, 15, n)
    owners = np.repeat(np.arange(n), sizes)
    places = (vocabulary * rng.random(len(owners)) ** 2).astype(np.int64)
    pairs = np.unique(np.stack([owners, places]), axis=1)
    owners, places = pairs
    holding = np.bincount(places, minlength=vocabulary)
    weights = np.array([lexical_search.weight(n, int(h)) for h in holding])
    lengths = np.bincount(owners, minlength=n)
    counts = np.ones(len(owners), np.int64)
    segment = lexical_search.Segment(
        np.arange(n), np.zeros(n, bool), lengths, owners, places, counts, weights, n, int(lengths.sum())
    )
    scored = []
    for _ in range(20):
        best = lexical_search.Best(50)
        scored.append(segment.search(rng.choice(vocabulary, 4, replace=False), best))
        assert best.full
    assert np.mean(scored) < n / 10


def test_terms_keep_what_is_beyond_ascii():
    text = "Größe-ÄB　日本 x_1\x00Y z É"
    assert [t.decode() for t in lexical_search.terms(text)] == TERM.findall(text.translate(LOWER))


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical_search.search(docs, items).count() == 0
    assert lexical_search.search(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0


def test_query(spark):
    out = op13_lexical_search(spark, "/root/testdata/sf0.001")
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    assert ordered(plain(out)) == ordered(brute(docs, items))
