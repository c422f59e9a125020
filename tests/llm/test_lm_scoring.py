import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from phrasegrove.llm import lm_scoring as lm


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(words, n):
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(texts, order, backoff=0.4):
    docs = [words_of(t) for t in texts]
    count = {n: sum((grams(d, n) for d in docs), Counter()) for n in range(1, order + 1)}
    total, out = sum(map(len, docs)), []
    for words in docs:
        own = {n: grams(words, n) for n in range(1, order + 1)}
        others = lambda g: count[len(g)][g] - own[len(g)][g]
        rest, score, found = max(1, total - len(words)), 0.0, [0] * (order + 1)
        for i in range(len(words)):
            factor, n = 1.0, min(order, i + 1)
            while n > 1 and not others(tuple(words[i - n + 1 : i + 1])):
                factor, n = factor * backoff, n - 1
            gram = tuple(words[i - n + 1 : i + 1])
            if n > 1:
                value = others(gram) / others(gram[:-1])
            elif others(gram):
                value = others(gram) / rest
            else:
                value, n = backoff / rest, 0
            found[n] += 1
            score += math.log(factor * value)
        out.append((len(words), *found, score))
    return out


def check(docs, order):
    rows = docs.collect()
    got = lm.lm_scores(docs, order).collect()
    assert len(got) == len(rows)
    want = brute([r.text for r in rows], order)
    key = lambda x: (repr(x[0]), x[1], round(x[-1], 6))
    got = sorted(((r.doc_id, r.words, *(r[f"found_{n}"] for n in range(order + 1)), r.log_score) for r in got), key=key)
    want = sorted(((r.doc_id, *w) for r, w in zip(rows, want)), key=key)
    for g, w in zip(got, want):
        assert g[:-1] == w[:-1]
        assert g[-1] == pytest.approx(w[-1], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_brute_force(clashing_docs, order):
    check(clashing_docs, order)


@pytest.mark.parametrize("order", [2, 3])
def test_many_blocks_and_buckets(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_CHARS", 300)
    monkeypatch.setattr(lm, "BUCKET_CHARS", 200)
    rows = [(i, " ".join(f"w{(i * j) % 13}" for j in range(i % 40))) for i in range(120)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), order)


def test_empty_and_single(edge_docs):
    assert lm.lm_scores(edge_docs.where("false")).collect() == []
    check(edge_docs.where("doc_id = 1"), 2)
    check(edge_docs.where("doc_id in (3, 4, 5)"), 2)


def test_other_id_types(spark):
    docs = spark.createDataFrame([("a", "x y"), (None, "x y z")], "doc_id string, text string").withColumn("id", F.lit(1))
    assert {r.doc_id for r in lm.lm_scores(docs).collect()} == {"a", None}
