import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from phrasegrove.llm import jaccard_join as jj


def shingles_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingles_of(t) for _, t in rows]
    at = {}
    for i, s in enumerate(sets):
        for g in s:
            at.setdefault(g, []).append(i)
    links = {i: set() for i in range(len(rows))}
    for i, s in enumerate(sets):
        seen = {}
        for g in s:
            for j in at[g]:
                seen[j] = seen.get(j, 0) + 1
        links[i] = {j for j, c in seen.items() if j != i and 100 * c >= 75 * (len(s) + len(sets[j]) - c)}
    out, done = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in done:
            continue
        part, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - part:
                part.add(j)
                todo.append(j)
        done |= part
        ids = [rows[j][0] for j in part if rows[j][0] is not None]
        for j in part:
            out[j] = (rows[j][0], len(sets[j]), min(ids) if ids else None)
    return sorted(out, key=repr)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = jj.near_duplicates(docs).collect()
    assert sorted((tuple(r)[:3] for r in got), key=repr) == brute(rows)
    # One document of each component is kept, the one that names it.
    kept = [r for r in got if r.kept and r.n_shingles]
    assert {r.component_id for r in kept} == {r.component_id for r in got if r.n_shingles}
    assert all(r.doc_id == r.component_id for r in kept)


def edited(rng, words, rate):
    out = []
    for w in words:
        x = rng.random()
        if x < rate:
            continue
        out.append(f"e{rng.randrange(10**6)}" if x < 2 * rate else w)
    return out


def corpus(seed, families, size, rate=(0.0, 0.005, 0.01, 0.02, 0.03), passage=0.4):
    rng = random.Random(seed)
    shared = [f"p{i}" for i in range(55)]
    rows = []
    for _ in range(families):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 5, 6, 7, 8, 9, 11, 14, 30, 60, 150, 400]))]
        if rng.random() < passage:
            words[len(words) // 2 : len(words) // 2] = shared
        for _ in range(rng.randint(1, size)):
            rows.append((len(rows), " ".join(edited(rng, words, rng.choice(rate)))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_families_and_shared_passages(spark, seed, monkeypatch):
    monkeypatch.setattr(jj, "BUCKET_CHARS", 20_000)
    check(spark.createDataFrame(corpus(seed, 120, 5), "doc_id bigint, text string").repartition(4))


def test_a_large_family(spark):
    rows = corpus(5, 1, 1) + [(1000 + i, t) for i, (_, t) in enumerate(corpus(9, 40, 2))]
    rng, words = random.Random(3), [f"k{i}" for i in range(120)]
    rows += [(5000 + i, " ".join(edited(rng, words, 0.01))) for i in range(250)]
    rows += [(9000 + i, " ".join(words)) for i in range(100)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_edges(clashing_docs):
    check(clashing_docs)
    check(clashing_docs.where("doc_id is null"))


def test_empty(edge_docs):
    assert jj.near_duplicates(edge_docs.where("false")).collect() == []
    check(edge_docs.where("doc_id in (3, 4, 5)"))


def test_bands_hold_all_partners():
    for n in [*range(3, 3000), 10**6, 10**9 + 7]:
        band, top = jj.band_of(n), 4 * n // 3
        assert jj.LOWS[band] <= n < jj.LOWS[band + 1]
        assert jj.band_of(top) <= band + 1
        least = -(-3 * n // 4)
        assert least < 3 or jj.band_of(least) >= band - 1


@pytest.mark.parametrize("words", [2, 64])
def test_linked_sets_share_a_signature(monkeypatch, words):
    monkeypatch.setattr(jj, "LEAST_WORDS", words)
    rng = np.random.default_rng(words)
    tried = 0
    while tried < 4000:
        a = int(rng.choice([3, 4, 5, 6, 7, 9, 12, 20, 33, 70, 200]))
        b = int(rng.integers(a, 4 * a // 3 + 1))
        both = -(-3 * (a + b) // 7)
        if both > a:
            continue
        tried += 1
        pool = np.unique(rng.integers(0, 2**64, a + b - both + 8, dtype=np.uint64))
        pool = rng.permutation(pool)[: a + b - both]
        x, y = np.sort(pool[:a]), np.sort(pool[a - both :])
        assert 4 * both >= 3 * (a + b - both)
        mine, theirs = (jj.signatures([s])[0] for s in (x, y))
        shared = np.intersect1d(mine, theirs)
        assert len(shared)
        # Whatever is held to be frequent, the pair still meets.
        words = np.unique(rng.choice(np.concatenate([shared, mine]), 1 + len(shared) // 2))
        frequent = jj.Frequent(words, rng.integers(3, 9, len(words)))
        both = jj.signatures([x, y], frequent)
        assert len(np.intersect1d(both[0][both[1] == 0], both[0][both[1] == 1]))


def test_bit_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n, d = int(rng.integers(3, 300)), int(rng.integers(0, 80))
        pool = np.unique(rng.integers(0, 2**64, n + d, dtype=np.uint64))
        x, y = pool[:n], pool[d:]
        band = jj.band_of(max(len(x), len(y)))
        apart = np.frombuffer(jj.sketch_bits(x, band), np.uint8) ^ np.frombuffer(jj.sketch_bits(y, band), np.uint8)
        assert np.bitwise_count(apart).sum() <= len(np.setxor1d(x, y))


def test_groups_with_the_same_hubs_are_one(spark):
    """Two words that the same hubs share would move the hubs' sketches twice."""
    rows = [(1, 10, 100, 0, 50), (1, 20, 200, 4, 60), (2, 20, 200, 0, 55), (2, 10, 100, 3, 40), (3, 10, 100, 0, 50), (3, 30, 300, 0, 50)]
    found = jj.one_of_each(spark.createDataFrame(rows, "g long, hub long, component long, radius long, most long")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.g, []).append((r.hub, r.component, r.radius, r.most))
    assert sorted(map(sorted, groups.values())) == [[(10, 100, 0, 50), (30, 300, 0, 50)], [(10, 100, 3, 50), (20, 200, 4, 60)]]


def test_components_of_stars_take_no_round(spark, monkeypatch):
    from phrasegrove.llm import components as module

    cuts = []
    monkeypatch.setattr(module, "cut_lineage", lambda df, real=module.cut_lineage: cuts.append(1) or real(df))
    rows = spark.createDataFrame([(1, 2), (3, 1), (7, 9), (1, 1), (None, 4)], "a long, b long")
    first = module.components(rows)
    assert sorted(map(tuple, first.collect())) == [(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)] and len(cuts) == 1
    # An earlier answer with a further link.
    links = first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(spark.createDataFrame([(3, 9)], "a long, b long"))
    assert sorted(map(tuple, module.components(links).collect())) == [(1, 1), (2, 1), (3, 1), (7, 1), (9, 1)]


def test_signatures_are_sent_without_their_low_bits(spark):
    """They only steer who meets; equal ones stay equal."""
    docs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(300)),)], "text string")
    packed = jj.signature_rows(docs, 4, spark.sparkContext.broadcast(jj.Frequent())).collect()
    words = np.concatenate([np.cumsum(jj.from_planes(r.words, np.uint64), dtype=np.uint64) for r in packed])
    assert len(words) and not np.any(words & np.uint64(0xFFFF))
