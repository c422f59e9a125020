import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from phrasegrove.llm import embedding_dedup as ed

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, threshold=0.95):
    good = []
    for i, (_, v) in enumerate(rows):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good.append(i)
    links = {i: set() for i in range(len(rows))}
    for dims in {len(rows[i][1]) for i in good}:
        at = [i for i in good if len(rows[i][1]) == dims]
        x = np.array([rows[i][1] for i in at], np.float32).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        close = x @ x.T >= threshold - 1e-12
        for a, i in enumerate(at):
            links[i] = {at[b] for b in np.flatnonzero(close[a])} - {i}
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        part, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - part:
                part.add(j)
                todo.append(j)
        seen |= part
        ids = [rows[j][0] for j in part if rows[j][0] is not None]
        for j in part:
            least = min(ids) if ids else None
            out[j] = (rows[j][0], len(links[j]), least, rows[j][0] == least)
    return sorted(out, key=repr)


def result(spark, rows, **columns):
    df = spark.createDataFrame(rows, SCHEMA).withColumns(columns)
    return sorted((tuple(r) for r in ed.near_vectors(df).collect()), key=repr)


def clusters(seed, groups, per, dims=32, noise=0.02):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=dims)
        for _ in range(per):
            v = centre / np.linalg.norm(centre) + rng.normal(size=dims) * noise
            rows.append((len(rows), [float(np.float32(x)) for x in v]))
    return rows


def test_clusters_copies_and_strays(spark):
    rows = clusters(1, 30, 6) + [(1000 + i, v) for i, v in clusters(2, 60, 1)]
    rows += [(2000 + i, rows[0][1]) for i in range(50)] + [(None, rows[7][1]), (3, rows[9][1])]
    assert result(spark, rows) == brute(rows)


def test_bad_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]),
        (8, [2.0, 0.0]), (9, [1.0]), (10, [1e30, 0.0]), (11, [1e-30, 0.0]), (None, None), (None, [0.0, 1.0]), (12, [-1.0, 0.0]),
        (7, [1.0, 0.0]),
    ]
    columns = {name: F.lit(1) for name in ("vec", "c", "m", "band", "key", "dims", "code", "valid", "root")}
    assert result(spark, rows, **columns) == brute(rows)


def test_empty(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_a_crowd_is_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(ed, "TILE", 16)
    monkeypatch.setattr(ed, "GROUP_ROWS", 64)
    rows = clusters(3, 1, 150, noise=0.01) + [(500 + i, v) for i, v in clusters(4, 40, 2)]
    assert result(spark, rows) == brute(rows)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = ed.unit(rng.normal(size=(400, 48)))
    y = ed.unit(x + rng.normal(size=x.shape) * 0.1)
    codes, factors = ed.encode(x, 512)
    guess, spread = ed.estimators(codes, factors, 48)
    error = (guess * y).sum(axis=1) - (x * y).sum(axis=1)
    assert abs(error.mean()) < 4 * error.std() / math.sqrt(len(x)) + 1e-3
    assert (np.abs(error) <= spread).all()
    assert spread.max() < 0.25


@pytest.mark.parametrize("at", [0.95, 0.955, 0.97])
def test_recall_at_the_threshold(at):
    rng = np.random.default_rng(7)
    width, bands = ed.banding(100_000, 0.95)
    x = ed.unit(rng.normal(size=(3000, 64)))
    z = rng.normal(size=x.shape)
    z = ed.unit(z - (z * x).sum(axis=1, keepdims=True) * x)
    y = at * x + math.sqrt(1 - at * at) * z
    a, b = (ed.encode(v, width * bands)[0][:, : width * bands].reshape(3000, bands, width) for v in (x, y))
    assert (a == b).all(axis=2).any(axis=1).mean() >= 0.99


def test_query_against_brute_force(spark):
    import __spark_entry__ as entry

    for sf in ("sf0.01", "sf0.1"):
        path = f"/root/testdata/{sf}"
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
        got = sorted((tuple(r) for r in entry.queries()["op9_embedding_dedup"](spark, path).collect()), key=repr)
        assert got == brute(rows)
