"""Whitening against exact rational arithmetic and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from phrasegrove.llm import whitening
from phrasegrove.llm.queries import op11_embedding_whitening

SCHEMA = "vec_id bigint, embedding array<double>"


def expected(rows, components=8):
    """Brute force: exact deviations, and a covariance of exactly centred values."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in kept]
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    deviation = [sum((n * r[d] - sums[d]) ** 2 for d in range(dims)) for r in x]
    centred = [[Fraction(r[d]) - Fraction(sums[d], n) for d in range(dims)] for r in x]
    scaled = np.array([[float(c) for c in r] for r in centred])
    matrix = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return kept, deviation, scaled @ vectors / np.sqrt(values), values / np.trace(matrix)


def check(out, rows, components=8):
    kept, deviation, white, explained = expected(rows, components)
    got = out.collect()
    assert len(got) == len(kept) * white.shape[1]
    assert {r["n"] for r in got} == {len(kept)}
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9
    by_id = {(r["vec_id"], r["component"]): r for r in got}
    signs = [math.copysign(1, by_id[kept[0][0], c + 1]["whitened"] * white[0, c]) for c in range(white.shape[1])]
    for k, (i, _) in enumerate(kept):
        for c in range(white.shape[1]):
            row = by_id[i, c + 1]
            assert row["deviation"] == deviation[k]
            assert row["whitened"] * signs[c] == pytest.approx(white[k, c], abs=1e-8)
            assert row["explained"] == pytest.approx(explained[c], rel=1e-10)


def test_against_fractions_with_rows_that_do_not_count(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=5) * [1, 2, 3, 4, 5] + 7).tolist()) for i in range(60)]
    rows += [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [math.nan] * 5), (103, [math.inf] + [0.0] * 4)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    check(whitening.whiten(df), rows)


def test_values_beyond_64_bit_squares(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=3) * [1e9, 3e9, 2e10]).tolist()) for i in range(20)]
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)), rows)


def test_sums_that_leave_64_bits_midway():
    sums = whitening.ExactSums(2)
    for _ in range(9):
        sums.add(np.array([1 << 61, 3]), 1 << 61, slice(None))
        sums.used += 1 << 61
    assert whitening.from_limbs(sums.limbs()) == [9 << 61, 27]
    sums.large[0] = -(1 << 100)
    assert whitening.from_limbs(sums.limbs())[0] == int(sums.small[0]) - (1 << 100)


def test_sums_of_many_tasks_are_added_in_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PIECES", 3)
    rows = [(i, [float(i % 7), float(i % 5), float(i % 3)]) for i in range(210)]
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(20), 2), rows, 2)


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).count() == 0
    for rows in ([(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 4, [(1, [])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0
    # Repeated rows and null ids count; another length and entries without an integer do not.
    rows = [(None, [0.0, 1.0]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [0.25, 0.0]), (4, [1.0]), (5, [1e300, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("w", "n", "vec", "deviation", "tile")})
    got = whitening.whiten(df).collect()
    assert sorted((r["vec_id"] or 0) for r in got) == [0, 0, 2, 2, 2, 2, 3, 3]
    # Dimensions that always move together have one component.
    line = spark.createDataFrame([(i, [i / 8.0, i / 4.0]) for i in range(5)], SCHEMA)
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}


def test_query_against_numpy(spark):
    path = "/root/testdata/sf0.01"
    vectors = np.array([r["embedding"] for r in spark.read.parquet(f"{path}/embeddings.parquet").orderBy("vec_id").collect()])
    x = np.floor(vectors.astype(float) * 1024) + 100000
    y = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / len(y))
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    white = y @ axes / np.sqrt(values)
    out = op11_embedding_whitening(spark, path)
    assert dict(out.dtypes)["deviation"] == "bigint" and dict(out.dtypes)["component"] == "int"
    got = out.orderBy("vec_id", "component").toPandas()
    assert len(got) == 8 * len(x)
    found = got["whitened"].to_numpy().reshape(-1, 8)
    found = found * np.sign(found[0] * white[0])
    np.testing.assert_allclose(found, white, atol=1e-8)
    n, sums = len(x), x.sum(axis=0)
    exact = ((n * x.astype(np.int64) - sums.astype(np.int64)) ** 2).sum(axis=1)
    assert (got["deviation"].to_numpy()[::8] == exact).all()
    assert got["identity_error"].iloc[0] < 1e-9
