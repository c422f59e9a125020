"""Packed moments, tiles, balls, heaps and coresets against plain numpy."""

import hashlib
import math
import random
import tracemalloc
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from phrasegrove.functions import heaps, kernels
from phrasegrove.functions.balls import Balls
from phrasegrove.operators import axes, coreset, covariance, incremental, metrics, moments, naming, nearest, training
from phrasegrove.params import ClusterParams
from phrasegrove.sources.models import load_model, save_model

ROWS = "cluster int, v array<double>"


def frame(spark, clusters, x, parts):
    return spark.createDataFrame([(int(c), r.tolist()) for c, r in zip(clusters, x)], ROWS).repartition(parts)


def seen_parts(monkeypatch, module):
    """The tasks' packed rows, as they enter the first shuffle."""
    seen = []
    real = module.merged

    def spy(parts, *rest):
        seen.append(parts)
        return real(parts, *rest)

    monkeypatch.setattr(module, "merged", spy)
    return seen


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- moments ---------------------------------------------------------------------------


@pytest.mark.parametrize("cells", [1 << 22, 40])
def test_moments_far_from_the_origin(spark, monkeypatch, cells):
    monkeypatch.setattr(moments, "TASK_CELLS", cells)
    seen = seen_parts(monkeypatch, moments)
    rng = np.random.default_rng(0)
    x = 1e6 + rng.normal(size=(2000, 5)) * 1e-3
    labels = np.where(rng.random(2000) < 0.4, 3, rng.integers(0, 20, 2000))  # one hot cluster
    found = moments.cluster_moments(frame(spark, labels, x, 7), "cluster", "v")
    for row in found.collect():
        own = x[labels == row.cluster_id]
        assert row.n == len(own)
        np.testing.assert_allclose(row.mean, own.mean(0), rtol=1e-14)
        np.testing.assert_allclose(row.spread, ((own - own.mean(0)) ** 2).sum(0), rtol=1e-6)
    if cells > 40:
        assert seen[0].count() <= 20 * 7
        assert "Generate" not in plan(found) and "HashAggregate" not in plan(found)


def test_plans_of_what_rests_on_moments_expand_no_vector(spark):
    df = frame(spark, [0, 1, 0, 1], np.eye(4), 2)
    sums = moments.cluster_moments(df, "cluster", "v")
    centres = moments.centroids(df, "cluster", "v")
    moved = moments.centroids(nearest.nearest_centroid(df, centres, "v"), "cluster_id", "v")
    merged = moments.merged_moments(sums, F.col("cluster_id") % 1)
    for made in (centres, moved, moments.wcss(sums), merged, metrics.silhouette_scores(df, "cluster", "v")):
        assert "posexplode" not in plan(made)


def test_several_sizes_need_dims(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0]), (2, [3.0, 4.0])]
    df = spark.createDataFrame(rows, ROWS).coalesce(1)
    with pytest.raises(Exception, match="several sizes"):
        moments.cluster_moments(df, "cluster", "v").collect()
    assert {r.cluster_id: r.n for r in moments.cluster_moments(df, "cluster", "v", 2).collect()} == {1: 1, 2: 1}


def test_no_rows_have_no_moments(spark):
    assert moments.cluster_moments(spark.createDataFrame([], ROWS), "cluster", "v", 3).count() == 0


# --- covariance ------------------------------------------------------------------------


def test_tiles_far_from_the_origin(spark, monkeypatch):
    seen = seen_parts(monkeypatch, covariance)
    rng = np.random.default_rng(1)
    x = 1e6 + rng.normal(size=(3000, 10)) @ rng.normal(size=(10, 10))
    rows = covariance.covariance(frame(spark, np.zeros(3000), x, 5), "v", 10, tile=4).collect()
    want = np.cov(x - 1e6, rowvar=False)
    assert sorted((r.i, r.j) for r in rows) == [(i, j) for i in range(10) for j in range(i, 10)]
    for r in rows:
        assert r.cov == pytest.approx(want[r.i, r.j], abs=1e-6)
    assert seen[0].count() == 5 * 6  # a row per tile and task


def test_many_dims_in_bounded_memory():
    rng = np.random.default_rng(2)
    x = 5 + rng.normal(size=(96, 4096))
    tracemalloc.start()
    held = kernels.CoMoments(4096, covariance.TILE)
    held.add(x[:40])
    held.add(x[40:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    want = np.cov(x[:, :300], rowvar=False) * 95
    np.testing.assert_allclose(held.tiles[0, 1][:, :44], want[:256, 256:], atol=1e-9)


# --- nearest centroid ------------------------------------------------------------------


def blobs(rng, heads, each, dims, width=0.05):
    middle = rng.normal(size=(heads, dims)) * 3
    return np.repeat(middle, each, axis=0) + rng.normal(size=(heads * each, dims)) * width


def test_few_distances_of_many_centroids():
    rng = np.random.default_rng(3)
    centres = blobs(rng, 160, 125, 16)
    rng.shuffle(centres)
    centres[100:200] = centres[300:400]  # equal ones go to the smaller index
    points = np.concatenate([centres[rng.integers(0, 20_000, 1500)] + rng.normal(size=(1500, 16)) * 0.05, centres[:500]])
    balls = Balls(centres)
    at, gap = balls.nearest(points)
    want, least = kernels.nearest(points, centres)
    assert (at == want).all() and (gap == least).all()
    assert balls.evaluated < len(points) * len(centres) / 5
    offsets = rng.random(20_000) * 0.01
    own = rng.integers(-1, 20_000, len(points))
    balls = Balls(centres, offsets)
    every = kernels.squared_gaps(points, centres) + offsets
    every[own >= 0, own[own >= 0]] = np.inf
    np.testing.assert_allclose(balls.least_other(points, own), every.min(axis=1), atol=1e-9)
    assert balls.evaluated < len(points) * len(centres) / 5


@pytest.mark.parametrize("k", [1, 5, 128, 700])
def test_centroids_without_structure(k):
    rng = np.random.default_rng(k)
    centres = np.round(rng.normal(size=(k, 24)), 1) + 100
    points = np.concatenate([rng.normal(size=(300, 24)) + 100, centres[:50], np.full((3, 24), 1e7)])
    at, gap = Balls(centres).nearest(points)
    want, least = kernels.nearest(points, centres)
    assert (at == want).all() and (gap == least).all()
    assert len(Balls(centres).nearest(points[:0])[0]) == 0


def test_equal_centroids_make_one_ball():
    at, gap = Balls(np.ones((400, 3))).nearest(np.zeros((2, 3)))
    assert at.tolist() == [0, 0] and gap.tolist() == [3.0, 3.0]


# --- samples of clusters ---------------------------------------------------------------


def brute_samples(rows, n):
    def key(row):
        gap = row[1]
        return (gap is not None, gap is not None and math.isnan(gap), gap if gap is not None and not math.isnan(gap) else 0, row[2])

    groups = {}
    for row in rows:
        if row[0] is not None:
            groups.setdefault(row[0], []).append(row)
    return sorted((c, k, r[2]) for c, own in groups.items() for k, r in enumerate(sorted(own, key=key)[:n], 1))


@pytest.mark.parametrize("n,buffer,limit", [(3, 1 << 14, 1 << 27), (3, 50, 1), (5000, 1 << 14, 1 << 27)])
def test_first_rows_of_clusters(spark, monkeypatch, n, buffer, limit):
    monkeypatch.setattr(heaps, "BUFFER_ROWS", buffer)
    monkeypatch.setattr(heaps, "TASK_BYTES", limit)
    rng = random.Random(n)
    count = 20_000 if n > 100 else 3000
    gaps = [None, math.nan, 0.5]
    rows = [
        (1 if rng.random() < 0.4 else rng.choice([None, *range(6)]), gaps[i % 100] if i % 100 < 3 else round(rng.random(), 3), f"i{i:06}", [i])
        for i in range(count)
    ]
    schema = "cluster_n1 int, distance double, id string, extra array<int>"
    df = spark.createDataFrame(rows, schema).repartition(9)
    found = naming.cluster_samples(df, n)
    assert found.columns == ["cluster_n1", "distance", "id", "extra", "position"]
    assert sorted((r.cluster_n1, r.position, r.id) for r in found.collect()) == brute_samples(rows, n)
    assert all(r.extra == [int(r.id[1:])] for r in found.take(20))
    assert "Sort" not in plan(found) and "Window" not in plan(found)


def test_no_rows_have_no_samples(spark):
    df = spark.createDataFrame([], "cluster_n1 int, distance double, id string")
    assert naming.cluster_samples(df, 3).count() == 0


# --- coresets --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def many(spark):
    """20,000 points in 12 blobs of different sizes, one of them hot, and some far ones."""
    rng = np.random.default_rng(4)
    heads = rng.normal(size=(12, 6)) * 4
    own = np.where(rng.random(20_000) < 0.4, 0, rng.integers(0, 12, 20_000))
    x = heads[own] + rng.normal(size=(20_000, 6))
    x[:20] *= 10
    rows = spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(x)], "id string, p array<double>")
    from pyspark.ml.functions import array_to_vector

    return rows.select("id", array_to_vector("p").alias("features")).repartition(6).cache(), x


def test_a_coreset_weighs_what_all_points_weigh(spark, many, monkeypatch):
    monkeypatch.setattr(coreset, "BLOCK_ROWS", 1500)
    monkeypatch.setattr(coreset, "BLOCK_SAMPLE", 400)
    rows, x = many
    found = coreset.coreset(rows, 1500, "features").collect()
    points, weights = np.array([r.point for r in found]), np.array([r.weight for r in found])
    assert 1000 < len(found) < 2000
    assert weights.sum() == pytest.approx(20_000, rel=0.1)
    for centre in (x.mean(0), x[5000], np.zeros(6)):
        want = ((x - centre) ** 2).sum()
        assert (weights * ((points - centre) ** 2).sum(1)).sum() == pytest.approx(want, rel=0.1)
    again = coreset.coreset(rows, 1500, "features").collect()
    assert sorted(r.point for r in again) == sorted(r.point for r in found)


def test_few_points_are_their_own_coreset(spark, many):
    rows, x = many
    few = rows.where("cast(id as int) < 300")
    found = coreset.coreset(few, 1500, "features").collect()
    assert len(found) == 300 and {r.weight for r in found} == {1.0}
    assert coreset.coreset(few.limit(0), 10, "features").count() == 0


def test_a_sweep_reads_the_points_twice(spark, many, monkeypatch):
    """Inertias of fits on a coreset are within a tenth of the range that fits of other seeds have on
    all rows (a fit ends in some local optimum in either case)."""
    monkeypatch.setattr(coreset, "BLOCK_ROWS", 1500)
    monkeypatch.setattr(coreset, "BLOCK_SAMPLE", 300)
    rows = many[0].where("cast(id as int) >= 20")  # far points would make for other optima
    params = ClusterParams(k_candidates=(2, 5, 10, 20), sample_fraction=1.0, coreset_per_k=60, max_iter=20)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    from pyspark.ml.functions import array_to_vector, vector_to_array

    arrays = rows.select("id", vector_to_array("features").alias("a"))
    watched = arrays.mapInArrow(counted, arrays.schema).select("id", array_to_vector("a").alias("features"))
    fits = training.k_sweep(watched, params)
    assert reads.value == 2 * 19_980
    for fit in fits:
        full = [training.kmeans(replace(params, seed=seed))(fit.k, "features", "c").fit(rows) for seed in (1, 2, 42)]
        costs = [model.summary.trainingCost for model in full]
        assert fit.n == 19_980 and 0.9 * min(costs) <= fit.inertia <= 1.1 * max(costs)
        assert -1 <= fit.silhouette <= 1
    assert [a.inertia > b.inertia for a, b in zip(fits, fits[1:])] == [True] * 3
    with pytest.raises(ValueError, match="two rows"):
        training.k_sweep(rows.limit(1), replace(params, k_candidates=(2,)))


# --- principal axes --------------------------------------------------------------------


def wide(spark, spectrum, n=600, far=3.0):
    rng = np.random.default_rng(6)
    dims = len(spectrum)
    turn = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    x = far + (rng.normal(size=(n, dims)) * np.sqrt(spectrum)) @ turn
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(5)
    values, vectors = np.linalg.eigh(np.cov(x, rowvar=False))
    return df, values[::-1], vectors[:, ::-1]


def test_axes_of_a_spectrum_with_a_gap(spark, monkeypatch):
    monkeypatch.setattr(axes, "ROWS_OF_TILE", 16)
    spectrum = np.concatenate([np.linspace(9, 3, 5), np.full(35, 1e-4)])
    df, values, vectors = wide(spark, spectrum)
    found, variances, total = axes.principal_axes(df, "v", 40, 5)
    outside = found - vectors[:, :5] @ (vectors[:, :5].T @ found)
    assert np.linalg.norm(outside, 2) < 1e-6  # sine of the largest angle
    np.testing.assert_allclose(variances, values[:5], rtol=1e-9)
    assert total == pytest.approx(values.sum())
    np.testing.assert_allclose(np.abs((found * vectors[:, :5]).sum(0)), 1, atol=1e-6)


def test_all_axes_and_no_rows(spark):
    df, values, vectors = wide(spark, np.array([4.0, 2.0, 1.0]))
    found, variances, _ = axes.principal_axes(df, "v", 3, 3)
    np.testing.assert_allclose(variances, values, rtol=1e-9)
    np.testing.assert_allclose(np.abs((found * vectors).sum(0)), 1, atol=1e-9)
    with pytest.raises(ValueError, match="no complete vectors"):
        axes.principal_axes(df.limit(0), "v", 3, 2)


def test_range_solver_in_the_pipeline(spark, mixture, tmp_path):
    exact = training.fit_features(mixture, 4)
    ranged = training.fit_features(mixture, 4, solver="range")
    path = f"{tmp_path}/model"
    save_model(ranged, path)
    points = [
        np.array([r.features.toArray() for r in training.apply_pipeline(m, mixture).orderBy("id").collect()])
        for m in (exact, ranged, load_model(path))
    ]
    np.testing.assert_allclose(np.abs(points[1]), np.abs(points[0]), atol=1e-3)  # a slow spectrum
    np.testing.assert_allclose(points[2], points[1])
    with pytest.raises(ValueError, match="solver"):
        training.fit_features(mixture, 4, solver="other")


# --- exact samples ---------------------------------------------------------------------


@pytest.mark.parametrize("buffer,limit", [(1 << 14, 1 << 27), (10, 1)])
def test_a_sample_of_exactly_n_ids(spark, monkeypatch, buffer, limit):
    monkeypatch.setattr(heaps, "BUFFER_ROWS", buffer)
    monkeypatch.setattr(heaps, "TASK_BYTES", limit)
    rows = [(f"a{i}", i) for i in range(900)] + [("hot", i) for i in range(450)] + [(None, 1)] * 9
    by_digest = sorted({r[0] for r in rows if r[0]}, key=lambda i: (hashlib.md5(i.encode()).hexdigest()[:15], i))
    df = spark.createDataFrame(rows, "id string, x int")
    for n, parts in ((1, 3), (100, 11), (100, 2), (5000, 4)):
        found = incremental.exact_sample(df.repartition(parts), n)
        want = set(by_digest[:n])
        assert sorted((r.id, r.x) for r in found.collect()) == sorted(r for r in rows if r[0] in want)
    assert incremental.exact_sample(df.where("id is null"), 3).count() == 0
