import math

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from phrasegrove.functions import kernels
from phrasegrove.functions.vectors import (
    is_valid_embedding,
    l2_normalize,
    squared_distance,
    with_array,
    with_vector,
)
from phrasegrove.operators import metrics, moments, quality
from phrasegrove.operators.covariance import covariance
from phrasegrove.operators.nearest import distance_to_centroid, nearest_centroid

SCHEMA = "id int, cluster int, embedding array<float>"


def points_frame(spark, n=300, dims=6, clusters=7, seed=3, parts=5):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dims)).astype("f4")
    assigned = rng.integers(0, clusters, n)
    rows = [(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(assigned, vectors))]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts), vectors.astype("f8"), assigned


def centroid_frame(spark, centres):
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, "cluster_id int, centroid array<double>")


def brute_silhouette(x, labels):
    gaps = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = gaps[i, same].sum() / (same.sum() - 1)
        b = min(gaps[i, labels == c].mean() for c in set(labels) - {own})
        scores.append(0.0 if a == b else (b - a) / max(a, b))
    return np.array(scores)


def test_invalid_embeddings_are_found(spark):
    nan = float("nan")
    rows = [
        (0, None),
        (1, [1.0, 2.0]),
        (2, [1.0, nan, 0.0]),
        (3, [1.0, None, 0.0]),
        (4, [0.0, 0.0, 0.0]),
        (5, []),
        (6, [None, nan, 1.0]),
    ]
    df = spark.createDataFrame(rows, "id int, embedding array<float>")
    valid, rest = quality.split_valid(df, "embedding", 3)
    assert [r.id for r in valid.collect()] == [4]
    assert sorted(r.id for r in rest.collect()) == [0, 1, 2, 3, 5, 6]
    report = {r.n_dims: r[1:] for r in quality.embedding_report(df, "embedding", 3).collect()}
    assert report == {None: (1, 0, 1), 0: (1, 0, 1), 2: (1, 0, 1), 3: (4, 1, 3)}
    assert df.where(is_valid_embedding("embedding", 3)).count() == 1


def test_l2_keeps_a_zero_vector(spark):
    df = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.0, 0.0])], "id int, e array<float>")
    unit = {r.id: r.u for r in l2_normalize(df, "e", "u").collect()}
    assert unit == {0: [0.6, 0.8], 1: [0.0, 0.0]}
    back = with_array(with_vector(df, "e", "v"), "v", "a").first()
    assert back.a == [3.0, 4.0]


def test_nearest_equals_brute_force(spark):
    df, x, _ = points_frame(spark)
    centres = np.random.default_rng(9).normal(size=(40, 6))
    gaps = ((x[:, None] - centres[None]) ** 2).sum(-1)
    for block_bytes in (None, 700):  # one block, then several
        found = nearest_centroid(df, centroid_frame(spark, centres), block_bytes=block_bytes)
        for row in found.collect():
            assert row.cluster_id == gaps[row.id].argmin()
            assert row.distance == pytest.approx(gaps[row.id].min(), abs=1e-9)


def test_nearest_gives_ties_to_the_smaller_id_and_null_to_bad_vectors(spark):
    rows = [(0, [0.0, 0.0]), (1, None), (2, [1.0]), (3, [float("nan"), 0.0]), (4, [None, 0.0])]
    df = spark.createDataFrame(rows, "id int, embedding array<float>")
    centres = spark.createDataFrame(
        [(5, [1.0, 0.0]), (2, [0.0, -1.0]), (9, [1.0, 0.0])],
        "cluster_id int, centroid array<double>",
    )
    for block_bytes in (None, 1):
        found = nearest_centroid(df, centres, block_bytes=block_bytes)
        assert {r.id: r.cluster_id for r in found.collect()} == {
            0: 2, 1: None, 2: None, 3: None, 4: None
        }


def test_a_filter_on_the_result_does_not_run_the_kernel_twice(spark):
    df, _, _ = points_frame(spark)
    centres = centroid_frame(spark, np.eye(6))
    near = nearest_centroid(df, centres).where("distance < 1 and cluster_id is not null")
    scored = metrics.silhouette_scores(df, "cluster").where("silhouette < 0")
    for frame in (near, scored):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
    pruned = nearest_centroid(df, centres).select("id")
    assert "ArrowEvalPython" not in pruned._jdf.queryExecution().executedPlan().toString()


def test_kernel_is_exact_for_far_and_equal_centres():
    rng = np.random.default_rng(0)
    base = rng.normal(size=(50, 8)) + 1e4
    centres = np.vstack([base[:20], base[:20]])
    index, distance = kernels.nearest(base[:20].copy(), centres)
    assert index.tolist() == list(range(20)) and not distance.any()


def test_moments_centroids_and_wcss(spark):
    df, x, labels = points_frame(spark)
    for row in moments.centroids(df, "cluster").collect():
        np.testing.assert_allclose(row.centroid, x[labels == row.cluster_id].mean(0), atol=1e-12)
    for row in moments.wcss(moments.cluster_moments(df, "cluster")).collect():
        own = x[labels == row.cluster_id]
        assert row.wcss == pytest.approx(((own - own.mean(0)) ** 2).sum())
        assert row.n == len(own)


def test_distance_to_own_centroid(spark):
    df, x, labels = points_frame(spark)
    centres = moments.centroids(df, "cluster")
    rows = distance_to_centroid(df, centres, "embedding", "cluster").collect()
    for r in rows:
        want = ((x[r.id] - x[labels == r.cluster].mean(0)) ** 2).sum()
        assert r.distance == pytest.approx(want)
    a = df.select(squared_distance("embedding", "embedding").alias("d")).agg(F.max("d")).first()
    assert a[0] == 0


def test_covariance_equals_numpy(spark):
    df, x, _ = points_frame(spark)
    want = np.cov(x, rowvar=False)
    rows = covariance(df, "embedding", 6).collect()
    assert len(rows) == 21
    for r in rows:
        assert r.cov == pytest.approx(want[r.i, r.j], abs=1e-12)


@pytest.mark.parametrize("block_bytes", [None, 1])
def test_silhouette_equals_brute_force(spark, block_bytes):
    df, x, labels = points_frame(spark, n=120)
    labels[0] = 50  # alone in its cluster
    df = df.withColumn("cluster", F.when(F.col("id") == 0, 50).otherwise(F.col("cluster")))
    want = brute_silhouette(x, labels)
    scored = metrics.silhouette_scores(df, "cluster", block_bytes=block_bytes)
    for r in scored.collect():
        assert r.silhouette == pytest.approx(want[r.id], abs=1e-9)


def test_silhouette_equals_evaluator(spark):
    df, _, _ = points_frame(spark)
    ours = metrics.mean_silhouette(df, "cluster").first()[0]
    vectors = with_vector(df, "embedding", "features")
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    assert ours == pytest.approx(evaluator.evaluate(vectors), abs=1e-9)


def test_silhouette_of_one_cluster_is_null_and_of_copies_is_one(spark):
    one = spark.createDataFrame([(0, 1, [1.0]), (1, 1, [2.0])], SCHEMA)
    assert metrics.mean_silhouette(one, "cluster").first()[0] is None
    copies = spark.createDataFrame(
        [(0, 1, [0.1]), (1, 1, [0.1]), (2, 2, [5.0]), (3, 2, [5.0])], SCHEMA
    )
    assert metrics.mean_silhouette(copies, "cluster").first()[0] == pytest.approx(1.0)


def elbow_of(spark, ks, inertias):
    rows = [("r", k, float(i)) for k, i in zip(ks, inertias)]
    sweep = spark.createDataFrame(rows, "run_id string, k int, inertia double")
    best = metrics.elbow(sweep).where("recommended").collect()
    assert len(best) == 1
    return best[0].k


def test_elbow(spark):
    assert elbow_of(spark, [2, 3, 5, 8, 10], [100, 40, 30, 25, 22]) == 3
    assert elbow_of(spark, [2, 3], [100, 90]) == 3
    assert elbow_of(spark, [4], [1]) == 4
    assert elbow_of(spark, [2, 3, 4, 5], [0, 0, 0, 0]) == 3
    assert elbow_of(spark, [2, 3, 4, 5], [40, 30, 20, 10]) == 3
    # the largest signed bend wins, not the largest in size
    assert elbow_of(spark, [1, 2, 3, 4], [10, 10, 2, 1]) == 3


def test_each_run_has_its_own_elbow(spark):
    rows = [(r, k, i) for r in "ab" for k, i in ((2, 9.0), (3, 1.0), (4, 0.5), (5, 0.2))]
    sweep = spark.createDataFrame(rows, "run_id string, k int, inertia double")
    best = metrics.elbow(sweep).where("recommended").collect()
    assert sorted((r.run_id, r.k) for r in best) == [("a", 3), ("b", 3)]
    assert not any(math.isnan(r.curvature) for r in best)


def test_bad_vectors_do_not_spoil_a_cluster(spark):
    good = [(i, [float(i), 1.0, -float(i)], 1) for i in range(6)] + [(9, [5.0, 5.0, 5.0], 2), (10, [6.0, 5.0, 5.0], 2)]
    bad = [(20, [float("nan"), 1.0, 1.0], 1), (21, None, 1), (22, [1.0, 2.0], 1), (23, [1.0] * 4, 1), (24, [1.0, None, 1.0], 1)]
    schema = "id int, embedding array<double>, cluster int"
    clean, dirty = (spark.createDataFrame(rows, schema) for rows in (good, good + bad))
    for made in (
        lambda df: moments.centroids(df, "cluster", dims=3),
        lambda df: moments.wcss(moments.cluster_moments(df, "cluster", dims=3)),
        lambda df: metrics.silhouette_scores(df, "cluster", dims=3).where("id < 20"),
    ):
        assert sorted(made(dirty).collect()) == sorted(made(clean).collect())
    scores = metrics.silhouette_scores(dirty, "cluster", dims=3).where("id >= 20").collect()
    assert len(scores) == 5 and all(r.silhouette is None for r in scores)


def test_wcss_far_from_the_origin(spark):
    rng = np.random.default_rng(2)
    x = 1000 + rng.normal(size=(300, 4)) * 1e-7
    df = spark.createDataFrame([(v.tolist(), 1) for v in x], "embedding array<double>, cluster int")
    want = ((x - x.mean(axis=0)) ** 2).sum()
    got = moments.wcss(moments.cluster_moments(df, "cluster")).first().wcss
    assert got == pytest.approx(want, rel=1e-4)


def test_merged_moments_equal_those_of_the_union(spark):
    rng = np.random.default_rng(3)
    rows = [(v.tolist(), int(c)) for v, c in zip(rng.normal(size=(90, 3)) + 50, rng.integers(0, 6, 90))]
    df = spark.createDataFrame(rows, "embedding array<double>, cluster int")
    whole = moments.cluster_moments(df.withColumn("cluster", F.col("cluster") % 2), "cluster")
    parts = moments.merged_moments(moments.cluster_moments(df, "cluster"), F.col("cluster_id") % 2)
    want = {r.cluster_id: (r.n, *r.mean, *r.spread) for r in whole.collect()}
    for r in parts.collect():
        assert (r.n, *r.mean, *r.spread) == pytest.approx(want[r.cluster_id], rel=1e-9)


def test_covariance_of_one_row_is_null(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "embedding array<double>")
    assert {r.cov for r in covariance(df, "embedding", 2).collect()} == {None}
