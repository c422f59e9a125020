from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from phrasegrove.functions.vectors import with_vector
from phrasegrove.operators import metrics, quality, training
from phrasegrove.params import ClusterParams
from phrasegrove.sources import models
from phrasegrove.sources.shared import fresh_path

PARAMS = ClusterParams(
    k_n1=5, k_n2=3, k_n3=2, init_steps=2, max_iter=10, pca_dims=8,
    k_candidates=(2, 3, 5), sample_fraction=0.5, silhouette_threshold=0.0,
)


@pytest.fixture(scope="module")
def trained(spark, mixture):
    return training.train_hierarchy(mixture, PARAMS)


def vector_rows(spark, rows):
    df = spark.createDataFrame([([float(x) for x in r],) for r in rows], "e array<double>")
    return with_vector(df, "e", "features").select("features")


def test_three_levels(spark, trained):
    assert [f.level for f in trained.levels] == [1, 2, 3]
    assert [f.n for f in trained.levels] == [200, trained.levels[0].k_found, trained.levels[1].k_found]
    assert all(f.inertia >= 0 for f in trained.levels)
    assert -1 <= trained.levels[0].silhouette <= 1 and trained.levels[0].silhouette > 0.5


def test_mapping_has_a_row_per_centre_and_one_parent_each(trained):
    rows = trained.mapping.collect()
    assert trained.mapping.columns == ["cluster_n1", "cluster_n2", "cluster_n3"]
    assert sorted(r.cluster_n1 for r in rows) == list(range(trained.levels[0].k_found))
    parents = {}
    for r in rows:
        assert parents.setdefault(r.cluster_n2, r.cluster_n3) == r.cluster_n3


def test_scores_follow_the_topics(spark, mixture, trained):
    scored = training.score(mixture, trained.pipeline, trained.mapping)
    assert scored.columns == [*mixture.columns, "cluster_n1", "cluster_n2", "cluster_n3"]
    report = quality.assignment_report(scored, "cluster_n1").first()
    assert report.n_rows == 200 and report.n_unassigned == 0
    assert 0 <= report.min_cluster <= report.max_cluster < 5
    pure = scored.groupBy("cluster_n1").agg(F.count_distinct("topic").alias("t"))
    assert pure.where("t > 1").count() <= 1


def test_mapping_equals_the_models_own_prediction(spark, trained):
    n1, n2, _ = (f.model for f in trained.levels)
    rows = n2.transform(training.centre_vectors(spark, n1)).collect()
    direct = {r.cluster_id: r.cluster_n2 for r in rows}
    assert direct == {r.cluster_n1: r.cluster_n2 for r in trained.mapping.collect()}


def test_level_silhouette_equals_the_evaluator(spark, mixture):
    model = training.fit_features(mixture, 8)
    rows = training.apply_pipeline(model, mixture).select("features").cache()
    fit = training.fit_level(rows, 4, 1, training.kmeans(PARAMS), "features")
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_n1")
    assert fit.silhouette == pytest.approx(evaluator.evaluate(fit.model.transform(rows)), abs=1e-9)


@pytest.mark.parametrize("steps", [1, 10])
def test_inertia_is_that_of_the_centres_returned(spark, mixture, steps):
    """Also of a model whose last step still moved its centres."""
    model = training.fit_features(mixture, 8)
    rows = training.apply_pipeline(model, mixture).select("features").cache()
    fit = training.fit_level(rows, 4, 1, training.kmeans(replace(PARAMS, max_iter=steps)), "features")
    points = np.array([r.features.toArray() for r in rows.collect()])
    gaps = ((points[:, None, :] - np.array(fit.model.clusterCenters())) ** 2).sum(axis=2)
    assert fit.inertia == pytest.approx(gaps.min(axis=1).sum(), rel=1e-9)


def test_projection_follows_numpy_up_to_sign(spark, mixture):
    x = np.array([r.embedding for r in mixture.select("id", "embedding").orderBy("id").collect()])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    values, vectors = np.linalg.eigh(np.cov(x, rowvar=False))
    axes = vectors[:, np.argsort(-values)[:3]]
    model = training.fit_features(mixture, 3)
    rows = training.apply_pipeline(model, mixture).orderBy("id").collect()
    got = np.array([r.features.toArray() for r in rows])
    np.testing.assert_allclose(np.abs(got), np.abs(x @ axes), atol=1e-6)


def test_another_estimator(spark, mixture):
    def bisecting(k, features_col, prediction_col):
        return BisectingKMeans(k=k, featuresCol=features_col, predictionCol=prediction_col, seed=1)

    trained = training.train_hierarchy(mixture, PARAMS, make_estimator=bisecting)
    assert trained.mapping.count() == trained.levels[0].k_found
    assert training.score(mixture, trained.pipeline, trained.mapping).count() == 200


def test_fewer_distinct_points_than_clusters(spark):
    rows = vector_rows(spark, [[0, 0], [0, 0], [5, 5], [5, 5], [9, 0]]).cache()
    fit = training.fit_level(rows, 4, 1, training.kmeans(PARAMS), "features")
    assert fit.k == 4 and fit.k_found <= 4 and fit.inertia == pytest.approx(0)


def test_one_cluster_in_use_has_no_silhouette(spark):
    rows = vector_rows(spark, [[0, 0], [1, 0], [2, 0]]).withColumn("c", F.lit(1))
    assert training.level_silhouette(rows, "features", "c", 2) is None


def test_equal_points_have_no_silhouette_and_one_row_is_refused(spark):
    same = vector_rows(spark, [[1, 1]] * 4).cache()
    assert training.fit_level(same, 2, 1, training.kmeans(PARAMS), "features").silhouette is None
    with pytest.raises(ValueError, match="two rows"):
        training.fit_level(vector_rows(spark, [[1, 1]]), 2, 1, training.kmeans(PARAMS), "features")


def test_sweep(spark, mixture):
    model = training.fit_features(mixture, 8)
    rows = training.apply_pipeline(model, mixture).select("id", "features")
    fits = training.k_sweep(rows, replace(PARAMS, k_candidates=(2, 3, 5, 8)))
    assert [f.k for f in fits] == [2, 3, 5, 8]
    assert fits[0].inertia > fits[2].inertia
    marked = metrics.elbow(training.sweep_frame(spark, fits, "r", 0.3))
    assert marked.where("recommended").count() == 1


def test_saved_model_scores_alike(spark, mixture, trained):
    path = fresh_path(spark, "model")
    assert not models.path_exists(spark, path)
    models.save_model(trained.pipeline, path)
    assert models.path_exists(spark, path)
    loaded = models.load_model(path, PipelineModel)
    before = training.score(mixture, trained.pipeline, trained.mapping)
    assert training.score(mixture, loaded, trained.mapping).exceptAll(before).isEmpty()
