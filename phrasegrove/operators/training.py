"""Fitting the feature pipeline, the three cluster levels, and the k sweep."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.storagelevel import StorageLevel

from phrasegrove.functions import kernels
from phrasegrove.functions.vectors import with_array, with_vector
from phrasegrove.operators.axes import range_pca
from phrasegrove.operators.bounded import pin
from phrasegrove.operators.coreset import coreset, inertias
from phrasegrove.operators.hierarchy import cluster_mapping, with_parents
from phrasegrove.operators.incremental import hash_sample
from phrasegrove.operators.metrics import mean_silhouette
from phrasegrove.operators.moments import cluster_moments
from phrasegrove.params import ClusterParams

VECTOR_COL, FEATURES_COL = "_vector", "features"
INTERMEDIATE = [VECTOR_COL, "_unit_vector", FEATURES_COL]

ROWS_PER_PARTITION = 4096

CENTROID_VECTORS = StructType(
    [
        StructField("cluster_id", IntegerType(), False),
        StructField(FEATURES_COL, VectorUDT(), False),
    ]
)

# (k, features column, prediction column) -> an unfitted pyspark.ml clustering estimator.
MakeEstimator = Callable[[int, str, str], Estimator]


@dataclass(frozen=True)
class LevelFit:
    """A fitted level. ``k_found`` may be below ``k`` where points coincide or are few."""

    level: int
    k: int
    k_found: int
    n: int
    inertia: float
    silhouette: float | None
    model: object


@dataclass(frozen=True)
class TrainedHierarchy:
    pipeline: PipelineModel
    levels: tuple[LevelFit, LevelFit, LevelFit]
    mapping: DataFrame


def kmeans(params: ClusterParams) -> MakeEstimator:
    def make(k: int, features_col: str, prediction_col: str) -> KMeans:
        return KMeans(
            k=k,
            featuresCol=features_col,
            predictionCol=prediction_col,
            initMode=params.init_mode,
            initSteps=params.init_steps,
            maxIter=params.max_iter,
            seed=params.seed,
            tol=params.tol,
            solver=params.solver,
        )

    return make


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Hold rows that are read many times on the executors; what one loses is recomputed
    from the scan, since no shuffle lies between."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def fit_features(
    df: DataFrame, pca_dims: int, vec_col: str = "embedding", solver: str = "exact"
) -> PipelineModel:
    """Unit length, then projection on the ``pca_dims`` main axes.

    The exact solver holds dims x dims numbers on the driver, the ``range`` solver dims x axes.
    """
    vectors = with_vector(df.select(vec_col), vec_col, VECTOR_COL)
    normalizer = Normalizer(inputCol=VECTOR_COL, outputCol="_unit_vector", p=2.0)
    if solver == "exact":
        pca = PCA(k=pca_dims, inputCol="_unit_vector", outputCol=FEATURES_COL)
        return Pipeline(stages=[normalizer, pca]).fit(vectors)
    if solver != "range":
        raise ValueError(f"solver must be exact or range, not {solver!r}")
    units = with_array(normalizer.transform(vectors), "_unit_vector", "unit", "double").select("unit")
    first = units.first()
    if first is None:
        raise ValueError("there are no vectors to fit on")
    projection = range_pca(units, "_unit_vector", "unit", FEATURES_COL, len(first["unit"]), pca_dims)
    return PipelineModel(stages=[normalizer, projection])


def apply_pipeline(model: PipelineModel, df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    return model.transform(with_vector(df, vec_col, VECTOR_COL))


def level_silhouette(
    predictions: DataFrame, features_col: str, prediction_col: str, k: int, moments: DataFrame | None = None
) -> float | None:
    """Mean silhouette over all rows, or None with fewer than two clusters in use."""
    if k < 2:
        return None
    points = with_array(predictions, features_col, "_point", "double")
    return mean_silhouette(points, prediction_col, "_point", moments=moments).first()["silhouette"]


def level_inertia(moments: DataFrame, centres: list[np.ndarray]) -> float:
    """Sum of the squared distances of all points to their cluster's centre, from the clusters' moments.

    A fitted model's own cost belongs to the centres before its last step.
    """
    table = moments.toArrow()
    means, spread = (kernels.matrix(table.column(name).combine_chunks()) for name in ("mean", "spread"))
    gaps = means - np.asarray(centres)[table.column("cluster_id").to_numpy()]
    return float(spread.sum() + table.column("n").to_numpy() @ np.einsum("ij,ij->i", gaps, gaps))


def fit_level(
    df: DataFrame,
    k: int,
    level: int,
    make_estimator: MakeEstimator,
    features_col: str,
    n: int | None = None,
) -> LevelFit:
    """Fit one level on rows that are held in memory or few. ``n`` is their number, if known.

    The estimator gets a projection of the held frame: it then keeps the vectors themselves
    through its iterations, where it would decode the held columns again in each.
    """
    n = df.count() if n is None else n
    if n < 2:
        raise ValueError(f"level {level} needs at least two rows to cluster, got {n}")
    prediction_col = f"cluster_n{level}"
    model = make_estimator(k, features_col, prediction_col).fit(df.select(features_col))
    k_found = len(model.clusterCenters())
    scored = model.transform(df)
    points = with_array(scored, features_col, "_point", "double")
    moments = pin(cluster_moments(points, prediction_col, "_point"))  # read for both measures
    silhouette = level_silhouette(scored, features_col, prediction_col, k_found, moments)
    return LevelFit(
        level=level,
        k=k,
        k_found=k_found,
        n=n,
        inertia=level_inertia(moments, model.clusterCenters()),
        silhouette=silhouette,
        model=model,
    )


def centre_vectors(spark: SparkSession, model) -> DataFrame:
    """``(cluster_id, features)`` of a fitted model, as input for the next level.

    A fitted model already lives on the driver as k x dims numbers, so its rows go into few
    partitions and not one per core of the cluster.
    """
    rows = [(i, Vectors.dense(c)) for i, c in enumerate(model.clusterCenters())]
    frame = spark.createDataFrame(rows, CENTROID_VECTORS)
    return frame.coalesce(1 + len(rows) // ROWS_PER_PARTITION)


def centre_rows(spark: SparkSession, model) -> DataFrame:
    """``(cluster_id, centroid)`` of a fitted model, in array form."""
    centres = [c.tolist() for c in model.clusterCenters()]
    rows = {
        "cluster_id": pa.array(range(len(centres)), pa.int32()),
        "centroid": pa.array(centres, pa.list_(pa.float64())),
    }
    return spark.createDataFrame(pa.table(rows))


def train_levels(
    features: DataFrame, params: ClusterParams, make_estimator: MakeEstimator | None = None
) -> tuple[LevelFit, LevelFit, LevelFit]:
    """N1 on the points, N2 on N1's centroids, N3 on N2's; a cluster's size has no weight."""
    make_estimator = make_estimator or kmeans(params)
    fits = []
    rows = features
    for level, k in enumerate(params.level_ks, start=1):
        fit = fit_level(rows, k, level, make_estimator, FEATURES_COL)
        fits.append(fit)
        rows = centre_vectors(features.sparkSession, fit.model)
    return tuple(fits)


def train_hierarchy(
    df: DataFrame,
    params: ClusterParams,
    vec_col: str = "embedding",
    make_estimator: MakeEstimator | None = None,
) -> TrainedHierarchy:
    """Fit features and all levels on valid embeddings."""
    features_model = fit_features(df, params.pca_dims, vec_col, params.pca_solver)
    features = apply_pipeline(features_model, df.select(vec_col), vec_col).select(FEATURES_COL)
    with kept(features) as rows:
        levels = train_levels(rows, params, make_estimator)
    return assemble(df.sparkSession, features_model, levels)


def assemble(spark: SparkSession, features_model: PipelineModel, levels) -> TrainedHierarchy:
    centres = [centre_rows(spark, fit.model) for fit in levels]
    return TrainedHierarchy(
        pipeline=PipelineModel(stages=[*features_model.stages, levels[0].model]),
        levels=levels,
        mapping=pin(cluster_mapping(*centres)),
    )


def score(
    df: DataFrame, pipeline: PipelineModel, mapping: DataFrame, vec_col: str = "embedding"
) -> DataFrame:
    """Add the three cluster ids to rows with valid embeddings; batch or streaming."""
    scored = apply_pipeline(pipeline, df, vec_col).drop(*INTERMEDIATE)
    return with_parents(scored, mapping)


def k_sweep(
    features: DataFrame,
    params: ClusterParams,
    id_col: str = "id",
    make_estimator: MakeEstimator | None = None,
) -> list[LevelFit]:
    """Fit every candidate k on one weighted coreset of a sample of ``(id, features)`` rows.

    The sampled rows are read twice, whatever the number of candidates: for the coreset, and to
    measure the inertia of all fits on them. Silhouettes are the coreset's, by weight. A sample
    smaller than the coreset is its own.
    """
    make_estimator = make_estimator or kmeans(params)
    sample = hash_sample(features, params.sample_fraction, id_col)
    size = params.coreset_per_k * max(params.k_candidates)
    points = coreset(sample, size, FEATURES_COL, id_col)
    points = points.select(array_to_vector("point").alias(FEATURES_COL), "weight")
    with kept(points) as rows:
        models = [weighted_fit(rows, make_estimator(k, FEATURES_COL, "cluster_n1")) for k in params.k_candidates]
        silhouettes = [weighted_silhouette(model.transform(rows), FEATURES_COL, "cluster_n1") for model in models]
    n, costs = inertias(sample, FEATURES_COL, [model.clusterCenters() for model in models])
    return [
        LevelFit(1, k, len(model.clusterCenters()), n, cost, silhouette, model)
        for k, model, cost, silhouette in zip(params.k_candidates, models, costs, silhouettes)
    ]


def weighted_fit(rows: DataFrame, estimator: Estimator):
    """Fit on weighted rows, if there are two at least and the estimator knows of weights."""
    if rows.isEmpty() or rows.agg(F.sum("weight")).first()[0] < 2:
        raise ValueError("a sweep needs at least two rows to cluster")
    if estimator.hasParam("weightCol"):
        estimator = estimator.copy({estimator.getParam("weightCol"): "weight"})
    return estimator.fit(rows.select(FEATURES_COL, "weight"))


def weighted_silhouette(predictions: DataFrame, features_col: str, prediction_col: str) -> float | None:
    """Mean silhouette of weighted rows, or None with fewer than two clusters in use."""
    used = predictions.agg(F.min(prediction_col), F.max(prediction_col)).first()
    if used[0] == used[1]:
        return None
    evaluator = ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col, weightCol="weight")
    return evaluator.evaluate(predictions)


def sweep_frame(spark: SparkSession, fits: list[LevelFit], run_id: str, threshold: float):
    """``(run_id, k, inertia, silhouette, below_threshold)``, one row per candidate."""
    rows = [(run_id, f.k, f.inertia, f.silhouette) for f in fits]
    frame = spark.createDataFrame(
        rows, "run_id string, k int, inertia double, silhouette double"
    )
    return frame.withColumn("below_threshold", F.col("silhouette") < threshold)


def level_frame(spark: SparkSession, fits) -> DataFrame:
    rows = [(f.level, f.k, f.k_found, f.n, f.inertia, f.silhouette) for f in fits]
    return spark.createDataFrame(
        rows,
        "level int, k int, k_found int, n long, inertia double, silhouette double",
    )
