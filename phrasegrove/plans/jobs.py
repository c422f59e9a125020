"""The three batch jobs: embed what is new, train the hierarchy, assign a day's phrases."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phrasegrove import schemas
from phrasegrove.functions.clients import Embedder, Namer, TermNamer
from phrasegrove.functions.vectors import with_array
from phrasegrove.operators.bounded import pin
from phrasegrove.operators.embedding import embed_phrases
from phrasegrove.operators.hierarchy import attach_names, names_wide
from phrasegrove.operators.incremental import (
    day_embeddings,
    increment_counts,
    is_new,
    new_rows,
    rows_per_id,
)
from phrasegrove.operators.metrics import elbow, metric_rows
from phrasegrove.operators.naming import attach_texts, cluster_samples, name_hierarchy
from phrasegrove.operators.nearest import distance_to_centroid
from phrasegrove.operators.quality import split_valid
from phrasegrove.operators.training import (
    FEATURES_COL,
    MakeEstimator,
    TrainedHierarchy,
    apply_pipeline,
    assemble,
    centre_rows,
    fit_features,
    k_sweep,
    kept,
    score,
    sweep_frame,
    train_levels,
)
from phrasegrove.params import ClusterParams, EmbedParams, NamingParams, Tables
from phrasegrove.plans import checks
from phrasegrove.sources.models import load_model, path_exists, save_model
from phrasegrove.sources.shared import fresh_path, stored
from phrasegrove.sources.tables import (
    DAY,
    on_day,
    read_or_empty,
    replace_day,
    table_exists,
    write_table,
)

PIPELINE, KMEANS_N2, KMEANS_N3 = "pipeline", "kmeans_n2", "kmeans_n3"


MAPPING, NAMES, RUNS = "mapping", "names", "runs"


def run_path(tables: Tables, run_id: str, part: str) -> str:
    """Where a training run keeps one of its parts: models, map or names."""
    return f"{tables.models.rstrip('/')}/{run_id}/{part}"


def runs_path(tables: Tables) -> str:
    return f"{tables.models.rstrip('/')}/{RUNS}"


def publish(spark: SparkSession, tables: Tables, run_id: str, trained_at: datetime) -> None:
    """Make a complete run the current one, by one appended row."""
    row = spark.createDataFrame([(run_id, trained_at)], "run_id string, trained_at timestamp")
    row.coalesce(1).write.mode("append").parquet(runs_path(tables))


def current_run(spark: SparkSession, tables: Tables) -> str:
    runs = spark.read.parquet(runs_path(tables))
    return runs.agg(F.max_by("run_id", F.struct("trained_at", "run_id"))).first()[0]


@dataclass(frozen=True)
class EmbedSummary:
    """Raw rows, those without an id, those embedded before, ids that were new, and ids
    embedded now. A new id without any text is not embedded: it is in ``new_ids`` of the run
    that finds it, recorded, and new again only with further raw rows."""

    total_raw: int
    without_id: int
    already_embedded: int
    new_ids: int
    embedded: int

    @property
    def without_text(self) -> int:
        return self.new_ids - self.embedded


def embed_new(
    spark: SparkSession,
    tables: Tables,
    make_embedder: Callable[[], Embedder],
    params: EmbedParams,
    created_at: datetime,
) -> EmbedSummary:
    """Embed the phrases of the raw table that the embeddings table lacks, and append them.

    The ids are compared once and kept; with nothing new no client is called, so running again is
    harmless. Each different text is embedded once, now or in an earlier run: vectors stand in a
    table by the text's digest. Texts that are not there yet go in waves of at most
    ``rows_per_task`` per task, each appended when done, and a job that is stopped goes on from
    there. Then the new ids take their texts' vectors by a join. Ids without a text are recorded.
    What was embedded is counted in the day's partition before and after, since counters kept by
    tasks count twice where a lost executor's tasks run again.
    """
    checks.require(checks.usable_table(spark, tables.raw, ["id", "frase"]))
    raw = spark.table(tables.raw).select(F.col("id").cast("string"), F.col("frase").cast("string"))
    existing = read_or_empty(spark, tables.embeddings, schemas.EMBEDDINGS).select("id")
    textless = read_or_empty(spark, tables.textless_table, schemas.TEXTLESS)
    per_id = stored(rows_per_id(raw, existing, textless=textless), "ids")
    counts = increment_counts(per_id).first()
    embedded = 0
    if counts.new_ids:
        before = embedded_on(spark, tables, created_at)
        new = new_rows(raw.where(F.col("frase").isNotNull()), per_id.where(is_new()))
        new = stored(new.withColumn("digest", F.sha2("frase", 256)), "new")
        embed_texts(spark, tables, new, make_embedder, params, created_at)
        append_vectors(spark, tables, new, created_at)
        embedded = embedded_on(spark, tables, created_at) - before
        record_textless(tables, per_id.where(is_new()), new, created_at)
    return EmbedSummary(
        total_raw=counts.total_raw,
        without_id=counts.without_id,
        already_embedded=counts.already_embedded,
        new_ids=counts.new_ids,
        embedded=embedded,
    )


def embed_texts(
    spark: SparkSession,
    tables: Tables,
    new: DataFrame,
    make_embedder: Callable[[], Embedder],
    params: EmbedParams,
    created_at: datetime,
) -> None:
    """Embed the texts of ``new`` whose digests have no vector yet, wave by wave.

    Copies of a text fall away in each task before the shuffle, so a text that many ids have is no
    large group. The digests are counted first, by themselves; then the texts are grouped and written
    once, by wave.
    """
    known = read_or_empty(spark, tables.digests_table, schemas.DIGESTS).select("digest")
    asked = new.select("digest").distinct().join(known, "digest", "left_anti").count()
    waves = -(-asked // (params.max_concurrent * params.rows_per_task))
    if not waves:
        return
    path = fresh_path(spark, "waves")
    wave_of = F.pmod(F.xxhash64("digest"), F.lit(waves)).cast("int")
    texts = new.groupBy("digest").agg(F.min("frase").alias("frase")).join(known, "digest", "left_anti")
    texts.withColumn("wave", wave_of).write.partitionBy("wave").parquet(path)
    parts = spark.read.schema("digest string, frase string, wave int").parquet(path)
    for wave in range(waves):
        rows = embed_phrases(parts.where(F.col("wave") == wave), make_embedder, params, id_col="digest", scanned=True)
        rows = rows.withColumnRenamed("id", "digest").withColumn("created_at", F.lit(created_at))
        write_table(schemas.conform(rows, schemas.DIGESTS), tables.digests_table)


def append_vectors(spark: SparkSession, tables: Tables, new: DataFrame, created_at: datetime) -> None:
    """Append ``new`` with the vectors of its texts.

    A digest has one vector (the first of those that two runs at once may have left), so the skew
    join can split the rows of a frequent text.
    """
    vectors = read_or_empty(spark, tables.digests_table, schemas.DIGESTS).join(new.select("digest").distinct(), "digest", "left_semi")
    vectors = vectors.groupBy("digest").agg(F.min_by("embedding", "created_at").alias("embedding"))
    rows = new.join(vectors, "digest").withColumn("created_at", F.lit(created_at))
    rows = schemas.conform(rows, schemas.EMBEDDINGS).withColumn(DAY, F.to_date("created_at"))
    write_table(rows, tables.embeddings, "append", DAY)


def record_textless(tables: Tables, found: DataFrame, new: DataFrame, created_at: datetime) -> None:
    """Record the ids that were new but had no text, with the number of their raw rows."""
    rows = found.join(new.select("id"), "id", "left_anti").withColumn("created_at", F.lit(created_at))
    write_table(schemas.conform(rows, schemas.TEXTLESS), tables.textless_table)


def embedded_on(spark: SparkSession, tables: Tables, moment: datetime) -> int:
    """Rows in the day partition of ``moment``."""
    if not table_exists(spark, tables.embeddings):
        return 0
    rows = spark.table(tables.embeddings)
    day = F.to_date(F.lit(moment))
    return rows.where((F.col(DAY) if DAY in rows.columns else F.to_date("created_at")) == day).count()


@dataclass(frozen=True)
class TrainSummary:
    hierarchy: TrainedHierarchy
    recommended_k: int | None
    reason: str | None
    quarantined: int
    total_records: int


def train(
    spark: SparkSession,
    tables: Tables,
    params: ClusterParams,
    run_id: str,
    trained_at: datetime,
    dims: int,
    make_namer: Callable[[], Namer] | None = TermNamer,
    naming: NamingParams = NamingParams(),
    make_estimator: MakeEstimator | None = None,
) -> TrainSummary:
    """Study k, fit the hierarchy, store models, map, names and metrics.

    All parts lie under the run's id and are made current together, when they are complete.
    Embeddings of another size or with null or NaN elements are left out and counted. With no
    namer the names table is left alone.
    """
    checks.require(
        checks.level_order(params),
        checks.usable_table(spark, tables.embeddings, ["id", "frase", "embedding"]),
        checks.path_usable(spark, tables.models),
    )
    embeddings = spark.table(tables.embeddings)
    valid, _ = split_valid(embeddings, "embedding", dims)
    stamp = F.lit(trained_at).cast("timestamp")

    features_model = fit_features(valid, params.pca_dims, solver=params.pca_solver)
    features = apply_pipeline(features_model, valid.select("id", "embedding"))
    recommended, reason = None, None
    with kept(features.select("id", FEATURES_COL)) as rows:
        if params.sweep:
            fits = k_sweep(rows, params, make_estimator=make_estimator)
            sweep = sweep_frame(spark, fits, run_id, params.silhouette_threshold)
            write_table(
                metric_rows(
                    sweep.select(
                        "run_id",
                        stamp.alias("trained_at"),
                        F.col("k").alias("k_n1"),
                        F.col("silhouette").alias("silhouette_n1"),
                        F.col("inertia").alias("inertia_n1"),
                    )
                ),
                tables.metrics,
            )
            best = elbow(sweep).where("recommended").first()
            recommended = best["k"]
            reason = f"elbow at k={best['k']}, silhouette={best['silhouette']}"
        levels = train_levels(rows, params, make_estimator)
    trained = assemble(spark, features_model, levels)
    n_valid = levels[0].n
    n_all = embeddings.count()

    save_model(trained.pipeline, run_path(tables, run_id, PIPELINE))
    save_model(levels[1].model, run_path(tables, run_id, KMEANS_N2))
    save_model(levels[2].model, run_path(tables, run_id, KMEANS_N3))
    mapping = schemas.conform(trained.mapping, schemas.MAPPING)
    mapping.write.mode("overwrite").parquet(run_path(tables, run_id, MAPPING))

    named = None
    if make_namer is not None:
        points = apply_pipeline(trained.pipeline, valid.select("id", "embedding"))
        points = with_array(points, FEATURES_COL, "point", "double")
        placed = distance_to_centroid(
            points.select("id", "cluster_n1", "point"),
            centre_rows(spark, levels[0].model),
            "point",
        ).drop("point")
        # Only the samples' texts are fetched, at the end.
        samples = cluster_samples(placed, naming.samples_per_cluster)
        samples = attach_texts(samples, valid.select("id", "frase"))
        names = name_hierarchy(samples, mapping, make_namer, naming, keep=pin)
        named = schemas.conform(names.withColumn("trained_at", stamp), schemas.NAMES)
        named.write.mode("overwrite").parquet(run_path(tables, run_id, NAMES))

    # Everything of the run is written: the tables follow, then the one row that makes it current.
    write_table(mapping, tables.mapping, "overwrite")
    if named is not None:
        write_table(spark.read.parquet(run_path(tables, run_id, NAMES)), tables.names, "overwrite")
    write_table(run_metrics(spark, levels, params, run_id, trained_at, n_valid), tables.metrics)
    publish(spark, tables, run_id, trained_at)
    return TrainSummary(trained, recommended, reason, n_all - n_valid, n_valid)


def run_metrics(
    spark: SparkSession, levels, params: ClusterParams, run_id: str, trained_at: datetime, total: int
) -> DataFrame:
    """The one metrics row of a training run."""
    row = {"run_id": run_id, "total_records": total, "pca_dims": params.pca_dims}
    for fit in levels:
        row[f"k_n{fit.level}"] = fit.k
        row[f"silhouette_n{fit.level}"] = fit.silhouette
        row[f"inertia_n{fit.level}"] = fit.inertia
    row["trained_at"] = trained_at
    ordered = tuple(row[name] for name in schemas.METRICS.names)
    return spark.createDataFrame([ordered], schemas.METRICS)


@dataclass(frozen=True)
class Run:
    """What assignment needs of a training run; ``names`` has a row per N1 cluster."""

    run_id: str
    pipeline: PipelineModel
    mapping: DataFrame
    names: DataFrame | None


def load_run(spark: SparkSession, tables: Tables, run_id: str) -> Run:
    mapping = spark.read.schema(schemas.MAPPING).parquet(run_path(tables, run_id, MAPPING))
    names_path = run_path(tables, run_id, NAMES)
    names = None
    if path_exists(spark, names_path):
        names = pin(names_wide(mapping, spark.read.parquet(names_path)))
    return Run(run_id, load_model(run_path(tables, run_id, PIPELINE), PipelineModel), mapping, names)


def outcome(run: Run, rows: DataFrame, dims: int, processed_at: datetime) -> tuple[DataFrame, DataFrame]:
    """``(id, frase, embedding)`` rows as rows of the output table, and those that cannot be scored
    as rows of the quarantine table."""
    valid, broken = split_valid(rows, "embedding", dims)
    stamp = F.lit(processed_at).cast("timestamp")
    scored = attach_names(score(valid, run.pipeline, run.mapping), run.names)
    broken = broken.withColumn("reason", F.lit("embedding")).withColumn("processed_at", stamp)
    return (
        schemas.conform(scored.withColumn("processed_at", stamp), schemas.OUTPUT),
        schemas.conform(broken, schemas.QUARANTINE),
    )


@dataclass(frozen=True)
class AssignSummary:
    """Rows of the day in the output table, and rows of the day that could not be scored."""

    rows: int
    quarantined: int


def assign(
    spark: SparkSession,
    tables: Tables,
    day: date,
    processed_at: datetime,
    dims: int,
    fresh: DataFrame | None = None,
) -> AssignSummary:
    """Score the embeddings of ``day`` and make them the output table's part for it.

    Model, map and names are those of one training run, the current one. Rows with an unusable
    embedding become the quarantine table's part for the day. Running it again for a day
    replaces both parts. ``fresh`` are further embeddings of the day that are not stored yet.

    A row's day is its partition's where the table has one, else its timestamp's in the session's
    zone; never both, so no row falls between two days.
    """
    checks.require(
        checks.model_present(spark, runs_path(tables)),
        checks.usable_table(spark, tables.embeddings, schemas.EMBEDDINGS.names),
    )
    embeddings = spark.table(tables.embeddings)
    of_day = F.col(DAY) == F.lit(day) if DAY in embeddings.columns else on_day("created_at", day)
    columns = ["id", "frase", "embedding"]
    rows = embeddings.where(of_day).select(*columns)
    if fresh is not None:
        rows = day_embeddings(rows, fresh.select(*columns))
    output, broken = outcome(load_run(spark, tables, current_run(spark, tables)), rows, dims, processed_at)
    replace_day(output, tables.output, day)
    replace_day(broken, tables.quarantine_table, day)
    counts = [
        spark.table(name).where(F.col(DAY) == F.lit(day)).count()
        for name in (tables.output, tables.quarantine_table)
    ]
    return AssignSummary(*counts)
