"""The registered queries: each operator of the engine over the given parquet tables.

The tables stand in for the engine's own: ``documents`` and ``conversations`` for raw
phrases, ``embeddings`` for stored vectors, ``events`` for rows of many days. The given
``label`` of a vector serves as a fixed N1 cluster, so that SQL can follow.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import partial

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phrasegrove import schemas
from phrasegrove.functions import prompts
from phrasegrove.functions.clients import TermNamer, TokenHashEmbedder
from phrasegrove.functions.vectors import l2_normalize, with_array
from phrasegrove.operators import hierarchy, incremental, metrics, moments, naming, quality, training
from phrasegrove.operators.bounded import pin
from phrasegrove.operators.covariance import covariance
from phrasegrove.operators.embedding import embed_phrases
from phrasegrove.operators.nearest import nearest_centroid
from phrasegrove.params import ClusterParams, EmbedParams, NamingParams, Tables
from phrasegrove.plans import jobs
from phrasegrove.plans.ship import ship_package
from phrasegrove.sources import models, tables
from phrasegrove.sources.shared import fresh_path
from phrasegrove.streaming.assign import BatchAssigner, assign_stream, stream_assign

DIMS = 64
DAY = date(2024, 1, 15)
STAMP = datetime(2024, 2, 1)
SWEEP_GROUPS = (2, 3, 5, 8, 10)

# The default cluster numbers and axes do not fit 500 vectors of 64 dims.
SMALL = ClusterParams(
    k_n1=20, k_n2=8, k_n3=3, pca_dims=16, k_candidates=(2, 5, 10, 20), sample_fraction=0.5
)
EMBED = EmbedParams(dims=DIMS, max_concurrent=8, first_delay=0.0)
NAMING = NamingParams(max_concurrent=8, first_delay=0.0)

make_embedder = partial(TokenHashEmbedder, DIMS)


# --- the given tables in the engine's terms ---------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("frase")
    )


def conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.concat_ws("-", "conv_id", "turn")).alias("id"),
        F.col("text").alias("frase"),
    )


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), "embedding", "label"
    )


def with_damage(rows):
    """The vectors, and again those of labels 0 to 3: cut short, null, with a NaN, with a null."""
    size = F.size("embedding")
    first = F.slice("embedding", 1, size - 1)
    damaged = (
        F.when(F.col("label") == 0, first)
        .when(F.col("label") == 2, F.concat(first, F.array(F.lit(float("nan")).cast("float"))))
        .when(F.col("label") == 3, F.concat(first, F.array(F.lit(None).cast("float"))))
    )
    broken = rows.where(F.col("label").isin(0, 1, 2, 3))
    broken = broken.withColumn("id", F.concat(F.lit("x"), "id")).withColumn("embedding", damaged)
    return rows.unionByName(broken)


def raw_with_copies(spark, sf_dir):
    """The raw phrases, those of two sources twice, and those of one again without an id."""
    given = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("frase"), "source"
    )
    twice = given.where(F.col("source").isin("src1", "src2"))
    nameless = given.where("source = 'src3'").withColumn("id", F.lit(None).cast("string"))
    return given.unionByName(twice).unionByName(nameless).drop("source")


def label_levels(spark, sf_dir):
    """Centroids of the labels, of the labels' remainders by 4, and of those by 2."""
    n1 = pin(moments.centroids(vectors(spark, sf_dir), "label", dims=DIMS))
    n2 = pin(moments.centroids(n1.withColumn("g", F.col("cluster_id") % 4), "g", "centroid"))
    n3 = pin(moments.centroids(n2.withColumn("g", F.col("cluster_id") % 2), "g", "centroid"))
    return n1, n2, n3


def label_mapping(spark, sf_dir):
    n1, n2, n3 = label_levels(spark, sf_dir)
    return n1, pin(hierarchy.cluster_mapping(n1, n2, n3))


def assigned(spark, sf_dir):
    n1, mapping = label_mapping(spark, sf_dir)
    return hierarchy.assign_hierarchy(vectors(spark, sf_dir), n1, mapping), mapping


def samples(spark, sf_dir, rows):
    """The vectors nearest their centroid, with their document's text where there is one."""
    chosen = naming.cluster_samples(
        rows.select("id", "cluster_n1", "distance"), NAMING.samples_per_cluster
    )
    return naming.attach_texts(chosen, documents(spark, sf_dir))


def named(spark, sf_dir):
    """Rows with their clusters, the map of the levels, and the names of all levels."""
    rows, mapping = assigned(spark, sf_dir)
    chosen = samples(spark, sf_dir, rows)
    return rows, mapping, naming.name_hierarchy(chosen, mapping, TermNamer, NAMING, keep=pin)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def scratch_database(spark: SparkSession) -> str:
    name = f"grove_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_path(spark, name)}'")
    return name


# --- scans and sinks -------------------------------------------------------------------


def scan_day_filter(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("day_events")
    rows = tables.read_table_with_filter(
        spark, "day_events", f"date(ts) = date('{DAY.isoformat()}')"
    )
    return rows.select("event_id", "user_id", "event_type", "value")


def sink_roundtrip(spark, sf_dir):
    name = f"{scratch_database(spark)}.raw"
    for rows in (documents(spark, sf_dir), conversations(spark, sf_dir)):
        tables.write_table(schemas.conform(rows, schemas.RAW), name)
    return tables.read_table(spark, name)


def sink_overwrite(spark, sf_dir):
    name = f"{scratch_database(spark)}.events"
    events = table(spark, sf_dir, "events").select(
        "event_id", "value", F.to_date("ts").alias("day")
    )
    for mode in ("append", "overwrite"):
        tables.write_table(events, name, mode, "day")
    revised = events.where(F.col("day") == F.lit(DAY)).withColumn("value", -F.col("value"))
    tables.replace_day(revised, name, DAY)
    return tables.read_table(spark, name)


def table_counts(spark, sf_dir):
    counts = [
        table(spark, sf_dir, name).agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        for name in ("documents", "conversations", "embeddings", "events")
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def existing_ids(spark, sf_dir):
    return incremental.existing_ids(vectors(spark, sf_dir))


# --- incremental -----------------------------------------------------------------------


def new_phrases(spark, sf_dir):
    return incremental.new_phrases(raw_with_copies(spark, sf_dir), vectors(spark, sf_dir))


def new_phrases_first_run(spark, sf_dir):
    nothing = tables.read_or_empty(spark, "no_embeddings_yet", schemas.EMBEDDINGS)
    return incremental.new_phrases(documents(spark, sf_dir), nothing)


def embedding_reconcile(spark, sf_dir):
    return incremental.reconcile(raw_with_copies(spark, sf_dir), vectors(spark, sf_dir))


def phrase_batches(spark, sf_dir):
    numbered = incremental.number_batches(
        documents(spark, sf_dir).select("id"), EmbedParams().batch_size, digits=3
    )
    return numbered.select("id", F.col("batch_no").cast("long"))


def exact_sample(spark, sf_dir):
    """A hundred ids of the raw phrases, with all rows of each."""
    return incremental.exact_sample(raw_with_copies(spark, sf_dir), 100).groupBy("id").agg(F.count("*").alias("n"))


def hash_sample(spark, sf_dir):
    return incremental.hash_sample(documents(spark, sf_dir).select("id"), 0.2)


def embed_documents(spark, sf_dir):
    embedded = embed_phrases(documents(spark, sf_dir), make_embedder, EMBED)
    cells = embedded.select("id", F.posexplode("embedding").alias("dim", "value"))
    filled = cells.where(F.col("value") != 0)
    return filled.select("id", "dim", F.round(F.col("value").cast("double"), 6).alias("value"))


def day_embeddings_union(spark, sf_dir):
    stored = vectors(spark, sf_dir).select("id", "embedding", F.lit("stored").alias("origin"))
    fresh = embed_phrases(documents(spark, sf_dir), make_embedder, EMBED).select(
        "id", "embedding", F.lit("new").alias("origin")
    )
    both = incremental.day_embeddings(stored, fresh)
    cells = both.select("id", "origin", F.explode("embedding").alias("x"))
    size = F.sqrt(F.sum(F.col("x").cast("double") * F.col("x")))
    return cells.groupBy("id", "origin").agg(
        F.count("x").alias("n_dims"), F.round(size, 5).alias("size")
    )


# --- vectors ---------------------------------------------------------------------------


def l2_normalized(spark, sf_dir):
    unit = l2_normalize(vectors(spark, sf_dir), "embedding", "unit")
    return rounded(unit.select("id", F.posexplode("unit").alias("dim", "value")), "value")


def covariance_pairs(spark, sf_dir):
    return rounded(covariance(vectors(spark, sf_dir), "embedding", DIMS), "cov", digits=8)


def label_centroids(spark, sf_dir):
    means = moments.centroids(vectors(spark, sf_dir), "label", dims=DIMS)
    return rounded(moments.unpack(means, "centroid"), "value")


def nearest(spark, sf_dir):
    n1 = moments.centroids(vectors(spark, sf_dir), "label", dims=DIMS)
    found = nearest_centroid(vectors(spark, sf_dir), n1)
    return rounded(found.select("id", "cluster_id", "distance"), "distance")


def lloyd_step(spark, sf_dir):
    n1 = moments.centroids(vectors(spark, sf_dir), "label", dims=DIMS)
    moved = moments.centroids(nearest_centroid(vectors(spark, sf_dir), n1), "cluster_id")
    return rounded(moments.unpack(moved, "centroid"), "value")


def wcss(spark, sf_dir):
    return rounded(moments.wcss(moments.cluster_moments(vectors(spark, sf_dir), "label")), "wcss")


def silhouette(spark, sf_dir):
    return rounded(metrics.silhouette_by_cluster(vectors(spark, sf_dir), "label"), "silhouette")


def elbow(spark, sf_dir):
    """Inertia of the groupings ``label mod k``, all from one pass over the vectors."""
    sums = moments.cluster_moments(vectors(spark, sf_dir), "label", dims=DIMS)
    candidates = F.explode(F.array(*[F.lit(k) for k in SWEEP_GROUPS]))
    regrouped = moments.merged_moments(
        sums.withColumn("k", candidates), F.col("cluster_id") % F.col("k"), "k"
    )
    sweep = regrouped.groupBy("k").agg(F.sum(moments.total("spread")).alias("inertia"))
    marked = metrics.elbow(sweep.withColumn("run_id", F.lit("labels")))
    return rounded(
        marked.select("k", "inertia", "curvature", "recommended"), "inertia", "curvature"
    )


# --- hierarchy -------------------------------------------------------------------------


def cluster_mapping(spark, sf_dir):
    return label_mapping(spark, sf_dir)[1]


def mapping_pairs(spark, sf_dir):
    return label_mapping(spark, sf_dir)[1].select("cluster_n2", "cluster_n3").distinct()


def assign_hierarchy(spark, sf_dir):
    rows, _ = assigned(spark, sf_dir)
    return rows.select("id", "cluster_n1", "cluster_n2", "cluster_n3")


def embedding_quality(spark, sf_dir):
    return quality.embedding_report(with_damage(vectors(spark, sf_dir)), "embedding", DIMS)


def assignment_quality(spark, sf_dir):
    """Damaged vectors are assigned too, and stay without a cluster."""
    n1, mapping = label_mapping(spark, sf_dir)
    rows = with_damage(vectors(spark, sf_dir)).drop("label")
    return quality.assignment_report(hierarchy.assign_hierarchy(rows, n1, mapping), "cluster_n1")


def run_metrics(spark, sf_dir):
    """The metrics row of the label hierarchy, each level judged on its own points."""
    n1, n2, n3 = label_levels(spark, sf_dir)
    mapping = pin(hierarchy.cluster_mapping(n1, n2, n3))
    level_points = [
        (vectors(spark, sf_dir), "label", "embedding"),
        (parented(n1, mapping, 1), "parent", "centroid"),
        (parented(n2, mapping, 2), "parent", "centroid"),
    ]
    fits = []
    for level, (points, cluster, vec) in enumerate(level_points, start=1):
        per_cluster = moments.wcss(moments.cluster_moments(points, cluster, vec, DIMS))
        found = per_cluster.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("wcss").alias("w"))
        k, n, inertia = found.first()
        score = metrics.mean_silhouette(points, cluster, vec, DIMS).first()[0]
        fits.append(training.LevelFit(level, k, k, n, inertia, score, None))
    full = jobs.run_metrics(
        spark, fits, replace(SMALL, pca_dims=DIMS), "labels", STAMP, fits[0].n
    )
    floats = [f"{m}_n{n}" for m in ("silhouette", "inertia") for n in (1, 2, 3)]
    shown = full.drop("trained_at").withColumns({c: F.col(c).cast("double") for c in floats})
    return rounded(shown, *floats, digits=4)


def parented(centres, mapping, level):
    child, parent = f"cluster_n{level}", f"cluster_n{level + 1}"
    pairs = mapping.select(
        F.col(child).alias("cluster_id"), F.col(parent).alias("parent")
    ).distinct()
    return centres.join(pairs, "cluster_id")


# --- naming ----------------------------------------------------------------------------


def cluster_samples(spark, sf_dir):
    rows = samples(spark, sf_dir, assigned(spark, sf_dir)[0])
    rows = rows.withColumn("distance", F.round("distance", 6))
    return rows.select("cluster_n1", "position", "id", "distance", "frase")


def naming_prompt(spark, sf_dir):
    """The prompts of all levels, each for the same groups of phrases."""
    groups = pin(naming.sample_phrases(samples(spark, sf_dir, assigned(spark, sf_dir)[0])))
    prompts_of = [naming.naming_prompts(groups, level) for level in (1, 2, 3)]
    return prompts_of[0].unionByName(prompts_of[1]).unionByName(prompts_of[2])


def parse_name_json(spark, sf_dir):
    """Answers built from every event: good ones, one without a key, and broken ones."""
    quoted = F.concat(F.lit('{"nome": "'), F.col("event_type"), F.lit('", "dor": "need '))
    answer = (
        F.when(F.col("event_type") == "error", F.substring("props", 1, 4))
        .when(F.col("event_type") == "view", F.col("props"))
        .when(F.col("event_type") == "click", F.lit(None).cast("string"))
        .otherwise(F.concat(quoted, F.col("user_id"), F.lit('"}')))
    )
    rows = table(spark, sf_dir, "events").select("event_id", answer.alias("answer"))
    return rows.select("event_id", prompts.parse_answer("answer").alias("r")).select(
        "event_id", "r.*"
    )


def names_n1(spark, sf_dir):
    groups = naming.sample_phrases(samples(spark, sf_dir, assigned(spark, sf_dir)[0]))
    return naming.name_level(groups, 1, TermNamer, NAMING)


def parent_children(spark, sf_dir):
    _, mapping, names = named(spark, sf_dir)
    level = names.where("nivel = 1")
    groups = naming.child_names(mapping, level, "cluster_n1", "cluster_n2")
    return groups.select("cluster_id", F.concat_ws("|", "phrases").alias("children"))


def names_parent(spark, sf_dir):
    return named(spark, sf_dir)[2].where("nivel > 1")


def names_wide(spark, sf_dir):
    _, mapping, names = named(spark, sf_dir)
    return hierarchy.names_wide(mapping, names)


def names_long(spark, sf_dir):
    return hierarchy.names_long(names_wide(spark, sf_dir))


def enrich_names(spark, sf_dir):
    rows, mapping, names = named(spark, sf_dir)
    plain = names.select("cluster_id", "nivel", "nome", "dor")
    enriched = hierarchy.with_names(rows, plain, mapping)
    stamped = enriched.withColumn("processed_on", F.to_date(F.lit(STAMP)))
    return stamped.select("id", *hierarchy.WIDE_COLUMNS, "processed_on")


# --- models ----------------------------------------------------------------------------


def features(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    model = training.fit_features(rows, SMALL.pca_dims)
    return training.apply_pipeline(model, rows).select("id", training.FEATURES_COL)


def pca_project(spark, sf_dir):
    """The projection against the saved axes times the unit vectors, and the axes' products."""
    rows = vectors(spark, sf_dir)
    model = training.fit_features(rows, SMALL.pca_dims)
    axes = model.stages[-1].pc.toArray()
    products = axes.T @ axes
    crooked = int((abs(products - np.eye(len(products))) > 1e-9).sum())
    columns = F.array(*[F.array(*map(F.lit, axis.tolist())) for axis in axes.T])
    both = with_array(training.apply_pipeline(model, rows), training.FEATURES_COL, "found", "double")
    both = l2_normalize(both, "embedding", "unit").withColumn(
        "wanted",
        F.transform(
            columns,
            lambda axis: F.aggregate(
                F.zip_with("unit", axis, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x
            ),
        ),
    )
    apart = F.exists(F.zip_with("found", "wanted", lambda x, y: F.abs(x - y)), lambda x: x > 1e-6)
    return both.agg(
        F.count("*").alias("n_rows"),
        F.max(F.size("found")).alias("n_axes"),
        F.count_if(apart).alias("n_differ"),
        F.lit(crooked).alias("n_crooked"),
    )


def pca_project_rows(spark, sf_dir):
    """Every coordinate of every projected vector."""
    cells = with_array(features(spark, sf_dir), training.FEATURES_COL, "axes", "double")
    return cells.select("id", F.posexplode("axes").alias("dim", "value"))


def fit_report(spark, rows, fit):
    """One row of a fitted level: its size, points that are not at their nearest centre, and
    whether the inertia is the sum of the distances."""
    points = with_array(fit.model.transform(rows), training.FEATURES_COL, "point", "double")
    placed = nearest_centroid(points, training.centre_rows(spark, fit.model), "point", "near")
    off = F.col("near") != F.col(fit.model.getPredictionCol())
    return placed.agg(
        F.lit(fit.k).alias("k"),
        F.lit(fit.k_found).alias("k_found"),
        F.count("*").alias("n"),
        F.count_if(off).alias("n_not_nearest"),
        (F.abs(F.sum("distance") - fit.inertia) <= 1e-6 * (1 + fit.inertia)).alias("inertia_agrees"),
    )


def train_level(spark, sf_dir):
    with training.kept(features(spark, sf_dir)) as rows:
        report = None
        for k in SMALL.k_candidates:
            fit = training.fit_level(rows, k, 1, training.kmeans(SMALL), training.FEATURES_COL)
            one = pin(fit_report(spark, rows, fit))
            report = one if report is None else report.unionByName(one)
    return report


def train_level_rows(spark, sf_dir):
    """The measures of a level fitted with each candidate."""
    with training.kept(features(spark, sf_dir)) as rows:
        fits = [
            training.fit_level(rows, k, 1, training.kmeans(SMALL), training.FEATURES_COL)
            for k in SMALL.k_candidates
        ]
    return training.level_frame(spark, fits)


def train_hierarchy_rows(spark, sf_dir):
    """The three clusters of every vector."""
    trained = training.train_hierarchy(vectors(spark, sf_dir), SMALL)
    scored = training.score(vectors(spark, sf_dir), trained.pipeline, trained.mapping)
    return scored.select("id", "cluster_n1", "cluster_n2", "cluster_n3")


def train_hierarchy(spark, sf_dir):
    """Every vector is in one cluster of each level, the map is a tree, and all of it is found."""
    trained = training.train_hierarchy(vectors(spark, sf_dir), SMALL)
    scored = training.score(vectors(spark, sf_dir), trained.pipeline, trained.mapping)
    levels = [f"cluster_n{n}" for n in (1, 2, 3)]
    missing = F.lit(False)
    for level in levels:
        missing = missing | F.col(level).isNull()
    counts = scored.agg(F.count("*").alias("n_rows"), F.count_if(missing).alias("n_unassigned"))
    above = trained.mapping.groupBy("cluster_n2").agg(F.countDistinct("cluster_n3").alias("parents"))
    split = above.agg(F.count_if(F.col("parents") != 1).alias("n_split"))
    size = trained.mapping.agg(
        F.count("*").alias("n_mapped"), F.countDistinct("cluster_n1").alias("n_clusters")
    )
    found = F.lit(trained.levels[0].k_found)
    one = [pin(part).withColumn("one", F.lit(1)) for part in (counts, split, size)]
    joined = one[0].join(one[1], "one").join(one[2], "one")
    return joined.select(
        "n_rows",
        "n_unassigned",
        "n_split",
        ((F.col("n_mapped") == found) & (F.col("n_clusters") == found)).alias("mapped_all"),
    )


def swept(spark, sf_dir):
    fits = training.k_sweep(features(spark, sf_dir), SMALL)
    sweep = training.sweep_frame(spark, fits, "sweep", SMALL.silhouette_threshold)
    return metrics.elbow(sweep)


def k_sweep(spark, sf_dir):
    """The candidates, with the recommendation against the rule worked out from the inertias."""
    rows = pin(swept(spark, sf_dir))
    marks = {r.k: (r.inertia, r.recommended) for r in rows.select("k", "inertia", "recommended").collect()}
    ks, top = sorted(marks), max(inertia for inertia, _ in marks.values())
    scaled = {k: marks[k][0] / top for k in ks}
    bend = {b: scaled[a] - 2 * scaled[b] + scaled[c] for a, b, c in zip(ks, ks[1:], ks[2:])}
    best = max(bend, key=lambda k: (bend[k], -k))
    agrees = F.col("recommended") == (F.col("k") == best)
    falls = F.coalesce(F.col("inertia") <= F.lag("inertia").over(Window.orderBy("k")), F.lit(True))
    scored = F.col("silhouette").between(-1, 1)
    return rows.select(
        "k", agrees.alias("elbow_agrees"), falls.alias("inertia_falls"), scored.alias("has_silhouette")
    )


def sweep_table(spark, sf_dir):
    """The metrics table that a sweep leaves."""
    name = f"{scratch_database(spark)}.metrics"
    rows = swept(spark, sf_dir).select(
        "run_id",
        F.lit(STAMP).alias("trained_at"),
        F.col("k").alias("k_n1"),
        F.col("silhouette").alias("silhouette_n1"),
        F.col("inertia").alias("inertia_n1"),
    )
    tables.write_table(metrics.metric_rows(rows), name)
    return tables.read_table(spark, name)


def k_sweep_metrics(spark, sf_dir):
    """What the metrics table holds of a sweep: known columns filled, the others null."""
    known = ["run_id", "trained_at", "k_n1", "silhouette_n1", "inertia_n1"]
    kept = sweep_table(spark, sf_dir)
    filled = sum((F.col(c).isNotNull().cast("int") for c in known), F.lit(0))
    other = [c for c in kept.columns if c not in known]
    null = sum((F.col(c).isNull().cast("int") for c in other), F.lit(0))
    return kept.select("run_id", "k_n1", filled.alias("n_filled"), null.alias("n_null"))


def model_roundtrip(spark, sf_dir):
    """Rows whose cluster differs between a fitted model and its saved and loaded form."""
    trained = training.train_hierarchy(vectors(spark, sf_dir), SMALL)
    path = fresh_path(spark, "model")
    models.save_model(trained.pipeline, path)
    loaded = models.load_model(path, PipelineModel)
    before, after = (
        training.score(vectors(spark, sf_dir), model, trained.mapping).select(
            "id", F.col("cluster_n1").alias(name)
        )
        for model, name in ((trained.pipeline, "before"), (loaded, "after"))
    )
    return before.join(after, "id").agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("n_differ"),
    )


def streamed_assignment(spark, sf_dir):
    n1, mapping = label_mapping(spark, sf_dir)
    given = table(spark, sf_dir, "embeddings")
    # A stream reads folders: a table that is one file is first written as a folder of parts.
    folder = fresh_path(spark, "source")
    given.repartition(4).write.parquet(folder)
    source = (
        spark.readStream.schema(given.schema)
        .parquet(folder)
        .select(F.col("vec_id").cast("string").alias("id"), "embedding")
    )

    def assign(df):
        placed = hierarchy.assign_hierarchy(df, n1, mapping)
        return placed.select("id", "cluster_n1", "cluster_n2", "cluster_n3")

    output = fresh_path(spark, "stream")
    stream_assign(source, assign, output, fresh_path(spark, "stream-log")).awaitTermination()
    return spark.read.parquet(output)


# --- jobs ------------------------------------------------------------------------------


def documents_near_vectors(spark, sf_dir):
    """The phrases whose id lies between the vectors' smallest and largest: no other has a vector, so
    the join with the vectors need not shuffle the others' texts."""
    ids = table(spark, sf_dir, "embeddings").agg(F.min("vec_id").alias("low"), F.max("vec_id").alias("high")).first()
    within = F.col("id").cast("bigint").between(ids["low"], ids["high"])
    return documents(spark, sf_dir).where(within)


def job_tables(spark, sf_dir) -> Tables:
    """Tables of a first day: all raw phrases, and the given vectors as stored embeddings."""
    base = scratch_database(spark)
    names = {f: f"{base}.{f}" for f in Tables.__dataclass_fields__ if f != "models"}  # and quarantine
    job = Tables(models=fresh_path(spark, "models"), **names)
    tables.write_table(schemas.conform(documents(spark, sf_dir), schemas.RAW), job.raw)
    stored = vectors(spark, sf_dir).join(documents_near_vectors(spark, sf_dir), "id", "left")
    stored = stored.withColumn("frase", F.coalesce("frase", F.lit(""))).withColumn(
        "created_at", F.lit(datetime(2024, 1, 14, 12))
    )
    stored = schemas.conform(stored, schemas.EMBEDDINGS)
    stored = stored.withColumn(tables.DAY, F.to_date("created_at"))
    tables.write_table(stored, job.embeddings, "append", tables.DAY)
    return job


def run_embedding(spark, job):
    return jobs.embed_new(spark, job, make_embedder, EMBED, datetime(2024, 1, 15, 12))


def job_embedding(spark, sf_dir):
    """Two runs of the job; the second finds nothing new."""
    job = job_tables(spark, sf_dir)
    run_embedding(spark, job)
    run_embedding(spark, job)
    rows = tables.read_table(spark, job.embeddings)
    return rows.select("id", F.size("embedding").alias("n_dims"), tables.DAY)


def trained_job(spark, sf_dir):
    job = job_tables(spark, sf_dir)
    run_embedding(spark, job)
    jobs.train(spark, job, SMALL, "run", STAMP, DIMS, TermNamer, NAMING)
    return job


def job_training_rows(spark, sf_dir):
    """The metrics table that the training job leaves."""
    return tables.read_table(spark, trained_job(spark, sf_dir).metrics)


def job_training(spark, sf_dir):
    """Rows of each table that the training job leaves, and of a second run: metrics only grow."""
    job = trained_job(spark, sf_dir)
    jobs.train(spark, job, SMALL, "again", STAMP + timedelta(days=1), DIMS, TermNamer, NAMING)
    names = tables.read_table(spark, job.names)
    per_level = names.groupBy(F.concat(F.lit("names_"), "nivel").alias("part")).agg(
        F.count("*").alias("n"), F.count_if(F.col("nome") == prompts.FALLBACK).alias("n_bad")
    )
    mapping = tables.read_table(spark, job.mapping).agg(
        F.lit("mapping").alias("part"), F.count("*").alias("n"), F.lit(0).cast("long").alias("n_bad")
    )
    kept = tables.read_table(spark, job.metrics)
    partly = F.col("silhouette_n1").isNull() | F.col("inertia_n1").isNull()
    measured = kept.agg(
        F.lit("metrics").alias("part"), F.count("*").alias("n"), F.count_if(partly).alias("n_bad")
    )
    return per_level.unionByName(mapping).unionByName(measured)


def job_assignment(spark, sf_dir):
    """A day with damaged rows, assigned twice: what went in, and what came out where."""
    job = trained_job(spark, sf_dir)
    damaged = with_damage(vectors(spark, sf_dir)).where("id like 'x%' and embedding is not null")
    damaged = damaged.withColumn("frase", F.lit("")).withColumn("created_at", F.lit(datetime(2024, 1, 15, 1)))
    damaged = schemas.conform(damaged, schemas.EMBEDDINGS).withColumn(tables.DAY, F.lit(DAY))
    tables.write_table(damaged, job.embeddings, "append", tables.DAY)
    for _ in range(2):
        done = jobs.assign(spark, job, DAY, STAMP, DIMS)
    rows = tables.read_table(spark, job.output)
    unnamed = F.col("nome_n1").isNull() | F.col("nome_n2").isNull() | F.col("nome_n3").isNull()
    came = tables.read_table(spark, job.embeddings).where(F.col(tables.DAY) == F.lit(DAY)).count()
    return rows.agg(
        F.lit(came).cast("long").alias("n_in"),
        F.count("*").alias("n_out"),
        F.lit(done.quarantined).cast("long").alias("n_quarantined"),
        F.count_if(F.col("cluster_n3").isNull()).alias("n_unassigned"),
        F.count_if(unnamed).alias("n_unnamed"),
    )


def job_assignment_rows(spark, sf_dir):
    """The output table of a day, without the vectors."""
    job = trained_job(spark, sf_dir)
    jobs.assign(spark, job, DAY, STAMP, DIMS)
    return tables.read_table(spark, job.output).drop("embedding")


def stream_job(spark, sf_dir):
    """Vectors, damaged ones among them, as a stream of several batches through the current run;
    then once more from the same checkpoint, which adds nothing."""
    job = trained_job(spark, sf_dir)
    given = with_damage(vectors(spark, sf_dir)).select("id", F.lit("").alias("frase"), "embedding")
    folder, log = fresh_path(spark, "source"), fresh_path(spark, "stream-log")
    given.repartition(4).write.parquet(folder)
    assigner = BatchAssigner(job, "vectors", DIMS, lambda: STAMP)
    for _ in range(2):
        source = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 2).parquet(folder)
        assign_stream(source, assigner, log).awaitTermination()
    rows, broken = tables.read_table(spark, assigner.output), tables.read_table(spark, assigner.quarantine)
    unnamed = F.col("nome_n1").isNull() | F.col("nome_n2").isNull() | F.col("nome_n3").isNull()
    return rows.agg(
        F.countDistinct("batch").alias("n_batches"),
        F.count("*").alias("n_out"),
        F.countDistinct("id").alias("n_ids"),
        F.lit(broken.count()).cast("long").alias("n_quarantined"),
        F.count_if(F.col("cluster_n3").isNull()).alias("n_unassigned"),
        F.count_if(unnamed).alias("n_unnamed"),
    )


QUERIES = {
    "scan_day_filter": scan_day_filter,
    "sink_roundtrip": sink_roundtrip,
    "sink_overwrite": sink_overwrite,
    "table_counts": table_counts,
    "existing_ids": existing_ids,
    "new_phrases": new_phrases,
    "new_phrases_first_run": new_phrases_first_run,
    "embedding_reconcile": embedding_reconcile,
    "phrase_batches": phrase_batches,
    "hash_sample": hash_sample,
    "exact_sample": exact_sample,
    "embed_documents": embed_documents,
    "day_embeddings_union": day_embeddings_union,
    "l2_normalize": l2_normalized,
    "covariance": covariance_pairs,
    "centroids": label_centroids,
    "nearest_centroid": nearest,
    "lloyd_step": lloyd_step,
    "wcss": wcss,
    "silhouette": silhouette,
    "elbow": elbow,
    "cluster_mapping": cluster_mapping,
    "mapping_pairs": mapping_pairs,
    "assign_hierarchy": assign_hierarchy,
    "embedding_quality": embedding_quality,
    "assignment_quality": assignment_quality,
    "run_metrics": run_metrics,
    "cluster_samples": cluster_samples,
    "naming_prompt": naming_prompt,
    "parse_name_json": parse_name_json,
    "names_n1": names_n1,
    "parent_children": parent_children,
    "names_parent": names_parent,
    "names_wide": names_wide,
    "names_long": names_long,
    "enrich_names": enrich_names,
    "pca_project": pca_project,
    "train_level": train_level,
    "train_hierarchy": train_hierarchy,
    "k_sweep": k_sweep,
    "k_sweep_metrics": k_sweep_metrics,
    # What the count forms above are worked out from, row by row; SQL cannot follow these.
    "pca_project_rows": pca_project_rows,
    "train_level_rows": train_level_rows,
    "train_hierarchy_rows": train_hierarchy_rows,
    "k_sweep_rows": swept,
    "k_sweep_metrics_rows": sweep_table,
    "model_roundtrip": model_roundtrip,
    "stream_assign": streamed_assignment,
    "stream_job": stream_job,
    "job_embedding": job_embedding,
    "job_training": job_training,
    "job_assignment": job_assignment,
    "job_training_rows": job_training_rows,
    "job_assignment_rows": job_assignment_rows,
}


def prepared(query):
    """The query, with the package shipped to the session's executors first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run
