from dataclasses import replace
from datetime import date, datetime
from functools import partial

import pytest
from clients import NeverAsked, Texts
from pyspark.sql import functions as F

from phrasegrove import schemas
from phrasegrove.functions.clients import TermNamer, TokenHashEmbedder
from phrasegrove.operators import naming, training
from phrasegrove.operators.bounded import pin
from phrasegrove.operators.embedding import embed_phrases
from phrasegrove.params import ClusterParams, EmbedParams, NamingParams, Tables
from phrasegrove.plans import checks, jobs
from phrasegrove.sources.shared import fresh_path
from phrasegrove.sources.tables import write_table
from phrasegrove.streaming import assign as streaming
from phrasegrove.streaming.assign import BatchAssigner, assign_stream, stream_assign

DIMS = 16
CLUSTERS = ClusterParams(
    k_n1=6, k_n2=3, k_n3=2, max_iter=10, pca_dims=4, k_candidates=(2, 3, 4), sample_fraction=1.0
)
EMBED = EmbedParams(batch_size=20, max_concurrent=3, first_delay=0.0, dims=DIMS)
NAMING = NamingParams(samples_per_cluster=4, max_concurrent=2, first_delay=0.0)
EMBEDDER = partial(TokenHashEmbedder, DIMS)
DAY_1, DAY_2 = datetime(2024, 5, 1, 23, 30), datetime(2024, 5, 2, 0, 30)
TOPICS = ["conta bloqueada no app", "cartao nao chegou ainda", "juros altos na fatura"]


def phrase_rows(start, n):
    return [(f"p{i}", f"{TOPICS[i % 3]} caso {'x' * (i % 5)}") for i in range(start, start + n)]


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW)


@pytest.fixture
def tables(spark, tmp_path):
    base = f"jobs_{tmp_path.name}".replace("-", "_").replace("[", "_").replace("]", "_").lower()
    spark.sql(f"CREATE DATABASE {base} LOCATION '{tmp_path}/db'")
    names = {f: f"{base}.{f}" for f in Tables.__dataclass_fields__ if f != "models"}
    return Tables(models=f"{tmp_path}/models", **names)


def embed(spark, tables, when, client=EMBEDDER):
    return jobs.embed_new(spark, tables, client, EMBED, when)


def test_embedding_job_takes_only_what_is_new(spark, tables):
    bad = [(None, "no id"), ("q", None), ("p1", "second text of p1")]
    write_table(raw_frame(spark, phrase_rows(0, 50) + bad), tables.raw)
    first = embed(spark, tables, DAY_1)
    assert first == jobs.EmbedSummary(53, 1, 0, 51, 50)
    again = embed(spark, tables, DAY_2, NeverAsked)
    assert again == jobs.EmbedSummary(53, 1, 51, 0, 0)  # the id without a text is recorded
    write_table(raw_frame(spark, phrase_rows(50, 7)), tables.raw)
    assert embed(spark, tables, DAY_2).embedded == 7
    rows = spark.table(tables.embeddings)
    assert rows.count() == 57 == rows.select("id").distinct().count()
    assert rows.where("day = date'2024-05-02'").count() == 7
    assert rows.where(F.size("embedding") != DIMS).isEmpty()


def test_an_id_without_text_is_settled_until_more_rows_come(spark, tables):
    write_table(raw_frame(spark, phrase_rows(0, 3) + [("q", None), ("q", None)]), tables.raw)
    assert embed(spark, tables, DAY_1).without_text == 1
    assert embed(spark, tables, DAY_1, NeverAsked).new_ids == 0
    record = spark.table(tables.textless_table).collect()
    assert [(r.id, r.raw) for r in record] == [("q", 2)]
    write_table(raw_frame(spark, [("q", None)]), tables.raw)
    assert embed(spark, tables, DAY_1, NeverAsked).new_ids == 1  # looked at again, and settled again
    assert embed(spark, tables, DAY_1, NeverAsked).new_ids == 0
    write_table(raw_frame(spark, [("q", "a text at last")]), tables.raw)
    assert embed(spark, tables, DAY_2) == jobs.EmbedSummary(7, 0, 3, 1, 1)


def test_each_text_is_embedded_once(spark, tables):
    """Across runs, waves and ids; a third of all ids have one text."""
    asked = spark.sparkContext.accumulator([], Texts())

    class Counting(TokenHashEmbedder):
        def __init__(self):
            super().__init__(DIMS)

        def embed_batch(self, texts):
            asked.add(list(texts))
            return super().embed_batch(texts)

    rows = [(f"h{i}", "the same text") for i in range(60)] + [(f"t{i}", f"text number {i % 70}") for i in range(120)]
    write_table(raw_frame(spark, rows), tables.raw)
    small = replace(EMBED, rows_per_task=9)
    assert jobs.embed_new(spark, tables, Counting, small, DAY_1).embedded == 180
    more = [(f"m{i}", f"text number {i}") for i in range(60, 80)] + [("h99", "the same text")]
    write_table(raw_frame(spark, more), tables.raw)
    assert jobs.embed_new(spark, tables, Counting, small, DAY_2).embedded == 21
    texts = {text for _, text in rows + more}
    assert sorted(asked.value) == sorted(texts)
    assert spark.table(tables.digests_table).count() == len(texts)
    own = TokenHashEmbedder(DIMS)
    for row in spark.table(tables.embeddings).where("id in ('h3', 'h99', 't5', 'm79')").collect():
        assert row.embedding == own.embed_batch([row.frase])[0].tolist()


def test_a_stopped_run_asks_for_no_text_again(spark, tables, monkeypatch):
    write_table(raw_frame(spark, phrase_rows(0, 60)), tables.raw)

    def stopped(*_):
        raise RuntimeError("the driver is lost")

    monkeypatch.setattr(jobs, "append_vectors", stopped)
    with pytest.raises(RuntimeError):
        embed(spark, tables, DAY_1)
    monkeypatch.undo()
    assert embed(spark, tables, DAY_1, NeverAsked).embedded == 60


def test_all_rows_rejected(spark, tables):
    write_table(raw_frame(spark, [(None, "a"), ("b", None)]), tables.raw)
    assert embed(spark, tables, DAY_1) == jobs.EmbedSummary(2, 1, 0, 1, 0)


def test_waves_append_every_phrase_once(spark, tables):
    write_table(raw_frame(spark, phrase_rows(0, 100)), tables.raw)
    small = replace(EMBED, rows_per_task=10)
    summary = jobs.embed_new(spark, tables, EMBEDDER, small, DAY_1)
    assert (summary.new_ids, summary.embedded) == (100, 100)
    assert spark.table(tables.embeddings).select("id").distinct().count() == 100


def train(spark, tables, **more):
    return jobs.train(
        spark, tables, CLUSTERS, "run-1", datetime(2024, 5, 3), DIMS, naming=NAMING, **more
    )


def test_train_and_assign(spark, tables):
    write_table(raw_frame(spark, phrase_rows(0, 90)), tables.raw)
    embed(spark, tables, DAY_1)
    write_table(raw_frame(spark, phrase_rows(90, 30)), tables.raw)
    embed(spark, tables, DAY_2)
    short = spark.createDataFrame(
        [("short", "broken", [1.0], DAY_1)], "id string, frase string, embedding array<float>, created_at timestamp"
    ).withColumn("day", F.to_date("created_at"))
    write_table(short, tables.embeddings, "append", "day")

    summary = train(spark, tables)
    assert (summary.total_records, summary.quarantined) == (120, 1)
    assert summary.recommended_k in CLUSTERS.k_candidates
    metrics = spark.table(tables.metrics)
    assert metrics.columns == schemas.METRICS.names
    assert metrics.count() == len(CLUSTERS.k_candidates) + 1
    run = metrics.where("total_records is not null").first()
    assert (run.k_n1, run.k_n2, run.k_n3, run.pca_dims) == (6, 3, 2, 4)
    names = spark.table(tables.names)
    assert names.columns == schemas.NAMES.names
    assert names.where("nivel = 1").count() == summary.hierarchy.levels[0].k_found
    assert names.where("nome = 'ERRO'").isEmpty()
    assert spark.table(tables.mapping).columns == schemas.MAPPING.names

    stamp = datetime(2024, 5, 4)
    assert jobs.assign(spark, tables, date(2024, 5, 2), stamp, DIMS) == jobs.AssignSummary(30, 0)
    output = spark.table(tables.output)
    assert output.columns == [*schemas.OUTPUT.names, "day"]
    once = {r.id: (r.cluster_n1, r.nome_n1, r.nome_n3) for r in output.collect()}
    assert jobs.assign(spark, tables, date(2024, 5, 2), stamp, DIMS) == jobs.AssignSummary(30, 0)
    spark.catalog.refreshTable(tables.output)
    twice = spark.table(tables.output).collect()
    assert {r.id: (r.cluster_n1, r.nome_n1, r.nome_n3) for r in twice} == once
    assert all(r.nome_n1 and r.dor_n2 and r.nome_n3 for r in twice)
    # The broken row of that day is not lost.
    assert jobs.assign(spark, tables, date(2024, 5, 1), stamp, DIMS) == jobs.AssignSummary(90, 1)
    bad = spark.table(tables.quarantine_table).collect()
    assert [(r.id, r.reason, r.day) for r in bad] == [("short", "embedding", date(2024, 5, 1))]
    assert jobs.assign(spark, tables, date(2024, 1, 1), stamp, DIMS) == jobs.AssignSummary(0, 0)
    assert spark.table(tables.output).count() == 120


def test_without_a_namer_output_has_no_names(spark, tables):
    write_table(raw_frame(spark, phrase_rows(0, 40)), tables.raw)
    embed(spark, tables, DAY_1)
    train(spark, tables, make_namer=None)
    assert jobs.assign(spark, tables, date(2024, 5, 1), DAY_2, DIMS).rows == 40
    rows = spark.table(tables.output)
    assert rows.where("nome_n1 is not null or cluster_n2 is null").isEmpty()


def test_assignment_does_not_shuffle_the_rows(spark, tables):
    """The names of all levels are stored per run, so that they are broadcast and the rows stay."""
    write_table(raw_frame(spark, phrase_rows(0, 40)), tables.raw)
    embed(spark, tables, DAY_1)
    train(spark, tables)
    run = jobs.load_run(spark, tables, jobs.current_run(spark, tables))
    output, _ = jobs.outcome(run, spark.table(tables.embeddings).select("id", "frase", "embedding"), DIMS, DAY_2)
    plan = output._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan, plan
    assert output.where("nome_n1 is null or nome_n2 is null or nome_n3 is null").isEmpty()


def test_assignment_takes_one_run_and_new_rows(spark, tables):
    write_table(raw_frame(spark, phrase_rows(0, 40)), tables.raw)
    embed(spark, tables, DAY_1)
    train(spark, tables)
    # A run that is not complete, and map and names of another run in the tables, change nothing.
    spark.range(1).write.parquet(jobs.run_path(tables, "run-2", jobs.MAPPING))
    empty = spark.createDataFrame([], schemas.MAPPING)
    write_table(empty, tables.mapping, "overwrite")
    fresh = embed_phrases(raw_frame(spark, phrase_rows(35, 10)), EMBEDDER, EMBED)
    done = jobs.assign(spark, tables, date(2024, 5, 1), DAY_2, DIMS, fresh)
    assert done == jobs.AssignSummary(45, 0)
    assert spark.table(tables.output).where("cluster_n3 is null or nome_n3 is null").isEmpty()


def test_a_failing_catalog_embeds_nothing(spark, tables, monkeypatch):
    write_table(raw_frame(spark, phrase_rows(0, 5)), tables.raw)
    embed(spark, tables, DAY_1)
    asked = spark.catalog.tableExists

    def failing(self, name, *more):
        if name == tables.embeddings:
            raise ConnectionError("no answer from the catalog")
        return asked(name, *more)

    monkeypatch.setattr(type(spark.catalog), "tableExists", failing)
    with pytest.raises(ConnectionError):
        embed(spark, tables, DAY_2, NeverAsked)
    monkeypatch.undo()
    assert spark.table(tables.embeddings).count() == 5


def test_a_namer_is_asked_once_per_group(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)

    class Counting(TermNamer):
        def complete_json(self, system, user):
            asked.add(1)
            return super().complete_json(system, user)

    groups = spark.range(40).select(
        F.col("id").cast("int").alias("cluster_id"), F.array(F.lit("some words")).alias("phrases")
    )
    names = pin(naming.name_level(groups, 1, Counting, NAMING))
    assert names.count() == 40 and names.where("ok").count() == 40
    assert asked.value == 40


def test_checks_name_every_failure(spark, tables):
    with pytest.raises(checks.PreconditionError) as error:
        jobs.train(
            spark, tables, replace(CLUSTERS, k_n2=9), "r", DAY_1, DIMS
        )
    assert "cluster numbers" in str(error.value) and "does not exist" in str(error.value)
    with pytest.raises(checks.PreconditionError, match="no model at"):
        jobs.assign(spark, tables, date(2024, 5, 1), DAY_1, DIMS)
    write_table(spark.createDataFrame([], "id string, other int"), tables.raw)
    with pytest.raises(checks.PreconditionError) as error:
        embed(spark, tables, DAY_1)
    assert "lacks columns ['frase']" in str(error.value) and "no rows" in str(error.value)
    assert checks.path_usable(spark, "nosuchscheme://x/y")


def test_stream_equals_batch(spark, mixture):
    trained = training.train_hierarchy(
        mixture, replace(CLUSTERS, pca_dims=8), make_estimator=None
    )
    folder = fresh_path(spark, "in")
    mixture.repartition(3).write.parquet(folder)

    def assign(df):
        scored = training.score(df, trained.pipeline, trained.mapping)
        return scored.select("id", "cluster_n1", "cluster_n2", "cluster_n3")

    out, log = fresh_path(spark, "out"), fresh_path(spark, "log")
    for _ in range(2):  # a restart adds nothing
        source = spark.readStream.schema(mixture.schema).parquet(folder)
        stream_assign(source, assign, out, log).awaitTermination()
    streamed, batch = spark.read.parquet(out), assign(mixture)
    assert streamed.count() == 200
    assert streamed.exceptAll(batch).isEmpty()


@pytest.fixture
def stream(spark, tables):
    """A trained run, and a folder of four files of vectors, one of them unusable in each."""
    write_table(raw_frame(spark, phrase_rows(0, 60)), tables.raw)
    embed(spark, tables, DAY_1)
    train(spark, tables)
    folder = fresh_path(spark, "vectors")
    good = embed_phrases(raw_frame(spark, phrase_rows(100, 40)), EMBEDDER, EMBED).collect()
    for i in range(4):
        rows = [tuple(r) for r in good[10 * i : 10 * i + 10]] + [(f"bad{i}", "broken", [1.0] if i % 2 else None)]
        rows = spark.createDataFrame(rows, "id string, frase string, embedding array<float>")
        rows.coalesce(1).write.mode("append").parquet(folder)
    return folder


def run_stream(spark, folder, assigner, log):
    schema = "id string, frase string, embedding array<float>"
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    assign_stream(source, assigner, log).awaitTermination()


def streamed(spark, assigner):
    spark.catalog.refreshTable(assigner.output)
    spark.catalog.refreshTable(assigner.quarantine)
    return spark.table(assigner.output), spark.table(assigner.quarantine)


def test_a_stream_goes_through_the_model_and_quarantine(spark, tables, stream):
    assigner, log = BatchAssigner(tables, "s", DIMS, lambda: DAY_2), fresh_path(spark, "log")
    for _ in range(2):  # the second start finds nothing
        run_stream(spark, stream, assigner, log)
        output, broken = streamed(spark, assigner)
        assert output.count() == 40 == output.select("id").distinct().count()
        assert output.where("cluster_n3 is null or nome_n3 is null").isEmpty()
        assert sorted(r.id for r in broken.collect()) == [f"bad{i}" for i in range(4)]
    assert output.columns == [*schemas.OUTPUT.names, "run_id", "stream", "batch"]
    assert {r.batch for r in output.select("batch").distinct().collect()} == {0, 1, 2, 3}
    write_table(spark.read.parquet(stream).withColumn("created_at", F.lit(DAY_2)).withColumn("day", F.lit(DAY_2.date())), tables.embeddings, "append", "day")
    jobs.assign(spark, tables, DAY_2.date(), DAY_2, DIMS)
    columns = schemas.OUTPUT.names
    batch = spark.table(tables.output)
    assert output.select(*columns).exceptAll(batch.select(*columns)).isEmpty() and batch.count() == 40


def test_a_stream_that_stops_midway_repeats_nothing(spark, tables, stream, monkeypatch):
    assigner, log = BatchAssigner(tables, "s", DIMS, lambda: DAY_2), fresh_path(spark, "log")
    real, calls = streaming.replace_part, []

    def failing(df, name, part):
        calls.append(part["batch"])
        if calls.count(2) == 2:  # batch 2 has its output, not its quarantine
            raise RuntimeError("the driver is lost")
        real(df, name, part)

    monkeypatch.setattr(streaming, "replace_part", failing)
    with pytest.raises(Exception, match="driver is lost"):
        run_stream(spark, stream, assigner, log)
    monkeypatch.undo()
    assert streamed(spark, assigner)[0].count() == 30
    run_stream(spark, stream, BatchAssigner(tables, "s", DIMS, lambda: DAY_2), log)
    output, broken = streamed(spark, assigner)
    assert output.count() == 40 == output.select("id").distinct().count() and broken.count() == 4
    # Another stream of the same tables has its own parts.
    run_stream(spark, stream, BatchAssigner(tables, "it's", DIMS, lambda: DAY_2), fresh_path(spark, "log"))
    assert streamed(spark, assigner)[0].groupBy("stream").count().where("count = 40").count() == 2


def test_a_run_published_midway_counts_from_the_next_batch_on(spark, tables, stream):
    class Publishing(BatchAssigner):
        def __call__(self, batch, batch_id):
            super().__call__(batch, batch_id)
            if batch_id == 1:
                jobs.train(spark, tables, CLUSTERS, "run-2", datetime(2024, 5, 9), DIMS, naming=NAMING)

    assigner = Publishing(tables, "s", DIMS, lambda: DAY_2)
    run_stream(spark, stream, assigner, fresh_path(spark, "log"))
    runs = {(r.batch, r.run_id) for r in streamed(spark, assigner)[0].select("batch", "run_id").distinct().collect()}
    assert runs == {(0, "run-1"), (1, "run-1"), (2, "run-2"), (3, "run-2")}


def test_a_stream_needs_a_run(spark, tables):
    source = spark.readStream.format("rate").load()
    with pytest.raises(checks.PreconditionError, match="no model at"):
        assign_stream(source, BatchAssigner(tables, "s", DIMS, datetime.now), fresh_path(spark, "log"))
