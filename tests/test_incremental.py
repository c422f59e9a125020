from collections import Counter

import pytest
from clients import BrokenEmbedder, FixedEmbedder, NarrowEmbedder, ShortEmbedder
from pyspark.sql import functions as F

from phrasegrove import schemas
from phrasegrove.functions.clients import TokenHashEmbedder, call_with_retry
from phrasegrove.operators import bounded, incremental
from phrasegrove.operators.embedding import embed_phrases
from phrasegrove.params import EmbedParams
from phrasegrove.sources import tables
from phrasegrove.sources.shared import shared_folder
from phrasegrove.sources.synthetic import synthetic_mixture


def test_new_phrases_keeps_copies_and_null_ids(spark):
    raw = spark.createDataFrame(
        [("a", 1), ("b", 2), ("b", 3), (None, 4), (None, 5)], "id string, n int"
    )
    existing = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    rows = incremental.new_phrases(raw, existing).collect()
    assert sorted(r.n for r in rows) == [2, 3, 4, 5]


@pytest.mark.parametrize("hot_is_known", [True, False])
def test_new_phrases_with_a_third_of_the_rows_in_one_id(spark, hot_is_known):
    n = 300_000
    key = F.col("id") % 3
    raw = spark.range(0, n, 1, 6).select(
        F.when(key == 0, F.lit("hot"))
        .when(F.col("id") % 30 == 1, F.lit(None))
        .otherwise(F.col("id").cast("string"))
        .alias("id")
    )
    known = [("7",), ("8",), ("hot",)] if hot_is_known else [("7",), ("8",)]
    existing = spark.createDataFrame(known, "id string")
    hot = bounded.hot_keys(raw, "id")
    assert set(hot) == {"hot", None}
    result = incremental.new_phrases(raw, existing)
    assert "_piece" in result._jdf.queryExecution().optimizedPlan().toString()
    counts = dict(
        result.groupBy(F.coalesce("id", F.lit("null")).alias("k")).count().where("count > 1")
        .collect()
    )
    expected = {"null": n // 30} | ({} if hot_is_known else {"hot": n // 3})
    assert counts == expected
    assert result.count() == n - 2 - (n // 3 if hot_is_known else 0)


def test_no_key_is_hot_in_even_or_small_data(spark):
    assert bounded.hot_keys(spark.range(400_000), "id") == []
    assert bounded.hot_keys(spark.range(100).withColumn("id", F.lit(1)), "id") == []


def test_reconcile(spark):
    raw = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    existing = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "id string")
    assert incremental.reconcile(raw, existing).first() == (4, 1, 3, 2, 5)
    assert incremental.increment(raw, existing).first() == (4, 1, 1, 1)
    nothing = spark.createDataFrame([], "id string")
    assert incremental.reconcile(nothing, nothing).first() == (0, 0, 0, 0, 0)
    assert incremental.increment(nothing, nothing).first() == (0, 0, 0, 0)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_new_rows(spark, threshold):
    raw = spark.createDataFrame(
        [("a", "x"), ("b", "z"), ("b", "y"), (None, "n"), ("c", "w")], "id string, frase string"
    )
    existing = spark.createDataFrame([("a",), (None,)], "id string")
    ids = incremental.rows_per_id(raw, existing).where(incremental.is_new())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = incremental.new_rows(raw, ids)
        text = rows._jdf.queryExecution().executedPlan().toString()
        assert sorted(rows.collect()) == [("b", "y"), ("c", "w")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only rows that survive the join are grouped.
    assert text.index("partial_min") < text.index("LeftSemi")


def test_null_alone_is_hot(spark):
    raw = spark.range(200_000).select(F.lit(None).cast("long").alias("id"), F.lit("x").alias("frase"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = incremental.new_phrases(raw, spark.range(50))
        sizes = left.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in sizes) == 200_000
    assert max(r["count"] for r in sizes) < 100_000


def test_null_ids_are_not_shuffled_however_few_rows_there_are(spark):
    raw = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) as id", "'x' as frase")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = incremental.new_phrases(raw, spark.range(50))
        sizes = left.where("id is null").groupBy(F.spark_partition_id()).count().collect()
        n = left.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert n == 3000 - 33 and sum(r["count"] for r in sizes) == 1000
    assert max(r["count"] for r in sizes) < 500


def test_day_embeddings_keep_the_stored_row(spark):
    stored = spark.createDataFrame([("a", [1.0], "s")], "id string, embedding array<float>, o string")
    fresh = spark.createDataFrame([("a", [2.0]), ("b", [3.0])], "id string, embedding array<float>")
    rows = incremental.day_embeddings(stored, fresh).collect()
    assert sorted((r.id, r.embedding, r.o) for r in rows) == [("a", [1.0], "s"), ("b", [3.0], None)]


class FakeContext:
    master = "spark://cluster:7077"

    def getCheckpointDir(self):
        return None


class FakeSession:
    sparkContext = FakeContext()

    class conf:
        @staticmethod
        def get(name, default):
            return default


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession())


def test_first_per_id_is_stable(spark):
    rows = [("a", "z", 1), ("a", "b", 9), ("c", None, 2)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id string, frase string, n int")
        assert sorted(incremental.first_per_id(df).collect()) == [("a", "b", 9), ("c", None, 2)]


@pytest.mark.parametrize("n, size", [(1237, 100), (500, 500), (3, 10)])
def test_batches_are_full_but_for_the_last(spark, n, size):
    numbered = incremental.number_batches(spark.range(n).withColumn("id", F.col("id")), size)
    counts = Counter(r.batch_no for r in numbered.collect())
    assert sorted(counts) == list(range(-(-n // size)))
    assert all(counts[b] == size for b in list(counts)[:-1] if b != max(counts))
    assert sum(counts.values()) == n


def test_hash_sample_does_not_depend_on_partitions(spark):
    ids = spark.range(20_000)
    one = {r.id for r in incremental.hash_sample(ids.repartition(1), 0.2).collect()}
    many = {r.id for r in incremental.hash_sample(ids.repartition(13), 0.2).collect()}
    assert one == many and 3_700 < len(one) < 4_300
    assert incremental.hash_sample(ids, 1.0).count() == 20_000


PARAMS = EmbedParams(batch_size=50, max_concurrent=5, attempts=2, first_delay=0.0, dims=32)


def phrases(spark, n=120):
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("texto "), "id").alias("frase")
    )


def test_embed_phrases(spark):
    rows = embed_phrases(phrases(spark), FixedEmbedder, PARAMS).collect()
    assert len({r.id for r in rows}) == 120
    assert all(len(r.embedding) == 32 and r.embedding[3] == pytest.approx(0.3) for r in rows)
    assert all(r.frase == f"texto {r.id}" for r in rows)
    assert embed_phrases(phrases(spark), FixedEmbedder, PARAMS).rdd.getNumPartitions() == 5


@pytest.mark.parametrize(
    "client, message",
    [(ShortEmbedder, "asked for"), (NarrowEmbedder, "asked for"), (BrokenEmbedder, "no answer")],
)
def test_a_bad_embedder_fails_the_job(spark, client, message):
    with pytest.raises(Exception, match=message):
        embed_phrases(phrases(spark), client, PARAMS).collect()


def test_retry_doubles_the_delay_and_gives_up():
    calls, waits, renewed = [], [], []

    def third_time():
        calls.append(1)
        if len(calls) < 3:
            raise ValueError("not yet")
        return "done"

    answer = call_with_retry(third_time, 3, 2.0, lambda: renewed.append(1), waits.append)
    assert (answer, waits, len(renewed)) == ("done", [2.0, 4.0], 3)
    with pytest.raises(ZeroDivisionError):
        call_with_retry(lambda: 1 / 0, 3, 0.0, sleep=waits.append)


def test_token_hash_embedder_is_unit_length_or_zero():
    words, empty = TokenHashEmbedder(16).embed_batch(["Olá mundo, olá!", "123 --"])
    assert sum(x * x for x in words) == pytest.approx(1.0, abs=1e-6)
    assert empty.tolist() == [0.0] * 16


def test_left_join_dimension(spark):
    facts = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")))
    dim = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    rows = bounded.left_join_dimension(facts, dim, "k").collect()
    assert len(rows) == 1000
    assert all(r.v == (2 * r.k if r.k < 500 else None) for r in rows)


def test_pin_evaluates_once(spark):
    ran = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        ran.add(1)
        return x

    kept = bounded.pin(spark.range(50).select(counted("id").alias("id")))
    assert kept.count() == 50 and kept.agg(F.sum("id")).first()[0] == 1225
    assert ran.value == 50


def test_synthetic_mixture(spark, mixture):
    assert mixture.count() == 200 and mixture.select("id").distinct().count() == 200
    again = synthetic_mixture(spark, 200, 32, 5, 42, partitions=9)
    assert again.exceptAll(mixture).isEmpty()
    per_topic = mixture.groupBy("topic").count().collect()
    assert sorted(r["count"] for r in per_topic) == [40] * 5
    cells = mixture.select("topic", F.posexplode("embedding")).groupBy("topic", "pos")
    spread = cells.agg(F.stddev("col").alias("s"), F.avg("col").alias("m"))
    noise, length = spread.agg(F.avg("s"), F.sqrt(F.sum(F.col("m") * F.col("m")) / 5)).first()
    assert noise == pytest.approx(0.05, rel=0.05)
    assert length == pytest.approx(1.0, abs=0.05)


def test_tables(spark):
    assert not tables.table_exists(spark, "absent") and not tables.table_exists(spark, "nodb.absent")
    with pytest.raises(Exception):
        tables.table_exists(spark, "a.b.c.d.e")
    empty = tables.read_or_empty(spark, "absent", schemas.EMBEDDINGS)
    assert empty.schema == schemas.EMBEDDINGS and empty.isEmpty()
    df = spark.createDataFrame([("1", "x")], "id string, frase string")
    for mode, n in (("append", 1), ("append", 2), ("overwrite", 1)):
        tables.write_table(df, "raw_here", mode)
        assert tables.read_table(spark, "raw_here").count() == n
    assert tables.table_exists(spark, "spark_catalog.default.raw_here")
    assert tables.read_table_with_filter(spark, "raw_here", "id = '2'").isEmpty()
    with pytest.raises(ValueError):
        tables.write_table(df, "raw_here", "upsert")


def test_conform(spark):
    df = spark.createDataFrame([(3, 1, 2)], "cluster_n3 long, cluster_n1 long, cluster_n2 long")
    fitted = schemas.conform(df, schemas.MAPPING)
    assert fitted.columns == ["cluster_n1", "cluster_n2", "cluster_n3"]
    assert [f.dataType.simpleString() for f in fitted.schema] == ["int"] * 3
    with pytest.raises(ValueError, match="cluster_n1"):
        schemas.conform(df.drop("cluster_n1"), schemas.MAPPING)
    rows = spark.createDataFrame([("r", 5)], "run_id string, k_n1 int")
    with pytest.raises(ValueError, match="trained_at"):
        schemas.conform(rows, schemas.METRICS)
