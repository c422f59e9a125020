"""Generated embeddings with known topics, for load tests of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_VALUES = 1 << 24


def synthetic_mixture(
    spark: SparkSession,
    n_samples: int = 4000,
    n_dims: int = 384,
    n_topics: int = 20,
    seed: int = 42,
    noise: float = 0.05,
    partitions: int | None = None,
) -> DataFrame:
    """``(id, frase, embedding, topic)``: unit topic centres plus N(0, noise), topics in turn.

    Topic centres depend only on the seed, the topic and the dimension, so every task can
    derive them and none has to be shipped. Each uniform pair becomes one normal deviate
    by the Box-Muller rule.
    """

    def normal(*keys):
        def uniform(tag):
            bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(tag), *keys), 11)
            return (bits + F.lit(0.5)) / F.lit(float(1 << 53))

        return F.sqrt(-2 * F.log(uniform("r"))) * F.cos(2 * F.pi() * uniform("a"))

    dims = F.sequence(F.lit(0), F.lit(n_dims - 1))
    topics = (
        spark.range(n_topics)
        .select(
            F.col("id").cast("int").alias("topic"),
            F.transform(dims, lambda d: normal(F.lit("centre"), F.col("id"), d)).alias("raw"),
        )
        .withColumn("norm", F.sqrt(F.aggregate("raw", F.lit(0.0), lambda s, x: s + x * x)))
        .select("topic", F.transform("raw", lambda x: x / F.col("norm")).alias("centre"))
    )
    rows = spark.range(0, n_samples, 1, partitions) if partitions else spark.range(n_samples)
    rows = rows.withColumn("topic", (F.col("id") % n_topics).cast("int"))
    noisy = F.transform(
        "centre",
        lambda c, d: (c + noise * normal(F.lit("noise"), F.col("id"), d)).cast("float"),
    )
    if n_topics * n_dims <= BROADCAST_VALUES:
        topics = F.broadcast(topics)
    return rows.join(topics, "topic").select(
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"))).alias("id"),
        F.format_string("customer note %2$d about subject %1$d", "topic", "id").alias("frase"),
        noisy.alias("embedding"),
        "topic",
    )
