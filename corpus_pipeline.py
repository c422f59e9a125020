"""The corpus pipeline: documents through five of the operators.

1. ``language_id`` rejects texts without a letter, texts in which no language prevails, and texts
   whose words are known less than the model's bound, as those in a script it has not learned.
2. ``exact_dedup`` keeps the winner of each group of equal texts, one row of it.
3. ``jaccard_join`` keeps one document of each group of near copies, that with the smallest id.
4. ``source_mix`` takes each document as often as the mix takes its words: the words taken over
   its size, rounded (halves up), are its rows: none, one or two.
5. ``sentencepiece`` gives each row's token ids, and the digest of the text they decode to.

A null text counts as empty, and ends in the first stage like other texts without a letter;
null ids and repeated rows are handled as the operators' docstrings say; empty tables pass through;
columns besides those of ``documents`` are carried along, but for the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phrasegrove.llm import exact_dedup, jaccard_join, language_id, mixing, sentencepiece_codec
from phrasegrove.llm.common import Shipped, free_name, stored
from phrasegrove.llm.url_filter import build_filter, may_hold
from phrasegrove.plans.ship import ship_package

#: A text is rejected when its best language has less than this part of its words.
LEAST_SHARE = 0.3


def parted(docs: DataFrame, spot: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose ``(doc_id, spot)`` is not in ``keys``, and those that have it.

    A filter of fixed size tells most rows that have no key; only the others, about as many as
    there are keys, are shuffled for the exact join.
    """
    key = F.concat_ws("|", "doc_id", "spot")
    bloom = build_filter(keys.select(key.alias("key")))
    # The row is a struct, so that no column of the documents clashes with the filter's.
    rows = docs.select(F.struct(*docs.columns).alias("row"), spot.alias("spot"))
    rows = rows.select("row", "spot", F.concat_ws("|", "row.doc_id", "spot").alias("key"))
    rows = may_hold(rows, bloom, "held")
    keys = keys.select(F.col("doc_id").alias("i"), F.col("spot").alias("s")).distinct()
    same = F.col("row.doc_id").eqNullSafe(F.col("i")) & F.col("spot").eqNullSafe(F.col("s"))
    maybe = rows.where("held")
    others = rows.where("not held").select("row.*").union(maybe.join(keys, same, "left_anti").select("row.*"))
    return others, maybe.join(keys, same, "left_semi").select("row.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = language_id.fit(docs)
    found, score = free_name(docs.columns, "lang_found"), free_name(docs.columns, "lang_share")
    known = free_name(docs.columns, "lang_known")
    rows = language_id.identify(docs, model, lang_out=found, score_out=score, known_out=known)
    kept = F.lit(True)
    if model is not None:  # else nothing to learn from, so no ground to reject any text
        kept = (F.col(found) != language_id.UNKNOWN) & (F.col(score) >= LEAST_SHARE)
        kept = kept & (F.col(known) >= model.least_known)
    return rows.where(kept).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    old = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rows = exact_dedup.exact_dedup(docs.where(old), docs.where(~old))
    rows = stored(rows.select("doc_id", F.col("text_sha256").alias("spot"), "kept"), "decided")
    digest = F.sha2(exact_dedup.normalized("text"), 256)
    left, _ = parted(docs, digest, rows.where("not kept"))
    # Rows that repeat the winner's id and text: one of them stays, the longest text first.
    repeated = rows.where("kept").groupBy("doc_id", "spot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    single, again = parted(left, digest, repeated)
    packed = again.select(F.struct(*docs.columns).alias("row"), digest.alias("spot"))
    longest = F.max_by("row", F.struct(F.length("row.text"), "row.text"))
    again = packed.groupBy("row.doc_id", "spot").agg(longest.alias("row")).select("row.*")
    return single.union(again)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    gone = stored(jaccard_join.near_duplicates(docs).where("not kept").select("doc_id", "spot"), "near")
    return parted(docs, F.xxhash64("text"), gone)[0]


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select("doc_id", "text", "source", F.xxhash64("text").alias("mark"))
    taken = mixing.mix(rows, carry=("mark",)).where("size > 0")
    # Rows that repeat an id and a text are taken alike.
    taken = taken.groupBy(F.col("doc_id").alias("i"), F.col("mark").alias("m")).agg(
        F.sum("taken").alias("t"), F.sum("size").alias("n")
    )
    times = F.expr("cast((2 * t + n) div (2 * n) as int)")
    taken = taken.select("i", "m", times.alias("times")).where("times > 0")
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("mark"))
    same = F.col("row.doc_id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m"))
    copies = packed.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), "times")).alias("copy"))
    return copies.select("row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = Shipped(spark, public_tokenizers.path("piece_bpe_32k.model"))
    rows = docs.select("doc_id", "lang", "source", "text")
    rows = sentencepiece_codec.encode(rows, model, decoded_col="decoded", keep=False)
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", dedup_stage),
    ("jaccard_join", near_stage),
    ("source_mix", mixing_stage),
    ("sentencepiece", token_stage),
]

#: The language and the tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
