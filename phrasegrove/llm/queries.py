"""The dealt operators as queries over the given tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.llm import (
    embedding_dedup,
    exact_dedup,
    jaccard_join,
    language_id,
    lexical_search,
    lm_scoring,
    mixing,
    sentencepiece_codec,
    sharding,
    token_counts,
    url_filter,
    warc_fixity,
    whitening,
)
from phrasegrove.llm.common import Shipped, read_table, stored

#: The rules of the contract. Fixed values.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
#: Host labels whose pages' canonical URLs make the list of blocked URLs.
LISTED_LABELS = "(^|[.])(cheap-pills|free-bets)[.]"


def op1_lm_scoring(spark, sf_dir) -> DataFrame:
    """Each document against the bigram and unigram counts of all others."""
    scores = lm_scoring.lm_scores(read_table(spark, sf_dir, "documents"))
    return scores.select(
        "doc_id",
        F.col("words").alias("n_words"),
        F.col("found_2").alias("n_bigram"),
        F.col("found_1").alias("n_unigram"),
        F.col("found_0").alias("n_unseen"),
        F.round("log_score", 3).alias("log_score"),
    )


def op2_sentencepiece(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = Shipped(spark, public_tokenizers.path("piece_bpe_32k.model"))
    both = sentencepiece_codec.encode(docs, model, decoded_col="decoded", keep=False)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_source_mix(spark, sf_dir) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark, sf_dir) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents")).drop("kept", "spot")


def op5_exact_dedup(spark, sf_dir) -> DataFrame:
    """History is one half of the rows, by a hash of the id; the rest is looked up."""
    docs = read_table(spark, sf_dir, "documents")
    old = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return exact_dedup.exact_dedup(docs.where(old), docs.where(~old)).drop("historical")


def op6_language_id(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit(docs)
    rows = docs.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "text")
    return language_id.identify(rows, model, keep_text=False)


def op7_warc_fixity(spark, sf_dir) -> DataFrame:
    """Every record of an archive of ``pages``, with what the audit of its replica found.

    The replica is the same archive with damage by a rule on the record's own SHA-256: one in
    64 records is cut to half its body, one in 64 is absent, one in 64 has another byte put first.
    """
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    whole = warc_fixity.warc_record(F.col("url"), F.col("html"))
    rows = pages.withColumn("digest", F.sha2(whole, 256)).withColumn("length", F.octet_length(whole))
    kind = F.substring("digest", 1, 2)
    body = F.coalesce("html", F.lit(""))
    half = F.expr("substring(coalesce(html, ''), 1, cast(length(coalesce(html, '')) div 2 as int))")
    harmed = (
        F.when(kind.isin("00", "40", "80", "c0"), warc_fixity.warc_record(F.col("url"), half))
        .when(kind.isin("02", "42", "82", "c2"), warc_fixity.warc_record(F.col("url"), F.concat(F.lit("~"), body)))
    )
    rows = rows.withColumn("harmed", harmed).select(
        "page_id",
        "digest",
        F.col("length").cast("bigint").alias("length"),
        F.coalesce(F.sha2("harmed", 256), "digest").alias("b_digest"),
        F.coalesce(F.octet_length("harmed"), "length").cast("bigint").alias("b_length"),
        kind.isin("01", "41", "81", "c1").alias("absent"),
    )
    archive = stored(warc_fixity.place(rows), "archive")
    replica = archive.where("not absent").select(
        "file", "offset", F.col("b_length").alias("length"), F.col("b_digest").alias("digest")
    )
    found = warc_fixity.audit(archive.select("file", "offset", "length", "digest"), replica)
    return archive.join(found.select("file", "offset", "status"), ["file", "offset"], "left").select(
        "page_id",
        F.col("file").alias("warc_file"),
        F.col("offset").alias("record_offset"),
        F.col("length").alias("n_bytes"),
        F.coalesce("status", F.lit("ok")).alias("status"),
    )


def op8_url_filter(spark, sf_dir) -> DataFrame:
    """Rules as the contract has them; the list of URLs comes from pages under listed labels."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_and_path("url")
    listed = pages.select(host.alias("host"), path.alias("path")).where(F.col("host").rlike(LISTED_LABELS))
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.judge(pages, rules, listed)


def op9_embedding_dedup(spark, sf_dir) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op10_token_counts(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    tokenizer = token_counts.Compiled(spark, public_tokenizers.path("byte_bpe_50k.json"))
    counted = token_counts.count_tokens(docs, tokenizer)
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
    )


def op11_embedding_whitening(spark, sf_dir) -> DataFrame:
    """A deviation beyond 64 bits, as some millions of vectors give, is null here."""
    rows = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op12_kd_sharding(spark, sf_dir) -> DataFrame:
    """Leaves of near equal bytes over size, source and language."""
    placed = sharding.kd_shards(read_table(spark, sf_dir, "documents"), shards=24)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op13_lexical_search(spark, sf_dir) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_source_mix": op3_source_mix,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_language_id": op6_language_id,
    "op7_warc_fixity": op7_warc_fixity,
    "op8_url_filter": op8_url_filter,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_kd_sharding": op12_kd_sharding,
    "op13_lexical_search": op13_lexical_search,
}
