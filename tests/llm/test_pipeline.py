import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_exact_dedup import brute as brute_equal
from test_jaccard_join import brute as brute_near
from test_mixing import brute_targets

import corpus_pipeline as cp
from phrasegrove.llm import language_id

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_stages_are_named():
    assert [name for name, _ in cp.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "source_mix", "sentencepiece"]


def test_language_stage(spark, documents):
    rows = documents.union(spark.createDataFrame([(900, "12 !", "en", "a", 4), (901, None, "en", "a", 0)], documents.schema))
    model = language_id.fit(rows)
    every = rows.collect()
    best, share, _, _ = language_id.predict([r.text or "" for r in every], model)
    want = sorted((tuple(r) for r, b, s in zip(every, best, share) if b >= 0 and s >= cp.LEAST_SHARE), key=repr)
    assert rows_of(cp.language_stage(spark, rows, SF_DIR)) == want
    assert len(want) == documents.count()


def test_language_stage_rejects_unlearned_scripts(spark, documents):
    strange = ["съешь же ещё этих мягких французских булок да выпей чаю", "η γρήγορη καφετιά αλεπού πηδάει", "日本語 の 文章 です", "ж"]
    # Without labels, so that nothing is learned from them.
    added = [(900 + i, text, None, "a", len(text)) for i, text in enumerate(strange)]
    rows = documents.union(spark.createDataFrame(added, documents.schema))
    assert rows_of(cp.language_stage(spark, rows, SF_DIR)) == rows_of(documents)


def test_dedup_stage(spark, documents, clashing_docs):
    for docs in (documents, clashing_docs.select("doc_id", "text", "lang", "digest", "n", "_text")):
        rows = docs.collect()
        kept = {(i, h) for i, _, _, keep, h in brute_equal([(r.doc_id, r.text) for r in rows]) if keep}
        out = cp.dedup_stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        norm = lambda r: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text or "").encode()).hexdigest()
        got = out.collect()
        assert sorted(((r.doc_id, norm(r)) for r in got), key=repr) == sorted(kept, key=repr)
        assert {tuple(r) for r in got} <= {tuple(r) for r in rows}


def test_near_stage(spark, documents, clashing_docs):
    for docs in (documents, clashing_docs.select("doc_id", "text", "lang", "key", "n").where("doc_id is null or doc_id <> 6")):
        rows = docs.collect()
        brute = brute_near([(r.doc_id, r.text) for r in rows])
        kept = sorted((i for i, n, c in brute if not n or i == c), key=repr)
        out = cp.near_stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        assert sorted((r.doc_id for r in out.collect()), key=repr) == kept


def test_mixing_stage(spark, documents):
    rows = {r.doc_id: r for r in documents.collect()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for i, r in rows.items()}
    out = cp.mixing_stage(spark, documents, SF_DIR)
    assert out.columns == documents.columns
    got = out.collect()
    times = Counter(r.doc_id for r in got)
    assert max(times.values()) <= 2 and all(tuple(r) == tuple(rows[r.doc_id]) for r in got)
    totals, mixed = Counter(), Counter()
    for i, r in rows.items():
        totals[r.source] += size[i]
        mixed[r.source] += size[i] * times[i]
    for source, target in brute_targets(dict(totals)).items():
        # A document that is taken in part is rounded to whole rows.
        assert abs(mixed[source] - target) <= 1.1 * max(size[i] for i, r in rows.items() if r.source == source)


def test_token_stage(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in cp.token_stage(spark, documents, SF_DIR).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_run(spark, documents):
    got = cp.run(spark, SF_DIR).collect()
    assert got and {r.doc_id for r in got} <= {r.doc_id for r in documents.select("doc_id").collect()}
    docs = documents
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF_DIR).cache()
    assert Counter((r.doc_id, r.n_tokens) for r in docs.collect()) == Counter((r.doc_id, r.n_tokens) for r in got)


def test_edges_and_empty_pass_through(spark, edge_docs):
    extra = edge_docs.withColumn("spot", F.lit(1)).withColumn("held", F.lit(2)).withColumn("row", F.lit(3))
    for docs in (extra, extra.where("false")):
        for name, stage in cp.STAGES:
            columns = docs.columns
            docs = stage(spark, docs, SF_DIR).cache()
            assert name == "sentencepiece" or docs.columns == columns
            docs.count()
