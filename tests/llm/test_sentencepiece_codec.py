import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from phrasegrove.llm import common
from phrasegrove.llm import sentencepiece_codec as sc
from phrasegrove.llm.common import Shipped

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
with open(PATH, "rb") as file:
    CODEC = sc.PieceCodec(file.read())


def check(text):
    ids = LIBRARY.encode(text)
    assert CODEC.encode(text).tolist() == ids, text[:200]
    assert CODEC.decode(ids) == LIBRARY.decode(ids), text[:200]


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    check(text)


@settings(max_examples=400, deadline=None)
@given(st.text("ab et▁in,.\n0é", max_size=40))
def test_texts_of_few_letters(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31_999), max_size=30))
def test_decoding_any_ids(ids):
    assert CODEC.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=30))
def test_decoding_bytes(ids):
    assert CODEC.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


def test_joined_pieces():
    rng = random.Random(3)
    names = [LIBRARY.id_to_piece(i) for i in range(259, 32_000)]
    for _ in range(1500):
        check("".join(rng.choices(names, k=rng.randint(1, 12))).replace("▁", rng.choice(["", " "])))


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, " " * 4000, "日本語" * 1500, "\n" * 500, "the" * 2000])
def test_long_chunks(text):
    check(text)


def test_frame(spark, clashing_docs):
    docs = clashing_docs.withColumn("ids", F.lit("x"))
    model = Shipped(spark, PATH)
    rows = sc.decode(sc.encode(docs, model), model).collect()
    assert len(rows) == docs.count()
    assert set(rows[0].asDict()) == {*docs.columns, "decoded"}
    for r in rows:
        want = LIBRARY.encode(r.text or "")
        assert r.ids == want and r.decoded == LIBRARY.decode(want)
    fused = sc.encode(docs, model, decoded_col="decoded").collect()
    assert sorted((repr(r.ids), r.decoded) for r in fused) == sorted((repr(r.ids), r.decoded) for r in rows)
    assert sc.decode(sc.encode(docs.where("false"), model), model).count() == 0


def test_query_on_whole_texts(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["op2_sentencepiece"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_a_task_leaves_no_chunks_in_its_worker(spark):
    """Workers outnumber the running tasks, so what each of them kept would add up."""
    rows = spark.range(200).selectExpr("id", "concat('some words of text ', id) as text").coalesce(1)
    model = Shipped(spark, PATH)

    def held(batches):
        from phrasegrove.llm.sentencepiece_codec import _codecs

        for batch in batches:
            n = sum(len(codec.memo) + len(codec.older) + len(codec.fits) for codec in _codecs.values())
            yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    sc.encode(rows, model).write.format("noop").mode("overwrite").save()
    found = [r.n for r in spark.range(1600).repartition(16).mapInArrow(held, "n long").collect()]
    assert found and not any(found)


def test_texts_stay_in_the_workers_and_go_in_small_slices(spark, monkeypatch):
    """What a task holds beside a batch is bounded by the slice; the texts come back only if they are kept."""
    asked = {}

    def add_columns(df, column, added, make, **options):
        asked.update(options)
        return common.add_columns(df, column, added, make, **options)

    monkeypatch.setattr(sc, "add_columns", add_columns)
    texts = ["", None, "two words", "words " * 40_000, "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sc.encode(docs, Shipped(spark, PATH), decoded_col="decoded", keep=False)
    assert rows.columns == ["doc_id", "ids", "decoded"]
    assert {r.doc_id: r.ids for r in rows.collect()} == {i: LIBRARY.encode(t or "") for i, t in enumerate(texts)}
    assert asked["slice_bytes"] <= 1 << 20
