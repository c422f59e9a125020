import itertools
import re
import tracemalloc
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from phrasegrove.llm import language_id as li
from phrasegrove.llm.common import slices, texts_of

EN = "the of and to in is that it for was on are with as his they at be this have from or had by word".split()
FR = "le la les et est une que dans pour qui sur pas avec son ils au plus être mais nous été leur très".split()


def passages(words, rng, n):
    return [" ".join(rng.choice(words, 40)) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(5)
    texts = [(t, "en") for t in passages(EN, rng, 40)] + [(t, "fr") for t in passages(FR, rng, 40)]
    return li.learn(texts, li.Sample(rounds=20))


def brute(scores, move):
    """Probabilities of each word and pair, by all paths."""
    n, k = scores.shape
    words, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in itertools.product(range(k), repeat=n + 1):
        weight = np.exp(sum(scores[i, path[i + 1]] + move[path[i], path[i + 1]] for i in range(n)))
        total += weight
        for i in range(n):
            words[i, path[i + 1]] += weight
            pairs[path[i], path[i + 1]] += weight
    return words / total, pairs / total


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(0)
    sizes = np.array([3, 0, 1, 5])
    scores, move = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    words, pairs = li.marginals(scores, np.arange(9), sizes, move, expect=True)
    at, expected = 0, np.zeros((3, 3))
    for size in sizes:
        if size:
            w, p = brute(scores[at : at + size], move)
            assert np.allclose(words[at : at + size], w)
            expected += p
        at += size
    assert np.allclose(pairs, expected)


@pytest.mark.parametrize("piece", [1, 2, 7, 64, 1000])
def test_pieces_do_not_matter(monkeypatch, piece):
    rng = np.random.default_rng(1)
    sizes = np.array([0, 200, 1, 64, 65, 0, 128, 3])
    scores, move = rng.normal(size=(sizes.sum(), 4)) * 3, rng.normal(size=(4, 4)) * 2
    words = np.arange(len(scores))
    want = li.marginals(scores, words, sizes, move, expect=True)
    monkeypatch.setattr(li, "PIECE", piece)
    got = li.marginals(scores, words, sizes, move, expect=True)
    assert np.allclose(got[0], want[0]) and np.allclose(got[1], want[1])


def test_short_texts_take_little_memory(model):
    """A slice of many short texts holds about its words, not a padded piece for each text."""
    import tracemalloc

    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(5000)]
    texts = [" ".join(rng.choice(vocabulary, 8)) for _ in range(li.SLICE // 56)]
    tracemalloc.start()
    li.judged(texts, model, known=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 75 << 20  # 150 MB for twice the slice


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    alone = li.features(["straße"], {"straße": 1})
    rows, owners, _ = li.features(["a", "straße", "xyz" * 30], {"straße": 1})
    assert sorted(rows[owners == 1]) == sorted(alone[0])
    assert li.HASHED + 1 in alone[0]


def test_code_switched_words(spark, model):
    text = " ".join(EN[:12] + FR[:12] + EN[12:20])
    rows = li.label_words(spark.createDataFrame([(text,), (None,), ("12",)], "text string"), model).collect()
    labels = [w.lang for w in rows[0].words]
    assert labels == ["en"] * 12 + ["fr"] * 12 + ["en"] * 8
    assert rows[1].words == rows[2].words == []


def test_edges(clashing_docs, model):
    rows = li.identify(clashing_docs.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == clashing_docs.count()
    for r in rows:
        letters = re.search(r"[^\W\d_]", r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert 0 <= r.score <= 1
        assert r.lang_pred in ("en", "fr", "und")
    assert li.identify(clashing_docs.where("false"), model).count() == 0


def test_nothing_to_learn_from(edge_docs):
    assert li.fit(edge_docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert li.fit(edge_docs.where("false")) is None
    assert {(r.lang_pred, r.score) for r in li.identify(edge_docs, None).collect()} == {("und", 0.0)}
    assert li.learn([("12 34", "en")]) is None


def test_only_rows_that_may_be_learned_are(spark):
    rows = [(i, "zwar oder " * 9, "de" if zlib.crc32(str(i).encode()) % 4 != 2 else "xx") for i in range(60)]
    model = li.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), li.Sample(rounds=2))
    assert model.languages == ["de"]


def test_words_behind_a_long_opening_are_learned(spark):
    rows = [(i, "12 | " * 2000 + "zwar oder " * 90, "de") for i in range(20)]
    rows += [(100 + i, "word or " * 9, "en") for i in range(20)]
    # Texts without a letter take no place of the sample.
    rows += [(200 + i, "12 | " * 20, "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = li.fit(docs, li.Sample(docs=5, rounds=2))
    assert model.languages == ["de", "en"]
    assert model.lexicon == {"zwar": 0, "oder": 0, "word": 1, "or": 1}


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["op6_language_id"](spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r.lang_pred == docs[r.doc_id].lang for r in held]
    assert sum(right) >= 0.98 * len(right)


def test_what_is_known_is_counted_in_little_memory():
    """The driver counts the sample's n-grams over all their places."""
    import tracemalloc

    texts = [[f"word{i}", "and", "more"] for i in range(50)]
    tracemalloc.start()
    learned, bound = li.least_known(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert learned.any() and 0 < bound < 1
    assert peak < 7 * li.KNOWN


def test_a_batch_goes_before_the_next_is_read():
    gone = []

    def batches():
        for _ in range(3):
            batch = pa.RecordBatch.from_pydict({"text": ["some words", "and more"]})
            held = weakref.ref(batch)
            yield batch
            del batch
            gone.append(held() is None)

    assert sum(part.num_rows for part in slices(batches(), "text")) == 6
    assert gone == [True] * 3


def test_memory_of_a_prediction_is_that_of_a_small_slice(model):
    texts = passages(EN + FR, np.random.default_rng(3), 15_000)  # about 2.7 MB
    batch = pa.RecordBatch.from_pydict({"text": texts})
    tracemalloc.start()
    rows = sum(len(li.judged(texts_of(part, "text"), model, True)[0]) for part in slices(iter([batch]), "text", li.SLICE))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts)
    assert most < 32 << 20, most
