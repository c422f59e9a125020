import json
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from phrasegrove.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH) as file:
    COUNTER = tc.Counter(json.load(file), tc.character_classes())


def check(*texts):
    want = [len(LIBRARY.encode(t, add_special_tokens=False).ids) for t in texts]
    assert COUNTER.count(list(texts)).tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=250), max_size=4))
def test_any_texts(texts):
    check(*texts)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(" '\n\tstredvlmx1!é\xa0<|endoftext|>", max_size=230), max_size=4))
def test_few_letters(texts):
    check(*texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["'re", "'ve", "'ll", "'r", " ", "  ", "\n", "a", "'", "9", "!", "<|endoftext|>"]), max_size=80))
def test_contractions(parts):
    check("".join(parts))


@settings(max_examples=200, deadline=None)
@given(st.text(" '\n\tstredvlmx1!", max_size=400))
def test_words_equal_the_pattern(text):
    assert COUNTER.words([text, "x", text])[2] == regex.findall(tc.PATTERN, text)


def test_every_character():
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(f"a{chr(p)} {chr(p)}b" for p in points[i : i + 4000]) for i in range(0, len(points), 4000)]
    check(*texts)


def test_scan_equals_running_in_sequence():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, tc.N_STATES, (50, tc.N_STATES), dtype=np.uint8)
    first = rng.random(50) < 0.1
    first[0] = True
    state, want = tc.START, []
    for m, f in zip(maps, first):
        state = tc.START if f else state
        want.append(state)
        state = m[state]
    assert tc.entry_states(maps, first).tolist() == want


@pytest.mark.parametrize("text", ["a" * 4000, " " * 3000, "'" * 900, "the" * 1500, "\n" * 700 + "x", "1 " * 2000, "é" * 999])
def test_long_runs(text):
    check(text, "", text + "!")


def test_bounds_of_what_is_kept(monkeypatch):
    monkeypatch.setattr(tc, "STATES", 50)
    monkeypatch.setattr(tc, "MEMO", 20)
    rng = random.Random(1)
    check(*(" ".join("".join(rng.choices("abcdeth", k=rng.randint(1, 12))) for _ in range(60)) for _ in range(30)))


def test_frame(spark, clashing_docs):
    rows = tc.count_tokens(clashing_docs.withColumn("n_tokens", F.lit("x")), tc.Compiled(spark, PATH)).collect()
    assert len(rows) == clashing_docs.count()
    for r in rows:
        assert r.n_tokens == len(LIBRARY.encode(r.text or "", add_special_tokens=False).ids)
    assert tc.count_tokens(clashing_docs.where("false"), tc.Compiled(spark, PATH)).count() == 0


def test_query_on_whole_texts(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["op10_token_counts"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = len(LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 512, len(texts[r.doc_id].encode()))
