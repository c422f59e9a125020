"""Stupid-backoff language-model scores of documents against the rest of their corpus.

A word w after a context is scored by ``c(context w) / c(context)`` if the n-gram occurs in other
documents, else by ``backoff`` times its score after the context without its first word; a single
word by ``c(w) / N``, an unseen one by ``backoff / N``. Counts are those of the whole corpus less
the document's own. A document's score is the sum of the logarithms over its words.

Relations, all partitioned by hash: documents are packed into blocks (written once, so block ids
hold if a task is lost); each block is exploded into its distinct n-grams with counts; these rows
go to the bucket of the n-gram's 64-bit hash, where the count table of the bucket is made and
joined back to the rows; the counts return to the blocks and are summed per document. An n-gram
leaves a block once however often it occurs, so frequent ones are no hot keys. Rows of a block
and a bucket travel together as packed numbers, about 6 bytes an n-gram. The numbers of blocks
and buckets follow from the corpus's size.

Words are runs of other characters than space and U+0009 to U+000D, with A-Z lower-cased.
Defined cases: null, empty and blank texts have no words and score 0; a document that is the
whole corpus scores its words as unseen with N = 1; a text of any length is scored whole; repeated
rows are documents of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phrasegrove.llm.common import from_planes, mix64, planes, slices, stored, texts_of

#: Characters of a block (a longer text is one of its own), and of the corpus per bucket.
BLOCK_CHARS = 4_000_000
BUCKET_CHARS = 4_000_000


def split_words(text: bytes) -> list[bytes]:
    """The lower() and split() of bytes know A-Z and the contract's white space, and no other."""
    return text.lower().split()


def pack(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(block, ids, sizes, chars, words, texts)``: documents in blocks, their texts compressed."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("chars", T.LongType()),
            T.StructField("words", T.LongType()),
            T.StructField("texts", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0
        kind = pa.schema([])
        squeeze = zstandard.ZstdCompressor(level=3)

        def block() -> pa.RecordBatch:
            raw = [t.encode() for t in texts]
            columns = [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(kind)),
                pa.array([[len(r) for r in raw]], pa.list_(pa.int64())),
                pa.array([held], pa.int64()),
                pa.array([sum(len(r.split()) for r in raw)], pa.int64()),
                pa.array([squeeze.compress(b"".join(raw))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in slices(batches, "text"):
            kind = batch.schema.field("id").type
            for i, text in zip(batch.column("id").to_pylist(), texts_of(batch, "text")):
                if texts and held + len(text) > BLOCK_CHARS:
                    yield block()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(i)
                texts.append(text)
                held += len(text)
        if texts:
            yield block()

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, schema)


class Exploded:
    """A block's n-grams: position by position, and the distinct ones with their counts."""

    def __init__(self, sizes, texts: bytes, order: int):
        raw = zstandard.ZstdDecompressor().decompress(texts)
        ends = np.cumsum(sizes, dtype=np.int64) if len(sizes) else np.zeros(0, np.int64)
        index: dict[bytes, int] = {}
        lengths, numbers = [], []
        for end, size in zip(ends, sizes):
            words = split_words(raw[end - size : end])
            lengths.append(len(words))
            numbers.append(np.array([index.setdefault(w, len(index)) for w in words], np.int64))
        self.lengths = np.array(lengths, np.int64)
        self.doc = np.repeat(np.arange(len(lengths)), self.lengths)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in index], np.uint64)
        words = hashes[np.concatenate(numbers)] if len(self.doc) else np.zeros(0, np.uint64)
        place = np.arange(len(words)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        # For each order the positions that end an n-gram, and its hash there.
        self.at, gram, grams = [], words, []
        for n in range(1, order + 1):
            if n > 1:
                joined = np.zeros_like(words)
                joined[1:] = mix64(gram[:-1] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) + words[1:]
                gram = mix64(joined)
            self.at.append(np.flatnonzero(place >= n - 1))
            grams.append(gram[self.at[-1]])
        every = np.concatenate(grams)
        self.keys, inverse, self.counts = np.unique(every, return_inverse=True, return_counts=True)
        self.number = np.split(inverse, np.cumsum([len(g) for g in grams])[:-1])


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are equal ranges of the hash, so sorted keys have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def explode(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """``(bucket, block, keys, counts)``: each block's distinct n-grams, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams = Exploded(row["sizes"], row["texts"], order)
                bounds = np.searchsorted(bucket_of(grams.keys, buckets), np.arange(buckets + 1))
                met = np.flatnonzero(np.diff(bounds))
                parts = [slice(bounds[b], bounds[b + 1]) for b in met]
                steps = [planes(np.diff(grams.keys[p], prepend=np.uint64(0))) for p in parts]
                counts = [planes(grams.counts[p].astype(np.uint32)) for p in parts]
                columns = [
                    pa.array(met, pa.int64()),
                    pa.array(np.full(len(met), row["block"]), pa.int64()),
                    pa.array(steps, pa.binary()),
                    pa.array(counts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "keys", "counts"])

    return blocks.select("block", "sizes", "texts").mapInArrow(run, "bucket bigint, block bigint, keys binary, counts binary")


def totals(exploded: DataFrame) -> DataFrame:
    """``(block, bucket, totals)``: the corpus's counts of each block's n-grams, in their order."""

    def join(part: pa.Table) -> pa.Table:
        keys = [np.cumsum(from_planes(k, np.uint64), dtype=np.uint64) for k in part["keys"].to_pylist()]
        counts = np.concatenate([from_planes(c, np.uint32) for c in part["counts"].to_pylist()])
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        table = np.bincount(inverse, weights=counts).astype(np.uint64)
        answers = np.split(table[inverse], np.cumsum([len(k) for k in keys])[:-1])
        packed = pa.array([planes(a) for a in answers], pa.binary())
        return pa.table({"block": part["block"], "bucket": part["bucket"], "totals": packed})

    return exploded.groupBy("bucket").applyInArrow(join, "block bigint, bucket bigint, totals binary")


def score_block(grams: Exploded, total: np.ndarray, words: int, backoff: float) -> dict[str, np.ndarray]:
    """Sums per document of a block; ``total`` has the corpus's counts of ``grams.keys``."""
    docs, doc = len(grams.lengths), grams.doc
    rest = np.maximum(1, words - grams.lengths)[doc]
    others = []
    for number, at in zip(grams.number, grams.at):
        # The document's own occurrences are those of the pair of document and n-gram.
        pair = doc[at] * np.int64(len(grams.keys)) + number
        _, inverse, own = np.unique(pair, return_inverse=True, return_counts=True)
        others.append(total[number].astype(np.int64) - own[inverse])
    logs = np.zeros(len(doc))
    used = np.zeros(len(doc), np.int64)  # the order at which a word was found; 0: unseen
    context = None
    for n, (count, at) in enumerate(zip(others, grams.at), start=1):
        below = rest[at] if n == 1 else context[at - 1]
        found = count > 0
        here = at[found]
        logs[at[~found]] += np.log(backoff)
        logs[here] = np.log(count[found] / below[found])
        used[here] = n
        if n == 1:
            logs[at[~found]] -= np.log(rest[at[~found]])
        context = np.zeros(len(doc), np.int64)
        context[at] = count
    out = {"words": grams.lengths, "log_score": np.bincount(doc, logs, minlength=docs).astype(float)}
    for n in range(len(others) + 1):
        out[f"found_{n}"] = np.bincount(doc[used == n], minlength=docs)
    return out


def lm_scores(
    docs: DataFrame, order: int = 2, backoff: float = 0.4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``words``, ``log_score``, and ``found_n``, the words that were
    scored by n-grams of order n (``found_0``: unseen ones)."""
    blocks = stored(pack(docs, id_col, text_col), "blocks")
    chars = blocks.agg(F.sum("chars")).first()[0] or 0
    buckets = max(1, -(-chars // BUCKET_CHARS))
    answers = totals(explode(blocks, order, buckets))
    words = blocks.agg(F.sum("words")).first()[0] or 0
    found = ", ".join(f"found_{n} bigint" for n in range(order + 1))
    id_type = docs.schema[id_col].dataType.simpleString()

    def score(block: pa.Table, answer: pa.Table) -> pa.Table:
        row = block.select(["sizes", "texts"]).to_pylist()[0]
        grams = Exploded(row["sizes"], row["texts"], order)
        parts = [from_planes(t, np.uint64) for t in answer.sort_by("bucket")["totals"].to_pylist()]
        total = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        sums = score_block(grams, total, words, backoff)
        return pa.table({"id": block["ids"].combine_chunks().flatten(), **{k: pa.array(v) for k, v in sums.items()}})

    packed = blocks.select("block", "ids", "sizes", "texts")
    scored = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, f"id {id_type}, words bigint, log_score double, {found}"
    )
    return scored.withColumnRenamed("id", id_col)
