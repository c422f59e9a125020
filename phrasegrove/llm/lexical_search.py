"""Ranked lexical search over posting lists with range-maximum tables.

1. Each document gives the query terms it holds with their counts, and its number of terms. From
   these rows follow the corpus' numbers and each query term's weight.
2. A task lays its documents into segments in order of id. A segment has a posting list per query term
   (documents in order, with the term's impact on each) and a sparse table over the lists: for
   every place and power of two, where the largest impact of that stretch stands. Any range's
   maximum is then the larger of two entries.
3. A query starts with the interval of all documents of a segment. The sum of its terms' range
   maxima bounds every score inside. Intervals with the highest bounds are taken first, some at a
   time; each is split at the document of its largest single impact, that document is scored exactly,
   and the two parts are bounded anew. An interval that cannot better the ``top`` documents found so far
   in the task, equal scores counted by id, is dropped; nothing else is, so the result is exact.
4. A task hands on ``top`` rows of a query, and these are merged in two levels of groups.

A term is a maximal run of ASCII letters and digits and of characters beyond ASCII; only A-Z are
lower-cased. Scores are 64-bit integers as the contract has them.

Queries are worked in blocks of about ``BLOCK_BYTES`` of their text (a single longer query makes a
block of its own size); what is sent to the workers is a block's terms and weights. A segment holds about
``SEGMENT_POSTINGS`` postings, whatever the size of the input.

Defined cases: null and termless texts match nothing and do not count in N; a null or termless query has
no rows; a null document id ranks after the others of its score; repeated documents are documents like
others, and repeated queries give their rows each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phrasegrove.llm.common import lists_of, slices, stored, texts_of

#: Bytes of query texts that are searched for in one pass over the documents, about.
BLOCK_BYTES = 2 << 20
#: Postings of a segment, about.
SEGMENT_POSTINGS = 1 << 20
#: Intervals that are split at a time.
WAVE = 48
#: Pieces in which the tasks' best rows are merged first.
PIECES = 64
#: The constants of the score. Fixed values of the contract.
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE, BASE, SLOPE = 1000, 1_000_000_000, 1000, 20, 100, 50

# Letters are lowered, digits and bytes beyond ASCII kept, the rest parts terms.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_PLAIN).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * holding + 1)))


def matched(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, counts)``: all terms' number, and the known terms with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, "text"):
            sizes, places, counts, ends = [], [], [], [0]
            for text in texts_of(batch, "text"):
                words = terms(text)
                sizes.append(len(words))
                for word, count in Counter(filter(known.__contains__, words)).items():
                    places.append(known[word])
                    counts.append(count)
                ends.append(len(places))
            ends = pa.array(ends, pa.int32())
            found = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (places, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *found], names=["doc_id", "n", "terms", "counts"]
            )

    return docs.mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, counts array<int>")


class Segment:
    """Posting lists of some documents, with their impacts and range-maximum tables."""

    def __init__(self, ids, absent, lengths, owners, places, counts, weights, total_docs, total_terms):
        order = np.lexsort((ids, absent))
        self.ids, self.absent = ids[order], absent[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.size = len(order)
        keys = places.astype(np.int64) * self.size + rank[owners]
        by_key = np.argsort(keys)
        self.keys = keys[by_key]
        counts = counts[by_key].astype(np.int64)
        stretch = BASE - SLOPE + SLOPE * lengths * total_docs // total_terms
        damped = IMPACT_SCALE * counts // (TF_SCALE * counts + LENGTH_SCALE * stretch[owners[by_key]])
        self.impacts = weights[places[by_key]] * damped
        self.starts = np.searchsorted(self.keys, np.arange(len(weights) + 1, dtype=np.int64) * self.size)
        longest = int(np.diff(self.starts).max(initial=0))
        self.tables = [np.arange(len(self.keys), dtype=np.int32)]
        step = 1
        while 2 * step <= longest:
            # Entries that reach beyond their list are never asked for.
            last = self.tables[-1]
            left, right = last[:-step], last[step:]
            made = last.copy()
            made[:-step] = np.where(self.impacts[left] >= self.impacts[right], left, right)
            self.tables.append(made)
            step *= 2
        self.tables = np.stack(self.tables)

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and size of the largest impact in each range; 0 for empty ranges."""
        width = high - low
        some = width > 0
        level = np.frexp(np.where(some, width, 1))[1] - 1
        last = len(self.impacts) - 1
        left = self.tables[level, np.minimum(low, last)]
        right = self.tables[level, np.minimum(np.maximum(high - (1 << level), 0), last)]
        best = np.where(self.impacts[left] >= self.impacts[right], left, right)
        return best, np.where(some, self.impacts[best], 0)

    def search(self, query: np.ndarray, best: Best) -> int:
        """Better ``best`` by this segment's documents; gives the number of documents scored."""
        query = query[self.starts[query + 1] > self.starts[query]]
        if not len(query):
            return 0
        base = query.astype(np.int64) * self.size
        pool = Intervals(len(query))
        low, high = self.starts[query][None, :], self.starts[query + 1][None, :]
        zero, scored = np.zeros(1, np.int64), 0
        pool.put(zero, zero + self.size, low, high, *self.bounds(low, high))
        while pool.used:
            taken = pool.take(WAVE)
            begin, end, low, high, pivot = (part[taken] for part in (pool.begin, pool.end, pool.low, pool.high, pool.pivot))
            pool.remove(taken)
            # The pivot's place in each list, and whether it stands there.
            wanted = base[None, :] + pivot[:, None]
            at = np.searchsorted(self.keys, wanted)
            hit = (at < high) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted)
            scores = np.where(hit, self.impacts[np.minimum(at, len(self.keys) - 1)], 0).sum(axis=1)
            scored += len(pivot)
            best.add(scores, self.ids[pivot], self.absent[pivot])
            begin, end = np.concatenate([begin, pivot + 1]), np.concatenate([pivot, end])
            low, high = np.concatenate([low, at + hit]), np.concatenate([at, high])
            bound, pivot = self.bounds(low, high)
            alive = self.may_better(best, bound, begin, end)
            pool.put(*(part[alive] for part in (begin, end, low, high, bound, pivot)))
            pool.keep(self.may_better(best, *(part[: pool.used] for part in (pool.bound, pool.begin, pool.end))))
        return scored

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The most a document of each interval can score, and the document of its largest impact."""
        place, impact = self.largest(low, high)
        first = impact.argmax(axis=1)
        return impact.sum(axis=1), self.keys[place[np.arange(len(place)), first]] % self.size

    def may_better(self, best: Best, bound: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        alive = (bound > 0) & (begin < end)
        if not best.full:
            return alive
        at = np.minimum(begin, self.size - 1)
        earlier = (self.absent[at] < best.last_absent) | ((self.absent[at] == best.last_absent) & (self.ids[at] < best.last_id))
        return alive & ((bound > best.last_score) | ((bound == best.last_score) & earlier))


class Intervals:
    """A pool of document intervals with their ranges in each list, their bounds and pivots."""

    def __init__(self, width: int):
        self.used = 0
        self.begin, self.end, self.bound, self.pivot = (np.zeros(256, np.int64) for _ in range(4))
        self.low, self.high = (np.zeros((256, width), np.int64) for _ in range(2))

    def put(self, begin, end, low, high, bound, pivot) -> None:
        need = self.used + len(begin)
        parts = {"begin": begin, "end": end, "low": low, "high": high, "bound": bound, "pivot": pivot}
        for name, rows in parts.items():
            held = getattr(self, name)
            if need > len(held):
                held = np.concatenate([held, np.zeros((max(need, len(held)), *held.shape[1:]), held.dtype)])
                setattr(self, name, held)
            held[self.used : need] = rows
        self.used = need

    def take(self, n: int) -> np.ndarray:
        """Places of the ``n`` intervals with the highest bounds."""
        if self.used <= n:
            return np.arange(self.used)
        return np.argpartition(self.bound[: self.used], self.used - n)[self.used - n :]

    def remove(self, places: np.ndarray) -> None:
        """The last intervals move to the places of those removed."""
        left = self.used - len(places)
        gone = np.zeros(self.used, bool)
        gone[places] = True
        holes, movers = np.flatnonzero(gone[:left]), left + np.flatnonzero(~gone[left:])
        for part in (self.begin, self.end, self.low, self.high, self.bound, self.pivot):
            part[holes] = part[movers]
        self.used = left

    def keep(self, alive: np.ndarray) -> None:
        """Drop dead intervals, once they are many."""
        dead = np.flatnonzero(~alive)
        if len(dead) * 4 > self.used:
            self.remove(dead)


class Best:
    """The best ``top`` documents of a query so far: highest score, then smallest id, nulls last."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.absent = np.zeros(0, bool)

    @property
    def full(self) -> bool:
        return len(self.scores) == self.top

    @property
    def last_score(self):
        return self.scores[-1]

    @property
    def last_id(self):
        return self.ids[-1]

    @property
    def last_absent(self):
        return self.absent[-1]

    def add(self, scores, ids, absent) -> None:
        some = scores > 0
        if self.full:
            some &= scores >= self.last_score
        if not some.any():
            return
        scores, ids = np.concatenate([self.scores, scores[some]]), np.concatenate([self.ids, ids[some]])
        absent = np.concatenate([self.absent, absent[some]])
        order = np.lexsort((ids, absent, -scores))[: self.top]
        self.scores, self.ids, self.absent = scores[order], ids[order], absent[order]


def best_of_task(
    batches: Iterator[pa.RecordBatch], queries: list[np.ndarray], weights: np.ndarray, totals: tuple[int, int], top: int
) -> list[Best]:
    """The best documents of a task's rows for each query, segment by segment."""
    found = [Best(top) for _ in queries]
    held: list[tuple] = []
    postings = 0

    def search_held() -> None:
        if not postings:
            return
        ids, absent, lengths, sizes, places, counts = (np.concatenate(part) for part in zip(*held))
        owners = np.repeat(np.arange(len(ids)), sizes)
        segment = Segment(ids, absent, lengths, owners, places, counts, weights, *totals)
        for query, best in zip(queries, found):
            segment.search(query, best)

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            rows = lists_of(part, "terms"), lists_of(part, "counts")
            sizes = np.array([len(x) for x in rows[0]])
            some = np.flatnonzero(sizes)
            if not len(some):
                continue
            ids = part.column("doc_id").take(pa.array(some))
            held.append(
                (
                    np.asarray(ids.fill_null(0)),
                    np.asarray(ids.is_null()),
                    np.asarray(part.column("n").take(pa.array(some))),
                    sizes[some],
                    *(np.concatenate([side[i] for i in some]) for side in rows),
                )
            )
            postings += int(sizes.sum())
            if postings >= SEGMENT_POSTINGS:
                search_held()
                held, postings = [], 0
    search_held()
    return found


def _first(rows: DataFrame, keys: list[str], top: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn(name, F.row_number().over(order)).where(F.col(name) <= top)


def search_block(docs: DataFrame, items: list, top: int) -> DataFrame:
    """``(no, doc_id, score, rank)`` for a block of queries ``(no, text)``."""
    vocabulary: dict[bytes, int] = {}
    queries = []
    for item in items:
        words = dict.fromkeys(terms(item["text"] or ""))
        queries.append(np.array([vocabulary.setdefault(word, len(vocabulary)) for word in words], np.int64))
    rows = stored(matched(docs, vocabulary), "matched")
    total = rows.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    totals = (total[0], total[1] or 1)
    weights = np.zeros(len(vocabulary), np.int64)
    for row in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[row["term"]] = weight(totals[0], row["count"])
    shared = docs.sparkSession.sparkContext.broadcast((queries, weights, [item["no"] for item in items]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, numbers = shared.value
        for no, best in zip(numbers, best_of_task(batches, queries, weights, totals, top)):
            if len(best.scores):
                columns = [np.full(len(best.scores), no), pa.array(best.ids, mask=best.absent), best.scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["no", "doc_id", "score"])

    found = rows.where("size(terms) > 0").mapInArrow(run, "no bigint, doc_id bigint, score bigint")
    found = found.withColumn("piece", F.spark_partition_id() % PIECES)
    found = _first(found, ["no", "piece"], top, "place").drop("piece", "place")
    return _first(found, ["no"], top, "rank")


def search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of every query."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    items = queries.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    items = stored(items.withColumn("no", F.monotonically_increasing_id()), "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    found = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == block).select("no", "text")
        rows = search_block(docs, part.collect(), top)
        rows = stored(rows, "found") if blocks > 1 else rows
        found = rows if found is None else found.union(rows)
    return found.join(items.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")
