"""Near-duplicate documents by a parity-sketch join on their word shingles.

Two documents link when the Jaccard similarity of their shingle sets is at least 0.75, that is,
when the sets differ in at most (a + b) / 7 shingles, a and b being their sizes.

Sketches. Every shingle XORs its hash into one word of a sketch, or flips one bit of it. Two
sketches of equal length then differ in at most as many words (bits) as the sets differ in
shingles.

Candidates. Sizes are dealt to bands so that linked documents are in the same band or in
neighbouring ones, and each band has its sketch length. If a set can differ in d shingles from any
partner it may link with, then of two linked documents' words that are not empty, all but d agree,
so the first word in any common order in which they agree is among the first d + 1 of either. These
words are the signatures that meet in a hash-partitioned join. The order puts words first that are
rare in a bounded sample of the corpus (which steers work, never results). A document with fewer
than d + 1 words takes part once more with another hash, until it has enough; an unlinked
pair of such documents would have met before. So no linked pair is lost.

Verification. Members of a signature's group are compared with one of them; links merge them into
components. In a second round members of different components meet; there a hub stands for the
members linked with it, and two hubs that differ by more than their radii and a link allow need no
closer look (differences obey the triangle inequality). A pair is first compared by bit sketches
of twice its size in bits, and what passes by the sets themselves, made again from the few
texts that need it.

Equal sets are one node from the start. Defined cases: texts without words have an empty set and
link with nothing; fewer than five words are one shingle; a null text has no words; a null id takes
part, and the smallest id of a component is one that is not null, if any; repeated rows are
documents of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.llm.common import from_planes, give_back, keeps, mix64, planes, slices, stored, texts_of
from phrasegrove.llm.components import components
from phrasegrove.llm.url_filter import build_filter, passing

SHINGLE = 5
#: Characters of the corpus per bucket of signatures.
BUCKET_CHARS = 12_000_000
#: Documents of the sample that steers the order of words, and how many of them make a word common.
SAMPLE_DOCS = 8000
COMMON = 3
#: Rows of hubs that a task compares at a time, about; a group is not cut.
HUB_ROWS = 20_000
#: Tasks that the partners of one hub are dealt to.
PIECES = 4
#: Shingles that are sketched at a time, about.
SKETCHED = 150_000
#: Words whose hashes a worker keeps.
WORDS_KEPT = 300_000
#: The bits of a signature that are sent. Equal ones stay equal, and what else meets is told apart later.
SENT = np.uint64(0xFFFFFFFFFFFF0000)
#: Least number of words of a sketch.
LEAST_WORDS = 64


def bands(top: int = 1 << 40) -> np.ndarray:
    """Lower bounds of the size bands: 4/3 of a size is at most in the next band."""
    lows = [3, 5]
    while lows[-1] < top:
        lows.append(max(lows[-1] + 1, 4 * (lows[-1] - 1) // 3 + 1))
    return np.array(lows, np.int64)


LOWS = bands()


def differ(a: int, b: int) -> int:
    """The most shingles in which linked sets of these sizes differ."""
    return (a + b) // 7


class WordHashes(dict):
    """Hashes of words; a worker keeps a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        if not self:
            keeps("jaccard", self.clear)
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


_hash_of = WordHashes().__getitem__


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    The lower() and split() of bytes know A-Z and the contract's white space, and no other.
    """
    out = []
    for text in texts:
        split = text.encode().lower().split()
        words = np.fromiter(map(_hash_of, split), np.uint64, len(split))
        width = min(SHINGLE, len(words))
        value = np.zeros(len(words) - width + 1 if width else 0, np.uint64)
        for k in range(width):
            value = value * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - width + 1 + k]
        value.sort()
        distinct = np.append(True, value[1:] != value[:-1])[: len(value)]
        # The hash is scrambled when sketches are made; here it only has to tell shingles apart.
        out.append(value[distinct] ^ np.uint64(width))
    return out


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def band_of(size: int) -> int:
    return int(np.searchsorted(LOWS, size, side="right")) - 1


def words_in(band) -> np.ndarray:
    return np.maximum(LEAST_WORDS, LOWS[np.asarray(band) + 1])


def bits_in(band) -> np.ndarray:
    """Bits of a band's parity sketch: whole words of 64, about twice the largest size."""
    return 64 * -(-2 * LOWS[np.asarray(band) + 1] // 64)


def _spread(shingles: np.ndarray, band, turn: int) -> np.ndarray:
    seed = np.atleast_1d(band).astype(np.uint64) * np.uint64(1000) + np.uint64(turn + 1)
    return mix64(shingles ^ (seed * np.uint64(0x9E3779B97F4A7C15)))


def _place(spread: np.ndarray, room) -> np.ndarray:
    return ((spread >> np.uint64(32)) * np.asarray(room, np.uint64) >> np.uint64(32)).astype(np.int64)


def sketch_words(sets: list[np.ndarray], bands: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the words that are not empty, and whose they are.

    A signature is a hash of the band, the word's place and its content. Every set has the band
    of its sketch.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    room = words_in(bands)
    owner = np.repeat(np.arange(len(sets)), sizes)
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    spread = _spread(every, bands[owner], turn)
    start = np.cumsum(room) - room
    at = start[owner] + _place(spread, room[owner])
    total = int(room.sum())
    sketch = np.zeros(total, np.uint64)
    np.bitwise_xor.at(sketch, at, spread)
    full = np.flatnonzero(np.bincount(at, minlength=total))
    whose = np.repeat(np.arange(len(sets)), room)[full]
    place = (full - start[whose]).astype(np.uint64)
    tag = (bands[whose].astype(np.uint64) * np.uint64(1000) + np.uint64(turn)) << np.uint64(44)
    return mix64(sketch[full] ^ mix64(tag ^ place)), whose


def sketch_bits(shingles: np.ndarray, band: int) -> bytes:
    """Parities of the shingles that fall on each bit."""
    bits = int(bits_in(band))
    at = _place(_spread(shingles, band, 998), bits)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(bool)).tobytes()


def roles(size: int) -> list[tuple[int, int]]:
    """Bands in which a set of this size seeks partners, with the most it may differ there."""
    band = band_of(size)
    if band < 0:
        return []  # sets of one or two shingles link with equal sets only
    out = [(band, differ(size, 4 * size // 3))]
    if band and 4 * (int(LOWS[band]) - 1) >= 3 * size:
        out.append((band - 1, differ(size, int(LOWS[band]) - 1)))
    return out


class Frequent:
    """Sorted words that several sets of the sample share, with the number of sets."""

    def __init__(self, words=(), counts=()):
        self.words = np.asarray(words, np.uint64)
        self.counts = np.asarray(counts, np.uint64)

    def rank(self, words: np.ndarray) -> np.ndarray:
        """The order in which words are taken: by the sample's count, then at random."""
        rank = mix64(words) >> np.uint64(16)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            known = self.words[at] == words
            rank[known] |= np.minimum(self.counts[at[known]], np.uint64(0xFFFF)) << np.uint64(48)
        return rank


def signatures(sets: list[np.ndarray], frequent: Frequent = Frequent()) -> tuple[np.ndarray, np.ndarray]:
    """The words by which sets meet their partners, and whose they are.

    Sketches are made for about ``SKETCHED`` shingles at a time, so that their arrays stay small.
    """
    ends = np.cumsum([len(s) for s in sets])
    part = (ends - 1) // SKETCHED if len(sets) else ends
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sets)]
    made = [_signatures(sets[a:b], frequent) for a, b in zip(cuts, cuts[1:])]
    return np.concatenate([words for words, _ in made]), np.concatenate([at + a for (_, at), a in zip(made, cuts)])


def _signatures(sets: list[np.ndarray], frequent: Frequent) -> tuple[np.ndarray, np.ndarray]:
    found, owners = [], []
    open_ = [(i, band, most) for i, s in enumerate(sets) for band, most in roles(len(s))]
    turn = 0
    while open_:
        bands = np.array([band for _, band, _ in open_], np.int64)
        words, whose = sketch_words([sets[i] for i, _, _ in open_], bands, turn)
        rank = frequent.rank(words)
        bounds = np.searchsorted(whose, np.arange(len(open_) + 1))
        again = []
        for k, (i, band, most) in enumerate(open_):
            mine = words[bounds[k] : bounds[k + 1]]
            if len(mine) > most + 1:
                mine = mine[np.argpartition(rank[bounds[k] : bounds[k + 1]], most)[: most + 1]]
            elif len(mine) <= most:
                again.append((i, band, most))
            found.append(mine)
            owners.append(np.full(len(mine), i))
        open_, turn = again, turn + 1
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def profiles(docs: DataFrame) -> DataFrame:
    """``(doc_id, spot, n, node, upper, lower)`` from ``(doc_id, spot, text)``.

    ``spot`` is a hash of the text; ``upper`` and ``lower`` are bit sketches for the set's own band
    and the one below.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", operator="jaccard"):
            sets = shingle_sets(texts_of(batch, "text"))
            own = [band_of(len(s)) for s in sets]
            columns = [
                batch.column("doc_id"),
                batch.column("spot"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node_of(s) for s in sets], pa.int64()),
                pa.array([sketch_bits(s, b) if b >= 0 else b"" for s, b in zip(sets, own)], pa.binary()),
                pa.array([sketch_bits(s, b - 1) if b > 0 else b"" for s, b in zip(sets, own)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spot", "n", "node", "upper", "lower"])

    return docs.mapInArrow(run, "doc_id bigint, spot bigint, n bigint, node bigint, upper binary, lower binary")


def frequent_words(docs: DataFrame) -> Frequent:
    """Words of several different sets of a bounded sample, at most a third of the sample's words.
    Only the order in which words are taken depends on them."""
    share = min(1.0, 1.1 * SAMPLE_DOCS / max(1, docs.count()))
    sampled = docs.where(F.pmod("spot", F.lit(1_000_000)) < int(share * 1_000_000)).limit(SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", operator="jaccard"):
            sets = shingle_sets(texts_of(batch, "text"))
            open_ = [(s, band) for s in sets for band, _ in roles(len(s))]
            words, whose = sketch_words([s for s, _ in open_], np.array([b for _, b in open_], np.int64), 0)
            nodes = np.array([node_of(s) for s, _ in open_], np.int64)[whose]
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(nodes, pa.int64())], names=["word", "node"])

    words = sampled.select("text").mapInArrow(run, "word bigint, node bigint")
    counted = words.groupBy("word").agg(F.countDistinct("node").alias("k")).where(F.col("k") >= COMMON).toArrow()
    word = counted["word"].to_numpy().view(np.uint64)
    order = np.argsort(word)
    return Frequent(word[order], counted["k"].to_numpy()[order])


def signature_rows(docs: DataFrame, buckets: int, common) -> DataFrame:
    """``(bucket, words, owner, nodes, sizes)``: packed signatures of many documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", operator="jaccard"):
            sets = shingle_sets(texts_of(batch, "text"))
            nodes, at = np.unique([node_of(s) for s in sets], return_index=True)
            words, owner = signatures([sets[i] for i in at], common.value)
            words &= SENT
            size_of = np.array([len(sets[i]) for i in at], np.int64)
            order = np.argsort(words)
            words, owner = words[order], owner[order]
            bucket = ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            bounds = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = {"bucket": [], "words": [], "owner": [], "nodes": [], "sizes": []}
            for b in np.flatnonzero(np.diff(bounds)):
                part = slice(bounds[b], bounds[b + 1])
                here, short = np.unique(owner[part], return_inverse=True)
                rows["bucket"].append(int(b))
                rows["words"].append(planes(np.diff(words[part], prepend=np.uint64(0))))
                rows["owner"].append(planes(short.astype(np.uint32)))
                rows["nodes"].append(nodes[here].astype(np.int64).tobytes())
                rows["sizes"].append(planes(size_of[here]))
            types = [pa.int64(), *[pa.binary()] * 4]
            arrays = [pa.array(v, t) for v, t in zip(rows.values(), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(rows))

    return docs.select("text").mapInArrow(run, "bucket bigint, words binary, owner binary, nodes binary, sizes binary")


def shared_words(packed: DataFrame) -> DataFrame:
    """``(g, node, n)``: the different groups of nodes that share a signature, found by bucket."""

    def run(part: pa.Table) -> pa.Table:
        words, nodes, sizes = [], [], []
        for row in part.to_pylist():
            owner = from_planes(row["owner"], np.uint32)
            words.append(np.cumsum(from_planes(row["words"], np.uint64), dtype=np.uint64))
            nodes.append(np.frombuffer(row["nodes"], np.int64)[owner])
            sizes.append(from_planes(row["sizes"], np.int64)[owner])
        words, nodes, sizes = map(np.concatenate, (words, nodes, sizes))
        # Only words that occur twice matter; of these, each node once.
        order = np.argsort(words, kind="stable")
        equal = words[order][1:] == words[order][:-1]
        keep = order[np.append(equal, False) | np.append(False, equal)]
        keep = keep[np.lexsort((nodes[keep], words[keep]))]
        words, nodes, sizes = words[keep], nodes[keep], sizes[keep]
        fresh = np.append(True, (words[1:] != words[:-1]) | (nodes[1:] != nodes[:-1]))[: len(words)]
        words, nodes, sizes = words[fresh], nodes[fresh], sizes[fresh]
        starts = np.flatnonzero(np.append(True, words[1:] != words[:-1])[: len(words)])
        if not len(starts):
            return pa.table({"g": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        length = np.diff(np.append(starts, len(words)))
        # Groups with the same members are one: their number is a hash of the members.
        number = np.add.reduceat(mix64(nodes.view(np.uint64)), starts)
        _, first = np.unique(number, return_index=True)
        taken = np.zeros(len(starts), bool)
        taken[first] = True
        taken &= length > 1
        rows = np.repeat(taken, length)
        g = np.repeat(number, length)[rows].view(np.int64)
        found = pa.table({"g": g, "node": nodes[rows], "n": sizes[rows]})
        del words, order, equal, keep, fresh
        give_back()
        return found

    return packed.groupBy("bucket").applyInArrow(run, "g bigint, node bigint, n bigint").distinct()


def apart_at_least(one: dict, two: dict) -> int:
    """A lower bound of the shingles in which two sets differ, by the sketches of a band that both
    have, or else by their sizes. Sets are rows with ``n``, ``upper`` and ``lower``."""
    i, j = band_of(one["n"]), band_of(two["n"])
    if abs(i - j) > 1:
        return abs(one["n"] - two["n"])
    x, y = one["upper" if i <= j else "lower"], two["upper" if j <= i else "lower"]
    return int(np.bitwise_count(np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64)).sum())


def passing_sketches(pairs: DataFrame, classes: DataFrame, ordered: bool = False) -> DataFrame:
    """The pairs ``(a, b)`` whose sizes and bit sketches allow a link.

    ``ordered`` says that no ``a`` is larger than its ``b``: the comparison never takes its sketch for
    the band below then, and only the other one is moved.
    """
    for side in "ab":
        lower = F.lit(b"") if ordered and side == "a" else F.col("lower")
        columns = [F.col(c).alias(f"{c}_{side}") for c in ("n", "upper")]
        pairs = pairs.join(classes.select(F.col("node").alias(side), *columns, lower.alias(f"lower_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sides = [
                [dict(zip(("n", "upper", "lower"), row)) for row in zip(*(batch.column(f"{c}_{x}").to_pylist() for c in ("n", "upper", "lower")))]
                for x in "ab"
            ]
            for i, (x, y) in enumerate(zip(*sides)):
                if 3 * max(x["n"], y["n"]) <= 4 * min(x["n"], y["n"]):
                    keep[i] = apart_at_least(x, y) <= differ(x["n"], y["n"])
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a bigint, b bigint")


def hubs_of(links: DataFrame) -> DataFrame:
    """``(node, hub, radius)`` of the linked nodes: the partner with the most links, or the node
    itself if it has more, and in how many shingles they differ."""
    both = links.select("a", "b", "apart").union(links.select("b", "a", "apart")).distinct()
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    best = both.join(degree.withColumnRenamed("a", "b"), "b").groupBy("a").agg(
        F.max(F.struct("degree", "b", "apart")).alias("top")
    )
    own = F.struct("degree", "a") > F.struct("top.degree", "top.b")
    return best.join(degree, "a").select(
        F.col("a").alias("node"),
        F.when(own, F.col("a")).otherwise(F.col("top.b")).alias("hub"),
        F.when(own, F.lit(0)).otherwise(F.col("top.apart")).cast("bigint").alias("radius"),
    )


def hubs_of_groups(member: DataFrame) -> DataFrame:
    """``(g, hub, component, radius, most)`` of the groups whose members are in several components."""
    mixed = member.groupBy("g").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("g")
    return member.join(mixed, "g").groupBy("g", "hub", "component").agg(
        F.max("radius").alias("radius"), F.max("n").alias("most")
    )


def one_of_each(per_hub: DataFrame) -> DataFrame:
    """``(g, hub, component, radius, most)``: groups with the same hubs are one, whose number is a hash of them.

    Many words are shared by the same hubs, and each group moves its hubs' sketches. The one has the
    largest radius and size of all: it rules out no pair that any of them asks for.
    """
    hubs = per_hub.groupBy("g").agg(
        F.xxhash64(F.bit_xor(F.xxhash64("hub")), F.sum(F.xxhash64(F.lit(1), "hub").cast("decimal(38,0)")), F.count(F.lit(1))).alias("same")
    )
    return per_hub.join(hubs, "g").groupBy(F.col("same").alias("g"), "hub", "component").agg(
        F.max("radius").alias("radius"), F.max("most").alias("most")
    )


def near_hubs(members: DataFrame) -> DataFrame:
    """``(h, k, least)``: hubs of one group and different components that may have linked members,
    and a lower bound of the shingles in which the hubs differ.

    ``members`` has ``g, hub, component, radius, most, n, upper, lower``: a hub's set, and the largest
    radius and size of what it stands for. If hubs differ in more shingles than both radii and a link
    allow, so do any members, as the difference of sets obeys the triangle inequality.
    """
    parts = max(1, members.count() // HUB_ROWS)

    def run(table: pa.Table) -> pa.Table:
        found = set()
        groups: dict[int, list[dict]] = {}
        for row in table.to_pylist():
            groups.setdefault(row["g"], []).append(row)
        for rows in groups.values():
            found.update(_near_pairs(rows))
        pairs = sorted(found)
        columns = list(zip(*pairs)) or [(), (), ()]
        return pa.table({name: pa.array(values, pa.int64()) for name, values in zip(("h", "k", "least"), columns)})

    dealt = members.withColumn("part", F.pmod(F.xxhash64("g"), F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(run, "h bigint, k bigint, least bigint").distinct()


def _near_pairs(rows: list[dict]) -> Iterator[tuple[int, int, int]]:
    """The pairs of one group, compared sketch by sketch: all rows with a band's sketch at once."""
    rows.sort(key=lambda r: (r["n"], r["hub"]))
    bands = np.array([band_of(r["n"]) for r in rows])
    part, radius, most = (np.array([r[c] for r in rows]) for c in ("component", "radius", "most"))
    hub = [r["hub"] for r in rows]
    for band in np.unique(bands):
        own, above = np.flatnonzero(bands == band), np.flatnonzero(bands == band + 1)
        sketches = [rows[i]["upper"] for i in own] + [rows[i]["lower"] for i in above]
        at = np.concatenate([own, above])
        matrix = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(at), -1)
        for x in range(len(own)):
            others = at[x + 1 :]
            least = np.bitwise_count(matrix[x + 1 :] ^ matrix[x]).sum(axis=1)
            room = radius[others] + radius[own[x]] + (most[others] + most[own[x]]) // 7
            near = (least <= room) & (part[others] != part[own[x]])
            for y, bound in zip(others[near], least[near]):
                yield hub[own[x]], hub[y], int(bound)
        # Hubs further apart than neighbouring bands are only held against each other by size.
        for y in np.flatnonzero(bands > band + 1):
            gap = rows[y]["n"] - np.array([rows[x]["n"] for x in own])
            room = radius[y] + radius[own] + (most[y] + most[own]) // 7
            near = (gap <= room) & (part[own] != part[y])
            for x, bound in zip(own[near], gap[near]):
                yield hub[x], hub[y], int(bound)


def spoke_pairs(near: DataFrame, spokes: DataFrame, classes: DataFrame) -> DataFrame:
    """``(a, b)``: what stands behind two near hubs, member by member, where the sketches allow a link.

    The members of the larger hub meet the others' in a task, so that only the pairs that pass are
    rows; the others are dealt to ``PIECES`` tasks.
    """
    count = spokes.groupBy(F.col("hub").alias("x")).agg(F.count(F.lit(1)).alias("m"))
    for side in "hk":
        near = near.join(count.select(F.col("x").alias(side), F.col("m").alias(f"m_{side}")), side)
    larger = F.struct("m_h", "h") > F.struct("m_k", "k")
    near = near.select(
        F.when(larger, F.col("h")).otherwise(F.col("k")).alias("h"),
        F.when(larger, F.col("k")).otherwise(F.col("h")).alias("k"),
    ).distinct()
    sets = classes.select("node", "n", "upper", "lower")
    inner = near.select("h").distinct().join(spokes.withColumnRenamed("hub", "h"), "h")
    outer = near.join(spokes.withColumnRenamed("hub", "k"), "k").select("h", "node").distinct()
    inner = inner.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    outer = outer.withColumn("piece", F.pmod(F.xxhash64("node"), F.lit(PIECES)).cast("int"))

    def run(inside: pa.Table, outside: pa.Table) -> pa.Table:
        one = inside.to_pylist()
        two = [{name[2:]: value for name, value in row.items()} for row in outside.to_pylist()]
        found_a, found_b = [], []
        for band in {band_of(r["n"]) for r in one}:
            own = [r for r in one if band_of(r["n"]) == band]
            size = np.array([r["n"] for r in own])
            for step, mine, theirs in ((-1, "lower", "upper"), (0, "upper", "upper"), (1, "upper", "lower")):
                others = [r for r in two if band_of(r["n"]) == band + step]
                if not others:
                    continue
                matrix = np.frombuffer(b"".join(r[mine] for r in own), np.uint64).reshape(len(own), -1)
                for y in others:
                    apart = np.bitwise_count(matrix ^ np.frombuffer(y[theirs], np.uint64)).sum(axis=1)
                    near = 3 * np.maximum(size, y["n"]) <= 4 * np.minimum(size, y["n"])
                    for i in np.flatnonzero(near & (apart <= (size + y["n"]) // 7)):
                        found_a.append(own[i]["node"])
                        found_b.append(y["node"])
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    left = inner.join(sets, "node").groupBy("h", "piece")
    right = outer.join(sets, "node")
    right = right.select(*(F.col(c).alias(f"o_{c}") for c in right.columns)).groupBy("o_h", "o_piece")
    return left.cogroup(right).applyInArrow(run, "a bigint, b bigint").where("a <> b")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``(a, b, apart)``: the pairs that link, and in how many shingles they differ.

    The sets are made anew from one text of each node in question.
    """
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    asked = stored(asked.join(classes.select("node", "rep"), "node").select("node", F.col("rep.i").alias("i"), F.col("rep.s").alias("s")), "asked")
    # Texts that nothing asks for are mostly held back here, before they would be shuffled.
    bloom = build_filter(asked.select(F.col("s").alias("key")))
    texts = passing(docs.select("doc_id", "text", F.col("spot").alias("key")), bloom)
    texts = texts.join(asked, (texts.key == asked.s) & texts.doc_id.eqNullSafe(asked.i)).select("node", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", operator="jaccard"):
            sets = shingle_sets(texts_of(batch, "text"))
            right = [node_of(s) == node for s, node in zip(sets, batch.column("node").to_pylist())]
            rows = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), rows], names=["node", "shingles"]).filter(pa.array(right))

    sets = stored(texts.mapInArrow(make, "node bigint, shingles binary"), "sets")
    if sets.count() > asked.count():  # rows that repeat an id and a text; else no node comes twice
        sets = stored(sets.dropDuplicates(["node"]), "sets")
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, apart = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column("of_a"), batch.column("of_b"))):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= 75 * (len(x) + len(y) - both)
                apart[i] = len(x) + len(y) - 2 * both
            columns = [batch.column("a"), batch.column("b"), pa.array(apart)]
            made = pa.RecordBatch.from_arrays(columns, names=["a", "b", "apart"])
            yield made.filter(pa.array(keep))

    # Plain joins, so a node with very many partners is split by the skew join.
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "of_a", "of_b")
    return rows.mapInArrow(compare, "a bigint, b bigint, apart bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept, spot``.

    ``kept`` marks one document of each component, that with the smallest id (repeated rows of
    one id and text are all marked); ``spot`` is the hash of the text, for joins back.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    source = source.withColumn("spot", F.xxhash64("text"))
    rows = stored(profiles(source.select("doc_id", "spot", "text")), "profiles")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("i"), F.col("spot").alias("s")))
    classes = rows.where("n > 0").groupBy("node").agg(
        first.alias("rep"), F.first("n").alias("n"), F.first("upper").alias("upper"), F.first("lower").alias("lower")
    )
    classes = stored(classes, "classes")

    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-chars // BUCKET_CHARS))
    common = spark.sparkContext.broadcast(frequent_words(source))
    groups = stored(shared_words(signature_rows(source, buckets, common)), "groups")
    common.unpersist()
    give_back()

    # First round: all members of a group against one of them.
    heads = groups.groupBy("g").agg(F.min(F.struct("n", "node")).alias("head"))
    star = groups.join(heads, "g").where("node <> head.node and 3 * n <= 4 * head.n")
    star = star.select(F.col("head.node").alias("a"), F.col("node").alias("b"))
    tried = stored(passing_sketches(star.distinct(), classes, ordered=True), "tried")
    links = stored(verified(tried, classes, source), "links")
    # Second round: the other members of a group, where they are still in different components, hub
    # against hub. Their pairs with the group's head have been compared.
    labels = components(links)
    known = labels.join(hubs_of(links), "node", "left")
    member = groups.join(heads, "g").where("node <> head.node").join(known, "node", "left").select(
        "g",
        "node",
        "n",
        F.coalesce("component", "node").alias("component"),
        F.coalesce("hub", "node").alias("hub"),
        F.coalesce("radius", F.lit(0)).alias("radius"),
    )
    member = stored(member, "members")
    per_hub = one_of_each(stored(hubs_of_groups(member), "group-hubs"))
    sketches = classes.select(F.col("node").alias("hub"), "n", "upper", "lower")
    near = stored(near_hubs(stored(per_hub.join(sketches, "hub"), "hubs")), "near")

    def compared(pairs: DataFrame, before: DataFrame, label: str) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = stored(passing_sketches(pairs.join(before, ["a", "b"], "left_anti"), classes), label)
        return stored(verified(pairs, classes, source), f"{label}-links")

    # The hubs themselves first: most of the components that are near each other are one then.
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = compared(near.select(F.col("h").alias("a"), F.col("k").alias("b")), done, "hub-pairs")
    # A node and its component are a link, so what is known goes in as that.
    merged = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    labels = components(merged.union(more.select("a", "b")))
    for side in "hk":
        named = labels.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
        near = near.join(named, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    near = near.where("of_h <> of_k").select("h", "k")
    spokes = stored(member.select("hub", "node").distinct(), "spokes")
    more = compared(spoke_pairs(near, spokes, classes), done, "pairs")

    merged = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    labels = components(merged.union(more.select("a", "b")))
    named = classes.select("node", "rep").join(labels, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("least"))
    named = named.join(least, "component").select("node", "least")
    out = rows.select("doc_id", "spot", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    stays = F.col("doc_id").eqNullSafe(F.col("least.i")) & (F.col("spot") == F.col("least.s"))
    return out.join(named, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least.i")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, stays).otherwise(F.lit(True)).alias("kept"),
        "spot",
    )
