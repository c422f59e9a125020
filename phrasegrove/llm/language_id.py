"""Language of texts by a linear-chain conditional random field over their words.

Words are runs of letters, lower-cased. A word's score for a language is the sum of learned
weights over its character n-grams (those with the word's edge are its affixes), the whole
word, and its entries in lexicons of words that are frequent in one language; languages of
neighbouring words are tied by learned transitions. The forward-backward algorithm gives each
word's probabilities, so a text that switches its language is labelled word by word; the text gets
the language with the largest part of the words' probability, and that part as its score.

Learning takes at most ``Sample.docs`` labelled texts of each language (those with the smallest
hash of their id and text, texts without a letter left out) and the first ``Sample.words`` words
of each, wherever in the text they stand, cuts them into passages, and strings passages of
different texts together, so that switches are seen with their labels. The sample is the only
part that is bounded; every text is predicted whole. Long texts do not make long loops:
chains are cut into pieces, the pieces' transfer matrices are multiplied along each text, and
all pieces run side by side.

How well a text is known is the mean over its words of the part of their n-grams that were
learned. ``Model.least_known`` lies halfway between what the sample's texts have by each other
(the lowest hundredth) and what the same words have in letters that were never learned.

Defined cases: null text, or one without a letter: ``und`` with score 0; no labelled rows at all:
every text is ``und``; ties go to the language first by name; repeated rows get equal results;
extra columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phrasegrove.functions.memory import give_back
from phrasegrove.llm.common import add_columns, mix64, stored

WORD = re.compile(r"[^\W\d_]+")
WORDS = WORD.findall
UNKNOWN = "und"
#: A character that ``WORD`` may hold, for Java's expressions.
LETTER = r"[\p{L}\p{Nl}\p{No}]"
#: Bytes of text that are worked on at a time, about; short words make many numbers.
SLICE = 1 << 19
#: Rows of the weight table: hashed features, then one row per language's lexicon.
HASHED = 1 << 16
#: Places of the learned n-grams: so many that few others share one.
KNOWN = 1 << 22
#: Lengths of character n-grams, edges of the word included.
GRAMS = (1, 2, 3, 4)
#: Words of a piece of a chain.
PIECE = 64


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learned from, and how."""

    docs: int = 300
    words: int = 150
    passage: int = 24
    rounds: int = 30
    rate: float = 0.3
    decay: float = 1e-5
    lexicon_count: int = 5
    lexicon_share: float = 0.9


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[str, int]
    #: By place, whether the sample has the n-gram.
    learned: np.ndarray
    #: A text that is known less than this is in none of the languages.
    least_known: float


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places (of ``KNOWN``) and word numbers of all n-grams of the words, and of the words."""
    flat = np.frombuffer(("\x01" + "\x02\x01".join(words) + "\x02").encode("utf-32-le"), np.uint32).astype(np.uint64)
    begins = np.flatnonzero(flat == 1)
    sizes = np.diff(np.append(begins, len(flat)))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(begins + sizes, sizes) - np.arange(len(flat))  # characters to the word's end
    rows, owners = [], []
    rolled = np.zeros(len(flat), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        rolled = rolled * np.uint64(0x100000001B3)
        rolled[: len(flat) - n + 1] += flat[n - 1 :]
        if n in GRAMS:
            fits = left >= n
            rows.append((mix64(rolled[fits] + np.uint64(n)) % np.uint64(KNOWN)).astype(np.int64))
            owners.append(owner[fits])
    sums = np.add.reduceat(mix64(flat + np.uint64(31) * left.astype(np.uint64)), begins)
    rows.append((mix64(sums) % np.uint64(KNOWN)).astype(np.int64))
    owners.append(np.arange(len(words)))
    return np.concatenate(rows), np.concatenate(owners)


def features(words: list[str], lexicon: dict[str, int], found=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature rows and word numbers, one pair per feature, and each word's scale.

    ``found`` is what ``grams`` gives, if it is there already: ``HASHED`` divides ``KNOWN``.
    """
    rows, owners = grams(words) if found is None else found
    entry = np.array([lexicon.get(w, -1) for w in words])
    rows = np.concatenate([rows % HASHED, HASHED + entry[entry >= 0]])
    owners = np.concatenate([owners, np.flatnonzero(entry >= 0)])
    return rows, owners, 1 / np.sqrt(np.bincount(owners, minlength=len(words)))


def word_scores(found, weights: np.ndarray) -> np.ndarray:
    rows, owners, scale = found
    columns = [np.bincount(owners, weights[rows, k], minlength=len(scale)) for k in range(weights.shape[1])]
    return np.stack(columns, axis=1) * scale[:, None]


def known_parts(found: tuple[np.ndarray, np.ndarray], learned: np.ndarray) -> np.ndarray:
    """The part of each word's n-grams, itself among them, that were learned."""
    rows, owners = found
    return np.bincount(owners, learned[rows]) / np.bincount(owners)


def least_known(texts: list[list[str]]) -> tuple[np.ndarray, float]:
    """``Model.learned`` and ``Model.least_known`` of the sample's texts, given as words."""
    index: dict[str, int] = {}
    numbers = [np.array([index.setdefault(w, len(index)) for w in words]) for words in texts]
    rows, owners = grams(list(index))
    order = np.argsort(owners, kind="stable")
    by_word, ends = rows[order], np.searchsorted(owners[order], np.arange(len(index) + 1))
    of = [by_word[ends[i] : ends[i + 1]] for i in range(len(index))]
    # How many texts have a feature; a text's own does not count for it.
    count = np.zeros(KNOWN, np.int32)
    mine = [np.unique(np.concatenate([of[i] for i in np.unique(n)])) for n in numbers]
    for own in mine:
        count[own] += 1
    shared = [np.mean([(count[of[i]] > 1).mean() for i in n]) for n in numbers]
    learned = count > 0
    strange = ["".join(chr(0xF0000 + ord(c) % 0xFFF0) for c in word) for word in index]
    noise = known_parts(grams(strange), learned)
    low, high = np.mean([noise[n].mean() for n in numbers]), np.quantile(shared, 0.01)
    return learned, float(min(high, (low + high) / 2))


def marginals(
    scores: np.ndarray, words: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, expect: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Each word's probabilities in chains laid end to end, and, if asked for, the expected transitions.

    ``scores`` has a row per different word, ``words`` the number of each word of the chains, ``sizes``
    the words of each chain. The word before a chain's first is taken as any language alike.

    The words of all pieces lie place by place, longer pieces first, so that a step of all pieces that
    reach it is one stretch and nothing is padded.
    """
    k = scores.shape[1]
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    pieces = -(-sizes // PIECE)
    total = int(pieces.sum())
    if not total:
        return np.zeros((0, k)), np.zeros((k, k)) if expect else None
    first = np.cumsum(pieces) - pieces
    inside = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    piece = np.repeat(first, sizes) + inside // PIECE
    inside %= PIECE
    lengths = np.bincount(piece, minlength=total)
    rank = np.empty(total, np.int64)
    rank[np.argsort(-lengths, kind="stable")] = np.arange(total)
    active = np.bincount(inside, minlength=PIECE)
    begin = np.cumsum(active) - active
    place = begin[inside] + rank[piece]
    del inside, piece
    steps = [slice(b, b + a) for b, a in zip(begin, active) if a]
    grid = np.empty((len(words), k))
    grid[place] = emit[words]

    enter = np.full((total, k), 1 / k)
    leave = np.full((total, k), 1 / k)
    longest = int(pieces.max())
    if longest > 1:
        # The transfer matrix of each piece; along each chain, what enters a piece from both sides.
        whole = np.broadcast_to(np.eye(k), (total, k, k)).copy()
        for on in steps:
            n = on.stop - on.start
            step = (whole[:n] @ move) * grid[on][:, None, :]
            whole[:n] = step / step.sum(axis=(1, 2), keepdims=True)
        for i in range(1, longest):
            p = first[pieces > i] + i
            new = np.einsum("pi,pij->pj", enter[rank[p - 1]], whole[rank[p - 1]])
            enter[rank[p]] = new / new.sum(axis=1, keepdims=True)
            q = (first + pieces - 1 - i)[pieces > i]
            new = np.einsum("pij,pj->pi", whole[rank[q + 1]], leave[rank[q + 1]])
            leave[rank[q]] = new / new.sum(axis=1, keepdims=True)
        del whole
    # All pieces side by side.
    forward, held = np.empty_like(grid), enter.copy()
    for on in steps:
        n = on.stop - on.start
        new = (held[:n] @ move) * grid[on]
        held[:n] = new / new.sum(axis=1, keepdims=True)
        forward[on] = held[:n]
    expected = np.zeros((k, k)) if expect else None
    for t in reversed(range(len(steps))):
        on = steps[t]
        n = on.stop - on.start
        ahead = grid[on] * leave[:n]
        if expect:
            before = enter[:n] if t == 0 else forward[steps[t - 1].start :][:n]
            pairs = before[:, :, None] * move * ahead[:, None, :]
            expected += (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        # The place is not read forwards any more and takes the answer.
        both = forward[on] * leave[:n]
        grid[on] = both / both.sum(axis=1, keepdims=True)
        new = ahead @ move.T
        leave[:n] = new / new.sum(axis=1, keepdims=True)
    return grid[place], expected


def learn(texts: list[tuple[str, str]], sample: Sample = Sample()) -> Model | None:
    """Fit the field to ``(text, language)`` pairs; the same pairs give the same model."""
    passages: dict[str, list[list[str]]] = {}
    whole = []
    for text, language in sorted(texts, key=lambda pair: (pair[1], pair[0])):
        words = WORDS(text.lower())[: sample.words]
        whole.extend([words] if words else [])
        for i in range(0, len(words), sample.passage):
            passages.setdefault(language, []).append(words[i : i + sample.passage])
    if not passages:
        return None
    languages = sorted(passages)
    rng = np.random.default_rng(7)
    pool = [(k, p) for k, language in enumerate(languages) for p in passages[language]]
    order = rng.permutation(len(pool))
    index: dict[str, int] = {}
    words = np.array([index.setdefault(w, len(index)) for i in order for w in pool[i][1]])
    labels = np.array([pool[i][0] for i in order for _ in pool[i][1]])
    per = sample.passage * 8
    sizes = np.diff(np.append(np.arange(0, len(words), per), len(words)))
    k = len(languages)

    by = np.zeros((len(index), k))
    np.add.at(by, (words, labels), 1)
    seen = by.sum(axis=1)
    frequent = (seen >= sample.lexicon_count) & (by.max(axis=1) >= sample.lexicon_share * seen)
    lexicon = {w: int(by[i].argmax()) for w, i in index.items() if frequent[i]}

    found = features(list(index), lexicon)
    rows, owners, scale = found
    weights, transitions = np.zeros((HASHED + k, k)), np.zeros((k, k))
    truth = np.zeros((len(words), k))
    truth[np.arange(len(words)), labels] = 1
    heads = np.zeros(len(words), bool)
    heads[np.cumsum(sizes) - sizes] = True
    # A chain's first word follows any language alike, as in ``marginals``.
    seen_pairs = np.zeros((k, k))
    np.add.at(seen_pairs, (labels[:-1][~heads[1:]], labels[1:][~heads[1:]]), 1)
    heads_of = np.bincount(labels[heads], minlength=k)
    moments = [np.zeros_like(weights), np.zeros_like(transitions)]
    for _ in range(sample.rounds):
        guess, pairs = marginals(word_scores(found, weights), words, sizes, transitions, expect=True)
        error = np.zeros((len(index), k))
        for j in range(k):
            error[:, j] = np.bincount(words, truth[:, j] - guess[:, j], minlength=len(index))
        error *= scale[:, None]
        slope = np.stack([np.bincount(rows, error[owners, j], minlength=len(weights)) for j in range(k)], axis=1)
        slope = slope / len(words) - sample.decay * weights
        # The expected share of each language before a first word is left as it is.
        turn = (seen_pairs + heads_of / k - pairs) / len(words) - sample.decay * transitions
        for value, gradient, moment in zip((weights, transitions), (slope, turn), moments):
            moment += gradient**2
            value += sample.rate * gradient / (np.sqrt(moment) + 1e-12)
    # What only the rounds need goes before the n-grams of the whole sample are counted.
    del found, rows, owners, scale, truth, by, moments, guess, error, slope
    give_back()
    return Model(languages, weights.astype(np.float32), transitions, lexicon, *least_known(whole))


def held_out(id_col: str) -> Column:
    """Whether a row is kept from learning: crc32 of its id, as text, leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: Sample = Sample(), id_col="doc_id", text_col="text", lang_col="lang") -> Model | None:
    """Learn from the bounded sample of rows that are not held out.

    Rows are ranked by their hash alone, and only the sampled texts are fetched.
    """
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(LETTER)).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col, text_col).alias("spot")
    )
    # First within a 64th of the tasks, so that no task gets what all tasks hold of a language.
    chosen = rows.select("lang", "spot").withColumn("piece", F.spark_partition_id() % 64)
    for keys in (["lang", "piece"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("spot"))
        chosen = chosen.withColumn("place", place).where(F.col("place") <= sample.docs)
    chosen = stored(chosen.select("lang", "spot").distinct(), "sample")

    def make(texts: list[str]) -> dict[str, pa.Array]:
        firsts = (islice(WORD.finditer(text.lower()), sample.words) for text in texts)
        return {"text": pa.array([" ".join(m.group() for m in first) for first in firsts], pa.string())}

    # Only the words that may be learned leave the task.
    rows = add_columns(rows.join(chosen, ["lang", "spot"]), "text", "text string", make).where("text <> ''")
    # Repeated rows share a hash.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("spot", "text"))
    taken = rows.withColumn("place", place).where(F.col("place") <= sample.docs).select("text", "lang").collect()
    model = learn([(r.text, r.lang) for r in taken], sample)
    give_back()
    return model


def predict(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, list[list[str]], np.ndarray]:
    """Language number (-1: none) and score of each text, its words, and all words' probabilities."""
    return judged(texts, model)[:4]


def judged(texts: list[str], model: Model, known: bool = False):
    """What ``predict`` gives, and how well each text is known (0 if not asked for)."""
    index: dict[str, int] = {}
    split = [WORDS(text.lower()) for text in texts]
    sizes = np.array([len(words) for words in split], np.int64)
    numbers = np.array([index.setdefault(w, len(index)) for words in split for w in words], np.int64)
    k = len(model.languages)
    if not len(numbers):
        return np.full(len(texts), -1), np.zeros(len(texts)), split, np.zeros((0, k)), np.zeros(len(texts))
    found = grams(list(index))
    scores = word_scores(features(list(index), model.lexicon, found), model.weights)
    parts = known_parts(found, model.learned) if known else None
    del found
    chances, _ = marginals(scores, numbers, sizes, model.transitions)
    owner = np.repeat(np.arange(len(texts)), sizes)
    mass = np.stack([np.bincount(owner, chances[:, j], minlength=len(texts)) for j in range(k)], axis=1)
    some = sizes > 0
    share = mass / np.maximum(sizes, 1)[:, None]
    # Equal up to rounding counts as a tie.
    best = np.round(share, 9).argmax(axis=1)
    score = np.clip(share[np.arange(len(texts)), best], 0, 1)
    part = np.zeros(len(texts))
    if known:
        part = np.bincount(owner, parts[numbers], minlength=len(texts)) / np.maximum(sizes, 1)
    return np.where(some, best, -1), np.where(some, score, 0.0), split, chances, part


def identify(df: DataFrame, model: Model | None, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score", known_out: str | None = None, keep_text: bool = True) -> DataFrame:
    """Add the predicted language and its score; the text is the only input.

    ``known_out``, if given, is added as how well the text is known. Without ``keep_text`` the
    text is left out.
    """
    if model is None:
        extra = {known_out: F.lit(0.0)} if known_out else {}
        rows = df.withColumns({lang_out: F.lit(UNKNOWN), score_out: F.lit(0.0), **extra})
        return rows if keep_text else rows.drop(text_col)
    # The table of weights has a fixed number of rows, the lexicon is bounded by the sample.
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make(texts: list[str]) -> dict[str, pa.Array]:
        model = sent.value
        best, score, _, _, known = judged(texts, model, bool(known_out))
        names = [*model.languages, UNKNOWN]
        made = {lang_out: pa.array([names[b] for b in best], pa.string()), score_out: pa.array(score)}
        return {**made, **({known_out: pa.array(known)} if known_out else {})}

    added = f"`{lang_out}` string, `{score_out}` double" + (f", `{known_out}` double" if known_out else "")
    return add_columns(df, text_col, added, make, keep=keep_text, slice_bytes=SLICE)


def label_words(df: DataFrame, model: Model, text_col: str = "text", out: str = "words") -> DataFrame:
    """Add ``out``: every word of the text with its own language and that language's probability."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make(texts: list[str]) -> dict[str, pa.Array]:
        model = sent.value
        _, _, split, chances = predict(texts, model)
        best = chances.argmax(axis=1) if len(chances) else np.zeros(0, int)
        rows, at = [], 0
        for words in split:
            part = zip(words, best[at : at + len(words)], chances[at : at + len(words)])
            rows.append([{"word": w, "lang": model.languages[b], "p": float(p[b])} for w, b, p in part])
            at += len(words)
        kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("p", pa.float64())]))
        return {out: pa.array(rows, kind)}

    return add_columns(df, text_col, f"`{out}` array<struct<word: string, lang: string, p: double>>", make)
