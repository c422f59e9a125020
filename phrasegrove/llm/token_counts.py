"""Token counts of a byte-level BPE tokenizer, by compiled finite-state transducers.

Two deterministic transducers replace the tokenizer; neither makes a token id.

* The splitter reads classes of characters and marks where its pattern (contractions, letters,
  numbers, other signs, white space) begins a word. It has twelve states. Texts are cut into
  chunks of ``CHUNK`` characters; every chunk is run from all states at once, which gives its map
  from entry to exit state. The maps are composed by a parallel prefix scan over all chunks of a
  batch (a text's first chunk has a constant map, so texts do not mix), and with the entry
  states known all chunks are run again, side by side, and mark the words.
* The counter reads the bytes of a word. The encoding of a prefix is the encoding of a shorter
  prefix and one more token, found by compatibility of two neighbouring tokens (merging their
  bytes anew gives both back). A state holds, for each place where a token that is still
  possible may have begun, the token before it and its count; a transition is annotated with the
  change of the count. States are compiled when first met and kept up to a bound, and so are
  the counts of words.

Classes come from the regular expressions of the tokenizer's own library. Defined cases: null and
empty texts have 0 tokens; special strings in a text are cut out first and count as one token;
texts of any length are counted whole, nothing is cut off or padded; rows are counted one by one,
so ties and repeated rows need no rule; extra columns are kept.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from phrasegrove.llm.common import Shipped, add_columns

#: Characters of a chunk, and the bounds of what a worker keeps.
CHUNK = 96
MEMO = 350_000
MEMO_CHARS = 48
STATES = 150_000

#: The pattern that the splitter implements. Fixed value of the tokenizer family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Classes of characters.
SPACE, BLANK, LETTER, NUMBER, SIGN, QUOTE, SOLE, R, V, L, E = range(11)
# States: before a word; in a run; after a quote that began a word, alone or with a letter;
# after one white-space character or several, the last one a space or another.
START, IN_LETTERS, IN_NUMBERS, IN_SIGNS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, S1, B1, SN, BN = range(12)
N_STATES, N_CLASSES = 12, 11
#: Marks: a word begins at this character, or began at the one before.
HERE, BEFORE = 1, 2


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next states and marks by state and class."""
    letters = (LETTER, SOLE, R, V, L, E)
    run = {**dict.fromkeys(letters, IN_LETTERS), NUMBER: IN_NUMBERS, SIGN: IN_SIGNS, QUOTE: IN_SIGNS, SPACE: S1, BLANK: B1}
    begin = {**run, QUOTE: QUOTED}
    after_quote = {R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}
    close = {QUOTED_R: E, QUOTED_V: E, QUOTED_L: L}
    to = np.zeros((N_STATES, N_CLASSES), np.uint8)
    mark = np.zeros((N_STATES, N_CLASSES), np.uint8)
    for c in range(N_CLASSES):
        white = c in (SPACE, BLANK)
        for state in range(N_STATES):
            to[state, c], mark[state, c] = begin[c], HERE
            if state in (IN_LETTERS, IN_NUMBERS, IN_SIGNS) and run[c] == state:
                to[state, c], mark[state, c] = state, 0
            elif state == QUOTED and c == SOLE:
                to[state, c], mark[state, c] = START, 0
            elif state == QUOTED and c in after_quote:
                to[state, c], mark[state, c] = after_quote[c], 0
            elif state == QUOTED and run[c] == IN_SIGNS:
                to[state, c], mark[state, c] = IN_SIGNS, 0
            elif state in close:
                if c == close[state]:
                    to[state, c], mark[state, c] = START, 0
                elif c in letters:
                    to[state, c], mark[state, c] = IN_LETTERS, BEFORE
                else:
                    mark[state, c] = BEFORE | HERE
            elif state in (S1, B1, SN, BN) and white:
                to[state, c], mark[state, c] = (SN if c == SPACE else BN), 0
            elif state == S1:
                to[state, c], mark[state, c] = run[c], 0
            elif state == SN:
                to[state, c], mark[state, c] = run[c], BEFORE
            elif state == BN:
                mark[state, c] = BEFORE | HERE
    return to, mark


TO, MARK = splitter()


@cache
def character_classes() -> np.ndarray:
    """The class of every code point, by the regular expressions of the tokenizer's library."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    every = "".join(map(chr, points))
    classes = np.full(0x110000, SIGN, np.uint8)
    codes = np.array(points)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        # Runs of the class come as pieces of their own; a piece is one if its first character is.
        for text, (a, b) in Split(Regex(pattern + "+"), "isolated").pre_tokenize_str(every):
            if Split(Regex(pattern), "removed").pre_tokenize_str(text[0]) == []:
                classes[codes[a:b]] = kind
    for kind, signs in ((SPACE, " "), (QUOTE, "'"), (SOLE, "stmd"), (R, "r"), (V, "v"), (L, "l"), (E, "e")):
        for sign in signs:
            classes[ord(sign)] = kind
    return classes


def entry_states(maps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each chunk's entry state, by a parallel prefix scan over the chunks' state maps.

    ``maps[i, s]`` is the exit state of chunk i entered in state s; ``first`` marks the chunks that
    begin a text.
    """
    scanned = maps.copy()
    scanned[first] = maps[first, START][:, None]
    step = 1
    while step < len(scanned):
        # Composition: first the map of what ends ``step`` chunks before, then one's own.
        scanned[step:] = np.take_along_axis(scanned[step:], scanned[:-step].astype(np.intp), axis=1)
        step *= 2
    entry = np.empty(len(maps), np.uint8)
    entry[0] = START
    entry[1:] = scanned[:-1, START]
    entry[first] = START
    return entry


class Counter:
    def __init__(self, tokenizer: dict, classes: np.ndarray):
        model, splitting = tokenizer["model"], tokenizer["pre_tokenizer"]
        plain = splitting and splitting["type"] == "ByteLevel" and splitting.get("use_regex", True)
        odd = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
        if tokenizer["normalizer"] or model["type"] != "BPE" or not plain or any(odd):
            raise ValueError("the tokenizer is no plain byte-level BPE")
        if splitting.get("add_prefix_space"):
            raise ValueError("a space put before texts is not supported")
        added = tokenizer["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take white space or whole words are not supported")
        strings = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, strings))) if strings else None
        self.classes = classes
        # The format writes bytes as characters: printable ones as they are, others from U+0100.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        byte_of = {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}

        def raw(name: str) -> bytes:
            return bytes(byte_of[c] for c in name)

        specials = set(strings)
        self.tokens = {raw(name) for name in model["vocab"] if name not in specials}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.open = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.lives: dict[bytes, tuple] = {}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.memo: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: the bytes since the earliest open place, and for each open place its offset,
        # the token before it (none at the word's start) and its count against the count here.
        first = (b"", ((0, b"", 0),))
        self.states, self.number, self.moves = [first], {first: 0}, {}

    def _merging(self, token: bytes):
        """Merge a token's bytes: whether they give the token, and the lives of its end symbols.

        A life is ``(symbol, rank of the merge that made it, rank of the one that ends it)``.
        """
        known = self.lives.get(token)
        if known is not None:
            return known
        parts = [token[i : i + 1] for i in range(len(token))]
        left, right, made_left, made_right = [], [], -1, -1
        while True:
            options = [(self.rank[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in self.rank]
            if not options:
                break
            rank, i = min(options)
            if i == 0:
                left.append((parts[0], made_left, rank))
                made_left = rank
            if i + 2 == len(parts):
                right.append((parts[-1], made_right, rank))
                made_right = rank
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        left.append((parts[0], made_left, len(self.rank)))
        right.append((parts[-1], made_right, len(self.rank)))
        if any(made > ended for _, made, ended in left + right):
            raise ValueError("a token is made of merges that come later than its own")
        known = self.lives[token] = (parts == [token], left, right)
        return known

    def _apart(self, before: bytes, token: bytes) -> bool:
        whole, lives, _ = self._merging(token)
        if not before or not whole:
            return whole
        whole, _, other = self._merging(before)
        for x, made_x, end_x in other if whole else ():
            for y, made_y, end_y in lives:
                # Both stand side by side for a while. Of equal ranks the left merge goes first.
                if made_x < end_y and made_y < end_x:
                    rank = self.rank.get((x, y))
                    if rank is not None and rank < end_x and rank <= end_y:
                        return False
        return whole

    def compatible(self, before: bytes, token: bytes) -> bool:
        """Whether merging the bytes of both anew never joins across their border."""
        known = self.fits.get((before, token))
        if known is None:
            if len(self.fits) >= 1 << 20:
                self.fits.clear()
            known = self.fits[before, token] = self._apart(before, token)
        return known

    def _compile(self, state: int, byte: int) -> int:
        """The transition, as ``state * 256 + change of the count + 128``."""
        window, places = self.states[state]
        window += bytes((byte,))
        for at, before, count in places:
            token = window[at:]
            if token in self.tokens and self.compatible(before, token):
                break
        else:
            raise ValueError("a byte has no token")
        change = count + 1
        open_ = [(a, b, n - change) for a, b, n in places if window[a:] in self.open]
        open_.append((len(window), token, 0))
        cut = open_[0][0]
        reached = (window[cut:], tuple((a - cut, b, n) for a, b, n in open_))
        if reached not in self.number:
            self.number[reached] = len(self.states)
            self.states.append(reached)
        move = self.number[reached] * 256 + change + 128
        self.moves[state * 256 + byte] = move
        return move

    def count_word(self, word: bytes) -> int:
        if len(self.states) > STATES:
            self._reset()
        moves, state, count = self.moves, 0, 0
        for byte in word:
            move = moves.get(state * 256 + byte)
            if move is None:
                move = self._compile(state, byte)
            state = move >> 8
            count += (move & 255) - 128
        return count

    def _counted(self, word: str) -> int:
        count = self.older.get(word)
        if count is None:
            count = self.count_word(word.encode())
        if len(word) <= MEMO_CHARS:
            if len(self.memo) >= MEMO:
                self.memo, self.older = {}, self.memo
            self.memo[word] = count
        return count

    def words(self, texts: list[str]) -> list[list[str]]:
        """The words of each text, by the splitter."""
        sizes = np.array([len(t) for t in texts], np.int64)
        chunks = -(-sizes // CHUNK)
        total, ends = int(chunks.sum()), np.cumsum(chunks)
        lanes = np.full(total * CHUNK, START, np.uint8)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        starts = (ends - chunks) * CHUNK
        text_at = np.cumsum(sizes) - sizes
        place = np.arange(len(points)) + np.repeat(starts - text_at, sizes)
        lanes[place] = self.classes[points]
        columns = np.ascontiguousarray(lanes.reshape(total, CHUNK).T)
        first = np.zeros(total, bool)
        first[(ends - chunks)[chunks > 0]] = True

        flat_to, flat_mark = TO.ravel(), MARK.ravel()
        maps = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (total, N_STATES)).copy()
        for column in columns:
            maps = flat_to[maps * np.uint8(N_CLASSES) + column[:, None]]
            if (maps == maps[:, :1]).all():
                break  # every chunk's map is constant by now; the second run follows one state
        state = entry_states(self._finish(maps, columns), first) if total else np.zeros(0, np.uint8)
        marks = np.zeros((CHUNK + 1, total), bool)
        for i, column in enumerate(columns):
            code = state * np.uint8(N_CLASSES) + column
            made = flat_mark[code]
            marks[i + 1] |= (made & HERE) > 0
            marks[i] |= (made & BEFORE) > 0
            state = flat_to[code]
        # A mark before a chunk's first character belongs to the chunk before.
        spill = np.flatnonzero(marks[0])
        marks[CHUNK, spill - 1] = True
        flat = np.ascontiguousarray(marks[1:].T).ravel()[place]
        cuts = np.flatnonzero(flat)
        out, at = [], np.searchsorted(cuts, text_at)
        stop = np.append(at[1:], len(cuts))
        for i, text in enumerate(texts):
            begin = (cuts[at[i] : stop[i]] - text_at[i]).tolist()
            words = [text[a:b] for a, b in zip(begin, [*begin[1:], len(text)])]
            if words and len(words[-1]) == 2 and words[-1] in ("'r", "'v", "'l"):
                words[-1:] = ["'", words[-1][1]]  # no contraction any more at the text's end
            out.append(words)
        return out

    def _finish(self, maps: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """The maps at the chunks' ends: constant maps need one state only."""
        if not len(maps) or not (maps == maps[:, :1]).all():
            return maps
        state = np.arange(N_STATES, dtype=np.uint8)[:1].repeat(len(maps))
        flat_to = TO.ravel()
        for column in columns:
            state = flat_to[state * np.uint8(N_CLASSES) + column]
        return np.repeat(state[:, None], N_STATES, axis=1)

    def count(self, texts: list[str]) -> np.ndarray:
        segments, owner, counts = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = self.special.split(text) if self.special else [text]
            counts[i] = len(parts) - 1
            segments += parts
            owner += [i] * len(parts)
        for i, words in zip(owner, self.words(segments)):
            found = list(map(self.memo.get, words))
            if None in found:
                for k, known in enumerate(found):
                    if known is None:
                        found[k] = self._counted(words[k])
            counts[i] += sum(found)
        return counts


_counters: dict[str, Counter] = {}


class Compiled:
    """A tokenizer file and the classes of characters, sent to the workers; both of fixed size."""

    def __init__(self, spark: SparkSession, path: str):
        self.file = Shipped(spark, path)
        self.classes = spark.sparkContext.broadcast(character_classes())

    def counter(self) -> Counter:
        if self.file.key not in _counters:
            _counters.clear()
            _counters[self.file.key] = Counter(json.loads(self.file.data.value), self.classes.value)
        return _counters[self.file.key]


def count_tokens(df: DataFrame, tokenizer: Compiled, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add ``out``, the number of tokens of each text."""

    def make(texts: list[str]) -> dict[str, pa.Array]:
        return {out: pa.array(tokenizer.counter().count(texts), pa.int64())}

    return add_columns(df, text_col, f"`{out}` bigint", make)
