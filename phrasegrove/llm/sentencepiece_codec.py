"""SentencePiece encoding and decoding of merge-type (BPE) models, exact.

The encoding is found by backtracking instead of merging. Aho-Corasick gives all pieces in a
chunk; from the left the longest piece is taken that is compatible with the piece before it, that
is, merging the two pieces' own characters anew gives just these two back (asked once per pair).
Where no piece fits, the position is marked in a bitfield as failed and the last piece gives way
to a shorter one. A sequence in which all neighbours are compatible is the one that merging
gives.

A text is cut before every space that follows another character, and around characters that occur
in no piece of several characters: no piece crosses these cuts, which is checked when the model is
read. Chunks repeat, so a task keeps the encodings of a bounded number of them. Inside, the model's
mark of a space is a plain space again, which keeps most chunks at a byte a character.

Supported are models without a normalisation table, as the class checks. Defined cases: a null or
empty text has no tokens; a text of any length is encoded whole; characters without a piece become
bytes (or the unknown id); decoding joins pieces, reads runs of bytes as UTF-8 with U+FFFD for
every byte that fits nowhere, and drops the one space put before the text. Rows are handled one by
one, so ties and repeated rows need no rule; extra columns are kept.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from phrasegrove.llm.common import Shipped, add_columns, keeps

SPACE = "▁"
UNKNOWN = " ⁇ "
#: Bytes that either half of a task's memory of chunks takes, about, and the longest chunk kept.
MEMO_BYTES = 24 << 20
MEMO_CHARS = 48
#: What an entry takes besides its characters and ids: two objects and a place in the table.
ENTRY_BYTES = 150
#: Pairs of pieces whose compatibility a task keeps.
PAIRS = 400_000
#: Bytes of text encoded at a time, about: ids and decoded text take several times as much beside them.
SLICE_BYTES = 1 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protobuf message's fields; fixed-width ones as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        width = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + width]
        at += width


def _automaton(ids: dict[str, int]) -> ahocorasick.Automaton:
    finder = ahocorasick.Automaton()
    for name, i in ids.items():
        finder.add_word(name, i)
    finder.make_automaton()
    return finder


class PieceCodec:
    def __init__(self, model: bytes):
        # Field numbers and piece types of the model format. Fixed values.
        message = list(_fields(model))
        trainer = dict(_fields(next((v for n, v in message if n == 2), b"")))
        normal = dict(_fields(next((v for n, v in message if n == 3), b"")))
        if trainer.get(3, 1) != 2:
            raise ValueError("the model is not of the merge type")
        if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1) or not normal.get(3, 1):
            raise ValueError("models that normalise texts are not supported")
        pieces = [dict(_fields(value)) for number, value in message if number == 1]
        names = [piece[1].decode() for piece in pieces]
        kinds = [piece.get(3, 1) for piece in pieces]  # 1 normal, 2 unknown, 3 control, 4 user-defined, 6 byte
        if 4 in kinds:
            raise ValueError("user-defined pieces are not supported")
        if any(" " in name for name, kind in zip(names, kinds) if kind == 1):
            raise ValueError("a piece holds a plain space")
        self.names = [name.replace(SPACE, " ") for name in names]
        self.ids = {name: i for i, (name, kind) in enumerate(zip(self.names, kinds)) if kind == 1}
        score = {i: float(np.frombuffer(pieces[i].get(2, bytes(4)), "<f4")[0]) for i in self.ids.values()}
        self.cost = {name: -score[i] for name, i in self.ids.items()}
        self.unknown = kinds.index(2)
        as_bytes = {int(name[3:5], 16): i for i, (name, kind) in enumerate(zip(names, kinds)) if kind == 6}
        self.byte_ids = as_bytes if len(as_bytes) == 256 else None

        several = [name for name in self.ids if len(name) > 1]
        if any(" " in name.lstrip(" ") for name in several):
            raise ValueError("a piece holds a space after another character")
        inside = set("".join(several))
        alone = re.escape("".join(c for c in map(chr, range(256)) if c not in inside and c != " "))
        self.cut = re.compile(f" *[^ {alone}]+| +|[{alone or ' '}]").findall
        # A character without a piece of its own has the number ``many`` + its code point.
        self.many = len(names)
        self.sizes = [len(name) for name in self.names]
        # The next shorter piece that a piece begins with; -1 for a single character.
        self.shorter = [-1] * self.many
        for name, i in self.ids.items():
            for size in range(len(name) - 1, 0, -1):
                j = self.ids.get(name[:size], -1)
                if j >= 0 or size == 1:
                    self.shorter[i] = j if j >= 0 else self.many + ord(name[0])
                    break
        finder = _automaton(self.ids)
        self.longest, self.matches = finder.iter_long, finder.iter
        self.packed = "H" if self.many <= 1 << 16 else "i"
        self.forget()

        surface = []
        for name, kind in zip(names, kinds):
            if kind == 6:
                surface.append(bytes([int(name[3:5], 16)]))
            elif kind == 3:
                surface.append(b"")
            else:
                surface.append((UNKNOWN if kind == 2 else name.replace(SPACE, " ")).encode())
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.width = np.array([len(s) for s in surface], np.int64)
        self.start = np.cumsum(self.width) - self.width
        self.silent = np.array([kind == 3 for kind in kinds])
        self.spaced = np.array([kind == 1 and name.startswith(SPACE) for name, kind in zip(names, kinds)])
        self.byte_piece = np.array([kind == 6 for kind in kinds])

    def forget(self) -> None:
        """Drop the pairs and chunks met so far."""
        self.fits: dict[int, bool] = {}
        # What is met again moves from the older half to the newer; a full half replaces the older.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def merged(self, text: str) -> list[str]:
        """The pieces by merging: always the neighbours whose joint piece scores best, leftmost."""
        parts, cost, never = list(text), self.cost.get, math.inf
        costs = [cost(a + b, never) for a, b in zip(parts, parts[1:])]
        while costs:
            least = min(costs)
            if least == never:
                break
            i = costs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = cost(parts[i - 1] + parts[i], never)
            if i < len(costs):
                costs[i] = cost(parts[i] + parts[i + 1], never)
        return parts

    def name(self, piece: int) -> str:
        return self.names[piece] if piece < self.many else chr(piece - self.many)

    def compatible(self, left: int, right: int) -> bool:
        """Whether both pieces come back when their characters are merged anew; -1 is no piece."""
        key = (left + 1) << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            pair = [self.name(left), self.name(right)] if left >= 0 else [self.name(right)]
            known = self.fits[key] = self.merged("".join(pair)) == pair
        return known

    def pieces(self, chunk: str) -> list[int]:
        """The encoding of a chunk.

        Taking the longest piece at every place, without a look at neighbours, is often the answer
        already; else the places are tried in order, with the shorter pieces and backtracking.
        """
        fits, sizes, at, before, taken = self.fits, self.sizes, 0, -1, []
        for last, piece in self.longest(chunk):
            if last + 1 - sizes[piece] != at:
                break
            known = fits.get((before + 1) << 32 | piece)
            if not (self.compatible(before, piece) if known is None else known):
                break
            taken.append(piece)
            before, at = piece, last + 1
        return taken if at == len(chunk) else self.backtracked(chunk)

    def backtracked(self, chunk: str) -> list[int]:
        fits, sizes, many, size = self.fits, self.sizes, self.many, len(chunk)
        # The longest piece at each place: of those that begin there it ends last.
        longest = [-1] * size
        for last, piece in self.matches(chunk):
            longest[last + 1 - sizes[piece]] = piece
        failed = bytearray(size + 1)
        taken: list[int] = []
        at, before = 0, -1
        piece = longest[0] if longest[0] >= 0 else many + ord(chunk[0])
        while True:
            end = at + (sizes[piece] if piece < many else 1)
            if not failed[end]:
                known = fits.get((before + 1) << 32 | piece)
                if self.compatible(before, piece) if known is None else known:
                    taken.append(piece)
                    if end == size:
                        return taken
                    at, before = end, piece
                    piece = longest[at] if longest[at] >= 0 else many + ord(chunk[at])
                    continue
            piece = self.shorter[piece] if piece < many else -1
            while piece < 0:
                # Nothing fits here: the piece before gives way to a shorter one.
                failed[at] = 1
                gone = taken.pop()
                at -= sizes[gone] if gone < many else 1
                before = taken[-1] if taken else -1
                piece = self.shorter[gone] if gone < many else -1

    def _ids(self, piece: int) -> list[int]:
        if piece < self.many:
            return [piece]
        if self.byte_ids is None:
            return [self.unknown]
        return [self.byte_ids[b] for b in chr(piece - self.many).encode()]

    def _encoded(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            pieces = self.pieces(chunk)
            if max(pieces) >= self.many:
                pieces = [i for piece in pieces for i in self._ids(piece)]
            found = array(self.packed, pieces).tobytes()
        if len(chunk) <= MEMO_CHARS:
            if self.held >= MEMO_BYTES:
                self.memo, self.older, self.held = {}, self.memo, 0
            self.memo[chunk] = found
            self.held += ENTRY_BYTES + len(chunk) + len(found)
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, self.packed)
        chunks = self.cut(" " + text.replace(SPACE, " "))
        found = list(map(self.memo.get, chunks))
        if None in found:
            memo = self.memo
            for i, known in enumerate(found):
                if known is None:
                    # The same chunk may have come before in this text.
                    known = memo.get(chunks[i])
                    found[i] = self._encoded(chunks[i]) if known is None else known
        return np.frombuffer(b"".join(found), self.packed)

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids."""
        ids = np.asarray(ids, np.int64)
        heard = ids[~self.silent[ids]] if len(ids) else ids
        widths = self.width[heard]
        ends = np.cumsum(widths)
        total = int(ends[-1]) if len(ends) else 0
        from_ = np.repeat(self.start[heard] - (ends - widths), widths) + np.arange(total)
        raw = self.surface[from_].tobytes()
        if len(heard) and self.spaced[heard[0]]:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_bytes(heard)

    def _decode_bytes(self, heard: np.ndarray) -> str:
        """As ``decode``, run by run, where some bytes are no UTF-8."""
        out = []
        edges = np.flatnonzero(np.diff(self.byte_piece[heard])) + 1
        for run in np.split(heard, edges):
            raw = b"".join(self.surface[self.start[i] : self.start[i] + self.width[i]].tobytes() for i in run)
            while self.byte_piece[run[0]] and raw:
                try:
                    out.append(raw.decode())
                    raw = b""
                except UnicodeDecodeError as wrong:
                    out.append(raw[: wrong.start].decode() + "�")
                    raw = raw[wrong.start + 1 :]
            out.append(raw.decode())
        text = "".join(out)
        return text[1:] if self.spaced[heard[0]] else text


_codecs: dict[str, PieceCodec] = {}


def _codec(model: Shipped) -> PieceCodec:
    """The worker's codec of a model; a worker keeps one."""
    if model.key not in _codecs:
        _codecs.clear()
        _codecs[model.key] = PieceCodec(model.data.value)
        keeps("sentencepiece", _codecs.clear)
    return _codecs[model.key]


def _forget() -> None:
    for codec in _codecs.values():
        codec.forget()


def ragged(parts: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind.to_pandas_dtype()), kind))


def encode(
    df: DataFrame,
    model: Shipped,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str | None = None,
    keep: bool = True,
) -> DataFrame:
    """Add ``ids_col``, the texts' token ids; ``model`` is a model file.

    With ``decoded_col`` the ids are decoded again in the same pass over the rows. Without ``keep``
    the texts themselves do not come back from the workers.
    """

    def make(texts: list[str]) -> dict[str, pa.Array]:
        codec = _codec(model)
        ids = [codec.encode(text) for text in texts]
        made = {ids_col: ragged(ids, pa.int32())}
        if decoded_col:
            made[decoded_col] = pa.array([codec.decode(i) for i in ids], pa.string())
        return made

    added = f"`{ids_col}` array<int>" + (f", `{decoded_col}` string" if decoded_col else "")
    return add_columns(
        df, text_col, added, make, keep=keep, slice_bytes=SLICE_BYTES, operator="sentencepiece", done=_forget
    )


def decode(df: DataFrame, model: Shipped, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col``, the texts of the ids in ``ids_col``; null ids read as none."""

    def make(rows: list) -> dict[str, pa.Array]:
        codec = _codec(model)
        return {text_col: pa.array([codec.decode(ids) for ids in rows], pa.string())}

    return add_columns(df, ids_col, f"`{text_col}` string", make, as_arrays=True, operator="sentencepiece")
