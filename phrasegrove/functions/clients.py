"""What an embedding or naming client must offer, and one offline stand-in for each."""

from __future__ import annotations

import hashlib
import re
import time
from collections import Counter
from typing import Protocol

import numpy as np

_WORD = re.compile(r"[^\W\d_]+")


# The methods' names are fixed values.
class Embedder(Protocol):
    def embed_batch(self, texts: list[str]) -> list[list[float]]: ...


class Namer(Protocol):
    def complete_json(self, system: str, user: str) -> dict: ...


def call_with_retry(call, attempts: int, first_delay: float, before=None, sleep=time.sleep):
    """Try ``call`` up to ``attempts`` times, doubling the wait; the last error is raised.

    ``before`` runs ahead of every attempt, for a client that renews its credentials.
    """
    delay = first_delay
    for left in range(attempts - 1, -1, -1):
        try:
            if before:
                before()
            return call()
        except Exception:
            if left == 0:
                raise
            sleep(delay)
            delay *= 2


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Buckets(dict):
    """The numbers that ``of`` gives to words; a bounded number of them is kept."""

    def __init__(self, of):
        self.of = of

    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 16:
            self.clear()
        made = self[word] = self.of(word)
        return made


class TokenHashEmbedder:
    """Counts words in ``dims`` hash buckets and scales the counts to unit length."""

    def __init__(self, dims: int = 64):
        self.dims = dims
        self._bucket = Buckets(self._hash).__getitem__

    def _hash(self, word: str) -> int:
        return int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % self.dims

    def embed_batch(self, texts: list[str]) -> np.ndarray:
        counts = np.zeros((len(texts), self.dims), "i8")
        for row, text in zip(counts, texts):
            found = words(text)
            row += np.bincount(np.fromiter(map(self._bucket, found), "i8", len(found)), minlength=self.dims)
        size = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return (counts / np.maximum(size, 1e-300)).astype("f4")


class TermNamer:
    """Names a group by its most frequent words of three letters or more, ties by word."""

    def complete_json(self, system: str, user: str) -> dict:
        body = user.partition("\n\n")[2]
        counts = Counter(word for word in words(body) if len(word) >= 3)
        ranked = sorted(counts, key=lambda word: (-counts[word], word))
        if not ranked:
            raise ValueError("no words to name the group by")
        return {"nome": " ".join(ranked[:3]), "dor": ", ".join(ranked[:8])}
