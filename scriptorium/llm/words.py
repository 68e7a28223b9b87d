"""Words, the unit of most text operators: runs of characters other than space, tab, \\n, \\v, \\f and \\r."""

from __future__ import annotations

import ctypes

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

JAVA_WORD = r"[^\x20\x09-\x0D]+"
#: A word with the white space before it; such tokens joined give the text without its last white space.
JAVA_TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(JAVA_WORD)), F.lit(0)).cast("long")


def split_words(text: str | None) -> list[bytes]:
    """UTF-8 words; bytes.split() divides at exactly the six white space characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def split_folded(text: str | None) -> list[bytes]:
    """As split_words, with A-Z in lower case and all other characters as they are."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Batch:
    """The words of several texts as arrays: ids into uniques, the texts' first positions and counts."""

    def __init__(self, texts, folded: bool = False):
        split = split_folded if folded else split_words
        lists = [split(t) for t in texts]
        self.counts = np.fromiter((len(w) for w in lists), np.int64, len(lists))
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))[:-1]
        flat = np.empty(int(self.counts.sum()), object)
        at = 0
        for words in lists:
            flat[at : at + len(words)] = words
            at += len(words)
        self.ids, self.uniques = pd.factorize(flat)
        self.doc = np.repeat(np.arange(len(lists)), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words, the same on every machine."""
        if not len(self.uniques):
            return np.empty(0, np.uint64)
        return pd.util.hash_array(np.asarray(self.uniques, object), categorize=False)[self.ids]

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `size` words inside a text, and each run's text. A text with
        fewer words, but some, has one shingle of all its words."""
        h = self.hashes()
        n = len(h)
        length = np.where(self.counts < size, self.counts, self.counts - size + 1).clip(0)
        length = np.where((self.counts > 0) & (self.counts < size), 1, length)
        out = np.zeros(n, np.uint64)
        factor = np.uint64(0x9E3779B97F4A7C15)
        for k in range(size):
            part = np.zeros(n, np.uint64)
            part[: n - k] = h[k:]
            if k:  # past the end of a short text nothing is added, so its hash is that of its own words
                same = np.zeros(n, bool)
                same[: n - k] = self.doc[k:] == self.doc[: n - k]
                part = np.where(same, part, np.uint64(0))
            out = mix64(out * factor + part + np.uint64(k + 1))
        first = np.zeros(n, bool)
        within = np.arange(n) - np.repeat(self.starts, self.counts)
        first = within < np.repeat(length, self.counts)
        return out[first], self.doc[first]


def trim() -> None:
    """Gives memory that a task has freed back to the machine; Python workers outlive tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def groups_of(texts, most_chars: int):
    """Slices of a list of texts with at most so many characters each, or one longer text."""
    yield from slices_of([len(t) if t else 0 for t in texts], most_chars)


def slices_of(sizes, most: int):
    """Slices of a list of sizes (null: 0) with a sum of at most so much each, or one larger size."""
    start = size = 0
    for i, n in enumerate(sizes):
        n = n or 0
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if len(sizes) > start:
        yield start, len(sizes)
