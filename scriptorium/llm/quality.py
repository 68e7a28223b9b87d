"""Quality rules on repetition inside a text, by suffix array.

The suffixes of a text's words are sorted by prefix doubling; the longest-common-prefix (LCP) of
neighbours follows from the ranks kept at each doubling. The LCP intervals are the maximal
repeated substrings: the deepest interval that holds a suffix has the larger of the suffix's two
neighbouring LCP values as its length. The spans of all intervals of a least length are united;
the covered share of the words and the longest repeat are limited.

Texts are independent, so there is no shuffle: several texts are sorted together as arrays, each
text in its own range of ranks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import add_columns
from .words import Batch, groups_of

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\v\f\r"


@dataclass(frozen=True)
class Limits:
    """window: least words of a repeat that counts; covered: most share of words in repeats;
    longest: most words of one repeat; base_words and base_repeat: the base rules' least words
    and most percent of words in repeated windows."""

    window: int = 16
    covered: float = 0.2
    longest: int = 48
    base_words: int = 20
    base_repeat: int = 30


def repeats(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each word of texts laid end to end, the most words that, from it on, occur twice or
    more in the same text (occurrences may overlap)."""
    n = len(ids)
    best = np.zeros(n, np.int64)
    if not n:
        return best
    doc = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(np.cumsum(counts), counts)
    _, rank = np.unique(doc.astype(np.int64) * (int(ids.max()) + 1) + ids, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    rank, tied, order = _regroup(rank[order], order, np.arange(n))
    small = np.int32 if n < 1 << 31 else np.int64  # one array for each doubling is kept
    levels = [rank.astype(small)]
    width = 1
    full = order
    while len(tied):
        at = full[tied]
        after = at + width
        inside = after < end[at]
        second = np.where(inside, levels[-1][np.minimum(after, n - 1)], -1).astype(np.int64)
        key = levels[-1][at].astype(np.int64) * (n + 1) + second + 1
        sort = np.argsort(key, kind="stable")
        key, at = key[sort], at[sort]
        full[tied] = at
        new = levels[-1].copy()
        first = np.concatenate(([True], key[1:] != key[:-1]))
        new[at] = tied[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        same = ~first
        keep = same | np.concatenate((same[1:], [False]))
        levels.append(new)
        tied = tied[keep]
        width *= 2
    # LCP of neighbours in suffix order: the highest power of two by which both still agree, again and again
    a, b = full[:-1].copy(), full[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        step = 1 << level
        ok = (a < n) & (b < n)
        equal = np.zeros(n - 1, bool)
        equal[ok] = levels[level][a[ok]] == levels[level][b[ok]]
        equal &= (lcp == 0) | _inside(a, b, end, n)
        lcp[equal] += step
        a[equal] += step
        b[equal] += step
    best[full[1:]] = lcp
    np.maximum.at(best, full[:-1], lcp)
    return best


def _inside(a, b, end, n):
    """Both places still lie in the text in which their suffixes began."""
    ok = (a < n) & (b < n)
    out = np.zeros(len(a), bool)
    out[ok] = end[a[ok]] == end[b[ok]]
    return out


def _regroup(sorted_rank, order, places):
    """Ranks as the first place of each group of equals, and the places of groups of two or more."""
    first = np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))
    start = np.maximum.accumulate(np.where(first, places, 0))
    rank = np.empty(len(order), np.int64)
    rank[order] = start
    same = ~first
    return rank, places[same | np.concatenate((same[1:], [False]))], order


def united(best: np.ndarray, window: int) -> np.ndarray:
    """Marks the words in the union of all repeats of `window` words or more."""
    n = len(best)
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(best >= window)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + best[at], -1)
    return np.cumsum(edge[:-1]) > 0


def _lines(text: str) -> int:
    seen, again = set(), 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(" \t\v\f\r"):
            seen.add(line)
    return again


def measure(docs: DataFrame, limits: Limits = Limits(), body: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    covered_words, longest_repeat, repeat_spans (united spans as word ranges, end exclusive) and kept.

    Null and empty texts have no words: all counts are 0, base_failed is true and kept false. Rows
    are judged one by one, so repeated rows and ties don't matter; an empty table stays empty.
    Columns of docs with the names of new ones are replaced.
    """
    ddl = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, covered_words long, longest_repeat long, repeat_spans array<struct<begin: long, end: long>>, kept boolean"
    return add_columns(docs, [body], ddl, lambda: lambda texts: _measure(texts, limits))


def _measure(column: pa.Array, limits: Limits) -> dict:
    texts = column.to_pylist()
    out = {k: np.zeros(len(texts), np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")}
    spans: list = [[] for _ in texts]
    for lo, hi in groups_of(texts, 1_000_000):
        batch = Batch(texts[lo:hi])
        best = repeats(batch.ids, batch.counts)
        base = united(best, 8)
        marked = base if limits.window == 8 else united(best, limits.window)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
        out["n_words"][lo:hi] = batch.counts
        if len(batch.doc):
            out["n_repeat_words"][lo:hi] = np.bincount(batch.doc, base, hi - lo)
            out["covered_words"][lo:hi] = np.bincount(batch.doc, marked, hi - lo)
            longest = np.zeros(hi - lo, np.int64)
            np.maximum.at(longest, batch.doc, best)
            out["longest_repeat"][lo:hi] = longest
            cut = np.union1d(edge, batch.starts[(batch.starts > 0) & (batch.counts > 0)])  # a span ends with its text
            cut = cut[cut < len(marked)]
            stop = np.append(cut[1:], len(marked))[: len(cut)]
            for s, e in zip(cut.tolist(), stop.tolist(), strict=True):
                if marked[s]:
                    d = int(batch.doc[s])
                    spans[lo + d].append({"begin": s - int(batch.starts[d]), "end": e - int(batch.starts[d])})
    for i, t in enumerate(texts):
        if t:
            raw = t.encode("utf-8", "surrogatepass")
            out["word_chars"][i] = len(t) - (len(raw) - len(raw.translate(None, WHITE)))
            out["n_symbols"][i] = len(raw) - len(raw.translate(None, SYMBOLS))
            out["n_dup_lines"][i] = _lines(t)
    failed = (out["n_words"] < limits.base_words) | (100 * out["n_repeat_words"] > limits.base_repeat * out["n_words"])
    ok = (out["covered_words"] <= limits.covered * out["n_words"]) & (out["longest_repeat"] <= limits.longest)
    return out | {"base_failed": failed, "kept": ~failed & ok, "repeat_spans": spans}
