"""Benchmark decontamination by greedy string tiling.

1. The benchmark items' word seeds (runs of `seed` words) are hashed. A bitmap of fixed size
   lets each document drop, where it is read, the seeds that no item has.
2. The seeds left in a document are joined with the items' seeds; salted item rows keep a seed
   that very many documents share from meeting in one task. A seed is no longer than the least
   tile, so every tile holds one; pairs whose shared seeds cannot cover enough of the item, even
   if all of them were in tiles and none overlapped, are dropped.
3. For each document and each item that it shares a seed with, greedy string tiling marks, again
   and again, the longest match of words not yet marked on either side, found by running
   Karp-Rabin: hashes of the search length are rolled over the unmarked words, and the length
   drops while nothing is found. Tiles are independent of their order, so reordered passages
   count. A document is contaminated if the tiles cover the threshold's share of an item.

Words are compared without the case of A-Z and without signs at their ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import drop, keep, stable
from .words import groups_of, mix64, split_folded

ENDS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
GROUP_CHARS = 4_000_000


@dataclass(frozen=True)
class Options:
    """seed: words of a seed, no more than tile; tile: least words of a tile; cover: least share of an item's words
    in tiles; bits: size of the seed bitmap, as a power of two; salts: copies of an item seed."""

    seed: int = 4
    tile: int = 4
    cover: float = 0.5
    bits: int = 23
    salts: int = 16

    def __post_init__(self):
        if self.seed > self.tile:
            raise ValueError("a seed longer than the least tile misses tiles")


def normal(text: str | None) -> list[bytes]:
    """Folded words without signs at their ends; a word of signs alone is dropped."""
    return [x for w in split_folded(text) if (x := w.strip(ENDS))]


def hashes(words: list) -> np.ndarray:
    """64-bit hashes of words, the same on every machine."""
    if not words:
        return np.empty(0, np.uint64)
    ids, uniques = pd.factorize(np.array(words, object))
    return pd.util.hash_array(uniques, categorize=False)[ids]


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of so many words (of the whole text where it is shorter, if not empty)."""
    size = min(size, len(h))
    if not size:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k])
    return out


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (place in doc, place in item, words)."""
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
    out: list[tuple[int, int, int]] = []
    size = len(item)
    while size >= least:
        starts_d, starts_i = _open(free_d, size), _open(free_i, size)
        best = 0
        matches = []
        if len(starts_d) and len(starts_i):
            rolled_d, rolled_i = _rolled(doc, size)[starts_d], _rolled(item, size)[starts_i]
            hit = np.isin(rolled_d, rolled_i)
            if hit.any():
                by = {}
                for p, v in zip(starts_i.tolist(), rolled_i.tolist(), strict=True):
                    by.setdefault(v, []).append(p)
                for p, v in zip(starts_d[hit].tolist(), rolled_d[hit].tolist(), strict=True):
                    for q in by[v]:
                        n = _extend(doc, item, free_d, free_i, p, q)
                        if n >= size:
                            matches.append((n, p, q))
                            best = max(best, n)
        if best > size:  # a longer match turned up: look for that length first
            matches = [m for m in matches if m[0] == best]
        for n, p, q in matches:
            if n == max(best, size) and free_d[p : p + n].all() and free_i[q : q + n].all():
                free_d[p : p + n] = False
                free_i[q : q + n] = False
                out.append((p, q, n))
        if best > size:
            continue
        size = size - 1 if size <= 2 * least else max(2 * least, size // 2)
    return out


def _open(free: np.ndarray, size: int) -> np.ndarray:
    """Places from which so many words on are unmarked."""
    if len(free) < size:
        return np.empty(0, np.int64)
    taken = np.concatenate(([0], np.cumsum(~free)))
    return np.flatnonzero(taken[size:] == taken[:-size])


_BASE = 0x100000001B3


def _rolled(h: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2 to the 64, of all runs of so many words."""
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    power, span, done = h, 1, 0  # power holds the hashes of runs of span words
    while True:
        if size & span:
            out = out * np.uint64(pow(_BASE, span, 1 << 64)) + power[done : done + n]
            done += span
        if done == size:
            return out
        power = power[:-span] * np.uint64(pow(_BASE, span, 1 << 64)) + power[span:]
        span *= 2


def _extend(doc, item, free_d, free_i, p: int, q: int) -> int:
    n = min(len(doc) - p, len(item) - q)
    ok = (doc[p : p + n] == item[q : q + n]) & free_d[p : p + n] & free_i[q : q + n]
    stop = np.flatnonzero(~ok)
    return int(stop[0]) if len(stop) else n


def contaminated(docs: DataFrame, benchmark: DataFrame, o: Options = Options(), key: str = "doc_id", body: str = "text", item: str = "item_id") -> DataFrame:
    """One row for each row of docs and item that its tiles cover to the threshold: key, item,
    coverage, tiles (number) and longest (words), and __row, which names the row of docs.

    Keys and items are integers. Null and empty texts have no words and match nothing; items without words are left out, and
    an item shorter than a seed is its own seed. Repeated rows of docs each get their rows. An
    empty table on either side gives no rows. Other columns are not read.
    """
    return _found(docs.select(docs[key].alias("k"), docs[body].alias("t")), benchmark, o, body, item).withColumnRenamed("k", key)


def clean(docs: DataFrame, benchmark: DataFrame, o: Options = Options(), key: str = "doc_id", body: str = "text", item: str = "item_id") -> DataFrame:
    """The rows of docs, with all their columns, that no item contaminates. As contaminated()."""
    narrow = docs.select(docs[key].alias("k"), docs[body].alias("t"))
    bad = _found(narrow, benchmark, o, body, item).groupBy("k", "digest").agg(F.lit(1).alias("one"))
    bad, _ = keep(bad.select("k", "digest"), "contaminated")
    return docs.join(bad, docs[key].eqNullSafe(bad["k"]) & (F.md5(docs[body]) == bad["digest"]), "left_anti")


def _found(docs: DataFrame, benchmark: DataFrame, o: Options, body: str, item: str) -> DataFrame:
    spark, docs = docs.sparkSession, stable(docs, "decontaminate-input")
    seeds, seeds_at = keep(benchmark.select(benchmark[item].alias("item"), benchmark[body].alias("t")).mapInArrow(_item_seeds(o), "item long, seed long, size int, times int, total int, words binary"), "items")
    bitmap = np.zeros(1 << o.bits, bool)
    set_bits = seeds.filter("seed is not null").select(F.expr(f"seed & {(1 << o.bits) - 1}").alias("b")).distinct()
    # the bitmap's size is fixed, however many seeds there are
    for rows in set_bits.toArrow().to_batches():
        bitmap[rows.column(0).to_numpy()] = True
    shared = spark.sparkContext.broadcast(np.packbits(bitmap, bitorder="little"))
    lengths = sorted(r["size"] for r in seeds.select("size").filter("seed is not null").distinct().collect())  # no more than o.seed
    hits, hits_at = keep(docs.mapInArrow(_doc_seeds(o, shared, lengths), "row long, k long, digest string, words binary, seeds array<long>"), "seed-hits")

    salt = F.pmod("row", F.lit(o.salts)).alias("salt")
    wanted = hits.select("row", salt, F.explode("seeds").alias("seed"))
    salted = seeds.filter("seed is not null").select("item", "seed", (F.col("size") * F.col("times")).alias("most"), "total", F.explode(F.expr(f"sequence(0L, {o.salts - 1}L)")).alias("salt"))
    # an upper bound of the coverage
    bound = wanted.join(salted, ["seed", "salt"]).groupBy("row", "item").agg(F.sum("most").alias("most"), F.min("total").alias("total"))
    pairs = bound.filter(F.col("most") / F.col("total") >= o.cover).select("row", "item")
    pairs, pairs_at = keep(pairs, "seed-pairs")
    items = seeds.filter("words is not null").select("item", F.col("words").alias("item_words"))
    both = pairs.join(hits.select("row", "k", "digest", "words"), "row").join(items, "item")
    tiled = both.select("row", "k", "digest", "item", "words", "item_words").mapInArrow(_tile(o, item), f"k long, digest string, {item} long, coverage double, tiles long, longest long, __row long")
    out, _ = keep(tiled.filter(F.col("coverage") >= o.cover), "contaminations")
    drop(spark, seeds_at, hits_at, pairs_at)
    return out


def _item_seeds(o: Options):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for i, t in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                h = hashes(normal(t))
                if len(h) and i is not None:
                    out.append((i, None, None, None, None, h.astype("<u8").tobytes()))
                    found, times = np.unique(windows(h, o.seed).astype(np.int64), return_counts=True)
                    out += [(i, s, min(o.seed, len(h)), n, len(h), None) for s, n in zip(found.tolist(), times.tolist(), strict=True)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["item", "seed", "size", "times", "total", "words"])

    return run


def _doc_seeds(o: Options, shared, lengths: list[int]):
    """Documents with a seed that the bitmap knows: their word hashes and those seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bitmap, mask = np.unpackbits(shared.value, bitorder="little").view(bool), np.uint64((1 << o.bits) - 1)
        row = TaskContext.get().partitionId() << 32
        for rows in batches:
            keys, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            out = []
            for lo, hi in groups_of(texts, GROUP_CHARS):
                words = [normal(t) for t in texts[lo:hi]]
                counts = np.array([len(w) for w in words])
                flat = hashes([w for d in words for w in d])
                stop = np.cumsum(counts)
                seeds: dict[int, list] = {}
                for size in lengths:
                    if len(flat) < size:
                        continue
                    all_seeds = windows(flat, size)
                    at = np.flatnonzero(bitmap[all_seeds & mask])
                    owner = np.searchsorted(stop, at, "right")
                    inside = at + size <= stop[owner]
                    for d, p in zip(owner[inside].tolist(), at[inside].tolist(), strict=True):
                        seeds.setdefault(d, []).append(all_seeds[p])
                for d, found in seeds.items():
                    h = flat[stop[d] - counts[d] : stop[d]]
                    out.append((row + lo + d, keys[lo + d], hashlib.md5(texts[lo + d].encode("utf-8", "surrogatepass")).hexdigest(), h.astype("<u8").tobytes(), np.unique(np.array(found, np.uint64)).astype(np.int64)))
            row += len(texts)
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["row", "k", "digest", "words", "seeds"])

    return run


def _tile(o: Options, item_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            column = {n: rows.column(k) for k, n in enumerate(rows.schema.names)}
            cover, number, longest = [], [], []
            for d, i in zip(column["words"], column["item_words"], strict=True):
                item = np.frombuffer(i.as_buffer(), "<u8")
                found = tiles(np.frombuffer(d.as_buffer(), "<u8"), item, min(o.tile, len(item)))
                cover.append(sum(n for _, _, n in found) / len(item))
                number.append(len(found))
                longest.append(max((n for _, _, n in found), default=0))
            arrays = [column["k"], column["digest"], column["item"], pa.array(cover, pa.float64()), pa.array(number, pa.int64()), pa.array(longest, pa.int64()), column["row"]]
            yield pa.RecordBatch.from_arrays(arrays, names=["k", "digest", item_name, "coverage", "tiles", "longest", "__row"])

    return run
