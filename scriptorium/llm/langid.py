"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of one to four letters inside words (lower case, letters alone, word
ends marked). A document's value for an n-gram is its count times the n-gram's inverse document
frequency, divided by the document's sum of those. Document frequencies cover every learning
document; the regression is fitted by follow-the-regularised-leader with elastic-net penalties
on a bounded sample (an expected `per_class` documents of each language), and a temperature is
fitted on a part of the sample that the regression doesn't see. The sample's n-grams are counted
where the texts are; only counts, at most one for each bucket and document, come to the driver.
The model has a weight for each bucket and language, 256 KB a language.

A document's scores are sums over its words, so they are computed once for each distinct word
of a batch of texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import add_columns
from .sharding import shuffle_hash
from .words import Batch, groups_of, mix64

LETTER = re.compile(r"[^\W\d_]")
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Characters of texts handled together.
BATCH_CHARS, FIT_CHARS = 4_000_000, 400_000


@dataclass(frozen=True)
class Options:
    orders: tuple[int, ...] = (1, 2, 3, 4)
    buckets: int = 1 << 16
    per_class: int = 1500
    calibrate: float = 0.2
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    scale: float = 100.0
    unknown: str = "und"


def ngrams(words: np.ndarray, o: Options) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of distinct UTF-8 words, and the word of each."""
    texts = ["\x02" + w + "\x03" if (w := NOT_LETTERS.sub("", x.decode("utf-8", "replace").lower())) else "" for x in words]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    n, value = len(codes), np.zeros(len(codes), np.uint64)
    buckets, owners = [], []
    for k in range(max(o.orders)):
        if k >= n:
            break
        value = (value[: n - k] if k else value) * np.uint64(0x100000001B3) + codes[k:] + np.uint64(1)
        if k + 1 in o.orders:
            ok = owner[: n - k] == owner[k:]
            buckets.append((mix64(value[ok] + np.uint64(k)) % np.uint64(o.buckets)).astype(np.int64))
            owners.append(owner[: n - k][ok])
    if not buckets:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def _pairs(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, word) pairs and their counts."""
    u = max(1, len(batch.uniques))
    key, count = np.unique(batch.doc * u + batch.ids, return_counts=True)
    return key // u, key % u, count


def _expand(words: np.ndarray, grams: np.ndarray, owners: np.ndarray, n: int):
    """For each entry of words, the n-grams of that word: entry numbers and buckets."""
    order = np.argsort(owners, kind="stable")
    grams, per = grams[order], np.bincount(owners, minlength=n)
    start = np.concatenate(([0], np.cumsum(per)))[:-1]
    many = per[words]
    entry = np.repeat(np.arange(len(words)), many)
    offset = np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many)
    return entry, grams[np.repeat(start[words], many) + offset]


def document_frequencies(docs: DataFrame, o: Options, body: str) -> tuple[np.ndarray, int]:
    """How many documents hold an n-gram of each bucket, and how many documents there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = np.zeros(o.buckets, np.int64), 0
        for rows in batches:
            texts = rows.column(0).to_pylist()
            total += len(texts)
            for lo, hi in groups_of(texts, BATCH_CHARS):
                batch = Batch(texts[lo:hi])
                doc, word, _ = _pairs(batch)
                grams, owners = ngrams(batch.uniques, o)
                for a in range(0, hi - lo, 256):  # a block of texts at a time, as a table of marks
                    s, e = np.searchsorted(doc, (a, a + 256))
                    entry, bucket = _expand(word[s:e], grams, owners, len(batch.uniques))
                    mark = np.zeros((256, o.buckets), bool)
                    mark[doc[s:e][entry] - a, bucket] = True
                    df += np.count_nonzero(mark, axis=0)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], total))], names=["bucket", "n"])

    rows = docs.select(body).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(o.buckets, np.int64)
    known = rows[rows.bucket >= 0]
    df[known.bucket.to_numpy()] = known.n
    return df, int(rows.n[rows.bucket < 0].sum())


def ftrl(xs: list, ys: np.ndarray, classes: int, o: Options) -> np.ndarray:
    """Weights (bucket, class); the last row is the intercept."""
    z, n = np.zeros((o.buckets + 1, classes)), np.zeros((o.buckets + 1, classes))

    def weights(at):
        zz = z[at]
        w = -(zz - np.sign(zz) * o.l1) / ((o.beta + np.sqrt(n[at])) / o.alpha + o.l2)
        return np.where(np.abs(zz) <= o.l1, 0.0, w)

    for epoch in range(o.epochs):
        for i in np.random.default_rng(epoch).permutation(len(xs)):
            at, value = xs[i]
            w = weights(at)
            p = _softmax(value @ w)
            p[ys[i]] -= 1
            g = value[:, None] * p
            before = n[at]
            after = before + g * g
            z[at] += g - (np.sqrt(after) - np.sqrt(before)) / o.alpha * w
            n[at] = after
    return weights(np.arange(o.buckets + 1))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    classes: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float
    options: Options


def _counts(o: Options):
    """Key, label and the n-gram counts of each text, as packed buckets and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column(2).to_pylist()
            for lo, hi in groups_of(texts, FIT_CHARS):
                batch = Batch(texts[lo:hi])
                doc, word, count = _pairs(batch)
                grams, owners = ngrams(batch.uniques, o)
                entry, bucket = _expand(word, grams, owners, len(batch.uniques))
                pair, at = np.unique(doc[entry] * o.buckets + bucket, return_inverse=True)
                tf = np.bincount(at, count[entry], len(pair)).astype("<u4")
                cut = np.searchsorted(pair // o.buckets, np.arange(hi - lo + 1)).tolist()
                bucket = (pair % o.buckets).astype("<u4")
                packed = [pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in (bucket, tf)]
                yield pa.RecordBatch.from_arrays([*[rows.column(c).slice(lo, hi - lo) for c in (0, 1, 3)], *packed], names=["k", "y", "h", "bucket", "tf"])

    return run


def fit(docs: DataFrame, learn: Column, o: Options = Options(), body: str = "text", label: str = "lang", key: str = "doc_id") -> Model:
    """Fits on the rows of docs where learn holds and the label isn't null."""
    known = docs.filter(learn & docs[label].isNotNull()).select(docs[key].cast("string").alias("k"), docs[label].cast("string").alias("y"), docs[body].alias("t"), F.xxhash64(docs[body]).alias("h"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    classes = sorted(counts)
    if not classes:
        return Model([], np.zeros((o.buckets + 1, 0)), np.zeros(o.buckets), 1.0, o)
    df, total = document_frequencies(known, o, "t")
    idf = np.log((1 + total) / (1 + df)) + 1
    rate = F.create_map(*[F.lit(v) for c in classes for v in (c, min(1.0, o.per_class / counts[c]) * 2**32)])
    sample = known.filter(shuffle_hash(F.col("k"), 8, F.col("h")) < rate[F.col("y")])
    rows = sample.mapInArrow(_counts(o), "k string, y string, h long, bucket binary, tf binary").toPandas().sort_values(["k", "h"], ignore_index=True)

    xs: list = []
    for b, t in zip(rows.bucket, rows.tf, strict=True):
        bucket = np.frombuffer(b, "<u4").astype(np.int32)
        value = np.frombuffer(t, "<u4") * idf[bucket]
        value *= o.scale / value.sum() if len(value) else 1
        xs.append((np.append(bucket, np.int32(o.buckets)), np.append(value, 1.0).astype(np.float32)))
    ys = np.array([classes.index(y) for y in rows.y], np.int64)
    aside = np.random.default_rng(0).random(len(xs)) < o.calibrate
    use = np.flatnonzero(~aside) if (~aside).any() else np.arange(len(xs))
    w = ftrl([xs[i] for i in use], ys[use], len(classes), o)
    held = np.flatnonzero(aside)
    temperature = 1.0
    if len(held):
        logits = np.array([xs[i][1] @ w[xs[i][0]] for i in held])
        loss = lambda t: -np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), ys[held]], 1e-12)).mean()
        temperature = float(min(np.geomspace(0.2, 20, 93), key=loss))
    return Model(classes, w.astype(np.float32), idf, temperature, o)


def predict(docs: DataFrame, model: Model, body: str = "text") -> DataFrame:
    """docs with lang_pred and score (the calibrated probability of lang_pred).

    Null and empty texts, texts without a letter (digits or signs only) and models without classes
    give `und` and 0; of languages equally likely the first by name is taken. Rows are judged one by one, from the whole text alone; an empty table stays empty. Columns of docs
    with these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m = shared.value
        o = m.options
        table = np.concatenate((m.weights[:-1] * m.idf[:, None], m.idf[:, None]), axis=1) if m.classes else None

        def make(column: pa.Array) -> dict:
            texts = column.to_pylist()
            pred, score = [o.unknown] * len(texts), np.zeros(len(texts))
            if table is None:
                return {"lang_pred": pred, "score": score}
            for lo, hi in groups_of(texts, BATCH_CHARS):
                batch = Batch(texts[lo:hi])
                grams, owners = ngrams(batch.uniques, o)
                word = np.zeros((max(1, len(batch.uniques)), table.shape[1]))
                for c in range(table.shape[1]):
                    word[:, c] = np.bincount(owners, table[grams, c], len(word))
                sums = np.stack([np.bincount(batch.doc, word[batch.ids, c], hi - lo) for c in range(table.shape[1])], axis=1)
                logits = sums[:, :-1] * (o.scale / np.maximum(sums[:, -1:], 1e-9)) + m.weights[-1]
                p = _softmax(logits / m.temperature)
                best = p.argmax(axis=1)
                for i in range(hi - lo):
                    if texts[lo + i] and any(m.group().isalpha() for m in LETTER.finditer(texts[lo + i])):
                        pred[lo + i], score[lo + i] = m.classes[best[i]], p[i, best[i]]
            return {"lang_pred": pred, "score": score}

        return make

    return add_columns(docs, [body], "lang_pred string, score double", start)
