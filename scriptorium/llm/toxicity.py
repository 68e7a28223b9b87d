"""Toxicity by multiple-instance learning: labels belong to documents, scores to sentences.

A sentence's probability is a logistic function of its words' weights, where a word has hashed
features for itself and for its first three, four and five letters. A document is toxic if any
sentence is: its probability is the noisy-or 1 - product(1 - p). Training maximises the document
labels' likelihood on a bounded sample (an expected `per_class` documents of each label, with at
most `chars` characters together, so that what comes to the driver has a bound in bytes); the
gradient reaches sentences through the noisy-or, so they are located without labels of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import add_columns
from .langid import NOT_LETTERS
from .sharding import shuffle_hash
from .words import Batch, groups_of

BATCH_CHARS = 4_000_000
PREFIXES = (3, 4, 5)
#: A sentence ends at the end of a line, after these signs, or after so many words.
STOPS, LONGEST = (b".", b"!", b"?"), 64


@dataclass(frozen=True)
class Options:
    buckets: int = 1 << 18
    per_class: int = 3000
    chars: int = 12_000_000
    rounds: int = 300
    rate: float = 0.2
    l1: float = 3e-4
    start: float = -7.0


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    options: Options


def features(words: np.ndarray, o: Options) -> np.ndarray:
    """(word, feature) buckets; words without letters have the last bucket, whose weight stays 0."""
    texts = [NOT_LETTERS.sub("", w.decode("utf-8", "replace").lower()) for w in words]
    out = np.full((len(texts), len(PREFIXES) + 1), o.buckets, np.int64)
    full = np.array([bool(t) for t in texts], bool)
    for k, n in enumerate((None, *PREFIXES)):
        part = np.array([f"{k}{t[:n]}" for t in texts], object)
        if len(part):
            out[:, k] = np.where(full, pd.util.hash_array(part, categorize=False) % np.uint64(o.buckets), o.buckets).astype(np.int64)
    return out


def sentences(texts: list[str | None], batch: Batch) -> np.ndarray:
    """The number of each word's sentence, counted through all texts."""
    n = len(batch.ids)
    last = np.zeros(n + 1, bool)
    stop = np.array([w.endswith(STOPS) for w in batch.uniques], bool)
    if n:
        last[1:] = stop[batch.ids]
    last[batch.starts] = True
    at = 0
    for t, words in zip(texts, batch.counts.tolist(), strict=True):
        if t and "\n" in t:
            lines = np.cumsum([len(x.split()) for x in t.encode("utf-8", "surrogatepass").split(b"\n")])
            last[at + lines[:-1]] = True
        at += words
    last[at:] = False
    run = np.arange(n) - np.maximum.accumulate(np.where(last[:n], np.arange(n), 0))
    last[:n] |= (run % LONGEST == 0) & (run > 0)
    return np.cumsum(last[:n]) - 1 if n else np.empty(0, np.int64)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, o: Options = Options(), body: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """Fits on the documents whose key satisfies learn (an expression over the key of labels)
    and has a label that isn't null; a key with several labels counts as toxic if one says so."""
    known = labels.filter(learn & labels[label].isNotNull() & labels[key].isNotNull()).groupBy(labels[key].alias("k")).agg((F.max(label) > 0).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    none = Model(np.zeros(o.buckets + 1, np.float32), o.start, o)
    if len(counts) < 2:
        return none
    rate = F.create_map(*[F.lit(v) for c in sorted(counts) for v in (c, min(1.0, o.per_class / counts[c]) * 2**32)])
    # the sample's size is bounded by the parameter, so it may be sent to every task
    sample = F.broadcast(known.filter(shuffle_hash(F.col("k"), 9) < rate[F.col("y")]))
    texts = docs.select(docs[key].alias("k"), docs[body].alias("t")).filter("t is not null").withColumn("h", F.xxhash64("t"))
    drawn = texts.join(sample, "k").select("k", "y", "h", F.length("t").alias("chars")).toPandas().sort_values(["k", "h"], ignore_index=True)
    use = np.zeros(len(drawn), bool)
    for label_rows in drawn.groupby("y").groups.values():
        room = o.chars
        for i in label_rows:
            if drawn.chars[i] <= room:
                use[i], room = True, room - drawn.chars[i]
    if drawn.y[use].nunique() < 2:
        return none
    spark = docs.sparkSession
    chosen = F.broadcast(spark.createDataFrame(drawn[["k", "h", "y"]][use].drop_duplicates()))
    rows = texts.join(chosen, ["k", "h"]).select("k", "h", "y", "t").toPandas()
    rows = rows.sort_values(["k", "h"], ignore_index=True)
    if rows.y.nunique() < 2:
        return none

    texts = rows.t.tolist()
    batch = Batch(texts)
    of = sentences(texts, batch)
    count = int(of[-1]) + 1
    doc = np.zeros(count, np.int64)
    doc[of] = batch.doc
    feat, y = features(batch.uniques, o), rows.y.to_numpy().astype(bool)
    w, b, squares, square_b = np.zeros(o.buckets + 1), o.start, np.zeros(o.buckets + 1), 0.0
    for _ in range(o.rounds):
        z = np.bincount(of, w[feat].sum(axis=1)[batch.ids], count) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none_of = np.exp(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)))
        slope = np.where(y[doc], -p * (none_of / np.maximum(1 - none_of, 1e-9))[doc], p) / len(y)
        by_word = np.bincount(batch.ids, slope[of], len(feat))
        g = np.bincount(feat.ravel(), np.repeat(by_word, feat.shape[1]), o.buckets + 1)
        squares += g * g
        square_b += slope.sum() ** 2
        step = o.rate / np.sqrt(squares + 1e-12)
        w -= step * g
        w = np.sign(w) * np.maximum(0, np.abs(w) - step * o.l1)
        w[o.buckets] = 0
        b -= 0.1 * o.rate * slope.sum() / np.sqrt(square_b + 1e-12)
    return Model(w.astype(np.float32), float(b), o)


def score(docs: DataFrame, model: Model, body: str = "text") -> DataFrame:
    """docs with score, predicted (1 if score >= 0.5, else 0) and offending: the sentences with a
    probability of at least 0.5, or else the likeliest one, as word ranges (end exclusive).

    Null and empty texts have score 0 and no sentences. Rows are judged one by one, from the
    whole text alone; an empty table stays empty. Columns of docs with these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ddl = "score double, predicted int, offending array<struct<begin: long, end: long, p: double>>"

    def start():
        m = shared.value
        w = m.weights.astype(np.float64)

        def make(column: pa.Array) -> dict:
            texts = column.to_pylist()
            total, found = np.zeros(len(texts)), [[] for _ in texts]
            for lo, hi in groups_of(texts, BATCH_CHARS):
                batch = Batch(texts[lo:hi])
                if not len(batch.ids):
                    continue
                of = sentences(texts[lo:hi], batch)
                count = int(of[-1]) + 1
                first = np.flatnonzero(np.diff(of, prepend=-1))
                doc, stop = batch.doc[first], np.append(first[1:], len(of))
                z = np.bincount(of, w[features(batch.uniques, m.options)].sum(axis=1)[batch.ids], count) + m.bias
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                total[lo:hi] = 1 - np.exp(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), hi - lo))
                best = np.zeros(hi - lo)
                np.maximum.at(best, doc, p)
                seen = set()
                for s in np.flatnonzero((p >= 0.5) | (p == best[doc])).tolist():
                    d = int(doc[s])
                    if p[s] >= 0.5 or d not in seen:
                        seen.add(d)
                        a = int(batch.starts[d])
                        found[lo + d].append({"begin": int(first[s]) - a, "end": int(stop[s]) - a, "p": float(p[s])})
            return {"score": total, "predicted": (total >= 0.5).astype(np.int32), "offending": found}

        return make

    return add_columns(docs, [body], ddl, start)
