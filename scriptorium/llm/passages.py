"""Substring dedup by paragraph MinHash banding.

A passage that several documents share may start and end anywhere in their lines, so paragraphs
are cut by content: in every run of `spread` places the one with the smallest shingle hash is an
anchor, and the `size` words from an anchor on are a paragraph. Documents that share a passage of
`size + spread - 1` words or more have the same anchors in it, and so a paragraph in common.

1. One pass makes the paragraphs' MinHash values (of shingles of five words) and band keys. The
   number of bands is the least with which a pair at the threshold meets with the wanted
   probability. Equal paragraphs of the documents handled together are sent once.
2. Keys meet in one packed exchange. Equal paragraphs are one content; different ones with a band
   in common are candidates, unless all of a key's overlap in one text.
3. Candidates' shingles are read from their documents' texts. All contents of a key are compared
   by exact Jaccard, keys with the same contents once. A few contents are compared pair by pair; more by
   widening components through an index of their shingles, so that contents which links connect
   already are not compared again. Keys with more than HOT contents are dealt into parts of so
   many, and each two parts are widened in one place: a content is sent once for each part, and
   no row is made for a pair of contents.
4. Components of the contents are clusters of passages. A cluster's passages stay in the document
   with the smallest key and are removals in the others; paragraphs that overlap are one span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..tables import drop, keep, settle, stable
from .components import components
from .jaccard_join import GROUP_DOCS, _join, bucket_number
from .words import Batch, groups_of, mix64, trim

SHINGLE = 5
GROUP_CHARS = 3_000_000
#: The most contents of a part of a band key (two parts are compared in one place), and of a key compared pair by pair.
HOT, FEW = 1 << 14, 24


@dataclass(frozen=True)
class Options:
    size: int = 40
    spread: int = 12
    rows: int = 2
    threshold: float = 0.75
    recall: float = 0.95

    @property
    def bands(self) -> int:
        return int(np.ceil(np.log(1 - self.recall) / np.log(1 - self.threshold**self.rows)))


_ROWS = "bucket long, gid long, kind int, a binary, b binary, c binary, d binary, e binary, f binary"
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 6]
#: kind 1: a paragraph of a content that occurs again; 3: a paragraph to be compared; 4: one of those and its key's contents (hash), 5: of a hot key.
_FOUND = "kind int, content long, gid long, place long, met long, did long, key long, hash long, begin long"
_FOUND_NAMES = [c.split()[0] for c in _FOUND.split(", ")]


def _table(rows: list, kinds: list, names: list) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _least(x: np.ndarray, width: int, least=np.minimum) -> np.ndarray:
    """The smallest (or largest) of each run of so many values; shorter by width - 1."""
    span, out = 1, x
    while 2 * span <= width:
        out = least(out[:-span], out[span:]) if len(out) > span else out[:0]
        span *= 2
    rest = width - span
    return least(out[: len(out) - rest], out[rest:]) if rest and len(out) > rest else out[:0] if rest else out


def paragraphs(texts: list, o: Options) -> tuple[Batch, np.ndarray, np.ndarray]:
    """The words of texts, the shingle hash at each word (0 where none starts) and the places of
    the paragraphs' first words."""
    batch = Batch(texts, folded=True)
    n = len(batch.ids)
    values = np.zeros(n, np.uint64)
    within = np.arange(n) - np.repeat(batch.starts, batch.counts)
    left = np.repeat(batch.counts, batch.counts) - within
    whole = left >= SHINGLE
    h = batch.hashes()
    for k in range(SHINGLE):
        at = np.flatnonzero(whole)
        values[at] = mix64(values[at] * np.uint64(0x9E3779B97F4A7C15) + h[at + k] + np.uint64(k + 1))
    if n < o.size:
        return batch, values, np.empty(0, np.int64)
    v = mix64(values ^ np.uint64(0x6A09E667F3BCC908))
    low = _least(v, o.spread)
    inside = left[: len(low)] >= o.spread + SHINGLE - 1  # the run of places lies in one text
    low = np.where(inside, low, np.uint64(0))
    padded = np.concatenate((np.zeros(o.spread - 1, np.uint64), low, np.zeros(o.spread - 1, np.uint64)))
    high = _least(padded, o.spread, np.maximum)[:n]  # the largest minimum of the runs that hold a place
    anchor = (v == high) & (left >= o.size)
    anchor[1:] &= (v[1:] != v[:-1]) | (within[1:] == 0)
    return batch, values, np.flatnonzero(anchor)


def _contents(values: np.ndarray, at: np.ndarray, o: Options) -> np.ndarray:
    """A hash of all the words of each paragraph."""
    out = np.zeros(len(at), np.uint64)
    for k in sorted({*range(0, o.size - SHINGLE + 1, SHINGLE), o.size - SHINGLE}):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + values[at + k])
    return out


def _bands(values: np.ndarray, at: np.ndarray, o: Options) -> list[np.ndarray]:
    width, keys = o.size - SHINGLE + 1, []
    for band in range(o.bands):
        key = np.full(len(at), band + 1, np.uint64)
        for row in range(o.rows):
            seed = mix64(np.array([band * o.rows + row + 1], np.uint64))
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + _least(mix64(values ^ seed), width)[at])
        keys.append(key)
    return keys


def _pack(o: Options, buckets: int):
    """kind 0: a group's documents; 2: its contents that occur in it again; 1: band keys."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        gid = TaskContext.get().partitionId() << 24
        for rows in batches:
            texts = rows.column(2).to_pylist()
            for lo, hi in groups_of(texts, GROUP_CHARS):
                for low in range(lo, hi, GROUP_DOCS):
                    high = min(hi, low + GROUP_DOCS)
                    yield from pack(gid, rows.slice(low, high - low), texts[low:high]).to_batches()
                    gid += 1
            trim()

    def pack(gid: int, rows: pa.RecordBatch, texts: list) -> pa.Table:
        batch, values, at = paragraphs(texts, o)
        null = np.array(rows.column(1).is_null().to_pylist(), "u1")
        keys = rows.column(1).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
        out = [(buckets + gid % buckets, gid, 0, rows.column(0).to_numpy().astype("<i8").tobytes(), keys.tobytes(), null.tobytes(), batch.counts.astype("<i8").tobytes(), b"", b"")]
        if not len(at):
            return _table(out, _TYPES, _NAMES)
        content, where, count = np.unique(_contents(values, at, o), return_index=True, return_counts=True)
        if (count > 1).any():
            every = _contents(values, at, o)
            order = np.argsort(every, kind="stable")
            again = np.repeat(count > 1, count)
            out.append((buckets + gid % buckets, gid, 2, every[order][again].astype("<u8").tobytes(), at[order][again].astype("<u4").tobytes(), b"", b"", b"", b""))
        first = at[where]
        place = first.astype("<u4")
        sent: dict[int, list] = {}
        for band, key in enumerate(_bands(values, first, o)):
            order = np.argsort(key)
            bucket = (key[order] >> shift).astype(np.int64)
            low = (key[order] & np.uint64(0xFFFFFFFF)).astype("<u4")
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cut)).tolist():
                s = slice(cut[b], cut[b + 1])
                some = order[s]
                row = sent.setdefault(b, [b"", b"", b"", b"", b"", b""])
                if band == 0:
                    row[0], row[1], row[2] = low[s].tobytes(), content[some].astype("<u8").tobytes(), place[some].tobytes()
                else:
                    row[3] += low[s].tobytes()
                    row[4] += (content[some] >> np.uint64(32)).astype("<u4").tobytes()
                    row[5] += place[some].tobytes()
        out += [(b, gid, 1, *row) for b, row in sent.items()]
        return _table(out, _TYPES, _NAMES)

    return run


def _meet(o: Options, buckets: int):
    """Contents that other groups hold too, and the contents that meet in a band key. Keys are told
    apart by the contents they hold: two keys with the same ones are one."""
    most = HOT

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= buckets:
            return table
        gid = table.column("gid").to_numpy()
        k0, n0 = _join(table.column("a"), "<u4")
        content, _ = _join(table.column("b"), "<u8")
        p0, _ = _join(table.column("c"), "<u4")
        k1, n1 = _join(table.column("d"), "<u4")
        mark1, _ = _join(table.column("e"), "<u4")
        p1, _ = _join(table.column("f"), "<u4")
        g0, g1 = np.repeat(gid, n0), np.repeat(gid, n1)
        out = []

        _, at, count = np.unique(content, return_inverse=True, return_counts=True)
        again = np.flatnonzero(count[at] > 1)
        again = again[np.argsort(g0[again], kind="stable")]
        for some in np.split(again, np.flatnonzero(np.diff(g0[again])) + 1):
            if len(some):
                out.append((bucket, int(g0[some[0]]), 1, content[some].tobytes(), p0[some].tobytes(), b"", b"", b"", b""))

        met = []
        for key, mark, g, p in ((k0, content >> np.uint64(32), g0, p0), (k1, mark1, g1, p1)):
            order = np.lexsort((p, g, mark, key))
            key, mark, g, p = key[order].astype(np.int64), mark[order], g[order], p[order].astype(np.int64)
            if not len(key):
                continue
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])))
            key, g, p = key[new], g[new], p[new]
            order = np.lexsort((p, g, key))
            key, g, p = key[order], g[order], p[order]
            begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            count = np.diff(np.append(begin, len(key)))
            first, last = np.repeat(begin, count), np.repeat(begin + count - 1, count)
            # paragraphs that overlap in one text are no news
            use = (g[first] != g[last]) | (p - p[first] >= o.size) | (p[last] - p >= o.size)
            key, g, p = key[use], g[use], p[use]
            if not len(key):
                continue
            begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            count = np.diff(np.append(begin, len(key)))
            who = mix64(mix64(g.astype(np.uint64)) ^ p.astype(np.uint64))
            contents = mix64(np.add.reduceat(who, begin)).view(np.int64)
            met.append(np.stack((contents.repeat(count), g, p, (count > most).repeat(count)), axis=1))
        if met:
            met = np.unique(np.concatenate(met), axis=0)
            met = met[np.argsort(met[:, 1], kind="stable")]
            for rows in np.split(met, np.flatnonzero(np.diff(met[:, 1])) + 1):
                if len(rows):
                    out.append((bucket, int(rows[0, 1]), 3, rows[:, 2].astype("<u4").tobytes(), rows[:, 0].astype("<i8").tobytes(), rows[:, 3].astype("u1").tobytes(), b"", b"", b""))
        return _table(out, _TYPES, _NAMES)

    return run


def _gather(table: pa.Table) -> pa.Table:
    """Paragraphs with their documents, for the contents and places that a group was asked for."""
    kind = table.column("kind").to_numpy()
    gid = table.column("gid")[0].as_py()
    part = lambda k: table.filter(pa.array(kind == k))
    docs = part(0)
    raw = lambda c, t: np.frombuffer(docs.column(c)[0].as_py(), t)
    hashes, keys, null, counts = raw("a", "<i8"), raw("b", "<i8"), raw("c", "u1"), raw("d", "<i8")
    stop = np.cumsum(counts)
    local = part(2)
    c2, _ = _join(local.column("a"), "<u8")
    p2, _ = _join(local.column("b"), "<u4")
    c1, _ = _join(part(1).column("a"), "<u8")
    p1, _ = _join(part(1).column("b"), "<u4")
    single = ~np.isin(c1, c2)  # contents with several places here bring all of them
    content, place = np.concatenate((c2, c1[single])).astype(np.int64), np.concatenate((p2, p1[single])).astype(np.int64)
    where, _ = _join(part(3).column("a"), "<u4")
    met, _ = _join(part(3).column("b"), "<i8")
    hot, _ = _join(part(3).column("c"), "u1")
    asked = np.unique(where).astype(np.int64)
    tables = []
    for k, c, p in ((1, content, place), (3, np.zeros(len(asked), np.int64), asked)):
        d = np.searchsorted(stop, p, "right")
        arrays = [pa.array(np.full(len(p), k, np.int32)), pa.array(c), pa.array(np.full(len(p), gid)), pa.array(p), pa.nulls(len(p), pa.int64()), pa.array(gid * GROUP_DOCS + d), pa.array(keys[d].astype(np.int64), mask=null[d].astype(bool)), pa.array(hashes[d].astype(np.int64)), pa.array(p - (stop - counts)[d])]
        tables.append(pa.Table.from_arrays(arrays, names=_FOUND_NAMES))
    none = pa.nulls(len(where), pa.int64())
    tables.append(pa.Table.from_arrays([pa.array(4 + hot.astype(np.int32)), none, pa.array(np.full(len(where), gid)), pa.array(where.astype(np.int64)), pa.array(met.astype(np.int64)), none, none, none, none], names=_FOUND_NAMES))
    return pa.concat_tables(tables)


def _shingles(o: Options):
    """The content hash and the distinct shingles (32 bits of each) of the paragraphs asked for in each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, asked = rows.column(1).to_pylist(), rows.column(0).to_pylist()
            for lo, hi in groups_of(texts, GROUP_CHARS):
                out = []
                batch, values, _ = paragraphs(texts[lo:hi], o)
                short = (values >> np.uint64(32)).astype("<u4")
                for i, some in enumerate(asked[lo:hi]):
                    at = np.array([x["begin"] for x in some], np.int64) + batch.starts[i]
                    for x, p, c in zip(some, at.tolist(), _contents(values, at, o).astype(np.int64).tolist(), strict=True):
                        out.append((x["gid"], x["place"], c, np.unique(short[p : p + o.size - SHINGLE + 1]).tobytes()))
                yield from _table(out, [pa.int64(), pa.int64(), pa.int64(), pa.binary()], ["gid", "place", "content", "s"]).to_batches()
            trim()

    return run


def _parts(hot: DataFrame, most: int) -> DataFrame:
    """Rows (met, gid, place) of keys with more than `most`, dealt into parts of about so many: for
    each two parts (a part with itself included) a key of its own, so all rows of a key meet."""
    parts = hot.groupBy("met").agg(F.expr(f"(count(*) + {most - 1}) div {most}").alias("parts"))
    dealt = hot.join(parts, "met").withColumn("own", F.pmod(F.xxhash64("gid", "place"), F.col("parts")))
    dealt = dealt.select("met", "gid", "place", "own", F.explode(F.expr("sequence(0L, parts - 1)")).alias("other"))
    return dealt.select(F.xxhash64("met", F.least("own", "other"), F.greatest("own", "other")).alias("met"), "gid", "place")


def _near(o: Options):
    """Links that connect, in each key, all contents that pairs at the threshold connect."""
    width = o.size - SHINGLE + 1

    def run(table: pa.Table) -> pa.Table:
        met, content, gid, place = (table.column(c).to_numpy() for c in ("met", "content", "gid", "place"))
        order = np.lexsort((place, gid, met))
        met, content, gid, place = met[order], content[order], gid[order], place[order]
        values, n = _join(table.column("s"), "<u4")
        start = (np.cumsum(n) - n)[order]
        n = n[order]
        begin = np.flatnonzero(np.concatenate(([True], met[1:] != met[:-1])))
        count = np.diff(np.append(begin, len(met)))
        edges = [np.empty((0, 2), np.int64)]
        for k in np.unique(count[(count > 1) & (count <= FEW)]).tolist():
            of = begin[count == k]
            for lo in range(0, len(of), step := max(1, 16000 // (k * k))):
                rows = of[lo : lo + step, None] + np.arange(k)
                label = _pairwise(rows, o, width, values, start, n, gid, place)
                g, other = np.nonzero(label != np.arange(k))
                edges.append(np.stack((content[rows[g, label[g, other]]], content[rows[g, other]]), axis=1))
        for lo, k in zip(begin[count > FEW].tolist(), count[count > FEW].tolist(), strict=True):
            label = _widen(np.arange(lo, lo + k), o, values, start, n, gid, place)
            other = np.flatnonzero(label != np.arange(k))
            edges.append(np.stack((content[lo + label[other]], content[lo + other]), axis=1))
        found = np.unique(np.concatenate(edges), axis=0)
        return pa.Table.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return run


def _pairwise(rows: np.ndarray, o: Options, width: int, values, start, n, gid, place) -> np.ndarray:
    """For several keys with k contents each, the least place in the key that links reach from each."""
    groups, k = rows.shape
    at = start[rows][:, :, None] + np.arange(width)
    inside = np.arange(width) < n[rows][:, :, None]
    sets = values[np.where(inside, at, 0)].astype(np.int64)
    left, right = np.where(inside, sets, -1), np.where(inside, sets, -2)
    inter = (left[:, :, None, :, None] == right[:, None, :, None, :]).sum(axis=(3, 4))
    size = n[rows]
    linked = inter >= o.threshold * (size[:, :, None] + size[:, None, :] - inter)
    linked &= (gid[rows][:, :, None] != gid[rows][:, None, :]) | (np.abs(place[rows][:, :, None] - place[rows][:, None, :]) >= o.size)
    linked |= np.eye(k, dtype=bool)
    label = np.broadcast_to(np.arange(k), (groups, k))
    while True:
        least = np.where(linked, label[:, None, :], k).min(axis=2)
        if (least == label).all():
            return label
        label = least


def _widen(rows: np.ndarray, o: Options, values, start, n, gid, place) -> np.ndarray:
    """The same for one key with many contents: a component grows from each content that has none
    by those, of the contents without one, that link with a content of it. Contents that share a
    shingle are found in an index of the shingles."""
    k = len(rows)
    size, gid, place = n[rows], gid[rows], place[rows]
    offset = np.concatenate(([0], np.cumsum(size)))
    flat = values[np.repeat(start[rows] - offset[:-1], size) + np.arange(offset[-1])]
    distinct, token = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(k), size)
    order = np.argsort(token, kind="stable")
    by_token, by_owner = token[order], owner[order]
    label = np.full(k, -1)

    def index() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The contents without a component, and for each token which of them hold it."""
        alive = np.flatnonzero(label < 0)
        use = label[by_owner] < 0
        first = np.concatenate(([0], np.cumsum(np.bincount(by_token[use], minlength=len(distinct)))))
        return alive, np.searchsorted(alive, by_owner[use]), first

    (alive, holders, first), open_ = index(), k
    for seed in range(k):
        if label[seed] >= 0:
            continue
        label[seed], open_ = seed, open_ - 1
        border = [seed]
        while border and open_:
            if 2 * open_ <= len(alive):  # most of what the index holds is done
                alive, holders, first = index()
            x = border.pop()
            held = token[offset[x] : offset[x + 1]]
            near = np.concatenate([holders[a:b] for a, b in zip(first[held].tolist(), first[held + 1].tolist(), strict=True)])
            inter = np.bincount(near, minlength=len(alive))
            some = np.flatnonzero(inter)
            other, inter = alive[some], inter[some]
            linked = (label[other] < 0) & (inter >= o.threshold * (size[other] + size[x] - inter)) & ((gid[other] != gid[x]) | (np.abs(place[other] - place[x]) >= o.size))
            new = other[linked]
            label[new] = seed
            open_ -= len(new)
            border += new.tolist()
    return label


def repeated(docs: DataFrame, o: Options = Options(), key: str = "doc_id", body: str = "text") -> DataFrame:
    """One row per span of a document whose passages occur in other documents: key, begin and end
    (words of the text, end exclusive), cluster (the smallest of the span's clusters), removed
    (another document keeps the passage) and __doc, which names the row of docs.

    Keys are integers. Null texts and texts with fewer words than a paragraph have no spans; passages that only one
    document repeats are none either. Rows with equal keys are documents of their own; among
    equal keys the first read keeps a passage, and a null key never keeps what others hold. An
    empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    narrow = stable(docs.select(F.xxhash64(docs[key], docs[body]).alias("h"), docs[key].cast("long").alias("k"), docs[body].alias("t")), "passages-input")
    buckets = bucket_number(narrow.count())
    met = narrow.mapInArrow(_pack(o, buckets), _ROWS).groupBy("bucket").applyInArrow(_meet(o, buckets), _ROWS)
    found, found_at = keep(met.groupBy("gid").applyInArrow(_gather, _FOUND), "paragraphs")
    del met
    settle(spark)  # the packed exchange is the largest

    asked = found.filter("kind = 3").select("gid", "place", "hash", "begin", "did", "key")
    wanted = asked.groupBy("hash").agg(F.collect_list(F.struct("gid", "place", "begin")).alias("asked"))
    # equal rows of docs give equal shingles, which does no harm
    shingles = wanted.join(narrow.select("h", "t"), F.col("hash") == F.col("h")).select("asked", "t").mapInArrow(_shingles(o), "gid long, place long, content long, s binary")
    shingles, shingles_at = keep(shingles, "shingles")
    settle(spark)

    which = ["gid", "place"]
    met = lambda kind: found.filter(f"kind = {kind}").select("met", *which).distinct()
    compared = met(4).union(_parts(met(5), HOT)).join(shingles, which).select(F.pmod("met", F.lit(buckets)).alias("bucket"), "met", "content", *which, "s")
    edges, edges_at = keep(compared.groupBy("bucket").applyInArrow(_near(o), "a long, b long").filter("a <> b").distinct(), "edges")
    labels = components(edges)

    # every paragraph of a content that occurs again or belongs to a component
    single = asked.join(shingles.select(*which, "content"), which).join(labels.select(F.col("v").alias("content")), "content", "left_semi")
    member = found.filter("kind = 1").select("content", "did", "key", "begin").union(single.select("content", "did", "key", "begin")).distinct()
    member, member_at = keep(member, "member")
    named = member.join(labels.withColumnRenamed("v", "content"), "content", "left").select("did", "key", "begin", F.coalesce("label", "content").alias("cluster"))
    named, named_at = keep(named, "named")
    holders = named.groupBy("cluster", "did").agg(F.first("key").alias("key"))
    cluster = holders.groupBy("cluster").agg(F.count("*").alias("docs"), F.min(F.struct(F.col("key").isNull(), "key", "did")).alias("first")).filter("docs > 1")
    cluster, cluster_at = keep(cluster.select("cluster", F.col("first")["did"].alias("keeper")), "clusters")
    placed = named.join(cluster, "cluster").withColumn("removed", F.col("did") != F.col("keeper"))
    placed = placed.groupBy("did", "key", "begin", "removed").agg(F.min("cluster").alias("cluster"))
    order = Window.partitionBy("did").orderBy("begin", "removed")
    fresh = (F.col("begin") > F.lag("begin").over(order) + o.size) | (F.col("removed") != F.lag("removed").over(order))
    placed = placed.withColumn("span", F.sum(F.coalesce(fresh.cast("int"), F.lit(1))).over(order))
    out = placed.groupBy("did", "key", "span").agg(F.min("begin").alias("begin"), (F.max("begin") + o.size).alias("end"), F.min("cluster").alias("cluster"), F.first("removed").alias("removed"))
    out, _ = keep(out.select(F.col("key").alias(key), "begin", "end", "cluster", "removed", F.col("did").alias("__doc")), "spans")
    drop(spark, found_at, shingles_at, edges_at, member_at, named_at, cluster_at)
    return out
