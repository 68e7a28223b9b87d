"""Exact Jaccard join on word shingles through a token-group matrix.

1. One pass over the texts makes each document's set of shingle hashes. The hashes go, packed
   by the bucket of their first bits, to one exchange, where the number of documents that hold
   each is counted; only shared ones (held by two documents or more) come back. A document with
   fewer shared shingles than the least overlap that a link needs has no link and is done.
2. Documents with equal sets are one class. For the classes that are left, shingles are counted
   once more, as copies don't count now. Among those that are still left, documents with
   equal MinHash values are compared with the first of them; those that link form a group with it.
3. The token-group matrix has a row for each group and each token of the group's union of
   members' prefixes: the rarest shared tokens, as many as a linked partner cannot all miss (of
   these, the indexed ones are those that no larger partner can all miss). Two groups have no
   link unless an indexed token of one is in the other's row. For the others the groups' first members are
   compared; if these don't link, their overlap and the most tokens that a member adds to its
   first member's bound the overlap of any member with the other group's union. Only groups
   that no links connect yet and that reach a link's least overlap are opened, and there only members that reach it too and
   share a prefix token.
4. Components of the links, and each class's smallest key.

Links are exact up to hash collisions. Sets are compared by 64-bit hashes in class fingerprints
(two, of 128 bits together), and by 43 bits or more in overlaps and counts: two sets of n shingles
have one wrong hit in common with a chance of n x n / 2^43, which is 10^-9 for 100 shingles each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import drop, keep, settle, stable
from .components import components
from .words import Batch, groups_of, mix64, trim

SHINGLE = 5
#: A link needs NUM / DEN of the union.
NUM, DEN = 3, 4
#: Characters and documents of one packed group at most, and documents to a bucket of hashes.
GROUP_CHARS, GROUP_DOCS, BUCKET_DOCS = 3_000_000, 1 << 16, 512
#: Packed rows get short with more buckets than this; beyond 5 x 10^8 documents buckets grow instead,
#: at 2 x 10^10 documents to about 50 MB of hashes.
LEAST_BUCKETS, MOST_BUCKETS = 1 << 11, 1 << 20
SEEDS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B, 0x510E527FADE682D1)

_PACKED = "bucket long, gid long, kind int, a binary, b binary, c binary, d binary, e binary, f binary, g binary"
_DOCS = "rid long, key long, digest long, n long, fp1 long, fp2 long, m1 long, m2 long, m3 long, m4 long, shared array<long>"


def bucket_number(rows: int, least: int = LEAST_BUCKETS) -> int:
    """A power of two that gives each bucket the hashes of so many documents as BUCKET_DOCS."""
    buckets = least
    while buckets < MOST_BUCKETS and buckets * BUCKET_DOCS < rows:
        buckets *= 2
    return buckets


def least_overlap(n: np.ndarray) -> np.ndarray:
    return (NUM * n + DEN - 1) // DEN


def _sets(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, one text after another, and their counts."""
    batch = Batch(texts, folded=True)
    values, owner = batch.shingles(SHINGLE)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    parts = [np.unique(values[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.array([len(p) for p in parts], np.int64)


def _pack(buckets: int):
    """Rows of kind 0 (a group's documents), 2 (its tokens held by several of its documents) and
    1 (for a bucket: tokens of one document each, and of several)."""
    bits = buckets.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        gid = TaskContext.get().partitionId() << 24
        for rows in batches:
            keys, digests, texts = rows.column(0), rows.column(1), rows.column(2).to_pylist()
            for lo, hi in groups_of(texts, GROUP_CHARS):
                for low in range(lo, hi, GROUP_DOCS):
                    high = min(hi, low + GROUP_DOCS)
                    yield pack(gid, keys.slice(low, high - low), digests.slice(low, high - low), texts[low:high])
                    gid += 1
            trim()

    def pack(gid: int, keys: pa.Array, digests: pa.Array, texts: list) -> pa.RecordBatch:
        h, n = _sets(texts)
        first = np.cumsum(n) - n
        some = np.flatnonzero(n)
        stats = np.zeros((6, len(n)), np.uint64)
        if len(some):
            stats[0, some] = np.add.reduceat(mix64(h), first[some])
            stats[1, some] = np.bitwise_xor.reduceat(h, first[some])
            for k, seed in enumerate(SEEDS):
                stats[2 + k, some] = np.minimum.reduceat(mix64(h ^ np.uint64(seed)), first[some])
        null = np.array(keys.is_null().to_pylist(), "u1")
        known = keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
        out = [(buckets + gid % buckets, gid, 0, known.tobytes(), null.tobytes(), n.astype("<i8").tobytes(), stats.astype("<u8").tobytes(), digests.to_numpy().astype("<i8").tobytes(), b"", b"")]

        order = np.argsort(h)
        hs, ds = h[order], np.repeat(np.arange(len(n)), n)[order].astype("<u2")
        begin = np.flatnonzero(np.concatenate(([True], hs[1:] != hs[:-1]))) if len(hs) else np.empty(0, np.int64)
        count = np.diff(np.append(begin, len(hs)))
        one, many = begin[count == 1], begin[count > 1]
        of_many = count[count > 1]
        bucket = (hs >> np.uint64(64 - bits)).astype(np.int64)
        token = ((hs << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
        held = np.repeat(count > 1, count)
        key = (bucket[many].astype("<u8") << np.uint64(32)) | token[many]
        out.append((buckets + gid % buckets, gid, 2, key.tobytes(), of_many.astype("<u4").tobytes(), ds[held].tobytes(), b"", b"", b"", b""))
        cut, cut_many = np.searchsorted(bucket[one], np.arange(buckets + 1)), np.searchsorted(bucket[many], np.arange(buckets + 1))
        t1, d1, tm = token[one], ds[one], token[many]
        for b in np.flatnonzero((np.diff(cut) > 0) | (np.diff(cut_many) > 0)).tolist():
            s, m = slice(cut[b], cut[b + 1]), slice(cut_many[b], cut_many[b + 1])
            out.append((b, gid, 1, t1[s].tobytes(), d1[s].tobytes(), tm[m].tobytes(), b"", b"", b"", b""))
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PACKED_TYPES, strict=True)], names=_PACKED_NAMES)

    return run


_PACKED_NAMES = [c.split()[0] for c in _PACKED.split(", ")]
_PACKED_TYPES = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 7]


def _join(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows, and how many each row has."""
    parts = column.to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(parts), kind), np.array([len(p) // size for p in parts], np.int64)


def _count(buckets: int):
    """Counts the documents that hold each token of a bucket and answers with the shared ones."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= buckets:
            return table
        gid = table.column("gid").to_numpy()
        t1, n1 = _join(table.column("a"), "<u4")
        d1, _ = _join(table.column("b"), "<u2")
        tm, _ = _join(table.column("c"), "<u4")
        values, at, held = np.unique(np.concatenate((t1, tm)), return_inverse=True, return_counts=True)
        several = held > 1
        several[at[len(t1) :]] = True  # in another group's several documents
        shared = several[at[: len(t1)]]
        row = np.repeat(np.arange(len(gid)), n1)[shared]
        t1, d1 = t1[shared], d1[shared]
        cut = np.searchsorted(row, np.arange(len(gid) + 1))
        out = [(bucket, int(gid[i]), 1, t1[a:b].tobytes(), d1[a:b].tobytes(), b"", b"", b"", b"", b"") for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(_PACKED_TYPES)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _PACKED_TYPES, strict=True)], names=_PACKED_NAMES)

    return run


def _gather(table: pa.Table) -> pa.Table:
    """One row per document of a group; those that may have links get their shared tokens, sorted,
    and the prefix of the rarest."""
    kind = table.column("kind").to_numpy()
    gid = table.column("gid")[0].as_py()
    docs = table.filter(pa.array(kind == 0)).slice(0, 1)
    several = table.filter(pa.array(kind == 2)).slice(0, 1)
    back = table.filter(pa.array(kind == 1))
    raw = lambda t, c, k: np.frombuffer(t.column(c)[0].as_py(), k)
    key, null, n = raw(docs, "a", "<i8"), raw(docs, "b", "u1"), raw(docs, "c", "<i8")
    stats, digest = raw(docs, "d", "<u8").reshape(6, len(n)).view("<i8"), raw(docs, "e", "<i8")

    t1, n1 = _join(back.column("a"), "<u4")
    d1, _ = _join(back.column("b"), "<u2")
    token1 = (np.repeat(back.column("bucket").to_numpy(), n1).astype(np.int64) << 32) | t1
    many, many_n, many_d = raw(several, "a", "<u8").astype(np.int64), raw(several, "b", "<u4").astype(np.int64), raw(several, "c", "<u2")
    doc = np.concatenate((d1, many_d)).astype(np.int64)
    token = np.concatenate((token1, np.repeat(many, many_n)))
    shared = np.bincount(doc, minlength=len(n))
    need = least_overlap(n)
    dense = (n > 0) & (shared >= need)
    use = dense[doc]
    doc, token = doc[use], token[use]
    token = token[np.argsort(doc, kind="stable")]
    sets: list = [None] * len(n)
    at = 0
    for i in np.flatnonzero(dense).tolist():
        sets[i] = token[at : at + shared[i]]
        at += shared[i]
    del token, token1, doc, use
    trim()
    arrays = [pa.array(gid * GROUP_DOCS + np.arange(len(n))), pa.array(key.astype(np.int64), mask=null.astype(bool)), pa.array(digest.astype(np.int64)), pa.array(n.astype(np.int64)), *[pa.array(s.astype(np.int64)) for s in stats], pa.array(sets, pa.list_(pa.int64()))]
    return pa.Table.from_arrays(arrays, names=[c.split()[0] for c in _DOCS.split(", ")])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of the intersections of sa and sb (distinct numbers, sorted), and what each has alone."""
    for rows in batches:
        column = {n: rows.column(k) for k, n in enumerate(rows.schema.names)}
        sets = [(c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()) for c in (column["sa"], column["sb"])]
        inter, over = np.zeros(len(rows), np.int64), np.zeros((2, len(rows)), np.int64)
        for i in range(len(rows)):
            x, y = (v[o[i] : o[i + 1]] for v, o in sets)
            inter[i] = len(np.intersect1d(x, y, assume_unique=True))
            over[:, i] = len(x) - inter[i], len(y) - inter[i]
        take = [column[c] for c in ("a", "b", "na", "nb")]
        yield pa.RecordBatch.from_arrays([*take, *[pa.array(x) for x in (inter, *over)]], names=["a", "b", "na", "nb", "inter", "ea", "eb"])


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b) with na, nb, inter, ea and eb (shared tokens of one alone) and linked. The side that may repeat very often, a,
    is joined last and nothing is grouped after it, so a hot one is split over tasks."""
    right = sets.select(F.col("rid").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    left = sets.select(F.col("rid").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "na", "nb", "sa", "sb")
    done = both.mapInArrow(_overlaps, "a long, b long, na long, nb long, inter long, ea long, eb long")
    union = F.col("na") + F.col("nb") - F.col("inter")
    return done.withColumn("linked", DEN * F.col("inter") >= NUM * union)


def link(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """One row per row of docs: key, n_shingles and component_id (the smallest key that links
    reach, the own one included).

    Keys are integers. Documents without words, or null, have no shingles and no links. Rows with
    equal keys are documents of their own; a null key is never the smallest unless all keys of its
    component are null, which gives null. An empty table stays empty; other columns are not read.
    """
    member, found = _components(docs, key, body)
    return member.join(found, "rep", "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("lowest", "least").alias("component_id"))


def representatives(docs: DataFrame, key: str = "doc_id", body: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, of which one of each component stays: the one with
    the smallest key (null last), then the smallest text hash. Rows are told apart by key and
    text, so rows with equal keys (null ones too) and different texts are judged each for itself;
    of rows equal in both the one with the smallest other columns stays. Rows without words have
    no links and all stay."""
    member, found = _components(docs, key, body)
    named = member.filter("n > 0").join(found, "rep", "left").select("key", "digest", F.coalesce("label", "rep").alias("g"))
    same, same_at = keep(named.groupBy("g", "key", "digest").agg(F.count("*").alias("c")), "members-by-text")
    first = same.groupBy("g").agg(F.min(F.struct(F.col("key").isNull(), "key", "digest")).alias("f")).select("g", "f.key", "f.digest", F.lit(True).alias("stays"))
    on = same["g"].eqNullSafe(first["g"]) & same["key"].eqNullSafe(first["key"]) & (same["digest"] == first["digest"])
    judged, _ = keep(same.join(first, on, "left").select(same["key"], same["digest"], "stays", "c"), "judged")
    drop(docs.sparkSession, same_at)
    # a text without words has no entry among the judged
    which = lambda rows: docs[key].eqNullSafe(rows["key"]) & (F.xxhash64(docs[body]) == rows["digest"])
    gone = judged.filter("stays is null")
    left = docs.join(gone, which(gone), "left_anti")
    several = judged.filter("stays and c > 1")
    if several.isEmpty():
        return left.select(*docs.columns)
    single = left.join(several, which(several), "left_anti").select(*docs.columns)
    rest = [c for c in docs.columns if c not in (key, body)]
    again = left.join(several, which(several), "left_semi").groupBy(key, body).agg(F.min(F.struct(*rest) if rest else F.lit(0)).alias("__rest"))
    return single.unionByName(again.select(key, body, *[F.col("__rest")[c].alias(c) for c in rest]).select(*docs.columns))


def _components(docs: DataFrame, key: str, body: str) -> tuple[DataFrame, DataFrame]:
    """The rows of docs (rid, key, digest of the text, n and rep, their class) and, for classes that
    links connect, their component's label and smallest key."""
    spark = docs.sparkSession
    narrow = stable(docs.select(docs[key].cast("long").alias("k"), F.xxhash64(docs[body]).alias("d"), docs[body].alias("t")), "jaccard-input")
    buckets = bucket_number(narrow.count())
    packed = narrow.mapInArrow(_pack(buckets), _PACKED)
    counted = packed.groupBy("bucket").applyInArrow(_count(buckets), _PACKED)
    table, table_at = keep(counted.groupBy("gid").applyInArrow(_gather, _DOCS), "shingle-sets")
    del packed, counted
    settle(spark)  # the packed exchange is the largest

    # classes of equal sets; only those with two documents or more have to be told to their members
    same = ["n", "fp1", "fp2"]
    classes = table.filter("n > 0").groupBy(*same).agg(F.min("rid").alias("rep"), F.min("key").alias("least"), F.count("*").alias("c")).filter("c > 1").drop("c")
    classes, classes_at = keep(classes, "classes")
    member = table.select("rid", "key", "digest", *same).join(classes, same, "left")
    member, member_at = keep(member.select("rid", "key", "digest", "n", F.coalesce("rep", "rid").alias("rep"), F.coalesce("least", "key").alias("least")), "members")

    dense = table.filter("shared is not null").join(member.filter("rid <> rep").select("rid"), "rid", "left_anti")
    dense, dense_at = keep(dense.select("rid", "n", "m1", "m2", "m3", "m4", "shared"), "dense")
    drop(spark, table_at, classes_at)
    again, again_at = _again(dense)
    drop(spark, dense_at)
    edges, edges_at = _links(again, [again_at])
    labels = components(edges)
    least = labels.join(member.filter("rid = rep").select(F.col("rid").alias("v"), "least"), "v")
    lowest, lowest_at = keep(least.groupBy("label").agg(F.min("least").alias("lowest")), "lowest")
    found, _ = keep(least.select("v", "label").join(lowest, "label").select(F.col("v").alias("rep"), "label", "lowest"), "found")
    drop(spark, lowest_at, *edges_at)
    return member, found


def _again(dense: DataFrame) -> tuple[DataFrame, str]:
    """The step of the shared shingles once more, among the classes that it has left: copies no
    longer count. Adds the prefix (the rarest shared tokens), how many of it are indexed, and
    central: a class whose tokens many others hold is likely to stand in the middle of them."""
    held, held_at = keep(dense.select("rid", F.explode("shared").alias("token")), "tokens")
    many, many_at = keep(held.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), "shared-tokens")
    least = held.join(many, "token").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    least = least.join(dense.drop("shared"), "rid")
    size, need = F.size("t"), F.expr(f"({NUM} * n + {DEN - 1}) div {DEN}")
    # the overlap with a partner that has as many shingles or more is at least 2 t / (1 + t) of the own
    as_large = F.expr(f"({2 * NUM} * n + {NUM + DEN - 1}) div {NUM + DEN}")
    least = least.filter(size >= need).withColumns({
        "shared": F.array_sort("t.token"), "prefix": F.slice("t.token", F.lit(1), (size - need + 1).cast("int")),
        "indexed": F.greatest(F.lit(0), size - as_large + 1).cast("int"),
        "central": F.expr("aggregate(t.df, 0L, (s, x) -> s + least(x, 1000000)) * 1000 div n"),
    })
    out, out_at = keep(least.drop("t"), "dense-again")
    del least
    drop(dense.sparkSession, held_at, many_at)
    settle(dense.sparkSession)
    return out, out_at


def _links(dense: DataFrame, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """Links between classes, enough of them to connect all that links connect."""
    found = []
    live = dense.select("rid", "m1", "m2", "m3", "m4", "central")
    for keys in (["m1", "m2"], ["m3", "m4"], ["m1"], ["m3"]):
        first = live.groupBy(*keys).agg(F.max(F.struct("central", -F.col("rid"))).alias("top"), F.count("*").alias("c")).filter("c > 1")
        first = first.select(*keys, (-F.col("top")["col2"]).alias("a"))
        first, at = keep(first, "firsts")
        pairs, pairs_at = keep(live.select(F.col("rid").alias("b"), *keys).join(first, keys).filter("a <> b").select("a", "b"), "star-pairs")
        stars, stars_at = keep(_compare(pairs, dense).filter("linked").select("a", "b", F.col("eb").alias("extra")), "stars")
        live, live_at = keep(live.join(stars.select(F.col("b").alias("rid")), "rid", "left_anti"), "live")
        paths += [at, pairs_at, stars_at, live_at]
        found.append(stars)
        settle(dense.sparkSession)  # the sets were shuffled for the comparison
    stars = found[0]
    for more in found[1:]:
        stars = stars.union(more)

    # the token-group matrix
    group = dense.select("rid", "n", "indexed", "prefix").join(stars.select(F.col("b").alias("rid"), F.col("a").alias("leader"), "extra"), "rid", "left")
    group, group_at = keep(group.select("rid", "n", "indexed", "prefix", F.coalesce("leader", "rid").alias("g"), F.coalesce("extra", F.lit(0)).alias("extra"), F.col("leader").isNotNull().alias("follows")), "groups")
    cells = group.select("g", "n", "indexed", F.posexplode("prefix").alias("place", "token")).groupBy("token", "g").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min(F.when(F.col("place") < F.col("indexed"), F.col("n"))).alias("indexed")
    )
    cells, cells_at = keep(cells, "matrix")
    # the smaller of two linked documents has a common token among its indexed ones
    left, right = cells.filter("indexed is not null").alias("x"), cells.alias("y")
    meet = F.expr(f"x.token = y.token and x.g <> y.g and x.indexed <= y.high and {DEN} * x.high >= {NUM} * y.low")
    pairs, pairs_at = keep(left.join(right, meet).select(F.least("x.g", "y.g").alias("a"), F.greatest("x.g", "y.g").alias("b")).distinct(), "group-pairs")
    leaders, leaders_at = keep(_compare(pairs, dense), "leaders")
    settle(dense.sparkSession)
    # what a group's union adds to its first member's tokens in any one member, and the least size
    beyond = group.groupBy("g").agg(F.max("extra").alias("extra"), F.min("n").alias("low"), F.max(F.col("follows")).alias("several"))
    beyond, beyond_at = keep(beyond, "beyond")
    side = lambda k: beyond.select(F.col("g").alias(k), F.col("extra").alias(f"x{k}"), F.col("low").alias(f"low{k}"), F.col("several").alias(f"several{k}"))
    far = leaders.filter("not linked").select("a", "b", "inter").join(side("a"), "a").join(side("b"), "b")
    may = f"{NUM + DEN} * (inter + xa + xb) >= {NUM} * (lowa + lowb) and (severala or severalb)"
    # groups that links already connect need not be opened
    known = stars.select("a", "b").union(leaders.filter("linked").select("a", "b"))
    labels = components(known)
    own = lambda k: labels.select(F.col("v").alias(k), F.col("label").alias(f"of{k}"))
    far = far.filter(may).join(own("a"), "a", "left").join(own("b"), "b", "left").filter("coalesce(ofa, a) <> coalesce(ofb, b)")
    opened, opened_at = keep(far.select("a", "b", "inter", "xa", "lowa", "xb", "lowb"), "opened")

    # members that cannot reach the bound with any of the other group are left out, and so are pairs
    # of members beyond it or without a prefix token in common
    turned = opened.select(F.col("b").alias("a"), F.col("a").alias("b"), "inter", F.col("xb").alias("xa"), F.col("lowb").alias("lowa"), F.col("xa").alias("xb"), F.col("lowa").alias("lowb"))
    both = opened.union(turned)
    reach = lambda own, n, other, low: f"{NUM + DEN} * (inter + {own} + {other}) >= {NUM} * ({n} + {low})"
    xs = group.select(F.col("g").alias("gx"), F.col("rid").alias("x"), F.col("extra").alias("ex"), F.col("n").alias("nx"), F.slice("prefix", F.lit(1), F.col("indexed")).alias("px")).filter(F.size("px") > 0)
    ys = group.select(F.col("g").alias("gy"), F.col("rid").alias("y"), F.col("extra").alias("ey"), F.col("n").alias("ny"), F.col("prefix").alias("py"))
    xs = both.join(xs, F.expr(f"a = gx and {reach('ex', 'nx', 'xb', 'lowb')}")).select("a", "b", "inter", "x", "ex", "nx", "px")
    ys = both.join(ys, F.expr(f"b = gy and {reach('ey', 'ny', 'xa', 'lowa')}")).select("a", "b", "y", "ey", "ny", "py")
    meet = f"{NUM + DEN} * (inter + ex + ey) >= {NUM} * (nx + ny) and nx <= ny and nx * {DEN} >= {NUM} * ny and arrays_overlap(px, py)"
    near = xs.alias("l").join(ys.alias("r"), F.expr(f"l.a = r.a and l.b = r.b and {meet}"))
    near = near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    near, near_at = keep(near, "opened-pairs")
    inner, inner_at = keep(_compare(near, dense).filter("linked").select("a", "b"), "inner")
    edges = known.union(inner)
    return edges, [*paths, group_at, cells_at, pairs_at, leaders_at, beyond_at, opened_at, near_at, inner_at]
