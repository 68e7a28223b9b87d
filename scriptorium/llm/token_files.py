"""Token ids in binary files of patched frame-of-reference blocks.

A file holds documents in ascending key order, all numbers little-endian:

    magic   8 bytes  SCRPFOR1
    header  5 x u64  documents, ids, blocks, payload words, exceptions
    keys    i64 per document, then one byte per document (1: the key is null)
    counts  u64 per document: its ids, the end id included
    minima  u32 per block of 256 ids
    widths  u8 per block: bits of a packed difference
    starts  u64 per block and one more: first payload word of the block (the block index)
    patched u64 per block and one more: first exception of the block
    payload u64 words: id minus minimum, 64 differences in `width` words, lowest bits first
    places  u8 per exception: position in its block
    values  u32 per exception: the difference that doesn't fit

A block's width is that of its 90th percentile of differences. The last block is filled up with
its minimum. Any block can be decoded alone through the index.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..tables import keep, new_folder
from .words import slices_of, trim

MAGIC = b"SCRPFOR1"
BLOCK, LANES = 256, 64
PERCENTILE = 0.9
#: A file is closed at the document that brings it to so many ids; tokens of so many segments are cached.
FILE_IDS, CACHE = 2_000_000, 600_000


def _bits(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def encode_file(keys: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    if n % BLOCK:
        padded[n:] = ids[(blocks - 1) * BLOCK :].min()
    rows = padded.reshape(blocks, BLOCK)
    minima = rows.min(axis=1) if blocks else np.empty(0, np.uint32)
    diff = (rows - minima[:, None]).astype(np.uint64)
    at = int(PERCENTILE * (BLOCK - 1))
    widths = _bits(np.partition(diff, at, axis=1)[:, at]) if blocks else np.empty(0, np.int64)
    over = diff >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
    block_of, places = np.nonzero(over)
    values = diff[block_of, places].astype(np.uint32)
    diff[over] = 0
    starts = np.concatenate(([0], np.cumsum(widths * (BLOCK // LANES)))).astype(np.int64)
    patched = np.concatenate(([0], np.cumsum(over.sum(axis=1)))).astype(np.int64)
    payload = np.zeros(int(starts[-1]), np.uint64)
    for w in np.unique(widths[widths > 0]):
        which = np.flatnonzero(widths == w)
        lanes = diff[which].reshape(len(which), BLOCK // LANES, LANES)
        packed = np.zeros((len(which), BLOCK // LANES, int(w)), np.uint64)
        for j in range(LANES):
            word, shift = divmod(j * int(w), 64)
            packed[:, :, word] |= lanes[:, :, j] << np.uint64(shift)
            if shift + w > 64:
                packed[:, :, word + 1] |= lanes[:, :, j] >> np.uint64(64 - shift)
        span = BLOCK // LANES * int(w)
        payload[starts[which][:, None] + np.arange(span)] = packed.reshape(len(which), span)
    null = np.array([k is None for k in keys], np.uint8)
    head = struct.pack("<5Q", len(keys), n, blocks, len(payload), len(values))
    parts = [np.array([k or 0 for k in keys], "<i8"), null, counts.astype("<u8"), minima.astype("<u4"), widths.astype("u1"), starts.astype("<u8"), patched.astype("<u8"), payload.astype("<u8"), places.astype("u1"), values.astype("<u4")]
    return MAGIC + head + b"".join(p.tobytes() for p in parts)


class TokenFile:
    """The sections of a file; ids() decodes all blocks or a range of them."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        docs, self.n, self.blocks, words, exceptions = struct.unpack_from("<5Q", data, 8)
        at = 48

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.keys, self.null, self.counts = take("<i8", docs), take("u1", docs), take("<u8", docs).astype(np.int64)
        self.minima, self.widths = take("<u4", self.blocks), take("u1", self.blocks)
        self.starts, self.patched = take("<u8", self.blocks + 1).astype(np.int64), take("<u8", self.blocks + 1).astype(np.int64)
        self.payload, self.places, self.values = take("<u8", words), take("u1", exceptions), take("<u4", exceptions)

    def ids(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.blocks if stop is None else min(stop, self.blocks)
        count = max(0, stop - first)
        rows = np.zeros((count, BLOCK), np.uint64)
        widths = self.widths[first:stop].astype(np.int64)
        for w in np.unique(widths[widths > 0]):
            which = np.flatnonzero(widths == w)
            span = BLOCK // LANES * int(w)
            packed = self.payload[self.starts[first:stop][which][:, None] + np.arange(span)].reshape(len(which), BLOCK // LANES, int(w))
            lanes = np.empty((len(which), BLOCK // LANES, LANES), np.uint64)
            mask = np.uint64((1 << int(w)) - 1)
            for j in range(LANES):
                word, shift = divmod(j * int(w), 64)
                part = packed[:, :, word] >> np.uint64(shift)
                if shift + w > 64:
                    part = part | (packed[:, :, word + 1] << np.uint64(64 - shift))
                lanes[:, :, j] = part & mask
            rows[which] = lanes.reshape(len(which), BLOCK)
        e = slice(self.patched[first], self.patched[stop]) if count else slice(0, 0)
        block_of = np.repeat(np.arange(count), np.diff(self.patched[first : stop + 1])) if count else np.empty(0, np.int64)
        rows[block_of, self.places[e]] = self.values[e]
        rows += self.minima[first:stop, None]
        return rows.reshape(-1)[: max(0, min(self.n, stop * BLOCK) - first * BLOCK)].astype("<u4")


#: White space around a space: only there may a cut before a space divide a pre-token.
_UNSAFE = re.compile(r"\s (?:\s|\Z)")
#: After letters, a run of these signs to a segment's end is one pre-token.
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


def _byte_alphabet() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable Latin-1 stands for
    itself, the other bytes in ascending order for the letters from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """Ids of whole texts, as little-endian 32-bit numbers.

    Byte-level pre-tokens never run across a space that follows a word, so texts are cut there
    and the ids of repeated segments are looked up. New segments that are a word, or a word and
    signs, are known to be one or two pre-tokens; their pre-tokens go to the tokenizer's model in
    one call, all other segments through the whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        # a text that holds an added token's string goes through the whole tokenizer
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) if added else r"(?!)")
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = CharDelimiterSplit("\n")
        self.alphabet = {b: c for b, c in _byte_alphabet().items() if b != 10}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self.cache: dict[str, bytes] = {}
        self.most = CACHE

    def _single(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of single pre-tokens, one after another, and each one's count of ids."""
        if not pieces:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        text = "\n".join(pieces).encode("utf-8", "surrogatepass").decode("latin-1").translate(self.alphabet)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        # tokens and pieces are both known by their bytes, so the pieces' last tokens follow
        sizes = np.cumsum(np.fromiter(map(len, text.split("\n")), np.int64, len(pieces)))
        stop = np.searchsorted(np.cumsum(self.bytes[ids]), sizes, "left") + 1
        return ids, np.diff(stop, prepend=0)

    def _any(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))

    def _lookup(self, words: list[str], single: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct segments: one array with the ids of all, and where each one's begin and how many they are."""
        found = list(map(self.cache.get, words))
        new = np.array([f is None for f in found], bool)
        known = [f for f in found if f is not None]
        sizes = np.zeros(len(words), np.int64)
        sizes[~new] = np.fromiter(map(len, known), np.int64, len(known)) // 4
        order = [np.flatnonzero(~new)]
        parts = [np.frombuffer(b"".join(known), np.uint32)]
        for at, encode in ((np.flatnonzero(new & single), self._single), (np.flatnonzero(new & ~single), self._any)):
            ids, many = encode([words[i] for i in at.tolist()])
            sizes[at] = many
            order.append(at)
            parts.append(ids)
            # the segments met first, among them all common ones, stay
            stop = np.cumsum(many)
            for i, e, m in zip(at[: max(0, self.most - len(self.cache))].tolist(), stop.tolist(), many.tolist(), strict=False):
                self.cache[words[i]] = ids[e - m : e].tobytes()
        place = np.concatenate(order)
        begin = np.zeros(len(words), np.int64)
        begin[place] = np.cumsum(sizes[place]) - sizes[place]
        return np.concatenate(parts), begin, sizes

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        if not texts:
            return []
        whole = [not t or bool(_UNSAFE.search(t) or self.added.search(t)) for t in texts]
        lists = pc.split_pattern(pa.array(["" if w else t for t, w in zip(texts, whole, strict=True)], pa.string()), " ")
        coded = lists.flatten().dictionary_encode()
        offsets, codes = lists.offsets.to_numpy(), coded.indices.to_numpy()
        segments = coded.dictionary
        # a segment is a word and signs, where the word may also be empty or anything else
        words = pc.utf8_rtrim(segments, characters=_SIGNS)
        plain = pc.utf8_is_alpha(words)
        words = pc.if_else(plain, words, segments).dictionary_encode()
        cut = pc.subtract(pc.binary_length(segments), pc.binary_length(words.dictionary.take(words.indices))).to_numpy()
        signs = np.zeros(len(segments), np.int64)
        ends, at = {"": 0}, np.flatnonzero(cut)
        for i, s, n in zip(at.tolist(), segments.take(pa.array(at)).to_pylist(), cut[at].tolist(), strict=True):
            signs[i] = ends.setdefault(s[-n:], len(ends))
        # a text's first segment has no space before it
        first = [t or "" if w else t.partition(" ")[0] for t, w in zip(texts, whole, strict=True)]
        base = [" " + w for w in words.dictionary.to_pylist()]
        pool, begin, sizes = self._lookup(base, pc.utf8_is_alpha(words.dictionary).to_numpy(zero_copy_only=False))
        extra, many = self._any([*ends, *first])
        begin = np.concatenate((begin, len(pool) + np.cumsum(many) - many))
        sizes, pool = np.concatenate((sizes, many)), np.concatenate((pool, extra))
        pieces = np.empty((len(codes), 2), np.int64)
        pieces[:, 0] = words.indices.to_numpy()[codes]
        pieces[:, 1] = len(base) + signs[codes]
        start = offsets[:-1]
        pieces[start, 0], pieces[start, 1] = len(base) + len(ends) + np.arange(len(texts)), len(base)
        pieces = pieces.ravel()
        many = sizes[pieces]
        stop = np.cumsum(many)
        ids = pool[np.repeat(begin[pieces] - stop + many, many) + np.arange(stop[-1])]
        return np.split(ids, stop[2 * offsets[1:-1] - 1])


_encoders: dict[str, Encoder] = {}


def encoder(path: str, kept: bool = True) -> Encoder:
    """One encoder for all tasks that a Python worker runs; with kept=False the worker gives it up
    to the caller, and its memory goes with the task."""
    if not kept:
        return _encoders.pop(path, None) or Encoder(path)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, files: int | None = None, group_chars: int = 10_000_000, cache: int = CACHE, kept: bool = True, key: str = "doc_id", body: str = "text") -> DataFrame:
    """Writes all documents as token files into folder and returns the manifest: file, part
    and seq (the order of the files), documents, ids and first_id (ids of all files before).

    Texts of group_chars characters together are encoded at once and the ids of `cache` segments
    kept between them: both trade memory of a task for time. With kept=False a worker that goes on
    to other work does not hold the tokenizer after its task.

    Keys are integers. Null texts have the end id alone. Null keys come first; rows with equal keys
    are ordered by a hash of their texts and then by the texts, so that a key which very many rows
    share is dealt over several files. Other columns are not read. An empty table gives no file. Files go to their final names by rename, so a task that
    runs again leaves the same files; the folder must be shared by all machines.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[key].cast("long").alias("k"), docs[body].alias("t"), F.xxhash64(docs[body]).alias("h"))
    ordered = rows.repartitionByRange(files, "k", "h").sortWithinPartitions("k", "h", "t").select("k", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        encode = encoder(tokenizer, kept)
        encode.most = cache
        keys, ids, made, total = [], [], [], 0

        def close():
            nonlocal keys, ids, total
            name = f"part-{part:07d}-{len(made):05d}.pfor"
            counts = np.array([len(x) for x in ids], np.int64)
            _put(folder, name, attempt, encode_file(keys, counts, np.concatenate(ids)))
            made.append((name, part, len(made), len(keys), int(counts.sum())))
            keys, ids, total = [], [], 0

        for batch in batches:
            k, sizes = batch.column(0).to_pylist(), pc.utf8_length(batch.column(1)).to_pylist()
            for lo, hi in slices_of(sizes, group_chars):
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                for one, got in zip(k[lo:hi], encode(texts), strict=True):
                    keys.append(one)
                    ids.append(np.append(got, np.uint32(end_id)))
                    total += len(got) + 1
                    if total >= FILE_IDS:
                        close()
                texts = got = None
                trim()
        if keys:
            close()
        encode = None
        trim()
        if made:
            columns = list(zip(*made, strict=True))
            kinds = (pa.string(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["file", "part", "seq", "documents", "ids"])

    manifest, _ = keep(ordered.mapInArrow(run, "file string, part long, seq long, documents long, ids long"), "token-manifest")
    # running sums first over the tasks that wrote, then over the files of each
    upto = lambda w: F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("ids")
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", upto(Window.orderBy("part")).alias("before"))
    return manifest.join(parts, "part").withColumn("first_id", F.col("before") + upto(Window.partitionBy("part").orderBy("seq"))).drop("before")


def _put(folder: str, name: str, attempt: int, data: bytes) -> None:
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    hidden = f"{root}/.{name}.{attempt}"
    with system.open_output_stream(hidden) as out:
        out.write(data)
    system.move(hidden, f"{root}/{name}")


def read(folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Decodes the files of a manifest: doc_id, start (ids of all documents before), n_tokens,
    ids_crc32 and, with with_ids=True, the ids themselves."""
    spark = manifest.sparkSession
    ddl = "file string, doc_id long, within long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    shape = spark.createDataFrame([], ddl.replace("within", "start")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                f = TokenFile(content.as_py())
                raw, stop = f.ids(), np.cumsum(f.counts)
                start = stop - f.counts
                view = memoryview(raw.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
                columns = [pa.array([path.as_py().rpartition("/")[2]] * len(start), pa.string()), pa.array(f.keys, pa.int64(), mask=f.null.astype(bool)), pa.array(start, pa.int64()), pa.array(f.counts, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array([raw[a:b].astype(np.int64) for a, b in zip(start, stop, strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ddl.split(", ")])
                del f, raw, view, columns
                trim()

    if manifest.isEmpty():
        return spark.createDataFrame([], shape).drop("file")
    files = spark.read.format("binaryFile").load(f"{folder}/*.pfor").select("path", "content")
    rows = files.mapInArrow(run, ddl).join(manifest.select("file", "first_id"), "file")
    return rows.select("doc_id", (F.col("first_id") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, **options) -> DataFrame:
    """Writes docs into a new folder of the shared place and reads the files back."""
    folder = new_folder(docs.sparkSession, "token-files")
    return read(folder, write(docs, folder, tokenizer, end_id, **options))
