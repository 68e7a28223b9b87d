"""The deterministic reviewer: proposals made from the texts alone, without a language model.

A reviewer is a function of units, and this one runs as Arrow batches: counting a text's words and
building its proposals as nested column expressions made methods too large for the JVM to compile
and took about ten times as long.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..conf import DRY_RUN_COMMENT, DRY_RUN_INSERT, QUOTE_CONTEXT, WORD

FIELDS = ("type", "part", "para_id", "unit_uid", "quoted_text", "range_start", "range_end", "snippet", "replacement", "new_text", "comment_text")
_OP = ", ".join(f"{f} {'int' if f.startswith('range') else 'string'}" for f in FIELDS)
OPS = f"doc_id long, chunk_id string, op_index int, {_OP}"
PROPOSALS = f"doc_id long, chunk_index int, order_index int, k int, {_OP}"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
UNIT = ("doc_id", "chunk_index", "order_index", "accepted_text", "part", "para_id", "unit_uid")


def word_frequency(units: DataFrame) -> DataFrame:
    """Words that occur once in their document."""
    words = units.select("doc_id", F.explode(F.regexp_extract_all("accepted_text", F.lit(WORD), F.lit(0))).alias("word"))
    return words.groupBy("doc_id", "word").agg(F.count("*").alias("n")).filter("n = 1").select("doc_id", "word")


_word = re.compile(WORD)


def first_unique(text: str, most: int = 4) -> list[tuple[int, int]]:
    """The places of the first words that occur once in the text."""
    found = list(_word.finditer(text))
    counts = Counter(m.group() for m in found)
    return [m.span() for m in found if counts[m.group()] == 1][:most]


class _Unit:
    """A unit's text and target, with the ops that can be made on it."""

    def __init__(self, text: str, target: tuple):
        self.text, self.target = text, target
        self.plain = text.isascii() or max(text) <= "￿"

    def units(self, at: int) -> int:
        return at if self.plain else len(self.text[:at].encode("utf-16-le", "surrogatepass")) // 2

    def quote(self, start: int, end: int) -> str:
        t = self.text
        return f"{t[max(0, start - QUOTE_CONTEXT) : start]}[[{t[start:end]}]]{t[end : end + QUOTE_CONTEXT]}"

    def op(self, kind: str, start: int, end: int, quoted: str | None = None, **other) -> tuple:
        """Values of FIELDS for an op on [start, end) in code points."""
        values = dict(zip(FIELDS, (kind, *self.target, quoted, self.units(start), self.units(end), self.text[start:end], None, None, None), strict=True))
        return tuple((values | other).values())

    def proposals(self, four: list[tuple[int, int]]) -> list[tuple]:
        comment, change, insert, delete = four
        word, at = self.text[slice(*change)], insert[1]
        loud = word.upper()
        return [
            self.op("replace_range", *change, self.quote(*change), replacement=f"{word}_DRYRUN" if loud == word else loud),
            self.op("insert_at", at, at, f"{self.text[max(0, at - 20) : at]}[[ ]]{self.text[at : at + 20]}", new_text=DRY_RUN_INSERT),
            self.op("replace_range", *delete, self.quote(*delete), replacement=""),
            self.op("add_comment", *comment, self.quote(*comment), comment_text=DRY_RUN_COMMENT),
        ]

    def trouble(self, four: list[tuple[int, int]], first: tuple, before: tuple) -> tuple:
        """An op that the later stages have to handle; which one follows from a hash of the unit."""
        a, b = four[0], four[1]
        nowhere = {"range_start": None, "range_end": None}
        match int(hashlib.sha256((self.target[2] or "").encode()).hexdigest()[:8], 16) % 12:
            case 0:  # a duplicate
                return first
            case 1:  # an overlap
                return self.op("replace_range", b[0] + 1, b[1] + 1, replacement="XXXX")
            case 2:
                return self.op("replace_range", *a, replacement="FIRST", unit_uid=None)
            case 3:
                return self.op("replace_range", *a, replacement="FILLED", **nowhere)
            case 4:
                return self.op("replace_range", *a, replacement="E", snippet="e", **nowhere)
            case 5:
                return self.op("replace_range", *a, replacement="E", snippet="NOT_FOUND", **nowhere)
            case 6:  # the unit before, which may belong to another chunk
                return self.op("add_comment", 0, 0, comment_text="context", **dict(zip(("part", "para_id", "unit_uid"), before, strict=True)))
            case 7:
                return self.op("unknown_type", *a)
            case 8:
                return self.op("add_comment", *a, comment_text="  ")
            case 9:
                return self.op("insert_at", *a, new_text="x")
            case 10:
                return self.op("replace_range", *a)
            case _:
                return self.op("insert_at", a[0], a[0], new_text="")


def _rows(batch: pa.RecordBatch):
    return zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in UNIT], strict=True)


def _batch(rows: list, ddl: str) -> pa.RecordBatch:
    names, kinds = zip(*[f.split() for f in ddl.split(", ")], strict=True)
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds, strict=True)], names=names)


def dry_run(packed: DataFrame) -> DataFrame:
    """Four proposals for every unit with four words that occur once in it: a comment on the
    first, a replacement of the second, an insertion after the third and a deletion of the fourth.
    Words don't touch, so these never collide. k is the proposal's number in its unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, chunk, order, text, *target in _rows(batch):
                four = first_unique(text)
                if len(four) == 4:
                    out += [(doc, chunk, order, k, *op) for k, op in enumerate(_Unit(text, target).proposals(four))]
            yield _batch(out, PROPOSALS)

    return packed.select(*UNIT).mapInArrow(run, PROPOSALS)


def first_result(proposals: DataFrame) -> DataFrame:
    """The proposals of each document's first unit that has any."""
    first = proposals.groupBy("doc_id").agg(F.min("order_index").alias("order_index"))
    return proposals.join(first, ["doc_id", "order_index"])


def disturbed(packed: DataFrame) -> DataFrame:
    """The dry run's proposals and, for each unit, one that the later stages have to handle: a
    duplicate, an overlap, a missing unit, a missing range, a wrong target, kind or payload.

    Units come in order of their documents, so op_index and the unit before are known without a
    window or a join: one exchange and one sort."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before, chunk_now, index = None, (None, None, None), None, 0
        for batch in batches:
            out = []
            for doc, chunk, order, text, *target in _rows(batch):
                if last != (doc, order - 1):
                    before = (None, None, None)
                if chunk_now != (doc, chunk):
                    chunk_now, index = (doc, chunk), 0
                four = first_unique(text)
                if len(four) == 4:
                    unit = _Unit(text, target)
                    ops = unit.proposals(four)
                    ops.append(unit.trouble(four, ops[0], before))
                    out += [(doc, f"chunk_{chunk + 1:04d}", index + k, *op) for k, op in enumerate(ops)]
                    index += len(ops)
                last, before = (doc, order), tuple(target)
            yield _batch(out, OPS)

    return packed.select(*UNIT).repartition("doc_id").sortWithinPartitions("doc_id", "order_index").mapInArrow(run, OPS)
