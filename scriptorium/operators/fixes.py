"""Boundary fixes that a check of the chunks asks for, and the protocol of that check."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIX = "struct<seq: int, type: string, left_chunk_id: string, right_chunk_id: string, move: int>"
SAMPLE = 3
_PLACE = T.ArrayType(T.StructType([T.StructField("chunk_id", T.StringType()), T.StructField("role", T.StringType()), T.StructField("order_index", T.IntegerType())]))
_DONE = T.StructType([T.StructField("members", _PLACE), T.StructField("applied", T.IntegerType()), T.StructField("error", T.StringType())])


class FixError(ValueError):
    """A fix that can't be applied."""


def fold(chunks: dict[str, dict[str, list[int]]], fixes: list) -> dict[str, dict[str, list[int]]]:
    """Chunks (in order; id to the units of each role) after all fixes, one after another."""
    for fix in fixes:
        names = list(chunks)
        left, right = fix["left_chunk_id"], fix["right_chunk_id"]
        if left not in chunks or right not in chunks:
            raise FixError(f"unknown chunk: {left}, {right}")
        if names.index(right) != names.index(left) + 1:
            raise FixError(f"not adjacent: {left}, {right}")
        a, b = chunks[left], chunks[right]
        own, other = a["primary"], b["primary"]
        if fix["type"] == "merge_adjacent":
            chunks[left] = {"primary": own + other, "context_before": a["context_before"], "context_after": b["context_after"]}
            del chunks[right]
        elif fix["type"] == "shift_boundary":
            move = fix["move"] or 0
            if move > len(other):
                raise FixError(f"move exceeds the right chunk: {right}")
            if -move > len(own):
                raise FixError(f"move exceeds the left chunk: {left}")
            if move:
                both, cut = own + other, len(own) + move
                # each side's context is its new neighbour
                chunks[left] = a | {"primary": both[:cut], "context_after": both[cut : cut + 1]}
                chunks[right] = b | {"primary": both[cut:], "context_before": both[max(0, cut - 1) : cut]}
        else:
            raise FixError(f"unsupported fix: {fix['type']}")
    return chunks


@F.pandas_udf(_DONE)
def _fixed(members: pd.Series, fixes: pd.Series) -> pd.DataFrame:
    out = []
    for rows, wanted in zip(members, fixes, strict=True):
        chunks: dict = {}
        for m in rows:
            chunks.setdefault(m["chunk_id"], {"primary": [], "context_before": [], "context_after": []})[m["role"]].append(m["order_index"])
        try:
            done, error = fold(dict(chunks), list(wanted)), None
        except FixError as e:  # as if no fix had been asked for
            done, error = chunks, str(e)
        placed = [{"chunk_id": c, "role": r, "order_index": int(u)} for c, roles in done.items() for r, units in roles.items() for u in units]
        out.append((placed, 0 if error else len(wanted), error))
    return pd.DataFrame(out, columns=["members", "applied", "error"])


def apply_fixes(members: DataFrame, fixes: DataFrame) -> DataFrame:
    """members(doc_id, chunk_id, chunk_index, role, order_index, ...) of the documents that fixes
    (doc_id, seq, type, left_chunk_id, right_chunk_id, move) name, as they are after them: doc_id,
    chunk_id, role, order_index, applied (number of fixes) and error.

    Fixes of a document follow one another by seq: a later one sees what an earlier one left. A
    shift takes units over the boundary, to the right if move is negative, and the units beside the
    new boundary become the context there; a merge takes the right chunk's units and its context
    after. An unknown chunk, chunks that aren't neighbours, a move that is larger than the chunk it
    takes from and an unknown type are errors, and then none of the document's fixes holds. Only
    places are gathered for it, one row a document; documents are handled in Arrow batches."""
    asked = fixes.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "type", "left_chunk_id", "right_chunk_id", F.col("move").cast("int").alias("move")).cast(FIX))).alias("fixes"))
    places = members.select("doc_id", "chunk_index", "order_index", "chunk_id", "role").join(asked.select("doc_id"), "doc_id", "left_semi")
    places = places.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "order_index", "chunk_id", "role"))).alias("members"))
    done = places.join(asked, "doc_id").select("doc_id", _fixed("members", "fixes").alias("d"))
    return done.select("doc_id", F.inline("d.members"), F.col("d.applied").alias("applied"), F.col("d.error").alias("error"))


def sample(members: DataFrame) -> DataFrame:
    """The members of each document's first three chunks, which a check gets to see."""
    return members.filter(F.col("chunk_index") < SAMPLE)


def check_chunks(members: DataFrame, judge: Callable[[DataFrame, DataFrame], tuple[str, DataFrame | None]]) -> DataFrame:
    """The protocol of the check. judge(members, sample) says ok, or needs_fix with fixes; these are
    applied and a second pass has to say ok. Returns the members it was happy with."""
    status, fixes = judge(members, sample(members))
    if status == "ok":
        return members
    if status != "needs_fix":
        raise ValueError(f"unexpected status: {status}")
    if fixes is None or fixes.isEmpty():
        raise ValueError("fixes were asked for, but there are none")
    fixed = apply_fixes(members, fixes)
    wrong = fixed.filter("error is not null").select("doc_id", "error").first()
    if wrong:
        raise FixError(f"document {wrong.doc_id}: {wrong.error}")
    untouched = members.join(fixes.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "chunk_id", "role", "order_index")
    after = untouched.unionByName(fixed.select("doc_id", "chunk_id", "role", "order_index"))
    after = after.withColumn("chunk_index", F.regexp_extract("chunk_id", r"(\d+)$", 1).cast("int") - 1)
    status, _ = judge(after, sample(after))
    if status != "ok":
        raise ValueError("the check still fails after the fixes")
    return after
