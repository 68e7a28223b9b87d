"""Merging of chunk results into one patch: owners, ranges, duplicates, conflicts and order."""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..conf import EDIT_TYPES, FIELD, MERGE_TYPES, NULL
from ..functions.offsets import overlap, spans_meet, utf16_offset
from ..functions.text import strip

PAYLOADS = ("replacement", "new_text", "comment_text")


def payload_present() -> Column:
    kind = F.col("type")
    return (
        F.when(kind == "replace_range", F.col("replacement").isNotNull())
        .when(kind == "insert_at", F.coalesce(F.col("new_text") != "", F.lit(False)))
        .when(kind == "add_comment", strip(F.coalesce("comment_text", F.lit(""))) != "")
        .otherwise(F.lit(True))
    )


def own(ops: DataFrame, members: DataFrame) -> DataFrame:
    """ops of known kinds with a payload, with owner_reason (null: the chunk owns the target) and
    autofilled. A missing unit_uid is filled from the chunk's primary unit in that paragraph if
    there is exactly one."""
    known = ops.filter(F.col("type").isin(*MERGE_TYPES) & payload_present())
    # a paragraph of a chunk has few units, so they are one row
    unit = F.struct("unit_uid", (F.col("role") == "primary").alias("primary"))
    place = members.groupBy("doc_id", "chunk_id", "part", "para_id").agg(F.collect_set(unit).alias("__units"))
    joined = known.join(place, ["doc_id", "chunk_id", "part", "para_id"], "left")
    units = F.coalesce("__units", F.array().cast("array<struct<unit_uid: string, primary: boolean>>"))
    primaries = F.filter(units, lambda u: u["primary"])
    missing = F.coalesce(strip(F.col("unit_uid")), F.lit("")) == ""
    fill = missing & (F.size(primaries) == 1)
    why = (
        F.when(missing & (F.size(primaries) > 1), "missing_unit_uid_ambiguous_primary_match")
        .when(fill | F.coalesce(F.exists(primaries, lambda u: u["unit_uid"] == F.col("unit_uid")), F.lit(False)), None)
        .when(F.coalesce(F.exists(units, lambda u: u["unit_uid"] == F.col("unit_uid")), F.lit(False)), "target_is_context_unit")
        .otherwise("target_not_owned_by_chunk")
    )
    return joined.withColumns({"owner_reason": why, "autofilled": fill, "unit_uid": F.when(fill, F.get(primaries, F.lit(0))["unit_uid"]).otherwise(F.col("unit_uid"))}).drop("__units")


def occurrences(text: Column, snippet: Column) -> Column:
    """How often the snippet occurs, left to right without overlap; 0 for an empty one."""
    return F.when(F.coalesce(snippet, F.lit("")) == "", F.lit(0)).otherwise(((F.length(text) - F.length(F.replace(text, snippet, F.lit("")))) / F.length(snippet)).cast("int"))


def resolve(owned: DataFrame, units: DataFrame) -> DataFrame:
    """Owned ops with the unit's order, and range_event: filled (the snippet occurs once),
    range_resolution_ambiguous_snippet (the op becomes a comment on the unit's start) or
    range_resolution_snippet_not_found (to be removed); null where the range was given. Only ops
    without a range meet the units' texts, and the texts stay behind."""
    mine = owned.filter("owner_reason is null")
    lacking = F.col("range_start").isNull() | F.col("range_end").isNull()
    given = mine.filter(~lacking).join(units.select("doc_id", "unit_uid", "order_index"), ["doc_id", "unit_uid"]).withColumn("range_event", F.lit(None).cast("string"))
    text, snippet = F.col("accepted_text"), F.col("snippet")
    found = mine.filter(lacking).join(units.select("doc_id", "unit_uid", "accepted_text", "order_index"), ["doc_id", "unit_uid"])
    found = found.withColumn("__n", occurrences(text, snippet))
    event = F.when(F.col("__n") == 1, "filled").when(F.col("__n") > 1, "range_resolution_ambiguous_snippet").otherwise("range_resolution_snippet_not_found")
    begin = F.expr("locate(snippet, accepted_text)")
    start, end = utf16_offset(text, begin - 1), utf16_offset(text, begin - 1 + F.length(snippet))
    several, filled = F.col("__n") > 1, F.col("__n") == 1
    found = found.withColumns({
        "range_event": event,
        "range_start": F.when(filled, start).when(several, F.lit(0)).otherwise(F.col("range_start")),
        "range_end": F.when(filled, end).when(several, F.lit(0)).otherwise(F.col("range_end")),
    })
    found = as_comment(found, F.coalesce(several, F.lit(False)), F.concat(F.lit("Ambiguous snippet: "), F.col("type")))
    return given.unionByName(found.select(*given.columns))


def as_comment(ops: DataFrame, which: Column, text: Column) -> DataFrame:
    """ops of which some become comments with the given text and lose their other payloads."""
    none = F.lit(None).cast("string")
    keep = lambda c, other: F.when(which, other).otherwise(F.col(c))
    return ops.withColumns({"comment_text": keep("comment_text", text), "replacement": keep("replacement", none), "new_text": keep("new_text", none), "type": keep("type", F.lit("add_comment"))})


def dedup_key() -> Column:
    fields = ("type", "part", "para_id", "unit_uid", "range_start", "range_end", "snippet", *PAYLOADS)
    return F.sha2(F.concat_ws(FIELD, *[F.coalesce(F.col(f).cast("string"), F.lit(NULL)) for f in fields]), 256)


def dedup(resolved: DataFrame) -> DataFrame:
    """Of equal ops of a document the first by chunk and index; removed ranges go."""
    live = resolved.filter("range_event is null or range_event <> 'range_resolution_snippet_not_found'").withColumn("dedup_key", dedup_key())
    first = F.row_number().over(Window.partitionBy("doc_id", "dedup_key").orderBy("chunk_id", "op_index"))
    return live.withColumn("__n", first).filter("__n = 1").drop("__n")


def conflict_pairs(ops: DataFrame) -> DataFrame:
    """Pairs of edits in one paragraph that collide: an equi-join on the paragraph with the
    collision as its condition."""
    edits = ops.filter(F.col("type").isin(*EDIT_TYPES)).select("doc_id", "part", "para_id", "chunk_id", "op_index", "range_start", "range_end")
    a, b = edits.alias("a"), edits.alias("b")
    c = lambda n: F.col(n)
    meet = (c("a.doc_id") == c("b.doc_id")) & (c("a.part") == c("b.part")) & (c("a.para_id") == c("b.para_id"))
    meet &= F.struct("a.chunk_id", "a.op_index") < F.struct("b.chunk_id", "b.op_index")
    meet &= overlap(c("a.range_start"), c("a.range_end"), c("b.range_start"), c("b.range_end"))
    return a.join(b, meet).select("a.doc_id", "a.para_id", c("a.chunk_id").alias("first_chunk"), c("a.op_index").alias("first_op"), c("b.chunk_id").alias("second_chunk"), c("b.op_index").alias("second_op"))


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _collides(starts: pd.Series, ends: pd.Series) -> pd.Series:
    """For the edits of a paragraph, in order: does one collide with an earlier one that was kept?
    Kept edits don't collide with each other, so they lie in the order of their places and only
    the neighbours of a new one can meet it."""

    def one(begin, stop) -> list[bool]:
        kept: list[tuple[int, int]] = []
        out = []
        for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
            at = bisect.bisect_left(kept, (a, b))
            # a point at a span's end, and spans that touch a point, are neighbours within two places
            hit = any(spans_meet(*kept[i], a, b) for i in range(max(0, at - 2), min(len(kept), at + 2)))
            if not hit and a <= b:  # a reversed range meets nothing
                kept.insert(at, (a, b))
            out.append(hit)
        return out

    return pd.Series([one(s, e) for s, e in zip(starts, ends, strict=True)], dtype=object)


def downgrade(ops: DataFrame) -> DataFrame:
    """Edits that collide with an earlier kept edit of their paragraph become comments, in the
    order of chunk and index; comments never collide. The ranges of a paragraph's edits are one
    row, and paragraphs are handled in Arrow batches."""
    key = ["doc_id", "part", "para_id"]
    entry = F.struct("chunk_id", "op_index", "range_start", "range_end")
    edits = ops.filter(F.col("type").isin(*EDIT_TYPES)).groupBy(*key).agg(F.array_sort(F.collect_list(entry)).alias("e")).filter(F.size("e") > 1)
    flags = F.arrays_zip(F.col("e.chunk_id").alias("chunk_id"), F.col("e.op_index").alias("op_index"), _collides(F.col("e.range_start"), F.col("e.range_end")).alias("downgraded"))
    down = edits.select("doc_id", F.inline(flags)).filter("downgraded")
    joined = ops.join(down, ["doc_id", "chunk_id", "op_index"], "left").withColumn("downgraded", F.coalesce("downgraded", F.lit(False)))
    return as_comment(joined, F.col("downgraded"), F.concat(F.lit("Conflict downgrade: "), F.col("type")))


def order(ops: DataFrame) -> DataFrame:
    """ops with patch_pos: document order, and from the end of a paragraph to its start."""
    w = Window.partitionBy("doc_id").orderBy("order_index", F.desc("range_start"), F.desc("range_end"), "chunk_id", "op_index")
    return ops.withColumn("patch_pos", F.row_number().over(w) - 1)


def merge(ops: DataFrame, members: DataFrame, units: DataFrame) -> DataFrame:
    """The patch of each document."""
    return order(downgrade(dedup(resolve(own(ops, members), units))))


def stats(ops: DataFrame, owned: DataFrame, resolved: DataFrame, patch: DataFrame) -> DataFrame:
    """One row per document with the counts of every step, each an aggregate over that step's flags."""
    raw = ops.groupBy("doc_id").agg(F.count_distinct("chunk_id").alias("chunk_file_count"), F.count("*").alias("input_ops"))
    why = lambda name: F.count_if(F.col("owner_reason") == name)
    by_owner = owned.groupBy("doc_id").agg(
        F.count("*").alias("valid_ops"), F.count_if(F.col("owner_reason").isNotNull()).alias("rejected"), why("target_is_context_unit").alias("rejected_context"),
        why("target_not_owned_by_chunk").alias("rejected_unknown"), why("missing_unit_uid_ambiguous_primary_match").alias("rejected_ambiguous_missing_unit_uid"), F.count_if("autofilled").alias("autofilled"),
    )
    live = resolved.groupBy("doc_id").agg(F.count_if(F.col("range_event").isNotNull()).alias("range_resolution_events"), F.count_if(F.coalesce(F.col("range_event") != "range_resolution_snippet_not_found", F.lit(True))).alias("__live"))
    final = patch.groupBy("doc_id").agg(F.count_if("downgraded").alias("conflict_downgrades"), F.count("*").alias("final_ops"))
    out = raw.join(by_owner, "doc_id", "left").join(live, "doc_id", "left").join(final, "doc_id", "left").fillna(0)
    return out.withColumns({"duplicates_removed": F.col("__live") - F.col("final_ops"), "ops_after_dedup": F.col("final_ops")}).drop("__live")
