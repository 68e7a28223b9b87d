"""Guarded application of a patch to the texts of units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..conf import EDIT_TYPES
from ..functions.offsets import utf16, utf16_length, utf16_slice
from ..functions.spans import computed


def check(patch: DataFrame, units: DataFrame) -> DataFrame:
    """The apply log: patch ops with actual_snippet, status and reason. An op is applied only if
    its target exists, its range lies in the text and the text there is the expected one."""
    texts = units.select("doc_id", "part", "para_id", F.col("unit_uid").alias("__uid"), F.col("accepted_text").alias("__text"))
    ops = patch.drop("accepted_text")
    # a target without unit_uid is found by its paragraph
    joined = ops.join(texts, ["doc_id", "part", "para_id"], "left").filter("__uid is null or unit_uid is null or unit_uid = __uid")
    length = utf16_length(F.col("__text"))
    inside = (F.col("range_start") >= 0) & (F.col("range_start") <= F.col("range_end")) & (F.col("range_end") <= length)
    joined = joined.withColumn("actual_snippet", F.when(inside, utf16_slice(F.col("__text"), F.col("range_start"), F.col("range_end"))))
    why = F.when(F.col("__uid").isNull(), "target_not_found").when(~F.coalesce(inside, F.lit(False)), "range_out_of_bounds")
    why = why.when((F.col("type") != "add_comment") & (F.col("actual_snippet") != F.coalesce("snippet", F.lit(""))), "snippet_mismatch")
    why = why.when((F.col("type") == "add_comment") & (F.col("range_start") < F.col("range_end")) & (F.col("actual_snippet") != F.coalesce("snippet", F.lit(""))), "snippet_mismatch")
    return joined.withColumn("reason", why).withColumn("status", F.when(F.col("reason").isNull(), "applied").otherwise("skipped")).withColumnRenamed("__text", "unit_text").drop("__uid")


def apply_text(log: DataFrame) -> DataFrame:
    """Units with applied edits: text before and after. Edits of a unit don't collide, so the new
    text is the gaps between them and their payloads, put together in ascending order."""
    edits = log.filter((F.col("status") == "applied") & F.col("type").isin(*EDIT_TYPES))
    put = F.when(F.col("type") == "replace_range", F.coalesce("replacement", F.lit(""))).when(F.col("type") == "insert_at", F.coalesce("new_text", F.lit(""))).otherwise("")
    done = edits.groupBy("doc_id", "part", "para_id").agg(F.first("unit_text").alias("before_text"), F.count("*").alias("edits"), F.array_sort(F.collect_list(F.struct("range_start", "range_end", put.alias("put")))).alias("__e"))
    done = computed(done, "__u", utf16(F.col("before_text")))  # encoded once for all gaps
    gap = lambda a, b: F.decode(F.substring(F.col("__u"), 2 * a + 1, 2 * (b - a)), "UTF-16LE")
    before = lambda i: F.coalesce(F.get(F.col("__e"), i - 1)["range_end"], F.lit(0))
    head = F.array_join(F.transform("__e", lambda x, i: F.concat(gap(before(i), x["range_start"]), x["put"])), "")
    tail = gap(before(F.size("__e")), utf16_length(F.col("before_text")))
    return done.select("doc_id", "part", "para_id", "edits", "before_text", F.concat(head, tail).alias("after_text"))


def stats(log: DataFrame) -> DataFrame:
    applied = F.col("status") == "applied"
    return log.groupBy("doc_id").agg(
        F.count("*").alias("input_ops"), F.count_if(applied).alias("applied_ops"), F.count_if(~applied).alias("skipped_ops"),
        F.count_if(applied & (F.col("type") == "add_comment")).alias("applied_comment_ops"), F.count_if(applied & (F.col("type") != "add_comment")).alias("applied_edit_ops"),
        *[F.count_if(F.col("reason") == r).alias(f"skipped_{r}") for r in ("snippet_mismatch", "target_not_found", "range_out_of_bounds")],
    )


def skip_breakdown(log: DataFrame) -> DataFrame:
    return log.filter("status <> 'applied'").groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def reconcile(patch: DataFrame, log: DataFrame) -> DataFrame:
    """Documents whose patch and log differ in their numbers of ops."""
    p = patch.groupBy("doc_id").agg(F.count("*").alias("patch_ops"))
    done = log.groupBy("doc_id").agg(F.count("*").alias("log_ops"))
    return p.join(done, "doc_id", "full_outer").fillna(0).filter("patch_ops <> log_ops")
