"""Overrides of a patch by actions: drop an op, or make it a comment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def resolve(actions: DataFrame, patch: DataFrame) -> DataFrame:
    """actions(doc_id, action, op_index, op_id, comment_text, seq) with patch_pos and ignored (why,
    or null). op_index wins where it is given; op_id names the first op with that dedup_key."""
    by_index = patch.select("doc_id", F.col("patch_pos").alias("op_index"), F.col("patch_pos").alias("__a"))
    by_key = patch.groupBy("doc_id", F.col("dedup_key").alias("op_id")).agg(F.min("patch_pos").alias("__b"))
    joined = actions.join(by_index, ["doc_id", "op_index"], "left").join(by_key, ["doc_id", "op_id"], "left")
    at = F.when(F.col("op_index").isNotNull(), F.col("__a")).otherwise(F.col("__b"))
    blank = strip(F.coalesce("comment_text", F.lit(""))) == ""
    why = F.when(at.isNull(), "unresolved_op_reference").when((F.col("action") == "downgrade_to_comment") & blank, "missing_comment_text")
    why = why.when(~F.coalesce(F.col("action").isin("drop_op", "downgrade_to_comment"), F.lit(False)), "unsupported_action_type")
    return joined.withColumns({"patch_pos": at, "ignored": why}).drop("__a", "__b")


def apply_overrides(patch: DataFrame, actions: DataFrame) -> DataFrame:
    """The final patch. A dropped op goes whatever else is asked for it; of several texts for a
    comment the last (by seq) holds."""
    use = resolve(actions, patch).filter("ignored is null")
    by_op = use.groupBy("doc_id", "patch_pos").agg(
        F.max(F.col("action") == "drop_op").alias("__drop"), F.max(F.when(F.col("action") == "downgrade_to_comment", F.struct("seq", strip(F.col("comment_text")).alias("t")))).alias("__last")
    )
    joined = patch.join(by_op, ["doc_id", "patch_pos"], "left").filter("not coalesce(__drop, false)")
    down = F.col("__last").isNotNull()
    none = F.lit(None).cast("string")
    return joined.withColumns({
        "type": F.when(down, "add_comment").otherwise(F.col("type")),
        "comment_text": F.when(down, F.col("__last.t")).otherwise(F.col("comment_text")),
        "replacement": F.when(down, none).otherwise(F.col("replacement")),
        "new_text": F.when(down, none).otherwise(F.col("new_text")),
    }).drop("__drop", "__last")


def override_report(patch: DataFrame, actions: DataFrame) -> DataFrame:
    acts = resolve(actions, patch).groupBy("doc_id").agg(F.count("*").alias("actions_in"), F.count_if(F.col("ignored").isNull()).alias("actions_applied"), F.count_if(F.col("ignored").isNotNull()).alias("actions_ignored"))
    merged = patch.groupBy("doc_id").agg(F.count("*").alias("merged_ops"))
    final = apply_overrides(patch, actions).groupBy("doc_id").agg(F.count("*").alias("final_ops"))
    return merged.join(acts, "doc_id", "left").join(final, "doc_id", "left").fillna(0)
