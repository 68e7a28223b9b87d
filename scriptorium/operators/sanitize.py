"""Sanitizing of raw proposals: the first rule that an op breaks, and its normalized target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..conf import REVIEW_TYPES
from ..functions.fuzzy import derive_ranges
from ..functions.offsets import utf16_slice
from ..functions.text import strip


def valid_range(start: Column, end: Column) -> Column:
    return F.coalesce((start >= 0) & (end >= start), F.lit(False))


def reason() -> Column:
    """Why an op is dropped, null if it is kept; rules in their order of evaluation. An absent
    replacement is an error, an empty one deletes."""
    kind = F.col("type")
    return (
        F.when(~F.coalesce(kind.isin(*REVIEW_TYPES), F.lit(False)), "invalid_type")
        .when(F.col("primary_uid").isNull(), "non_primary_target")
        .when(~valid_range(F.col("range_start"), F.col("range_end")), "missing_range")
        .when((kind == "replace_range") & F.col("replacement").isNull(), "missing_replacement")
        .when((kind == "insert_at") & (F.col("range_start") != F.col("range_end")), "non_collapsed_range")
        .when((kind == "insert_at") & F.col("new_text").isNull(), "missing_new_text")
        .when((kind == "insert_at") & (F.col("new_text") == ""), "empty_new_text")
        .when((kind == "add_comment") & (strip(F.coalesce("comment_text", F.lit(""))) == ""), "missing_comment_text")
    )


def sanitize(ops: DataFrame, members: DataFrame) -> DataFrame:
    """ops with reason; targets are found by unit_uid alone among the chunk's primary units, whose
    part and para_id replace those of the op."""
    own = members.filter("role = 'primary'").select(F.col("doc_id").alias("__d"), F.col("chunk_id").alias("__c"), F.col("unit_uid").alias("primary_uid"), F.col("part").alias("own_part"), F.col("para_id").alias("own_para"))
    same = (F.col("doc_id") == F.col("__d")) & (F.col("chunk_id") == F.col("__c")) & (strip(F.col("unit_uid")) == F.col("primary_uid"))
    joined = ops.join(own, same, "left").drop("__d", "__c")
    return joined.withColumns({"part": F.coalesce("own_part", "part"), "para_id": F.coalesce("own_para", "para_id"), "reason": reason()}).drop("own_part", "own_para", "primary_uid")


def anchored(ops: DataFrame, members: DataFrame) -> DataFrame:
    """ops with the range of their quote where they have one and no range: the quote's place in the
    chunk's primary unit, exact or by similarity. Other ops stay as they are."""
    wants = F.col("quoted_text").isNotNull() & (F.col("range_start").isNull() | F.col("range_end").isNull())
    texts = members.filter("role = 'primary'").select("doc_id", "chunk_id", "unit_uid", "accepted_text")
    open_ = ops.filter(wants).withColumn("__uid", strip(F.col("unit_uid"))).join(texts.withColumnRenamed("unit_uid", "__uid"), ["doc_id", "chunk_id", "__uid"], "left").drop("__uid")
    found = derive_ranges(open_)
    found = found.withColumns({"range_start": F.coalesce("found_start", "range_start"), "range_end": F.coalesce("found_end", "range_end")})
    # the text at the range is what the later stages guard
    own = F.when(F.col("found_start").isNotNull() & F.col("snippet").isNull(), utf16_slice(F.col("accepted_text"), F.col("range_start"), F.col("range_end"))).otherwise(F.col("snippet"))
    return ops.filter(~wants).unionByName(found.withColumn("snippet", own).select(*ops.columns))


def conversions(sanitized: DataFrame) -> DataFrame:
    """One row for each chunk with a dropped op: the reasons with the ops' positions, in order."""
    entry = F.struct("op_index", "reason")
    dropped = sanitized.filter("reason is not null").groupBy("doc_id", "chunk_id").agg(F.array_sort(F.collect_list(entry)).alias("c"))
    return dropped.select("doc_id", "chunk_id", F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["op_index"].cast("string"), x["reason"])), ",").alias("conversions"))


def totals(logs: DataFrame) -> DataFrame:
    """The counts of log() over all chunks of a document, and of all documents in summaries' order."""
    return logs.groupBy("doc_id").agg(F.count("*").alias("chunks"), *[F.sum(c).alias(c) for c in ("input_op_count", "output_op_count", "converted_ops")])


def summaries(logs: DataFrame) -> DataFrame:
    """The counts of log() with place, from 1 in each document, by chunk id."""
    return logs.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk_id")))


def log(sanitized: DataFrame) -> DataFrame:
    """Counts of each chunk: input, kept and dropped ops."""
    return sanitized.groupBy("doc_id", "chunk_id").agg(F.count("*").alias("input_op_count"), F.count_if(F.col("reason").isNull()).alias("output_op_count"), F.count_if(F.col("reason").isNotNull()).alias("converted_ops"))
