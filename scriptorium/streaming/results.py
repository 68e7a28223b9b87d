"""Streams of chunk results and of events. The batch result stays the authority: a late op could
change which of two colliding ops came first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import dedup_key
from ..sources.artifacts import RESULT_DDL


def result_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The ops of result files as they arrive, with the time of their file."""
    files = spark.readStream.schema(RESULT_DDL).option("multiLine", True).option("pathGlobFilter", "chunk_*_result.json").json(folder)
    ops = files.select("chunk_id", F.col("_metadata.file_modification_time").alias("arrived"), F.posexplode("ops").alias("op_index", "o"))
    return ops.select(
        "chunk_id", "arrived", "op_index", "o.type", F.col("o.target.part").alias("part"), F.col("o.target.para_id").alias("para_id"), F.col("o.target.unit_uid").alias("unit_uid"),
        F.col("o.range.start").alias("range_start"), F.col("o.range.end").alias("range_end"), F.col("o.expected.snippet").alias("snippet"), "o.replacement", "o.new_text", "o.comment_text",
    )


def first_ops(ops: DataFrame, late: str = "10 minutes") -> DataFrame:
    """One of equal ops that arrive within the watermark."""
    return ops.withColumn("dedup_key", dedup_key()).withWatermark("arrived", late).dropDuplicatesWithinWatermark(["dedup_key"])


def event_windows(events: DataFrame, size: str = "1 hour", slide: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by kind in sliding windows; late rows beyond the watermark are dropped in streams."""
    out = events.withWatermark("ts", late).groupBy(F.window("ts", size, slide), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return out.select(F.col("window.start").alias("start_at"), F.col("window.end").alias("end_at"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """A user's events without a longer gap between them."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start_at"), F.col("session_window.end").alias("end_at"), "n")
