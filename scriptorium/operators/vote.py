"""Ensemble vote: what most of several review runs propose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..conf import EDIT_TYPES
from ..functions.offsets import overlap
from .merge import as_comment


def vote(proposals: DataFrame, runs: int) -> DataFrame:
    """proposals(doc_id, run, dedup_key, ...): the ops that more than half of the runs propose, with votes."""
    votes = proposals.groupBy("doc_id", "dedup_key").agg(F.count_distinct("run").alias("votes"))
    return votes.filter(2 * F.col("votes") > runs)


def settle(ops: DataFrame, votes: DataFrame) -> DataFrame:
    """ops that have votes, with votes and outcome. Of edits of a paragraph that collide the one
    with most votes is kept and the others are outvoted; where the most votes are equal, the edits
    are tied and become comments. Comments never collide. These rules are this engine's own."""
    won = ops.join(votes, ["doc_id", "dedup_key"])
    edits = won.filter(F.col("type").isin(*EDIT_TYPES)).select("doc_id", "part", "para_id", "dedup_key", "range_start", "range_end", "votes")
    a, b = edits.alias("a"), edits.alias("b")
    c = F.col
    meet = (c("a.doc_id") == c("b.doc_id")) & (c("a.part") == c("b.part")) & (c("a.para_id") == c("b.para_id")) & (c("a.dedup_key") != c("b.dedup_key"))
    meet &= overlap(c("a.range_start"), c("a.range_end"), c("b.range_start"), c("b.range_end"))
    rival = a.join(b, meet).groupBy(c("a.doc_id").alias("doc_id"), c("a.dedup_key").alias("dedup_key")).agg(F.max("b.votes").alias("__most"))
    out = won.join(rival, ["doc_id", "dedup_key"], "left")
    out = out.withColumn("outcome", F.when(F.col("__most") > F.col("votes"), "outvoted").when(F.col("__most") == F.col("votes"), "tied").otherwise("kept")).drop("__most")
    return as_comment(out, F.col("outcome") == "tied", F.concat(F.lit("Tied vote: "), F.col("type")))


def missing(proposals: DataFrame, chunks: DataFrame, runs: int) -> DataFrame:
    """Chunks for which a run has no proposal file."""
    seen = proposals.groupBy("doc_id", "chunk_id").agg(F.count_distinct("run").alias("runs"))
    return chunks.select("doc_id", "chunk_id").join(seen, ["doc_id", "chunk_id"], "left").fillna(0).filter(F.col("runs") < runs)
