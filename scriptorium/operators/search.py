"""Search in units: every hit with its UTF-16 span and a window of text around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.offsets import utf16_offset
from ..functions.spans import computed, literal_pattern, may_match_empty, python_spans, with_spans

ASTRAL = r"[\x{10000}-\x{10FFFF}]"
KEYS = ("doc_id", "part", "para_id", "unit_uid", "order_index")


def search(units: DataFrame, query: str, regex: bool = False, ignore_case: bool = False, snippet_chars: int = 40) -> DataFrame:
    """Hits in document order: keys, start, end, match_text and snippet (snippet_chars code points
    on each side). Empty matches are no hits. A cheap filter drops units without a match before
    spans are computed; patterns that may match the empty string run in Python."""
    if not query:
        raise ValueError("the query is empty")
    if regex and may_match_empty(query):
        found = units.withColumn("found", python_spans(query, ignore_case)(F.col("accepted_text")))
        hit = found.select(*KEYS, "accepted_text", F.explode("found").alias("m"))
        before = F.decode(F.substring(F.encode("accepted_text", "UTF-16LE"), F.lit(1), 2 * F.col("m.start")), "UTF-16LE")
        hit = hit.withColumn("at", F.length(before))
    else:
        pattern = (("(?iu)" if ignore_case else "") + query) if regex else literal_pattern(query, ignore_case)
        some = units.filter(F.col("accepted_text").rlike(pattern)).select(*KEYS, "accepted_text")
        # only texts with characters beyond the basic plane have other offsets in code units
        some = computed(some, "astral", F.col("accepted_text").rlike(ASTRAL))
        points = with_spans(some, "found", F.col("accepted_text"), pattern).select(*KEYS, "accepted_text", "astral", F.explode("found").alias("p"))
        unit = lambda at: F.when(F.col("astral"), utf16_offset(F.col("accepted_text"), at)).otherwise(at)
        hit = points.select(*KEYS, "accepted_text", F.struct(unit(F.col("p.start")).alias("start"), unit(F.col("p.end")).alias("end"), F.col("p.value").alias("value")).alias("m"), F.col("p.start").alias("at"))
    low = F.greatest(F.lit(0), F.col("at") - snippet_chars)
    snippet = F.substring("accepted_text", low + 1, F.col("at") + F.length("m.value") + snippet_chars - low)
    return hit.select(*KEYS, F.col("m.start").alias("start"), F.col("m.end").alias("end"), F.col("m.value").alias("match_text"), snippet.alias("snippet"))


def ordered(hits: DataFrame) -> DataFrame:
    return hits.orderBy("doc_id", "order_index", "start")


def summary(units: DataFrame, hits: DataFrame) -> DataFrame:
    """One row: units searched, hits and units with a hit."""
    every = units.agg(F.count("*").alias("unit_count"))
    found = hits.groupBy("doc_id", "part", "para_id", "unit_uid").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("hit_count"), F.count("*").alias("hit_unit_count"))
    return every.crossJoin(F.broadcast(found))  # one row each
