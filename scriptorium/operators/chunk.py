"""Chunks: units packed in order under a token budget, with read-only neighbours as context."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..conf import Budget


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(text) / 4)).cast("int")


def chunk_name(index: Column) -> Column:
    """chunk_0001 and so on; numbers of more than four digits stay whole."""
    number = (index + 1).cast("string")
    return F.concat(F.lit("chunk_"), F.when(index < 9999, F.lpad(number, 4, "0")).otherwise(number))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _greedy(sizes: pd.Series, target: pd.Series) -> pd.Series:
    """The chunk of each size, in order: a size that takes the running sum over the target opens one."""

    def one(tokens, most: int) -> list[int]:
        out, chunk, total = [], -1, 0
        for n in tokens.tolist():
            total += n
            if chunk < 0 or total > most:
                chunk, total = chunk + 1, n
            out.append(chunk)
        return out

    return pd.Series([one(t, m) for t, m in zip(sizes, target, strict=True)], dtype=object)


def pack(units: DataFrame, budget: Budget) -> DataFrame:
    """units with token_estimate and chunk_index. A unit opens a new chunk if it would take the
    running sum over the target. Packing has to follow the order, so a document is one fold, done
    in Arrow batches of many documents; only sizes, not texts, are gathered for it."""
    sized = units.withColumn("token_estimate", token_estimate(F.col("accepted_text")))
    # sizes are made from the units again, not read back from a shuffle with their texts
    sizes = sized.select("doc_id", "order_index", "token_estimate").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("order_index", "token_estimate"))).alias("u"))
    numbers = sizes.select("doc_id", F.inline(F.arrays_zip(F.col("u.order_index").alias("order_index"), _greedy(F.col("u.token_estimate"), F.lit(budget.target)).alias("chunk_index"))))
    return sized.join(numbers, ["doc_id", "order_index"])


def chunk_units(packed: DataFrame, budget: Budget) -> DataFrame:
    """The long form: a row for each chunk and unit with role (primary, context_before or
    context_after), editable, pos and token_estimate. Context is trimmed to the hard maximum, the
    side after first; a chunk that alone exceeds it has none."""
    edges = packed.groupBy("doc_id", "chunk_index").agg(F.min("order_index").alias("first"), F.max("order_index").alias("last"), F.sum("token_estimate").alias("primary"))
    primary = packed.withColumn("role", F.lit("primary"))
    sides = []
    for role, count, place in (("context_before", budget.overlap_before_units, "first"), ("context_after", budget.overlap_after_units, "last")):
        if not count:
            continue
        away = F.explode(F.sequence(F.lit(1), F.lit(count))).alias("away")
        wanted = edges.select("doc_id", F.col("chunk_index").alias("of"), "primary", place, away)
        wanted = wanted.withColumn("order_index", F.col(place) - F.col("away") if place == "first" else F.col(place) + F.col("away"))
        side = packed.join(wanted.select("doc_id", "of", "primary", "away", "order_index"), ["doc_id", "order_index"])
        sides.append(side.withColumns({"chunk_index": F.col("of"), "role": F.lit(role)}))
    if sides:
        context = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        # before, nearest first, then after: kept while the sum stays within the hard maximum
        w = Window.partitionBy("doc_id", "chunk_index").orderBy(F.col("role") == "context_after", "away").rowsBetween(Window.unboundedPreceding, 0)
        context = context.withColumn("total", F.col("primary") + F.sum("token_estimate").over(w)).filter(F.col("total") <= budget.hard_max_tokens)
        primary = primary.unionByName(context.drop("of", "primary", "away", "total"))
    pos = F.row_number().over(Window.partitionBy("doc_id", "chunk_index", "role").orderBy("order_index")) - 1
    return primary.withColumns({"editable": F.col("role") == "primary", "pos": pos, "chunk_id": chunk_name(F.col("chunk_index"))})


def manifest(members: DataFrame, budget: Budget) -> DataFrame:
    """One row per chunk: spans, unit counts, token sums and flags."""
    role = lambda name, c: F.coalesce(F.sum(F.when(F.col("role") == name, c)), F.lit(0))
    own = lambda c: F.when(F.col("role") == "primary", c)
    out = members.groupBy("doc_id", "chunk_id", "chunk_index").agg(
        F.min(own(F.col("order_index"))).alias("start_order_index"), F.max(own(F.col("order_index"))).alias("end_order_index"),
        role("primary", F.lit(1)).alias("primary_unit_count"), role("context_before", F.lit(1)).alias("context_before_count"), role("context_after", F.lit(1)).alias("context_after_count"),
        role("primary", F.col("token_estimate")).alias("primary_tokens"), role("context_before", F.col("token_estimate")).alias("context_before_tokens"), role("context_after", F.col("token_estimate")).alias("context_after_tokens"),
    )
    out = out.withColumn("total_tokens", F.col("primary_tokens") + F.col("context_before_tokens") + F.col("context_after_tokens"))
    return out.withColumns({"is_within_hard_max": F.col("total_tokens") <= budget.hard_max_tokens, "allowed_overflow": (F.col("total_tokens") > budget.hard_max_tokens) & (F.col("primary_unit_count") == 1)})
