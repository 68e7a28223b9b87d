"""Sharding by proportional stratified interleaving, with DataFrame functions only.

The rows of each source are put in a seeded pseudorandom order. The row with rank r of n gets
the fractional rank (2r - 1) / 2n, all rows are sorted by it, and the sorted sequence is cut
into shards of equal row counts, so every shard holds each source in its overall proportion.

Neither the ranks nor the cut need one task to see a whole source. Ranks come from buckets of
the shuffle hash: rows are numbered inside (source, bucket) and start from the prefix sum of the
bucket counts. How many rows of a source fall into a bucket of fractional ranks follows from
its row count alone, so the global positions need no second counting pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows aimed at in a bucket, and the most buckets of one source.
BUCKET_ROWS, MOST_BUCKETS = 1000, 65536


def shuffle_hash(key: Column, seed: int, *more: Column) -> Column:
    """A 32-bit hash of the key's text (null: empty) that any SQL engine with md5 can repeat. More
    columns keep rows with equal keys apart."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (key, *more)]
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws(":", *parts))), 1, 8), 16, 10).cast("long")


def bucket_count(rows: int, least: int = 16) -> int:
    return min(MOST_BUCKETS, max(least, -(-rows // BUCKET_ROWS)))


def stratum(source: Column) -> Column:
    """A key that is never null: null sources form a stratum of their own."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def interleave(docs: DataFrame, shards: int, seed: int = 0, source: str = "source", key: str = "doc_id", ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds shard (0 to shards - 1) and slot (gapless from 0 in each shard) to all columns of docs.

    Shard row counts are at most one apart. Null sources are a stratum. The shuffle follows a hash
    of the key (null: empty) and of the columns in ties, so very many rows with one key are spread;
    rows equal in all of these are interchangeable. An empty table gives an empty table. The columns added here replace
    columns of docs with the same names; names that start with `__` are reserved.
    """
    rows = docs.count()
    buckets = bucket_count(rows)
    base = docs.drop("shard", "slot").withColumns({"__s": stratum(docs[source]), "__h": shuffle_hash(docs[key], seed, *[docs[c] for c in ties])})
    base = base.withColumn("__b", F.expr(f"(__h * {buckets}) div 4294967296"))

    counts = base.groupBy("__s", "__b").agg(F.count("*").alias("__c"))
    by_source = Window.partitionBy("__s")
    counts = counts.select(
        "__s", "__b",
        (F.sum("__c").over(by_source.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__c")).alias("__before"),
        F.sum("__c").over(by_source).alias("__n"),
    )
    order = ["__h", key, *ties]
    ranked = base.withColumn("__r", F.row_number().over(Window.partitionBy("__s", "__b").orderBy(*order)))
    ranked = ranked.join(counts, ["__s", "__b"]).withColumn("__odd", 2 * (F.col("__before") + F.col("__r")) - 1)
    ranked = ranked.withColumns({"__f": F.col("__odd") / (2 * F.col("__n")), "__g": F.expr(f"(__odd * {buckets}) div (2 * __n)")})

    merged = _fraction_counts(base, buckets)
    place = F.row_number().over(Window.partitionBy("__g").orderBy("__f", "__s"))
    ranked = ranked.withColumn("__p", place).join(merged, "__g").withColumn("__p", F.col("__first") + F.col("__p") - 1)
    ranked = ranked.withColumn("shard", F.expr(f"cast((__p * {shards}) div {max(rows, 1)} as int)"))
    ranked = ranked.withColumn("slot", F.col("__p") - F.expr(f"(shard * cast({rows} as bigint) + {shards - 1}) div {shards}"))
    return ranked.select(*[c for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")


def _fraction_counts(base: DataFrame, buckets: int) -> DataFrame:
    """For each bucket of fractional ranks, how many rows of all sources come before it."""
    sources = base.groupBy("__s").agg(F.count("*").alias("__n"))
    # a source with fewer rows than buckets is counted row by row, any other bucket by bucket
    k = sources.select("__n", F.explode(F.expr(f"sequence(0L, least(__n, {buckets}L) - 1)")).alias("__k"))
    upto = lambda b: f"(((({b}) * 2 * __n - 1) div {buckets} + 1) div 2)"  # noqa: E731  ranks r with (2r - 1) * buckets < b * 2n
    few = F.col("__n") < buckets
    parts = k.select(
        F.when(few, F.expr(f"((2 * __k + 1) * {buckets}) div (2 * __n)")).otherwise(F.col("__k")).alias("__g"),
        F.when(few, F.lit(1)).otherwise(F.expr(f"{upto('__k + 1')} - if(__k = 0, 0, {upto('__k')})")).alias("__c"),
    )
    total = parts.groupBy("__g").agg(F.sum("__c").alias("__c"))
    before = F.sum("__c").over(Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__c")
    return total.select("__g", before.alias("__first"))
