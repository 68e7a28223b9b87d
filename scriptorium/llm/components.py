"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import drop, keep


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) to (v, label): every vertex with the smallest vertex of its component.

    The graph is contracted until no edge is left. In a round every vertex goes to the one with
    the smallest hash among itself and its neighbours, and from there to that one's choice; edges
    follow, and those that have become one or a loop go. Hashes are in no order along paths, so a
    constant share of the vertices goes in each round and all rounds together cost little more
    than the first. The choices, composed from the last to the first, are the components.

    All tables go through the shared folder. Minima are aggregated before the shuffle, and the
    joins are between plain tables, so a vertex with very many edges is split over tasks. No edges
    give no rows.
    """
    spark = edges.sparkSession
    pairs = edges.select("a", "b").filter("a <> b")
    left, left_at = keep(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    choices, paths = [], []
    while not left.isEmpty():
        near = left.groupBy("a").agg(F.min_by("b", F.xxhash64("b")).alias("b"))
        smaller = F.expr("xxhash64(b) < xxhash64(a) or (xxhash64(b) = xxhash64(a) and b < a)")
        hop, hop_at = keep(near.select(F.col("a").alias("v"), F.when(smaller, F.col("b")).otherwise(F.col("a")).alias("p")), "hops")
        chosen, at = keep(hop.join(hop.select(F.col("v").alias("p"), F.col("p").alias("q")), "p").select("v", F.col("q").alias("p")), "chosen")
        choices.append(chosen)
        to = lambda x: chosen.select(F.col("v").alias(x), F.col("p").alias(f"{x}_to"))  # noqa: B023, E731
        moved = left.join(to("a"), "a").join(to("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).filter("a <> b").distinct()
        after, after_at = keep(moved, "edges")
        drop(spark, hop_at, left_at)
        paths.append(at)
        left, left_at = after, after_at
    if not choices:
        drop(spark, left_at)
        return spark.createDataFrame([], "v long, label long")
    total = choices.pop()
    for chosen in reversed(choices):
        total = chosen.join(total.select(F.col("v").alias("p"), F.col("p").alias("q")), "p", "left").select("v", F.coalesce("q", "p").alias("p"))
    total, total_at = keep(total, "roots")
    # every root has chosen itself, so it has a row of its own
    least = total.groupBy("p").agg(F.min("v").alias("label"))
    labels, _ = keep(total.join(least, "p").select("v", "label"), "labels")
    drop(spark, left_at, total_at, *paths)
    return labels
