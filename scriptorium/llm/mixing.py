"""Mixing sources to target weights, with DataFrame functions only.

The words of each source are packed, document after document in a pseudorandom order, into
blocks of fixed length. A source's quota of slots follows from its target. Every output shard has
the same number of slots, and each slot draws its source with the quotas as weights, so a shard's
source counts are multinomial. A source's counts, one shard after another, number its slots. Free
draws miss the targets of small sources by their own noise, so there is a last step: the slots of
a source beyond its quota go, in their order, to the sources that fell short. The number of a
slot goes through the source's pseudorandom permutation of its blocks (a new permutation for each
pass over the source), and slots and blocks meet in an equi-join.

The last slot of a source may take only the first words of its block, so a source's words come
to its target rounded to a whole word. No block is used in more passes than the cap.

Slots are drawn once and numbered once, into tables. Their sizes as files, and what the planner
makes of sequences that are exploded, say little about their rows in memory, so joins with a side
that grows with the corpus are merge joins by hint: none of them is broadcast through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sharding import bucket_count, shuffle_hash, stratum
from ..tables import drop, keep
from .words import JAVA_TOKEN, count_words

PRIME, HIGH = 2147483647, 2147483648
#: Rounds of the index permutations.
ROUNDS = 10
#: Shards whose slots are made together, and whose counts are summed together.
RUN = 8


def targets(sizes: DataFrame, share: float, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """sizes(__s, __size) with __id (place by code point, null last), __w and __target.

    Targets are in proportion to the weights and sum to share times all words. None exceeds cap
    times its source; the excess goes to the others by weight. The sources that stop at the cap are
    those with the lowest cap-to-weight ratio, so one running sum over the sources finds them.
    """
    ordered = Window.orderBy(F.col("__s").startswith("n"), "__s")
    place = sizes.withColumn("__id", F.row_number().over(ordered) - 1)
    rule = "".join(f" when {i} then {w}D" for i, w in enumerate(weights))
    place = place.withColumn("__w", F.expr(f"case __id % {len(weights)}{rule} end")).withColumn("__most", cap * F.col("__size"))
    ratio = Window.orderBy(F.col("__most") / F.col("__w"), "__id")
    upto, everything = ratio.rowsBetween(Window.unboundedPreceding, 0), ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped_before, weight_before = F.sum("__most").over(upto) - F.col("__most"), F.sum("__w").over(upto) - F.col("__w")
    level = (share * F.sum("__size").over(everything) - capped_before) / (F.sum("__w").over(everything) - weight_before)
    place = place.withColumn("__level", level).withColumn("__free", F.col("__level") * F.col("__w") <= F.col("__most"))
    # the first source that is not capped sets the level of all that follow
    level = F.first(F.when(F.col("__free"), F.col("__level")), ignorenulls=True).over(everything)
    return place.withColumn("__target", F.least(F.col("__most"), F.coalesce(level * F.col("__w"), F.col("__most")))).drop("__free", "__level", "__most")


def _rounds(x: str, n: str, salt: str, div: str) -> tuple[str, str, str]:
    """SQL of a round (step) of a permutation of 0 to n - 1: the mirror image m of place v around a
    key, a mixture y of the larger of place w and m, and from y whether they swap. All products
    stay below 2^63; places above 2^31 take part with their high and their low digits."""
    a, b = f"(({salt} * 7919 + step * 1299721 + 12345) % {PRIME})", f"(({salt} * 104729 + step * 611953 + 1) % {PRIME})"
    mirror = f"((({a} * 48271 % {PRIME}) * {HIGH} + {b} * 69621 % {PRIME}) % {n} + {n} - v) % {n}"
    mixed = f"((greatest(w, m) % {PRIME}) * ({a} % 65536 + 1) + (greatest(w, m) {div} {PRIME}) * ({b} % 65536 + 1) + {b}) % {PRIME}"
    return mirror, mixed, f"(y * ((y + {a}) % {PRIME}) % {PRIME}) {div} 64 % 2 = 1"


def permuted(x: str, n: str, salt: str) -> str:
    """SQL for a pseudorandom permutation of 0 to n - 1 (long numbers): a swap-or-not shuffle. Each
    round pairs every place with its mirror image around a key, and a bit of the pair decides
    whether they swap. Lists of one element hand values on within a round."""
    mirror, mixed, swap = _rounds(x, n, salt, "div")
    inner = f"aggregate(array({mixed}), w, (u, y) -> if({swap}, m, u))"
    return f"aggregate(sequence(1L, {ROUNDS}L), cast({x} as bigint), (v, step) -> aggregate(array({mirror}), v, (w, m) -> {inner}))"


def permuted_sql(x: str, n: str, salt: str) -> str:
    """The same permutation in DuckDB's SQL."""
    mirror, mixed, swap = _rounds(x, n, salt, "//")
    mixed = mixed.replace("greatest(w, m)", f"greatest(v, {mirror})")
    swap = swap.replace("y", f"({mixed})")
    return f"list_reduce(list_prepend(cast({x} as bigint), range(1, {ROUNDS + 1})), lambda v, step: case when {swap} then {mirror} else v end)"


def plan(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = (3, 1, 2), block: int = 128, shard_slots: int = 1024, seed: int = 0, text: bool = False, carry: str | None = None, source: str = "source", key: str = "doc_id", body: str = "text") -> DataFrame:
    """What each document gives to the mix: a row for every use of a piece of a document, and one
    with null shard for a document no piece of which is used.

    Columns: key, size (words; null text: 0), source_size, target, __row (names the row of docs),
    block, begin (the piece's first word in the document), words (0 where nothing is used), pass,
    shard, slot and, with text=True, the piece's text with the white space before its words;
    carry names a column of docs to hand on.

    Null sources are one source, the last. The list of sources is one row on its way, as weights
    are given for each. Documents without words and empty tables give no
    pieces. Rows with equal keys are packed in the order of their sizes and text hashes; rows
    equal in all of that are interchangeable. Other columns of docs are not read.
    """
    base = docs.select(
        docs[key].alias(key), count_words(docs[body]).alias("size"), stratum(docs[source]).alias("__s"), shuffle_hash(docs[key], seed, F.md5(docs[body])).alias("__h"),
        F.md5(docs[body]).alias("__t"), *([docs[body].alias("__text")] if text else []), *([docs[carry].alias("__carried")] if carry else []),
    )
    buckets = bucket_count(docs.count())
    base = base.withColumn("__b", F.expr(f"(__h * {buckets}) div 4294967296"))
    if text:
        sums, _ = keep(base.groupBy("__s", "__b").agg(F.sum("size").alias("__c")), "mix-sums")
    else:  # words are counted once
        base, _ = keep(base, "mix-sizes")
        sums = base.groupBy("__s", "__b").agg(F.sum("size").alias("__c"))
    sources, sources_at = keep(targets(sums.groupBy("__s").agg(F.sum("__c").alias("__size")), share, cap, weights), "mix-sources")

    before = F.sum("__c").over(Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__c")
    sums = sums.select("__s", "__b", before.alias("__before")).join(sources.select("__s", "__id", "__size", "__target"), "__s")
    inside = Window.partitionBy("__s", "__b").orderBy("__h", key, "size", "__t")
    placed = base.withColumns({"__r": F.row_number().over(inside), "__start": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")})
    placed = placed.join(sums.hint("merge"), ["__s", "__b"]).withColumn("__start", F.col("__start") + F.col("__before"))

    piece = f"greatest(b * {block}L, __start) - __start as begin, least((b + 1) * {block}L, __start + size) - greatest(b * {block}L, __start) as n"
    piece = f"struct(b as block, {piece}" + (f", array_join(slice(w, cast(greatest(b * {block}L, __start) - __start + 1 as int), cast(least((b + 1) * {block}L, __start + size) - greatest(b * {block}L, __start) as int)), '') as text)" if text else ")")
    if text:
        placed = placed.withColumn("w", F.regexp_extract_all("__text", F.lit(JAVA_TOKEN), F.lit(0)))
    pieces = placed.select(
        key, "size", F.col("__size").alias("source_size"), F.col("__target").alias("target"), "__id", F.struct("__id", "__b", "__r").alias("__row"), "__start", *(["__carried"] if carry else []),
        F.expr(f"inline_outer(if(size > 0, transform(sequence(__start div {block}, (__start + size - 1) div {block}), b -> {piece}), null))"),
    )

    slots = draw(sources, block, shard_slots, seed)
    offset = F.expr(f"__start + begin - block * {block}L")
    used = pieces.join(slots.hint("merge"), ["__id", "block"], "left").withColumn("words", F.greatest(F.lit(0), F.least(offset + F.col("n"), F.coalesce("take", F.lit(0))) - offset))
    if text:  # of the last block of a source perhaps only the first words are taken
        part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(JAVA_TOKEN), F.lit(0)), F.lit(1), F.col("words").cast("int")), "")
        used = used.withColumn("text", F.when(F.col("words") == F.col("n"), F.col("text")).when(F.col("words") > 0, part))
    return used.select(key, "size", "source_size", "target", "__row", "block", "begin", F.coalesce("words", F.lit(0)).cast("long").alias("words"), "pass", "shard", "slot", *(["text"] if text else []), *([F.col("__carried").alias(carry)] if carry else []))


def draw(sources: DataFrame, block: int, shard_slots: int, seed: int) -> DataFrame:
    """The slots of all output shards: shard, slot, __id, pass, block and take (words of the block).
    Every shard but the last has shard_slots slots."""
    quota = sources.filter("__size > 0").select("__id", "__size", F.expr("cast(round(__target) as bigint)").alias("__words"))
    quota = quota.withColumns({"__n": F.expr(f"(__size + {block - 1}) div {block}"), "__whole": F.expr(f"__size div {block}"), "__full": F.expr("__words div __size")})
    quota = quota.withColumn("__q", F.expr(f"__full * __n + (__words - __full * __size + {block - 1}) div {block}")).filter("__q > 0")
    shape = quota.agg(F.array_sort(F.collect_list(F.struct("__id", "__q"))).alias("__all"), F.sum("__q").alias("__slots")).filter("__slots > 0")
    bounds = F.transform("__all", lambda _, i: F.aggregate(F.slice("__all", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, s: a + s["__q"]) / F.col("__slots"))
    shape = shape.select("__slots", bounds.alias("__to"), F.expr(f"(__slots + {shard_slots - 1}) div {shard_slots}").alias("__shards"), F.col("__all.__id").alias("__ids"))
    runs = shape.select("*", F.explode(F.expr(f"sequence(0L, (__shards - 1) div {RUN})")).alias("__run"))
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = runs.repartition(tasks, "__run").select("*", F.explode(F.expr(f"sequence(__run * {RUN}, least(__shards, (__run + 1) * {RUN}) - 1)")).alias("shard"))
    slots = shards.select("__ids", "__to", "__run", "shard", F.explode(F.expr(f"sequence(0L, least({shard_slots}L, __slots - shard * {shard_slots}) - 1)")).alias("slot"))
    chance = shuffle_hash(F.concat_ws(":", "shard", "slot"), seed + 1) / F.lit(4294967296)
    # the first source whose share of the running sum of quotas lies above the chance
    place = F.size(F.filter("__to", lambda t: t <= F.col("__u")))
    # read twice: for the counts and for the slots
    drawn, drawn_at = keep(slots.withColumn("__u", chance).select("__run", "shard", "slot", F.get(F.col("__ids"), place).alias("__id")), "mix-drawn")

    counts, counts_at = keep(drawn.groupBy("__id", "__run", "shard").agg(F.count("*").alias("__c")), "mix-counts")
    upto = lambda w: F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__c")
    by_run = counts.groupBy("__id", "__run").agg(F.sum("__c").alias("__c"))
    by_run = by_run.select("__id", "__run", upto(Window.partitionBy("__id").orderBy("__run")).alias("__run_first"))
    first = counts.withColumn("__first", upto(Window.partitionBy("__id", "__run").orderBy("shard"))).join(by_run.hint("merge"), ["__id", "__run"])
    first = first.select("__id", "shard", (F.col("__first") + F.col("__run_first")).alias("__first"))
    own = Window.partitionBy("shard", "__id").orderBy("slot")
    numbered = drawn.withColumn("__i", F.row_number().over(own)).join(first.hint("merge"), ["shard", "__id"]).withColumn("__i", F.col("__first") + F.col("__i") - 1)

    # the last step: what a source has beyond its quota, and what the others lack
    got = quota.join(counts.groupBy("__id").agg(F.sum("__c").alias("__got")), "__id", "left").fillna(0, ["__got"])
    got = got.withColumns({"__over": F.greatest(F.lit(0), F.col("__got") - F.col("__q")), "__lack": F.greatest(F.lit(0), F.col("__q") - F.col("__got"))})
    order = Window.orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    got = got.withColumns({"__over_first": F.sum("__over").over(order) - F.col("__over"), "__lack_first": F.sum("__lack").over(order) - F.col("__lack")})
    short, _ = keep(got.select("__id", "__q", "__got", "__over_first", "__lack_first", "__lack"), "mix-short")
    inside, _ = keep(numbered.select("shard", "slot", "__id", "__i").join(short.select("__id", "__q", "__over_first"), "__id").withColumn("__spare", F.col("__i") - F.col("__q")), "mix-numbered")
    drop(sources.sparkSession, drawn_at, counts_at)
    stay = inside.filter("__spare < 0").select("shard", "slot", "__id", "__i")
    spare = inside.filter("__spare >= 0").select("shard", "slot", (F.col("__over_first") + F.col("__spare")).alias("__r"))
    wanted = short.filter("__lack > 0").select(F.col("__id"), F.explode(F.expr("sequence(0L, __lack - 1)")).alias("__j"), "__got", "__lack_first")
    wanted = wanted.select("__id", (F.col("__got") + F.col("__j")).alias("__i"), (F.col("__lack_first") + F.col("__j")).alias("__r"))
    slots = stay.union(spare.join(wanted.hint("merge"), "__r").select("shard", "slot", "__id", "__i"))

    # few bytes here, but much work for each row: adaptive planning would put them into few tasks
    slots = slots.repartition(tasks, "shard", "slot").join(quota.select("__id", "__size", "__n", "__whole", "__full", "__words"), "__id")
    slots = slots.withColumns({"pass": F.expr("__i div __n"), "__j": F.expr("__i % __n")})
    # the short block at a source's end stays last, so the words before an index are known
    place = permuted("__j", "__whole", f"(__id * 2 + pass + {seed % 1000} * 1009)")
    # a generator, so that filters on the block don't compute it once more
    slots = slots.select("*", F.explode(F.array(F.expr(f"if(__j < __whole, {place}, __j)"))).alias("block"))
    length = f"if(block < __whole, {block}L, __size - __whole * {block}L)"
    slots = slots.withColumn("take", F.expr(f"if(pass < __full, {length}, least({length}, __words - __full * __size - __j * {block}L))"))
    return slots.select("__id", "block", "pass", "take", "shard", "slot")


def taken(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs: key, size, source_size, target, taken (words that the mix takes,
    repeats counted) and first_shard (the first output shard that takes some; null where none does)."""
    key = options.get("key", "doc_id")
    use = plan(docs, **options)
    first = F.min(F.when(F.col("words") > 0, F.col("shard"))).alias("first_shard")
    return use.groupBy("__row", key, "size", "source_size", "target").agg(F.sum("words").alias("taken"), first).drop("__row")


def blocks(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: shard, slot, words and text of every block, documents in packing order."""
    use = plan(docs, text=True, **options).filter("words > 0")
    part = F.array_sort(F.collect_list(F.struct("__row", "begin", "text")))
    return use.groupBy("shard", "slot").agg(F.sum("words").alias("words"), F.array_join(F.transform(part, lambda p: F.ltrim(p["text"])), " ").alias("text"))


def documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: for each pass, what it takes of a document, in the document's order,
    with the other columns of the document. A column n_chars gets the new text's length."""
    key, body = options.get("key", "doc_id"), options.get("body", "text")
    source = options.get("source", "source")
    # places in a written table don't change, so texts stay out of the plan and join its result once
    rows, _ = keep(docs.withColumn("__rid", F.monotonically_increasing_id()), "mix-rows")
    use = plan(rows.select(key, body, source, "__rid"), carry="__rid", **options).filter("words > 0")
    part = use.groupBy("__rid", "pass").agg(F.array_sort(F.collect_list(F.struct("begin", "words"))).alias("parts"))
    passes = part.groupBy("__rid").agg(F.array_sort(F.collect_list(F.struct("pass", "parts"))).alias("__passes"))
    split = rows.join(passes.hint("merge"), "__rid").withColumn("__w", F.regexp_extract_all(body, F.lit(JAVA_TOKEN), F.lit(0)))
    taken = "transform(__passes, p -> array_join(flatten(transform(p.parts, q -> slice(__w, cast(q.begin + 1 as int), cast(q.words as int)))), ''))"
    out = split.select(*[c for c in docs.columns if c != body], F.explode(F.expr(taken)).alias(body))
    column = {c: F.col(c) for c in docs.columns}
    if "n_chars" in column:
        column["n_chars"] = F.length(body).cast(docs.schema["n_chars"].dataType)
    return out.select(*[column[c].alias(c) for c in docs.columns])
