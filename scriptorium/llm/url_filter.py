"""URL filters by a temporal list join, with DataFrame functions only.

A list is a log of dated entries: a pattern is added or removed. Each entry is valid until the
next one for the same list and pattern, so the log becomes disjoint validity intervals, and the
entry in force at a capture's fetch time (an as-of join) is the interval that holds that time: an
equi-join on the pattern's key with a range condition.

A URL has the keys of its host, of every domain that its host belongs to, and of every prefix of
its path. Captures are reduced to distinct (URL, fetch time) pairs first, and keys are salted, so
a host or domain with a large share of the captures is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 32
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case, without a last dot; empty where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")


def path_of(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(url, PATH, 1), "/+$", "")


def intervals(entries: DataFrame) -> DataFrame:
    """entries(list, effect, kind, pattern, action, at) to (list, effect, token, since, until).

    kind: host, domain (the host or one above it) or prefix (host and path up to a slash);
    effect: block or allow; action: add or remove. Entries with a null in these columns are left
    out; of entries for one pattern at one time the removal comes last. until is null for the last.
    """
    named = entries.dropna(subset=["list", "effect", "kind", "pattern", "action", "at"])
    pattern = F.regexp_replace(F.regexp_replace("pattern", "/+$", ""), r"\.+$", "")
    head = F.lower(F.substring_index(pattern, "/", 1))
    tail = F.substring(pattern, F.length(F.substring_index(pattern, "/", 1)) + 1, F.length(pattern))
    named = named.withColumn("token", F.concat(F.substring("kind", 1, 1), F.lit(":"), head, F.when(F.col("kind") == "prefix", tail).otherwise("")))
    w = Window.partitionBy("list", "effect", "token").orderBy("at", "action")
    return named.withColumn("until", F.lead("at").over(w)).filter("action = 'add' and (until is null or until > at)").select("list", "effect", "token", F.col("at").alias("since"), "until")


def tokens(url: Column) -> Column:
    """The keys under which entries for this URL may be listed."""
    host, path = host_of(url), path_of(url)
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    steps = F.when(F.size(parts) > 1, F.sequence(F.lit(2), F.size(parts))).otherwise(F.array().cast("array<int>"))
    prefixes = F.transform(steps, lambda i: F.concat(F.lit("p:"), host, F.array_join(F.slice(parts, F.lit(1), i), "/")))
    own = F.array(F.concat(F.lit("h:"), host), F.concat(F.lit("p:"), host))
    return F.when(host != "", F.array_distinct(F.concat(own, domains, prefixes))).otherwise(F.array().cast("array<string>"))


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """All rows and columns of captures with active (entries in force at the fetch time), blocked_by
    (names of blocking lists, sorted, comma between; empty where none) and kept.

    A capture is kept if no blocking entry is in force or an allowing one is. Null URLs, URLs
    without a host and null times match no entry and are kept. Repeated rows stay repeated; an
    empty list keeps everything; empty captures stay empty. Columns with the names of new ones
    are replaced.
    """
    spans = intervals(entries).select("list", "effect", "token", "since", "until", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    visits = captures.select(captures[url].alias("u"), captures[at].alias("t")).filter("u is not null and t is not null").distinct()
    asked = visits.select("u", "t", F.pmod(F.xxhash64("u", "t"), F.lit(SALTS)).alias("salt"), F.explode(tokens(F.col("u"))).alias("token"))
    asof = asked.join(spans, ["token", "salt"]).filter("since <= t and (until is null or t < until)")
    verdict = asof.groupBy("u", "t").agg(
        F.count("*").alias("active"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("effect") == "block", F.col("list")))), ",").alias("blocked_by"),
        F.max(F.when(F.col("effect") == "allow", True).otherwise(False)).alias("allowed"),
    )
    rest = [c for c in captures.columns if c not in ("active", "blocked_by", "kept")]
    joined = captures.select(*rest).join(verdict, (captures[url] == verdict["u"]) & (captures[at] == verdict["t"]), "left")
    blocked = F.coalesce("blocked_by", F.lit(""))
    return joined.select(*[captures[c] for c in rest], F.coalesce("active", F.lit(0)).cast("long").alias("active"), blocked.alias("blocked_by"), ((blocked == "") | F.coalesce("allowed", F.lit(False))).alias("kept"))
