"""The registered queries of the training-data operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, jaccard_join, langid, mixing, passages, quality, sharding, token_files, toxicity, url_filter


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The test tables have neither fetch times nor a list. Both are made from ids and hosts by fixed
#: arithmetic: a capture time in 2024 for each page, and a log of entries for the hosts that occur.
_EPOCH, _DAY = 1704067200, 86400


def _captures(pages):
    return pages.select("page_id", "url", F.expr(f"{_EPOCH} + (page_id * 37 % 366) * {_DAY} + page_id * 7919 % {_DAY}").alias("fetched_at"))


def _entries(pages):
    host = url_filter.host_of(F.col("url"))
    hosts = pages.select(host.alias("host")).filter("host <> ''").distinct()
    number = lambda c: F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")
    hosts = hosts.withColumn("domain", F.substring_index("host", ".", -3)).withColumns({"h": number("host"), "d": number("domain")})
    entry = "if({when}, named_struct('list', '{list}', 'effect', '{effect}', 'kind', '{kind}', 'pattern', {pattern}, 'action', '{action}', 'at', {epoch} + ({day}) * {length}), null)"
    log = [entry.format(when=w, list=n, effect=e, kind=k, pattern=p, action=a, day=d, epoch=f"{_EPOCH}L", length=_DAY) for w, n, e, k, p, a, d in _LOG]
    return hosts.select(F.explode(F.array_compact(F.expr(f"array({', '.join(log)})"))).alias("e")).select("e.*").distinct()


#: When, list, effect, kind, pattern, action and day of the entries of a host.
_LOG = (
    ("h % 4 = 0", "spam", "block", "host", "host", "add", "h % 200"),
    ("h % 8 = 0", "spam", "block", "host", "host", "remove", "h % 200 + 60"),
    ("h % 16 = 0", "spam", "block", "host", "host", "add", "h % 200 + 120"),
    ("d % 6 = 1", "malware", "block", "domain", "domain", "add", "d % 300"),
    ("h % 3 = 0", "region", "block", "prefix", "concat(host, '/fr')", "add", "30"),
    ("h % 3 = 0", "region", "block", "prefix", "concat(host, '/fr')", "remove", "200"),
    ("h % 12 = 0", "partners", "allow", "host", "host", "add", "100"),
)


def op1_url_filters(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(_captures(pages), _entries(pages))


_SQL_LOG = " union all ".join(f"select '{n}' as list, '{e}' as effect, '{k[0]}:' || {p} as token, '{a}' as action, {_EPOCH} + ({d}) * {_DAY} as since from hosts where {w}" for w, n, e, k, p, a, d in _LOG)
OP1_SQL = rf"""
with captures as (
  select page_id, url, {_EPOCH} + (page_id * 37 % 366) * {_DAY} + page_id * 7919 % {_DAY} as fetched_at,
    rtrim(lower(regexp_extract(url, '{url_filter.HOST}', 1)), '.') as host, rtrim(regexp_extract(url, '{url_filter.PATH}', 1), '/') as path
  from pages),
names as (select distinct host from captures where host <> ''),
hosts as (
  select host, array_to_string(string_split(host, '.')[-3:], '.') as domain, cast('0x' || substr(md5(host), 1, 8) as bigint) as h,
    cast('0x' || substr(md5(array_to_string(string_split(host, '.')[-3:], '.')), 1, 8) as bigint) as d
  from names),
log as (select distinct * from ({_SQL_LOG})),
spans as (select *, lead(since) over (partition by list, effect, token order by since, action) as until from log),
asked as (
  select distinct page_id, url, fetched_at, token from (
    select page_id, url, fetched_at, unnest(list_concat(['h:' || host, 'p:' || host],
      list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: 'd:' || array_to_string(string_split(host, '.')[i:], '.')),
      list_transform(range(2, len(string_split(path, '/')) + 1), lambda i: 'p:' || host || array_to_string(string_split(path, '/')[1:i], '/')))) as token
    from captures where host <> '')),
verdict as (
  select page_id, count(*) as active, array_to_string(list_sort(list_distinct(list(list) filter (where effect = 'block'))), ',') as blocked_by, bool_or(effect = 'allow') as allowed
  from asked join spans using (token) where action = 'add' and since <= fetched_at and (until is null or fetched_at < until) group by page_id)
select c.page_id, c.url, c.fetched_at, coalesce(active, 0) as active, coalesce(blocked_by, '') as blocked_by,
  coalesce(blocked_by, '') = '' or coalesce(allowed, false) as kept
from captures c left join verdict v using (page_id)
"""


def op2_source_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return mixing.taken(docs).select("doc_id", "size", "source_size", "target", "taken", "first_shard")


def op3_benchmark_decontamination(spark, sf_dir):
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.contaminated(docs, benchmark)
    return found.select("doc_id", "item_id", "coverage", "tiles", "longest", F.lit(True).alias("contaminated"))


def op4_substring_dedup(spark, sf_dir):
    return passages.repeated(_table(spark, sf_dir, "documents")).drop("__doc")


def op5_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality.measure(docs.select("doc_id", "text")).drop("text", "repeat_spans")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_token_files(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return token_files.round_trip(docs, tokenizer_path())


def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.link(_table(spark, sf_dir, "documents"))


def _fold(folds: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op8_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs, _fold(4) != 2)
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, _fold(5) != 0)
    out = toxicity.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted", "offending")


def op10_sharding(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    docs = docs.select(
        "doc_id", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    out = sharding.interleave(docs, 40, ties=("size", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _hash(*parts: str, seed: int = 0) -> str:
    return f"cast('0x' || substr(md5('{seed}:' || " + " || ':' || ".join(f"coalesce(cast({p} as varchar), '')" for p in parts) + "), 1, 8) as bigint)"


OP2_SQL = rf"""
with docs as (select doc_id, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size, coalesce('s' || source, 'n') as s, {_hash('doc_id', 'md5(text)')} as h, md5(text) as t from documents),
placed as (select *, cast(sum(size) over (partition by s order by h nulls first, doc_id nulls first, size, t nulls first rows unbounded preceding) as bigint) - size as start from docs),
sources as (select *, [3.0, 1.0, 2.0][id % 3 + 1]::double as w, 2.0::double * total as most from (select s, cast(sum(size) as bigint) as total, row_number() over (order by starts_with(s, 'n'), s) - 1 as id from docs group by s)),
levels as (select *, (1.5::double * sum(total) over () - (sum(most) over u - most)) / (sum(w) over () - (sum(w) over u - w)) as level from sources window u as (order by most / w, id rows unbounded preceding)),
targets as (select *, least(most, coalesce((select level from levels where level * w <= most order by most / w, id limit 1) * w, most)) as target from levels),
quotas as (select *, cast(round(target) as bigint) as words, total // 128 as whole, (total + 127) // 128 as n, case when total > 0 then cast(round(target) as bigint) // total else 0 end as full_passes from targets),
wanted as (select *, sum(q) over (order by id) / sum(q) over () as upto from (select *, full_passes * n + (words - full_passes * total + 127) // 128 as q from quotas where total > 0) where q > 0),
slots as (select shard, slot, (select min_by(id, upto) from wanted where upto > u) as id from (
  select g // 1024 as shard, g % 1024 as slot, {_hash('g // 1024', 'g % 1024', seed=1)} / 4294967296.0::double as u from (select unnest(range((select cast(sum(q) as bigint) from wanted))) as g))),
numbered as (select *, row_number() over (partition by id order by shard, slot) - 1 as i from slots),
counted as (select id, q, coalesce(got, 0) as got from wanted left join (select id, count(*) as got from slots group by id) using (id)),
spare as (select shard, slot, row_number() over (order by id, i) as r from numbered join counted using (id) where i >= q),
lacking as (select id, got + j as i, row_number() over (order by id, j) as r from (select id, got, unnest(range(q - got)) as j from counted where q > got)),
final as (select shard, id, i from numbered join counted using (id) where i < q union all select shard, id, i from spare join lacking using (r)),
used as (select f.shard, w.s, i // n as pass, i % n as j, whole, total, full_passes, words, case when i % n < whole then {mixing.permuted_sql("(i % n)", "greatest(1, whole)", "(f.id * 2 + i // n)")} else i % n end as block from final f join wanted w on w.id = f.id),
takes as (select s, shard, block, case when pass < full_passes then len else least(len, words - full_passes * total - j * 128) end as take from (select *, case when block < whole then 128 else total - whole * 128 end as len from used)),
part as (select p.s, p.start, p.doc_id, sum(greatest(0, least(p.start + p.size, b.block * 128 + b.take) - greatest(p.start, b.block * 128))) as words,
    min(b.shard) filter (where least(p.start + p.size, b.block * 128 + b.take) > greatest(p.start, b.block * 128)) as first_shard
  from placed p join takes b on b.s = p.s and b.block between p.start // 128 and (p.start + p.size - 1) // 128 where p.size > 0 group by all)
select p.doc_id, p.size, q.total as source_size, q.target, cast(coalesce(part.words, 0) as bigint) as taken, cast(first_shard as bigint) as first_shard
from placed p join quotas q using (s) left join part on part.s = p.s and part.start = p.start and part.doc_id is not distinct from p.doc_id and p.size > 0
"""
_CRC_STEP = "list_reduce(list_prepend(n, range(8)), lambda a, k: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end)"
OP10_SQL = f"""
with steps as (select list_transform(range(256), lambda n: {_CRC_STEP}) as t),
docs as (
  select doc_id, coalesce('s' || source, 'n') as s, cast(coalesce(strlen(text), 0) + 16 as bigint) as size,
    xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: cast('0x' || x as bigint))), lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), cast(4294967295 as bigint)) as text_crc32
  from documents, steps),
hashed as (select *, {_hash('doc_id', 'size', 'text_crc32')} as h from docs),
ranked as (select *, row_number() over (partition by s order by h, doc_id nulls first, size, text_crc32) as r, count(*) over (partition by s) as n, count(*) over () as total from hashed),
placed as (select *, row_number() over (order by (2 * r - 1)::double / (2 * n), s) - 1 as pos from ranked)
select doc_id, size, text_crc32, 'rows' as law, cast(pos * 40 // total as integer) as shard, cast(pos - (pos * 40 // total * total + 39) // 40 as bigint) as slot, cast(null as integer) as grown_shard from placed
"""

QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_source_mixing": op2_source_mixing,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_token_files": op6_token_files,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_sharding": op10_sharding,
}
ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": OP1_SQL,
    "op2_source_mixing": OP2_SQL,
    "op10_sharding": OP10_SQL,
}
