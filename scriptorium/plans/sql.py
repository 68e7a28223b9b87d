"""The registered queries in SQL for DuckDB.

Each query is a chain of named steps and a final SELECT. Offsets are counted in code points,
which equals UTF-16 code units on tables without characters beyond the basic plane.
"""

from __future__ import annotations

from ..conf import ADJACENT_GAP, BODY, DRY_RUN_COMMENT, DRY_RUN_INSERT, QUERY_BUDGET, WORD
from ..operators.report import CONTEXT, GUIDANCE
from .queries import FIXES, LITERAL, REGEX, RUNS

_WORD = WORD.replace("'", "''")
_TARGET, _HARD = QUERY_BUDGET.target, QUERY_BUDGET.hard_max_tokens


def _ids(doc: str, part: str, index: str) -> str:
    joined = f"{doc} || '|' || {part} || '|' || {index}"
    return f"'para_' || substr(sha256({joined}), 1, 16) as para_id, 'unit_' || substr(sha256('unit|' || {joined}), 1, 12) as unit_uid"


def _spans(text: str, pattern: str) -> str:
    """Unnested matches with their offsets, from the lengths of gaps and matches before them."""
    before = "cast(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as integer)"
    return f"""select * exclude (m, g, i), m[i] as value, {before} as s, {before} + length(m[i]) as e from (
      select *, unnest(range(1, len(m) + 1)) as i from (select *, regexp_extract_all({text}, '{pattern}') as m, regexp_split_to_array({text}, '{pattern}') as g from units))"""


def _overlap(a: str, b: str, c: str, d: str) -> str:
    return f"case when {a} = {b} and {c} = {d} then {a} = {c} when {a} = {b} then {c} <= {a} and {a} <= {d} when {c} = {d} then {a} <= {c} and {c} <= {b} else greatest({a}, {c}) < least({b}, {d}) end"


def _occurrences(text: str, snippet: str) -> str:
    return f"case when coalesce({snippet}, '') = '' then 0 else cast((length({text}) - length(replace({text}, {snippet}, ''))) // length({snippet}) as integer) end"


def _chunk_id(index: str) -> str:
    return f"'chunk_' || lpad(cast({index} + 1 as varchar), cast(greatest(4, length(cast({index} + 1 as varchar))) as integer), '0')"


STEPS: dict[str, tuple[str, tuple[str, ...]]] = {}


def _step(name: str, sql: str, *needs: str) -> None:
    STEPS[name] = (sql, needs)


_step("units", rf"""
  select doc_id, '{BODY}' as part, 'body' as part_kind, cast(i as integer) as paragraph_index_in_part, t as accepted_text,
    cast(row_number() over (partition by doc_id order by i) - 1 as integer) as order_index, {_ids('doc_id', f"'{BODY}'", 'i')}
  from (select doc_id, unnest(string_split(text, chr(10))) as t, unnest(range(len(string_split(text, chr(10))))) as i from documents) where regexp_matches(t, '\S')""")
_step("page_units", rf"""
  select *, cast(row_number() over (partition by doc_id order by paragraph_index_in_part) - 1 as integer) as order_index, {_ids('doc_id', 'part', 'paragraph_index_in_part')} from (
    select page_id as doc_id, case when tag = 'footer' then 'page/footer' else 'page/body' end as part, case when tag = 'footer' then 'footer' else 'body' end as part_kind,
      cast(row_number() over (partition by page_id order by place) - 1 as integer) as paragraph_index_in_part, tag, trim(regexp_replace(t, '<[^>]*>', '', 'g'), ' ' || chr(9) || chr(10) || chr(13)) as accepted_text
    from (select page_id, place, lower(split_part(piece, chr(2), 1)) as tag, substr(piece, strpos(piece, chr(2)) + 1) as t from (
      select page_id, unnest(pieces) as piece, unnest(range(len(pieces))) as place from (
        select page_id, string_split(regexp_replace(html, '(?i)<(/?(?:h[1-6]|p|li|footer|ul|ol|dl|dt|dd|div|nav|header|main|section|article|aside|table|thead|tbody|tr|td|th|form|body|html|head|title|script|style))\b[^>]*>', chr(1) || '\1' || chr(2), 'g'), chr(1)) as pieces from pages)))
    where regexp_full_match(tag, 'h[1-6]|p|li|footer')
  ) where accepted_text <> ''""")
_step("pages_with_headings", "select *, " + ", ".join(
    f"max_by(accepted_text, order_index) filter (where tag = 'h{n}') over w as t{n}, max(order_index) filter (where tag = 'h{n}') over w as o{n}, max(order_index) filter (where tag in ({', '.join(repr(f'h{m}') for m in range(1, n)) or repr('none')})) over w as c{n}"
    for n in range(1, 7)) + " from page_units window w as (partition by doc_id order by order_index rows unbounded preceding)", "page_units")
_step("sized", "select *, greatest(1, cast(ceil(length(accepted_text) / 4.0) as integer)) as tok from units", "units")
_step("pk", f"""
  select doc_id, order_index, tok, 0 as chunk_index, tok as running from sized where order_index = 0
  union all
  select s.doc_id, s.order_index, s.tok, p.chunk_index + cast(p.running + s.tok > {_TARGET} as integer), case when p.running + s.tok > {_TARGET} then s.tok else p.running + s.tok end
  from pk p join sized s on s.doc_id = p.doc_id and s.order_index = p.order_index + 1""", "sized")
_step("edges", "select doc_id, chunk_index, min(order_index) as f, max(order_index) as l, sum(tok) as p from pk group by all", "pk")
_step("context", """
  select *, p + sum(tok) over (partition by doc_id, chunk_index order by side rows unbounded preceding) as total from (
    select e.doc_id, e.chunk_index, e.p, u.order_index, u.tok, 'context_before' as role, 0 as side from edges e join pk u on u.doc_id = e.doc_id and u.order_index = e.f - 1
    union all
    select e.doc_id, e.chunk_index, e.p, u.order_index, u.tok, 'context_after' as role, 1 as side from edges e join pk u on u.doc_id = e.doc_id and u.order_index = e.l + 1)""", "edges", "pk")
_step("members", f"""
  select *, {_chunk_id('chunk_index')} as chunk_id from (
    select doc_id, chunk_index, 'primary' as role, order_index, tok from pk union all select doc_id, chunk_index, role, order_index, tok from context where total <= {_HARD})""", "pk", "context")
_role = lambda name, c: f"cast(coalesce(sum({c}) filter (where role = '{name}'), 0) as bigint)"
_step("chunks", f"""
  select *, primary_tokens + context_before_tokens + context_after_tokens as total_tokens from (
    select doc_id, chunk_id, chunk_index, min(order_index) filter (where role = 'primary') as start_order_index, max(order_index) filter (where role = 'primary') as end_order_index,
      {", ".join(f"{_role(r, '1')} as {n}" for r, n in (("primary", "primary_unit_count"), ("context_before", "context_before_count"), ("context_after", "context_after_count")))},
      {", ".join(f"{_role(r, 'tok')} as {r}_tokens" for r in ("primary", "context_before", "context_after"))}
    from members group by doc_id, chunk_id, chunk_index)""", "members")
_step("words", _spans("accepted_text", _WORD), "units")
_step("ranked", """
  select *, row_number() over (partition by doc_id, order_index order by s) as r
  from (select *, count(*) over (partition by doc_id, order_index, value) as c from words) where c = 1""", "words")
_step("four", f"""
  select w.*, p.chunk_index, u.accepted_text as t, u.part, u.para_id, u.unit_uid, b.part as b_part, b.para_id as b_para, b.unit_uid as b_uid, cast('0x' || substr(sha256(u.unit_uid), 1, 8) as bigint) % 12 as h
  from (select doc_id, order_index, {", ".join(f"max({c}) filter (where r = {i + 1}) as {n}{i}" for i in range(4) for c, n in (("s", "s"), ("e", "e"), ("value", "v")))} from ranked where r <= 4 group by all having count(*) = 4) w
  join units u using (doc_id, order_index) join pk p using (doc_id, order_index) left join units b on b.doc_id = w.doc_id and b.order_index = w.order_index - 1""", "ranked", "units", "pk")


def _quote(s: str, e: str) -> str:
    return f"substr(t, greatest(0, {s} - 15) + 1, {s} - greatest(0, {s} - 15)) || '[[' || substr(t, {s} + 1, {e} - {s}) || ']]' || substr(t, {e} + 1, 15)"


def _op(k: int, kind: str, s: str, e: str, when: str = "true", quoted: str = "null", snippet: str | None = None, repl: str = "null", new: str = "null", comment: str = "null", ranged: bool = True, target: str = "part, para_id, unit_uid") -> str:
    shown = snippet or f"substr(t, {s} + 1, {e} - {s})"
    return f"select doc_id, chunk_index, order_index, {k} as k, '{kind}' as type, {target}, {quoted} as quoted_text, {s if ranged else 'null'} as range_start, {e if ranged else 'null'} as range_end, {shown} as snippet, {repl} as replacement, {new} as new_text, {comment} as comment_text from four where {when}"


_SHOUT = "case when upper(v1) = v1 then v1 || '_DRYRUN' else upper(v1) end"
_GAP = "substr(t, greatest(0, e2 - 20) + 1, e2 - greatest(0, e2 - 20)) || '[[ ]]' || substr(t, e2 + 1, 20)"
_DRY = [
    _op(0, "replace_range", "s1", "e1", quoted=_quote("s1", "e1"), repl=_SHOUT),
    _op(1, "insert_at", "e2", "e2", quoted=_GAP, new=f"'{DRY_RUN_INSERT}'"),
    _op(2, "replace_range", "s3", "e3", quoted=_quote("s3", "e3"), repl="''"),
    _op(3, "add_comment", "s0", "e0", quoted=_quote("s0", "e0"), comment=f"'{DRY_RUN_COMMENT}'"),
]
_EXTRA = [
    _op(4, "replace_range", "s1", "e1", "h = 0", quoted=_quote("s1", "e1"), repl=_SHOUT),
    _op(4, "replace_range", "s1 + 1", "e1 + 1", "h = 1", snippet="substr(t, s1 + 2, e1 - s1)", repl="'XXXX'"),
    _op(4, "replace_range", "s0", "e0", "h = 2", repl="'FIRST'", target="part, para_id, null as unit_uid"),
    _op(4, "replace_range", "s0", "e0", "h = 3", repl="'FILLED'", ranged=False),
    _op(4, "replace_range", "s0", "e0", "h = 4", snippet="'e'", repl="'E'", ranged=False),
    _op(4, "replace_range", "s0", "e0", "h = 5", snippet="'NOT_FOUND'", repl="'E'", ranged=False),
    _op(4, "add_comment", "0", "0", "h = 6", snippet="''", comment="'context'", target="b_part, b_para, b_uid"),
    _op(4, "unknown_type", "s0", "e0", "h = 7"),
    _op(4, "add_comment", "s0", "e0", "h = 8", comment="'  '"),
    _op(4, "insert_at", "s0", "e0", "h = 9", new="'x'"),
    _op(4, "replace_range", "s0", "e0", "h = 10"),
    _op(4, "insert_at", "s0", "s0", "h = 11", new="''"),
]
_step("ops", f"select *, {_chunk_id('chunk_index')} as chunk_id, cast(row_number() over (partition by doc_id, chunk_index order by order_index, k) - 1 as integer) as op_index from (" + " union all ".join(_DRY + _EXTRA) + ")", "four")
_step("mem", "select m.doc_id, m.chunk_id, m.role, u.part, u.para_id, u.unit_uid from members m join units u using (doc_id, order_index)", "members", "units")
_step("sanitized", r"""
  select o.* replace (coalesce(m.part, o.part) as part, coalesce(m.para_id, o.para_id) as para_id), case when o.type not in ('add_comment', 'replace_range', 'insert_at') then 'invalid_type' when m.unit_uid is null then 'non_primary_target'
      when not coalesce(range_start >= 0 and range_end >= range_start, false) then 'missing_range' when o.type = 'replace_range' and replacement is null then 'missing_replacement'
      when o.type = 'insert_at' and range_start <> range_end then 'non_collapsed_range' when o.type = 'insert_at' and new_text is null then 'missing_new_text'
      when o.type = 'insert_at' and new_text = '' then 'empty_new_text' when o.type = 'add_comment' and not regexp_matches(coalesce(comment_text, ''), '\S') then 'missing_comment_text' end as reason
  from ops o left join mem m on m.doc_id = o.doc_id and m.chunk_id = o.chunk_id and m.unit_uid = o.unit_uid and m.role = 'primary'""", "ops", "mem")
_step("owned", r"""
  select v.* exclude (unit_uid), coalesce(v.unit_uid, '') = '' and coalesce(primaries = 1, false) as autofilled,
    case when coalesce(v.unit_uid, '') = '' and coalesce(primaries = 1, false) then only_uid else v.unit_uid end as unit_uid,
    case when coalesce(v.unit_uid, '') = '' and primaries > 1 then 'missing_unit_uid_ambiguous_primary_match'
      when (coalesce(v.unit_uid, '') = '' and coalesce(primaries = 1, false)) or coalesce(is_primary, false) then null
      when is_primary is not null then 'target_is_context_unit' else 'target_not_owned_by_chunk' end as owner_reason
  from (select * from ops where type in ('add_comment', 'replace_range', 'insert_at', 'delete_range') and
      case type when 'replace_range' then replacement is not null when 'insert_at' then coalesce(new_text <> '', false) when 'add_comment' then regexp_matches(coalesce(comment_text, ''), '\S') else true end) v
  left join (select doc_id, chunk_id, part, para_id, unit_uid, bool_or(role = 'primary') as is_primary from mem group by all) r using (doc_id, chunk_id, part, para_id, unit_uid)
  left join (select doc_id, chunk_id, part, para_id, count(*) as primaries, min(unit_uid) as only_uid from mem where role = 'primary' group by all) p using (doc_id, chunk_id, part, para_id)""", "ops", "mem")
_step("counted", f"""
  select o.* exclude (order_index), u.accepted_text, u.order_index, case when range_start is null or range_end is null then {_occurrences('u.accepted_text', 'snippet')} end as n
  from owned o join units u using (doc_id, unit_uid) where owner_reason is null""", "owned", "units")
_step("resolved", """
  select * replace (case when n = 1 then strpos(accepted_text, snippet) - 1 when n > 1 then 0 else range_start end as range_start, case when n = 1 then strpos(accepted_text, snippet) - 1 + length(snippet) when n > 1 then 0 else range_end end as range_end,
      case when n > 1 then 'Ambiguous snippet: ' || type else comment_text end as comment_text, case when n > 1 then null else replacement end as replacement, case when n > 1 then null else new_text end as new_text, case when n > 1 then 'add_comment' else type end as type),
    case when n = 1 then 'filled' when n > 1 then 'range_resolution_ambiguous_snippet' when n = 0 then 'range_resolution_snippet_not_found' end as range_event
  from counted""", "counted")
_KEY = "sha256(concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in ("type", "part", "para_id", "unit_uid", "range_start", "range_end", "snippet", "replacement", "new_text", "comment_text")) + "))"
_step("deduped", f"""
  select * from (select *, row_number() over (partition by doc_id, dedup_key order by chunk_id, op_index) as first_n from (
    select *, {_KEY} as dedup_key from resolved where coalesce(range_event, '') <> 'range_resolution_snippet_not_found')) where first_n = 1""", "resolved")
_step("edits", "select doc_id, part, para_id, chunk_id, op_index, range_start as rs, range_end as re, row_number() over (partition by doc_id, part, para_id order by chunk_id, op_index) as n from deduped where type in ('replace_range', 'insert_at', 'delete_range')", "deduped")
_hit = f"len(list_filter(g.kept, lambda k: {_overlap('k.s', 'k.e', 'e.rs', 'e.re')})) > 0"
_step("greedy", f"""
  select doc_id, part, para_id, chunk_id, op_index, n, false as down, [struct_pack(s := rs, e := re)] as kept from edits where n = 1
  union all
  select e.doc_id, e.part, e.para_id, e.chunk_id, e.op_index, e.n, {_hit}, case when {_hit} then g.kept else list_append(g.kept, struct_pack(s := e.rs, e := e.re)) end
  from greedy g join edits e on e.doc_id = g.doc_id and e.part = g.part and e.para_id = g.para_id and e.n = g.n + 1""", "edits")
_step("downgraded", """
  select d.* replace (case when coalesce(down, false) then 'Conflict downgrade: ' || d.type else comment_text end as comment_text, case when coalesce(down, false) then null else replacement end as replacement,
      case when coalesce(down, false) then null else new_text end as new_text, case when coalesce(down, false) then 'add_comment' else d.type end as type), coalesce(down, false) as downgraded
  from deduped d left join (select doc_id, chunk_id, op_index, down from greedy) g using (doc_id, chunk_id, op_index)""", "deduped", "greedy")
_step("patch", "select *, cast(row_number() over (partition by doc_id order by order_index, range_start desc, range_end desc, chunk_id, op_index) - 1 as integer) as patch_pos from downgraded", "downgraded")
_step("actions", """
  select doc_id, patch_pos as seq, 'drop_op' as action, patch_pos as op_index, cast(null as varchar) as op_id, cast(null as varchar) as comment_text from patch where patch_pos % 7 = 0
  union all select doc_id, patch_pos, 'downgrade_to_comment', null, dedup_key, 'Checked by hand.' from patch where patch_pos % 5 = 0
  union all select doc_id, patch_pos, 'drop_op', 100000, null, null from patch where patch_pos = 1
  union all select doc_id, patch_pos, 'downgrade_to_comment', patch_pos, null, ' ' from patch where patch_pos = 2
  union all select doc_id, patch_pos, 'rewrite', patch_pos, null, null from patch where patch_pos = 3""", "patch")
_step("acts", r"""
  select *, case when at_pos is null then 'unresolved_op_reference' when action = 'downgrade_to_comment' and not regexp_matches(coalesce(comment_text, ''), '\S') then 'missing_comment_text'
    when action not in ('drop_op', 'downgrade_to_comment') then 'unsupported_action_type' end as ignored
  from (select a.*, case when a.op_index is not null then i.patch_pos else k.patch_pos end as at_pos from actions a left join patch i on i.doc_id = a.doc_id and i.patch_pos = a.op_index
    left join (select doc_id, dedup_key, min(patch_pos) as patch_pos from patch group by all) k on k.doc_id = a.doc_id and k.dedup_key = a.op_id)""", "actions", "patch")
_step("final", """
  select p.* replace (case when u.txt is not null then 'add_comment' else p.type end as type, case when u.txt is not null then u.txt else p.comment_text end as comment_text)
  from patch p left join (select doc_id, at_pos, bool_or(action = 'drop_op') as dropped, max_by(comment_text, seq) filter (where action = 'downgrade_to_comment') as txt from acts where ignored is null group by all) u
    on u.doc_id = p.doc_id and u.at_pos = p.patch_pos where not coalesce(dropped, false)""", "acts", "patch")
_step("spoiled", """
  select * replace (case when patch_pos % 11 = 3 and range_start < range_end then 'WRONG' else snippet end as snippet, case when patch_pos % 13 = 5 then 'para_none' else para_id end as para_id,
    case when patch_pos % 17 = 7 then range_end + 100000 else range_end end as range_end) from patch""", "patch")
_step("log", """
  select *, case when reason is null then 'applied' else 'skipped' end as status from (
    select *, case when unit_text is null then 'target_not_found' when not inside then 'range_out_of_bounds' when type <> 'add_comment' and actual_snippet <> coalesce(snippet, '') then 'snippet_mismatch'
      when type = 'add_comment' and range_start < range_end and actual_snippet <> coalesce(snippet, '') then 'snippet_mismatch' end as reason
    from (select *, case when inside then substr(unit_text, range_start + 1, range_end - range_start) end as actual_snippet from (
      select s.* exclude (accepted_text), u.accepted_text as unit_text, range_start >= 0 and range_start <= range_end and range_end <= length(u.accepted_text) as inside
      from spoiled s left join units u on u.doc_id = s.doc_id and u.part = s.part and u.para_id = s.para_id where u.unit_uid is null or s.unit_uid is null or u.unit_uid = s.unit_uid)))""", "spoiled", "units")
_step("applied", """
  select *, substr(unit_text, coalesce(lag(range_end) over w, 0) + 1, range_start - coalesce(lag(range_end) over w, 0)) || case type when 'replace_range' then coalesce(replacement, '') when 'insert_at' then coalesce(new_text, '') else '' end as piece
  from log where status = 'applied' and type in ('replace_range', 'insert_at', 'delete_range') window w as (partition by doc_id, part, para_id order by range_start, range_end)""", "log")
_step("changed", f"""
  select doc_id, patch_pos, type, part, para_id, unit_uid, part || ':' || para_id || ':' || unit_uid as stable_location, actual_snippet as exact_snippet,
    right(substr(unit_text, 1, range_start), {CONTEXT}) || actual_snippet || substr(unit_text, range_end + 1, {CONTEXT}) as before_snippet,
    case type when 'replace_range' then coalesce(replacement, '') when 'insert_at' then coalesce(new_text, '') when 'delete_range' then '' else coalesce(comment_text, '') end as after_snippet,
    {_occurrences('unit_text', 'actual_snippet')} as occurrence_count,
    case when {_occurrences('unit_text', 'actual_snippet')} > 0 then {_occurrences("substr(unit_text, 1, range_start) || actual_snippet", 'actual_snippet')} end as occurrence_index,
    {_occurrences('unit_text', 'actual_snippet')} > 1 as location_uncertain
  from log where status = 'applied'""", "log")
_step("runs", f"""
  select doc_id, chunk_id, dedup_key, run from (select doc_id, chunk_id, dedup_key, unnest(range({RUNS})) as run from deduped)
  where cast('0x' || substr(sha256(dedup_key || '|' || run), 1, 8) as bigint) % 3 <> 0""", "deduped")


_step("voted", "select *, cast('0x' || substr(dedup_key, 1, 4) as bigint) % 2 + 2 as votes from deduped", "deduped")
_step("rival", f"""
  select a.doc_id, a.dedup_key, max(b.votes) as most from voted a join voted b on a.doc_id = b.doc_id and a.part = b.part and a.para_id = b.para_id and a.dedup_key <> b.dedup_key and {_overlap('a.range_start', 'a.range_end', 'b.range_start', 'b.range_end')}
  where a.type in ('replace_range', 'insert_at', 'delete_range') and b.type in ('replace_range', 'insert_at', 'delete_range') group by all""", "voted")
#: A document's chunks as their ids and the position of each one's last unit; a fix changes both lists.
_FIXES = " union all ".join(f"select {case} as c, {i} as seq, '{kind}' as type, 'chunk_{left:04d}' as l, 'chunk_{right:04d}' as r, {move} as move" for case, some in enumerate(FIXES) for i, (kind, left, right, move) in enumerate(some))
_step("fix_start", f"""
  select doc_id, list({_chunk_id('chunk_index')} order by chunk_index) as ids, list(hi order by chunk_index) as his from (
    select doc_id, chunk_index, cast(sum(count(*)) over (partition by doc_id order by chunk_index) as bigint) as hi from pk group by doc_id, chunk_index) group by doc_id having max(chunk_index) >= 3""", "pk")
_step("fix_all", f"select doc_id, f.* from fix_start join ({_FIXES}) f on f.c = doc_id % {len(FIXES)}", "fix_start")
_step("fix_walk", """
  select doc_id, -1 as seq, ids, his, cast(null as varchar) as error from fix_start
  union all
  select doc_id, seq, case when error is null and type = 'merge_adjacent' then ids[1:li] || ids[ri + 1:] else ids end,
    case when error is not null then his when type = 'merge_adjacent' then his[1:li - 1] || his[ri:] when type = 'shift_boundary' then his[1:li - 1] || [his[li] + move] || his[ri:] else his end, error
  from (
    select *, case when before is not null then before when li is null or ri is null then 'unknown chunk: ' || l || ', ' || r when ri <> li + 1 then 'not adjacent: ' || l || ', ' || r
      when type not in ('merge_adjacent', 'shift_boundary') then 'unsupported fix: ' || type when type = 'shift_boundary' and move > his[ri] - his[li] then 'move exceeds the right chunk: ' || r
      when type = 'shift_boundary' and -move > his[li] - coalesce(his[li - 1], 0) then 'move exceeds the left chunk: ' || l end as error
    from (select w.doc_id, f.seq, w.ids, w.his, w.error as before, f.type, f.l, f.r, f.move, nullif(list_position(w.ids, f.l), 0) as li, nullif(list_position(w.ids, f.r), 0) as ri
      from fix_walk w join fix_all f on f.doc_id = w.doc_id and f.seq = w.seq + 1))""", "fix_start", "fix_all")
_step("fix_end", "select doc_id, max_by(ids, seq) as ids, max_by(his, seq) as his, max(error) as error from fix_walk group by doc_id", "fix_walk")
_step("fix_spans", "select doc_id, unnest(ids) as chunk_id, unnest(list_prepend(cast(0 as bigint), his)[1:len(his)]) as lo, unnest(his) as hi from fix_end where error is null", "fix_end")


def _with(final: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for n in STEPS[name][1]:
                add(n)
            order.append(name)

    for n in needs:
        add(n)
    return "with recursive " + ", ".join(f"{n} as ({STEPS[n][0]})" for n in order) + " " + final


_UNIT = "doc_id, part, part_kind, paragraph_index_in_part, accepted_text, order_index, para_id, unit_uid"
_OP = "doc_id, chunk_id, op_index, type, part, para_id, unit_uid, quoted_text, cast(range_start as integer) as range_start, cast(range_end as integer) as range_end, snippet, replacement, new_text, comment_text"


def _search(pattern: str) -> str:
    hit = f"select doc_id, part, para_id, unit_uid, order_index, s as start, cast(e as integer) as \"end\", value as match_text, substr(accepted_text, greatest(0, s - 40) + 1, e + 40 - greatest(0, s - 40)) as snippet from ({_spans('accepted_text', pattern)})"
    return _with(hit, "units")


ORACLE_SQL: dict[str, str] = {
    "units_documents": _with(f"select {_UNIT} from units", "units"),
    "units_conversations": rf"select *, cast(row_number() over (partition by doc_id order by paragraph_index_in_part, part, accepted_text) - 1 as integer) as order_index, {_ids('doc_id', 'part', 'paragraph_index_in_part')} from (select conv_id as doc_id, 'conversation/' || coalesce(role, '?') as part, role as part_kind, cast(turn as integer) as paragraph_index_in_part, text as accepted_text from conversations where regexp_matches(text, '\S'))",
    "units_pages": _with(f"select {_UNIT}, array_to_string([x for x in [" + ", ".join(f"case when o{n} is not null and (c{n} is null or o{n} > c{n}) then t{n} end" for n in range(1, 7)) + "] if x is not null], ' > ') as heading_path from pages_with_headings", "pages_with_headings"),
    "doc_struct": _with("select doc_id, part, part_kind, count(*) as unit_count, min(order_index) as first_order_index, max(order_index) as last_order_index, cast(sum(length(accepted_text)) as bigint) as characters from page_units group by all", "page_units"),
    "search_literal": _search(LITERAL),
    "search_literal_ci": _search("(?i)The"),
    "search_regex": _search(REGEX),
    "search_summary": _with(f"select (select count(*) from units) as unit_count, cast(coalesce(sum(n), 0) as bigint) as hit_count, count(*) as hit_unit_count from (select doc_id, part, para_id, unit_uid, count(*) as n from ({_spans('accepted_text', LITERAL)}) group by all)", "units"),
    "word_unique": _with(f"select doc_id, word from (select doc_id, unnest(regexp_extract_all(accepted_text, '{_WORD}')) as word from units) group by all having count(*) = 1", "units"),
    "chunk_pack": _with("select doc_id, order_index, tok as token_estimate, chunk_index from pk", "pk"),
    "chunk_context": _with("select doc_id, chunk_id, role, role = 'primary' as editable, cast(row_number() over (partition by doc_id, chunk_index, role order by order_index) - 1 as integer) as pos, order_index, tok as token_estimate from members", "members"),
    "chunk_manifest": _with(f"select doc_id, chunk_id, chunk_index, start_order_index, end_order_index, primary_unit_count, context_before_count, context_after_count, total_tokens, total_tokens <= {_HARD} as is_within_hard_max, total_tokens > {_HARD} and primary_unit_count = 1 as allowed_overflow from chunks", "chunks"),
    "chunk_tokens": _with("select doc_id, chunk_id, primary_tokens, context_before_tokens, context_after_tokens, total_tokens from chunks", "chunks"),
    "chunk_overflow": _with(f"select doc_id, chunk_id, total_tokens, primary_unit_count, context_before_count, context_after_count from chunks where total_tokens > {_HARD} and primary_unit_count = 1", "chunks"),
    "chunk_fixes": _with("""
      select p.doc_id, p.order_index, coalesce(r.chunk_id, p.old_id) as chunk_id, f.error
      from (select doc_id, order_index, row_number() over (partition by doc_id order by order_index) as pos, @id as old_id from pk) p join fix_end f on f.doc_id = p.doc_id
      left join fix_spans r on f.error is null and r.doc_id = p.doc_id and p.pos > r.lo and p.pos <= r.hi""".replace("@id", _chunk_id("chunk_index")), "pk", "fix_end", "fix_spans"),
    "chunk_invariants": _with("""
      select doc_id, unit_uid, 'primary_not_once' as rule from mem where role = 'primary' group by all having count(*) <> 1
      union all select doc_id, unit_uid, 'primary_and_context' from mem group by doc_id, chunk_id, unit_uid having count(distinct role = 'primary') > 1""", "mem"),
    "synth_ops": _with(f"select {_OP} from ops", "ops"),
    "synth_first": _with("""
      select o.doc_id, o.chunk_index, o.order_index, o.k, o.type, o.snippet, cast(o.range_start as integer) as range_start from ops o
      join (select doc_id, min(order_index) as order_index from four group by doc_id) f using (doc_id, order_index) where o.k < 4""", "ops"),
    "quoted_range_exact": _with(r"""
      select doc_id, chunk_id, op_index, cast(case when p > 0 then p - 1 + length(pre) end as integer) as start_at, cast(case when p > 0 then p - 1 + length(pre) + length(mid) end as integer) as end_at from (
        select *, strpos(accepted_text, pre || mid || post) as p from (
          select o.doc_id, o.chunk_id, o.op_index, u.accepted_text, split_part(quoted_text, '[[', 1) as pre, split_part(quoted_text, ']]', 2) as post,
            case when regexp_matches(split_part(split_part(quoted_text, '[[', 2), ']]', 1), '\S') then split_part(split_part(quoted_text, '[[', 2), ']]', 1) else '' end as mid
          from ops o join units u using (doc_id, unit_uid) where quoted_text is not null))""", "ops", "units"),
    "sanitize_reasons": _with("select doc_id, chunk_id, op_index, type, part, para_id, reason from sanitized", "sanitized"),
    "sanitize_log": _with("select doc_id, chunk_id, count(*) as input_op_count, count(*) filter (where reason is null) as output_op_count, count(*) filter (where reason is not null) as converted_ops from sanitized group by all", "sanitized"),
    "ownership": _with("select doc_id, chunk_id, op_index, owner_reason from owned", "owned"),
    "uid_autofill": _with("select doc_id, chunk_id, op_index, unit_uid from owned where autofilled", "owned"),
    "range_resolution": _with("select doc_id, chunk_id, op_index, range_event, type, cast(range_start as integer) as range_start, cast(range_end as integer) as range_end, comment_text from resolved where range_event is not null", "resolved"),
    "dedup_ops": _with("select doc_id, chunk_id, op_index, type, dedup_key from deduped", "deduped"),
    "conflict_pairs": _with(f"select a.doc_id, a.para_id, a.chunk_id as first_chunk, a.op_index as first_op, b.chunk_id as second_chunk, b.op_index as second_op from edits a join edits b on a.doc_id = b.doc_id and a.part = b.part and a.para_id = b.para_id and a.n < b.n and {_overlap('a.rs', 'a.re', 'b.rs', 'b.re')}", "edits"),
    "conflict_greedy": _with("select doc_id, chunk_id, op_index, type, downgraded, comment_text from downgraded", "downgraded"),
    "patch_order": _with("select doc_id, patch_pos, chunk_id, op_index, type, cast(range_start as integer) as range_start, cast(range_end as integer) as range_end from patch", "patch"),
    "merge_stats": _with("""
      select r.doc_id, chunk_file_count, input_ops, coalesce(valid_ops, 0) as valid_ops, coalesce(rejected, 0) as rejected, coalesce(rejected_context, 0) as rejected_context, coalesce(rejected_unknown, 0) as rejected_unknown, coalesce(rejected_ambiguous_missing_unit_uid, 0) as rejected_ambiguous_missing_unit_uid, coalesce(autofilled, 0) as autofilled,
        coalesce(range_resolution_events, 0) as range_resolution_events, coalesce(conflict_downgrades, 0) as conflict_downgrades, coalesce(final_ops, 0) as final_ops, coalesce(live, 0) - coalesce(final_ops, 0) as duplicates_removed, coalesce(final_ops, 0) as ops_after_dedup
      from (select doc_id, count(distinct chunk_id) as chunk_file_count, count(*) as input_ops from ops group by all) r
      left join (select doc_id, count(*) as valid_ops, count(owner_reason) as rejected, count(*) filter (where owner_reason = 'target_is_context_unit') as rejected_context, count(*) filter (where owner_reason = 'target_not_owned_by_chunk') as rejected_unknown, count(*) filter (where owner_reason = 'missing_unit_uid_ambiguous_primary_match') as rejected_ambiguous_missing_unit_uid, count(*) filter (where autofilled) as autofilled from owned group by all) o using (doc_id)
      left join (select doc_id, count(range_event) as range_resolution_events, count(*) filter (where coalesce(range_event, '') <> 'range_resolution_snippet_not_found') as live from resolved group by all) l using (doc_id)
      left join (select doc_id, count(*) filter (where downgraded) as conflict_downgrades, count(*) as final_ops from downgraded group by all) f using (doc_id)""", "ops", "owned", "resolved", "downgraded"),
    "merge_reasons": _with("select reason, count(*) as n from (select owner_reason as reason from owned where owner_reason is not null union all select range_event from resolved where range_event is not null) group by all", "owned", "resolved"),
    "qa_overrides": _with("select doc_id, patch_pos, type, comment_text from final", "final"),
    "qa_override_report": _with("""
      select m.doc_id, merged_ops, coalesce(actions_in, 0) as actions_in, coalesce(actions_applied, 0) as actions_applied, coalesce(actions_ignored, 0) as actions_ignored, coalesce(final_ops, 0) as final_ops
      from (select doc_id, count(*) as merged_ops from patch group by all) m
      left join (select doc_id, count(*) as actions_in, count(*) filter (where ignored is null) as actions_applied, count(ignored) as actions_ignored from acts group by all) a using (doc_id)
      left join (select doc_id, count(*) as final_ops from final group by all) f using (doc_id)""", "patch", "acts", "final"),
    "apply_guard": _with("select doc_id, patch_pos, status, reason, actual_snippet from log", "log"),
    "apply_text": _with("select doc_id, para_id, count(*) as edits, any_value(unit_text) as before_text, string_agg(piece, '' order by range_start, range_end) || substr(any_value(unit_text), max(range_end) + 1) as after_text from applied group by doc_id, part, para_id", "applied"),
    "apply_stats": _with("""
      select doc_id, count(*) as input_ops, count(*) filter (where status = 'applied') as applied_ops, count(*) filter (where status <> 'applied') as skipped_ops,
        count(*) filter (where status = 'applied' and type = 'add_comment') as applied_comment_ops, count(*) filter (where status = 'applied' and type <> 'add_comment') as applied_edit_ops,
        count(*) filter (where reason = 'snippet_mismatch') as skipped_snippet_mismatch, count(*) filter (where reason = 'target_not_found') as skipped_target_not_found, count(*) filter (where reason = 'range_out_of_bounds') as skipped_range_out_of_bounds
      from log group by all""", "log"),
    "skip_breakdown": _with("select reason, count(*) as n from log where status <> 'applied' group by all", "log"),
    "reconcile_patch_log": _with("""
      select coalesce(p.doc_id, l.doc_id) as doc_id, coalesce(patch_ops, 0) as patch_ops, coalesce(log_ops, 0) as log_ops from (select doc_id, count(*) as patch_ops from patch group by all) p
      full join (select doc_id, count(*) as log_ops from log where not (doc_id % 2 = 0 and patch_pos = 0) group by all) l on l.doc_id = p.doc_id where coalesce(patch_ops, 0) <> coalesce(log_ops, 0)""", "patch", "log"),
    "changes": _with("select * from changed", "changed"),
    "failed_ops": _with(f"select doc_id, patch_pos as op_index, reason as skip_reason, '{GUIDANCE}' as failure_guidance from log where status <> 'applied'", "log"),
    "disambiguation": _with("select doc_id, patch_pos, 'repeated_before_snippet' as kind, exact_snippet, occurrence_count, occurrence_index from changed where occurrence_count > 1", "changed"),
    "adjacent_merge": _with(f"""
      select doc_id, part, para_id, cast(min(range_start) as integer) as range_start, cast(max(range_end) as integer) as range_end, count(*) as ops, string_agg(patch_pos, ',' order by patch_pos) as merged_op_indices from (
        select *, sum(fresh) over (partition by doc_id, part, para_id order by range_start, range_end) as run from (
          select *, cast(last is null or range_start - last > {ADJACENT_GAP} or regexp_matches(substr(unit_text, last + 1, greatest(0, range_start - last)), '[.!?]') as integer) as fresh from (
            select *, lag(range_end) over (partition by doc_id, part, para_id order by range_start, range_end) as last from log where status = 'applied' and type = 'replace_range')))
      group by doc_id, part, para_id, run""", "log"),
    "report_stats": _with("""
      select p.doc_id, input_patch_ops, coalesce(op_count, 0) as op_count, coalesce(failed_op_count, 0) as failed_op_count from (select doc_id, count(*) as input_patch_ops from patch group by all) p
      left join (select doc_id, count(*) filter (where status = 'applied') as op_count, count(*) filter (where status <> 'applied') as failed_op_count from log group by all) l using (doc_id)""", "patch", "log"),
    "ensemble_vote": _with(f"select doc_id, dedup_key, count(distinct run) as votes from runs group by all having 2 * count(distinct run) > {RUNS}", "runs"),
    "ensemble_missing": _with(f"""
      select doc_id, chunk_id, coalesce(runs, 0) as runs from (select distinct doc_id, chunk_id from members) c left join (select doc_id, chunk_id, count(distinct run) as runs from runs group by all) r using (doc_id, chunk_id)
      where coalesce(runs, 0) < {RUNS}""", "members", "runs"),
    "schema_check": """
      select conv_id, turn, ['', 'Missing required field: root.status', 'Expected string at root.status, got int; Expected array at root.ops, got dict', 'Missing required field: root.ops[1].type; Expected integer at root.ops[1].at, got bool',
        'Expected number at root.score, got bool; Expected boolean at root.done, got int; Expected object at root.ops[0], got int', 'Expected object at root, got list',
        'Expected string at root.status, got NoneType; Expected string at root.ops[0].type, got list; Expected integer at root.ops[0].at, got float', 'Not JSON'][(conv_id + turn) % 8 + 1] as faults from conversations""",
    "alternate_ops": _with("""
      select o.doc_id, o.chunk_id, cast(row_number() over (partition by o.doc_id, o.chunk_id order by op_index) - 1 as integer) as op_index, o.type, m.part, m.para_id, o.unit_uid, cast(range_start as integer) as range_start, cast(range_end as integer) as range_end
      from ops o left join mem m on m.doc_id = o.doc_id and m.chunk_id = o.chunk_id and m.unit_uid = o.unit_uid and m.role = 'primary' where o.type <> 'unknown_type'""", "ops", "mem"),
    "sanitize_conversions": _with("select doc_id, chunk_id, string_agg(op_index || ':' || reason, ',' order by op_index) as conversions from sanitized where reason is not null group by all", "sanitized"),
    "review_totals": _with("select doc_id, count(distinct chunk_id) as chunks, count(*) as input_op_count, count(*) filter (where reason is null) as output_op_count, count(*) filter (where reason is not null) as converted_ops from sanitized group by all", "sanitized"),
    "review_summaries": _with("select *, cast(row_number() over (partition by doc_id order by chunk_id) as integer) as place from (select doc_id, chunk_id, count(*) as input_op_count, count(*) filter (where reason is null) as output_op_count, count(*) filter (where reason is not null) as converted_ops from sanitized group by doc_id, chunk_id)", "sanitized"),
    "failed_in_order": _with("""
      select doc_id, op_index, skip_reason, cast(row_number() over (partition by doc_id order by coalesce(try_cast(op_index as bigint), 1000000000), op_index, skip_reason) as integer) as place from (
        select doc_id, case when patch_pos % 3 = 0 then 'op ' || patch_pos else cast(patch_pos as varchar) end as op_index, reason as skip_reason from log where status <> 'applied')""", "log"),
    "event_windows": """
      select start_at, start_at + interval 1 hour as end_at, event_type, count(*) as n
      from (select event_type, unnest([time_bucket(interval 30 minutes, ts), time_bucket(interval 30 minutes, ts) - interval 30 minutes]) as start_at from events) group by all""",
    "event_sessions": """
      select user_id, min(ts) as start_at, max(ts) + interval 30 minutes as end_at, count(*) as n from (
        select *, sum(fresh) over (partition by user_id order by ts) as run from (select user_id, ts, case when ts <= lag(ts) over (partition by user_id order by ts) + interval 30 minutes then 0 else 1 end as fresh from events))
      group by user_id, run""",
    "ensemble_settled": _with("""
      select doc_id, chunk_id, op_index, votes, case when most > votes then 'outvoted' when most = votes then 'tied' else 'kept' end as outcome,
        case when most = votes then 'add_comment' else type end as type, case when most = votes then 'Tied vote: ' || type else comment_text end as comment_text
      from voted left join rival using (doc_id, dedup_key)""", "voted", "rival"),
    "report_suggestions": _with(f"""
      select doc_id, part, para_id, cast(min(patch_pos) as integer) as patch_pos, any_value(substr(unit_text, lo + 1, hi - lo)) as exact_snippet, string_agg(case when range_start = lo then '' else substr(unit_text, last + 1, range_start - last) end || coalesce(replacement, ''), '' order by range_start) as after_snippet,
        string_agg(patch_pos, ',' order by patch_pos) as merged_op_indices
      from (select *, min(range_start) over (partition by doc_id, part, para_id, run) as lo, max(range_end) over (partition by doc_id, part, para_id, run) as hi from (
        select *, sum(fresh) over (partition by doc_id, part, para_id order by range_start, range_end) as run from (
          select *, cast(last is null or range_start - last > {ADJACENT_GAP} or regexp_matches(substr(unit_text, last + 1, greatest(0, range_start - last)), '[.!?]') as integer) as fresh from (
            select *, lag(range_end) over (partition by doc_id, part, para_id order by range_start, range_end) as last from log where status = 'applied' and type = 'replace_range'))))
      group by doc_id, part, para_id, run having count(*) > 1""", "log"),
}
