"""The review engine on the contract's own cases."""

import io
import random
import re
import zipfile
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from scriptorium.conf import Budget
from scriptorium.functions import fuzzy, jsontext
from scriptorium.functions.offsets import overlap, utf16_length, utf16_slice
from scriptorium.functions.schema import schema_faults
from scriptorium.functions.text import collapse, quote, render, shorten, target_label
from scriptorium.operators import apply, chunk, fixes, merge, overrides, report, review, sanitize, search, vote
from scriptorium.plans.pipeline import Pipeline
from scriptorium.sinks import docx as docx_sink
from scriptorium.sinks.files import json_report, markdown
from scriptorium.sources import artifacts
from scriptorium.sources import docx as docx_source
from scriptorium.sources import units as sources
from scriptorium.streaming import results

UNIT = "doc_id long, part string, part_kind string, para_id string, unit_uid string, accepted_text string, order_index int, paragraph_index_in_part int"
OP = "doc_id long, chunk_id string, op_index int, type string, part string, para_id string, unit_uid string, quoted_text string, range_start int, range_end int, snippet string, replacement string, new_text string, comment_text string"
BODY = "word/document.xml"


def units(spark, *texts):
    return spark.createDataFrame([(1, BODY, "body", f"para_{i}", f"unit_{i}", t, i, i) for i, t in enumerate(texts)], UNIT)


def op(i, kind, unit, start, end, snippet, payload=None, chunk="chunk_0001", uid=True):
    return (1, chunk, i, kind, BODY, f"para_{unit}", f"unit_{unit}" if uid else None, None, start, end, snippet, payload if kind == "replace_range" else None, payload if kind == "insert_at" else None, payload if kind == "add_comment" else None)


def members(spark, *rows):
    return spark.createDataFrame([(1, c, r, BODY, f"para_{u}", f"unit_{u}") for c, r, u in rows], "doc_id long, chunk_id string, role string, part string, para_id string, unit_uid string")


def test_offsets(spark):
    text = "𝄞 Cello oboe TUBA horn viola!"
    row = spark.createDataFrame([(text,)], "t string").select(utf16_length(F.col("t")).alias("n"), utf16_slice(F.col("t"), F.lit(3), F.lit(8)).alias("s")).first()
    assert (row.n, row.s) == (30, "Cello")
    cases = [(a, b, c, d) for a in range(4) for b in range(a, 4) for c in range(4) for d in range(c, 4)]

    def brute(a, b, c, d):
        if a == b or c == d:
            return a == c if a == b and c == d else c <= a <= d if a == b else a <= c <= b
        return bool(set(range(a, b)) & set(range(c, d)))

    frame = spark.createDataFrame(cases, "a int, b int, c int, d int")
    assert all(x.hit == brute(x.a, x.b, x.c, x.d) for x in frame.withColumn("hit", overlap(*map(F.col, "abcd"))).collect())


def test_search(spark):
    u = units(spark, "😀 Alpha beta ALPHA Beta alpha.", "gamma alpha beta.")
    got = lambda *a, **k: [(x.unit_uid, x.start, x.end) for x in search.ordered(search.search(u, *a, **k)).collect()]
    assert got("alpha") == [("unit_0", 25, 30), ("unit_1", 6, 11)]
    assert got("alpha", ignore_case=True) == [("unit_0", 3, 8), ("unit_0", 14, 19), ("unit_0", 25, 30), ("unit_1", 6, 11)]
    assert got("alpha|gamma", regex=True, ignore_case=True)[-2:] == [("unit_1", 0, 5), ("unit_1", 6, 11)]
    assert got("a*", regex=True)[:2] == [("unit_0", 7, 8), ("unit_0", 12, 13)]
    assert search.search(u, "alpha", snippet_chars=3).first().snippet == "ta alpha."
    none = search.summary(u, search.search(u, "absent")).first()
    assert (none.unit_count, none.hit_count, none.hit_unit_count) == (2, 0, 0)
    for pattern in (r"\bthe\b", "t(?=h)", "[a-e]+"):
        text = "😀 other the bathe the"
        want = [(len(text[: m.start()].encode("utf-16-le")) // 2, len(text[: m.end()].encode("utf-16-le")) // 2) for m in re.finditer(pattern, text)]
        assert [(x.start, x.end) for x in search.ordered(search.search(units(spark, text), pattern, regex=True)).collect()] == want


@pytest.mark.parametrize("seed", range(3))
def test_chunks(spark, seed):
    r = random.Random(seed)
    budget = Budget(120, 0.25, 40)
    texts = ["w" * r.randrange(1, 90) for _ in range(25)] + ["oversized " * 42, "end"]
    packed = chunk.pack(units(spark, *texts), budget)
    out, running, index = {}, 0, -1
    for i, t in enumerate(texts):
        n = max(1, -(-len(t) // 4))
        if index < 0 or running + n > budget.target:
            index, running = index + 1, 0
        running += n
        out[i] = index
    assert {x.order_index: x.chunk_index for x in packed.collect()} == out
    for c in chunk.manifest(chunk.chunk_units(packed, budget), budget).collect():
        assert c.total_tokens == c.primary_tokens + c.context_before_tokens + c.context_after_tokens
        assert c.is_within_hard_max == (c.total_tokens <= 40)
        if not c.is_within_hard_max:
            assert c.allowed_overflow and c.primary_unit_count == 1 and c.context_before_count == c.context_after_count == 0


def test_chunk_fixes(spark):
    rows = [(d, f"chunk_{c + 1:04d}", c, "primary", 3 * c + i) for d in range(7) for c in range(4) for i in range(3)]
    rows += [(d, f"chunk_{c + 1:04d}", c, role, 3 * c + at) for d in range(7) for c in range(4) for role, at in (("context_before", -1), ("context_after", 3)) if 0 <= 3 * c + at < 12]
    members = spark.createDataFrame(rows, "doc_id long, chunk_id string, chunk_index int, role string, order_index int")
    fix = lambda d, i, kind, a, b, move=0: (d, i, kind, f"chunk_{a:04d}", f"chunk_{b:04d}", move)
    asked = [
        fix(0, 0, "shift_boundary", 1, 2, 2), fix(0, 1, "shift_boundary", 2, 3, 1), fix(1, 0, "merge_adjacent", 1, 2), fix(1, 1, "shift_boundary", 1, 3, -4), fix(2, 0, "shift_boundary", 3, 4, 4),
        fix(3, 0, "shift_boundary", 1, 2, -1), fix(3, 1, "merge_adjacent", 1, 3), fix(4, 0, "merge_adjacent", 1, 2), fix(4, 1, "shift_boundary", 2, 3, 1), fix(5, 0, "shift_boundary", 2, 3, 3), fix(5, 1, "shift_boundary", 2, 3, 1),
    ]
    out = fixes.apply_fixes(members, spark.createDataFrame(asked, "doc_id long, seq int, type string, left_chunk_id string, right_chunk_id string, move int")).collect()
    held = {}
    for x in out:
        held.setdefault((x.doc_id, x.role), {}).setdefault(int(x.chunk_id[-4:]), []).append(x.order_index)
    errors = {x.doc_id: x.error for x in out}
    assert held[0, "primary"] == {1: [0, 1, 2, 3, 4], 2: [5, 6], 3: [7, 8], 4: [9, 10, 11]} and held[0, "context_after"][1] == [5] and held[0, "context_before"][3] == [6]
    assert held[1, "primary"] == {1: [0, 1], 3: [2, 3, 4, 5, 6, 7, 8], 4: [9, 10, 11]} and held[1, "context_before"][3] == [1]
    assert "exceeds the right chunk" in errors[2] and "not adjacent" in errors[3] and "unknown chunk" in errors[4] and "exceeds the right" in errors[5] and errors[0] is None and 6 not in errors
    assert all(held[d, "primary"] == {c + 1: [3 * c, 3 * c + 1, 3 * c + 2] for c in range(4)} for d in (2, 3, 4, 5))
    said = iter([("needs_fix", spark.createDataFrame(asked[:2], "doc_id long, seq int, type string, left_chunk_id string, right_chunk_id string, move int")), ("ok", None)])
    seen = []
    after = fixes.check_chunks(members, lambda _, sample: (seen.append(sample.select("chunk_id").distinct().count()), next(said))[1])
    assert seen == [3, 3] and after.filter("doc_id = 0 and role = 'primary' and chunk_index = 1").count() == 2 and after.filter("doc_id = 6").count() == members.filter("doc_id = 6").count()
    for answers in ([("odd", None)], [("needs_fix", None)], [("needs_fix", spark.createDataFrame(asked[:1], "doc_id long, seq int, type string, left_chunk_id string, right_chunk_id string, move int")), ("needs_fix", None)]):
        replies = iter(answers)
        with pytest.raises(ValueError):
            fixes.check_chunks(members, lambda *_, replies=replies: next(replies))


def test_packing_of_many_units(spark):
    texts = ["w" * (i * 37 % 190 + 1) for i in range(20000)]
    out = chunk.pack(units(spark, *texts), Budget(512, 0.5, 320)).orderBy("order_index").collect()
    total, index = 0, 0
    for x in out:
        total += x.token_estimate
        if total > 256:
            total, index = x.token_estimate, index + 1
        assert x.chunk_index == index
    assert [r.n for r in spark.range(2).select(chunk.chunk_name(F.col("id") * 12344).alias("n")).collect()] == ["chunk_0001", "chunk_12345"]


def test_schema_faults(spark):
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": "array", "items": {"type": "integer"}}, "b": {"type": "number", "enum": [1]}}}
    rows = ['{"a": [1, 2], "b": 7}', '{"b": true}', '{"a": [1, "x", false]}', "7", "{", None]
    got = [x.f for x in spark.createDataFrame([(r,) for r in rows], "t string").select(schema_faults(F.col("t"), schema).alias("f")).collect()]
    assert got == [[], ["Missing required field: root.a", "Expected number at root.b, got bool"], ["Expected integer at root.a[1], got str", "Expected integer at root.a[2], got bool"], ["Expected object at root, got int"], ["Not JSON"], None]


def test_conflicts_by_neighbours(spark):
    """The fold over neighbours against a comparison with all kept edits."""
    r = random.Random(5)
    u = units(spark, *["x" * 60] * 40)
    rows, want = [], {}
    for p in range(40):
        kept = []
        for i in range(25):
            a = r.randrange(30)
            b = r.choice([a, a + r.randrange(8), max(0, a - 1)])
            meets = lambda c, d, a=a, b=b: (a == c if a == b and c == d else c <= a <= d if a == b else a <= c <= b if c == d else max(a, c) < min(b, d))
            want[p * 25 + i] = any(meets(c, d) for c, d in kept)
            if not want[p * 25 + i]:
                kept.append((a, b))
            rows.append(op(p * 25 + i, "replace_range", p, a, b, "x", str(i)))
    assert {x.op_index: x.downgraded for x in merge.downgrade(spark.createDataFrame(rows, OP)).collect()} == want and u.count() == 40


def test_quoted_only_ops_reach_the_patch(spark, tmp_path):
    """A reviewer whose ops have a quote and neither range nor snippet."""
    docs = spark.createDataFrame([(1, "Green lamps hang above the narrow harbour road.\nNobody walks there after nine.")], "doc_id long, text string")
    uid = {x.order_index: x.unit_uid for x in sources.document_units(docs).collect()}
    none = (None, None, None)
    raw = [
        (1, "chunk_0001", 0, "replace_range", None, None, uid[0], "lamps [[hang]] above", *none, "swing", None, None), (1, "chunk_0001", 1, "replace_range", None, None, uid[0], "the [[narow]] harbour road", *none, "wide", None, None),
        (1, "chunk_0001", 2, "add_comment", None, None, uid[1], "walks[[ ]] there", *none, None, None, "Who?"), (1, "chunk_0001", 3, "insert_at", None, None, uid[1], "after [[nine]]", *none, None, "x", None), (1, "chunk_0001", 4, "replace_range", None, None, uid[1], "zzz [[qqq]] www", *none, "x", None, None),
    ]
    run = Pipeline(spark, str(tmp_path), Budget(120, 0.25, 40), reviewer=lambda packed: spark.createDataFrame(raw, OP))
    run.run(sources.document_units(docs))
    assert {x.op_index: x.reason for x in run.sanitized().collect()} == {0: None, 1: None, 2: None, 3: "non_collapsed_range", 4: "missing_range"}
    log = {x.op_index: (x.status, x.range_start, x.range_end) for x in run.load("apply").collect()}
    assert log[0] == ("applied", 12, 16) and log[2] == ("applied", 12, 12) and log[1][0] == "applied" and set(log) == {0, 1, 2}


def test_similarity_bound():
    r = random.Random(3)
    for _ in range(60):
        text = "".join(r.choice("abcde ") for _ in range(r.randrange(20, 400)))
        at, n = r.randrange(0, len(text) - 10), r.choice([8, 30, 120])
        needle = "".join(c if r.random() > 0.1 else r.choice("abcdexy") for c in text[at : at + n])
        places = range(0, len(text) - len(needle) + 1, 1 if len(needle) < 100 else 5)
        score = lambda p, needle=needle, text=text: SequenceMatcher(None, needle, text[p : p + len(needle)]).ratio()
        best = max(map(score, places), default=0)
        want = next((p for p in places if score(p) == best), None) if best >= 0.8 else None
        if needle in text:
            want = text.find(needle)
        elif want is not None and len(needle) >= 100:
            near = range(max(0, want - 5), min(len(text) - len(needle), want + 5) + 1)
            top = max(map(score, near))
            want = next(p for p in near if score(p) == top) if top > best else want
        assert fuzzy.best_window(needle, text, 0.8) == want


def test_alternate_answers(spark, tmp_path):
    (tmp_path / "chunk_0001_result.json").write_text('{"chunk_id": "chunk_0001", "patch_ops": [{"type": "add_comment", "target_unit_uid": " unit_0 ", "range": {"start": 0, "end": 0}, "comment_text": "a"}, {"type": "add_comment", "target": {"part": "p", "para_id": "q", "unit_uid": "unit_0"}, "target_unit_uid": "unit_9", "comment_text": "b"}]}')
    ops = artifacts.full_targets(artifacts.read_results(spark, str(tmp_path), "legacy"), members(spark, ("chunk_0001", "primary", 0)))
    assert sorted((x.op_index, x.part, x.para_id, x.unit_uid) for x in ops.collect()) == [(0, BODY, "para_0", "unit_0"), (1, "p", "q", "unit_0")]


def test_sanitize(spark):
    ops = [op(0, "replace_range", 0, 1, 3, "x"), op(1, "add_comment", 0, 0, 0, "", ""), op(2, "add_comment", 0, 0, 0, "", "note"), op(3, "unknown_type", 0, 1, 2, "x"), op(4, "replace_range", 0, 1, 3, "x", ""), op(5, "insert_at", 0, 3, 3, "", ""), op(6, "insert_at", 0, 3, 4, "", "x"), op(7, "replace_range", 0, None, None, "", "x"), op(8, "replace_range", 9, 1, 3, "", "x"), op(9, "insert_at", 0, 3, 3, "")]
    got = sanitize.sanitize(spark.createDataFrame(ops, OP), members(spark, ("chunk_0001", "primary", 0)))
    assert [x.reason for x in got.orderBy("op_index").collect()] == ["missing_replacement", "missing_comment_text", None, "invalid_type", None, "empty_new_text", "non_collapsed_range", "missing_range", "non_primary_target", "missing_new_text"]
    log = sanitize.log(got).first()
    assert (log.input_op_count, log.output_op_count, log.converted_ops) == (10, 2, 8)


def test_merge_main_set(spark):
    u = units(spark, "Alpha beta beta gamma delta and more.", "some junk here")
    ops = [op(0, "replace_range", 0, 10, 14, "beta", "BETA"), op(1, "insert_at", 0, 20, 20, "", " !!!"), (*op(2, "delete_range", 1, 5, 9, "junk"),)]
    ops += [op(0, "replace_range", 0, 10, 14, "beta", "BETA", "chunk_0002"), op(1, "replace_range", 0, 12, 16, "ta g", "XXXX", "chunk_0002"), op(2, "replace_range", 0, 10, 14, "beta", "Beta2", "chunk_0002"), op(3, "add_comment", 0, 0, 5, "Alpha", "text", "chunk_0002")]
    who = members(spark, *[(c, "primary", i) for c in ("chunk_0001", "chunk_0002") for i in (0, 1)])
    frame = spark.createDataFrame(ops, OP)
    patch = merge.merge(frame, who, u).orderBy("patch_pos").collect()
    assert len(patch) == 6 and [x.unit_uid for x in patch] == ["unit_0"] * 5 + ["unit_1"]
    starts = [x.range_start for x in patch[:5]]
    assert starts == sorted(starts, reverse=True) and sum(x.downgraded for x in patch) == 2
    assert all("Conflict downgrade" in x.comment_text and x.replacement is None for x in patch if x.downgraded)
    owned = merge.own(frame, who)
    s = merge.stats(frame, owned, merge.resolve(owned, u), merge.merge(frame, who, u)).first()
    assert (s.chunk_file_count, s.input_ops, s.valid_ops, s.duplicates_removed, s.ops_after_dedup, s.conflict_downgrades, s.final_ops) == (2, 7, 7, 1, 6, 2, 6)


def test_ownership_and_ranges(spark):
    u = units(spark, "Alpha beta gamma.", "beta x beta", "Alpha beta gamma")
    who = members(spark, ("chunk_0001", "primary", 0), ("chunk_0001", "primary", 1), ("chunk_0001", "primary", 2), ("chunk_0001", "context_after", 3))
    ops = [op(0, "replace_range", 0, None, None, "beta", "B"), op(1, "replace_range", 1, None, None, "beta", "B"), op(2, "replace_range", 2, None, None, "NOT_FOUND", "B"), op(3, "replace_range", 3, 0, 1, "x", "B"), op(4, "replace_range", 8, 0, 1, "x", "B"), op(5, "replace_range", 0, 0, 5, "Alpha", "B", uid=False)]
    owned = merge.own(spark.createDataFrame(ops, OP), who)
    assert {x.op_index: (x.owner_reason, x.autofilled) for x in owned.collect()} == {0: (None, False), 1: (None, False), 2: (None, False), 3: ("target_is_context_unit", False), 4: ("target_not_owned_by_chunk", False), 5: (None, True)}
    got = {x.op_index: (x.range_event, x.type, x.range_start, x.range_end) for x in merge.resolve(owned, u).collect()}
    assert got == {0: ("filled", "replace_range", 6, 10), 1: ("range_resolution_ambiguous_snippet", "add_comment", 0, 0), 2: ("range_resolution_snippet_not_found", "replace_range", None, None), 5: (None, "replace_range", 0, 5)}
    double = spark.createDataFrame([(1, "chunk_0001", "primary", BODY, "para_0", f"unit_{i}") for i in "ab"], "doc_id long, chunk_id string, role string, part string, para_id string, unit_uid string")
    assert merge.own(spark.createDataFrame(ops[5:], OP), double).first().owner_reason == "missing_unit_uid_ambiguous_primary_match"


def test_apply_and_report(spark):
    u = units(spark, "😀 Alpha beta, Alpha beta gamma.", "plain")
    ops = [op(0, "replace_range", 0, 9, 13, "beta", "BETA"), op(1, "replace_range", 0, 21, 25, "beta", ""), op(2, "insert_at", 0, 31, 31, "", "++"), op(3, "replace_range", 0, 3, 8, "WRONG", "x"), op(4, "add_comment", 1, 0, 5, "plain", "why"), op(5, "replace_range", 7, 0, 1, "x", "y"), op(6, "replace_range", 1, 2, 90, "x", "y")]
    who = members(spark, *[("chunk_0001", "primary", i) for i in (0, 1, 7)])
    patch = spark.createDataFrame(ops, OP).withColumns({"patch_pos": F.col("op_index"), "accepted_text": F.lit(""), "order_index": F.lit(0), "dedup_key": F.col("op_index").cast("string")})
    log = apply.check(patch, u)
    assert [x.reason for x in log.orderBy("patch_pos").collect()] == [None, None, None, "snippet_mismatch", None, "target_not_found", "range_out_of_bounds"]
    assert apply.apply_text(log).first().after_text == "😀 Alpha BETA, Alpha  gamma++."
    assert [(x.reason, x.n) for x in apply.skip_breakdown(log).collect()] == [("range_out_of_bounds", 1), ("snippet_mismatch", 1), ("target_not_found", 1)]
    s = apply.stats(log).first()
    assert (s.input_ops, s.applied_ops, s.applied_comment_ops, s.applied_edit_ops, s.skipped_snippet_mismatch) == (7, 4, 1, 3, 1)
    d = {x.patch_pos: (x.occurrence_count, x.occurrence_index) for x in report.disambiguation(log).collect()}
    assert d == {0: (2, 1), 1: (2, 2)}
    text = markdown(report.changes(log), report.failed(log)).first().markdown
    assert "# Review" in text and "4 suggestions" in text and "**BETA**" in text and "## Not Applied (Manual Review Required)" in text and "target_not_found" in text
    assert '"op_count":4' in json_report(report.changes(log), report.failed(log)).first().report and apply.reconcile(patch, log).count() == 0
    actions = spark.createDataFrame([(1, 0, "drop_op", 0, None, None), (1, 1, "downgrade_to_comment", 0, None, "t"), (1, 2, "downgrade_to_comment", None, "1", " note "), (1, 3, "drop_op", 99, None, None), (1, 4, "other", 2, None, None)], "doc_id long, seq int, action string, op_index int, op_id string, comment_text string")
    final = {x.patch_pos: (x.type, x.comment_text) for x in overrides.apply_overrides(patch, actions).collect()}
    assert 0 not in final and final[1] == ("add_comment", "note") and len(final) == 6
    o = overrides.override_report(patch, actions).first()
    assert (o.actions_in, o.actions_applied, o.actions_ignored, o.merged_ops, o.final_ops) == (5, 3, 2, 7, 6)
    near = units(spark, "aa bb cc. dd")
    ops = [op(0, "replace_range", 0, 0, 2, "aa", "x"), op(1, "replace_range", 0, 3, 5, "bb", "x"), op(2, "replace_range", 0, 10, 12, "dd", "x")]
    log = apply.check(spark.createDataFrame(ops, OP).withColumns({"patch_pos": F.col("op_index"), "accepted_text": F.lit("")}), near)
    assert sorted(x.merged_op_indices for x in report.adjacent(log).collect()) == ["0,1", "2"] and who.count() == 3


def test_report_rules(spark):
    """Neighbouring replacements are one suggestion; white space, commas and stars in the Markdown."""
    text = "Two cats and dogs sleep , here. The C*D key."
    u = units(spark, text, " indented")
    at = lambda w: (text.index(w), text.index(w) + len(w))
    rows = [op(0, "replace_range", 0, *at("cats"), "cats", "cat"), op(1, "replace_range", 0, *at("dogs"), "dogs", "dog"), op(2, "replace_range", 0, *at("sleep ,"), "sleep ,", "rest ,"), op(3, "replace_range", 0, *at("C*D"), "C*D", "C*E"), op(4, "replace_range", 1, 0, 1, " ", "")]
    patch = spark.createDataFrame(rows, OP).withColumns({"patch_pos": F.col("op_index"), "accepted_text": F.lit("")})
    log = apply.check(patch, u)
    got = {x.merged_op_indices: (x.exact_snippet, x.after_snippet) for x in report.suggestions(log).collect()}
    assert got["0,1,2"] == ("cats and dogs sleep ,", "cat and dog rest ,") and len(got) == 2 and report.suggestions(log).count() == 3
    made = markdown(report.suggestions(log), report.failed(log)).first().markdown
    assert "**cat and dog rest,**" in made and "␠" in made and "C\\*E" in made and "**C" not in made


def test_tied_votes(spark):
    rows = [op(0, "replace_range", 0, 0, 4, "x", "a"), op(1, "replace_range", 0, 2, 6, "x", "b"), op(2, "replace_range", 0, 10, 12, "x", "c"), op(3, "replace_range", 0, 11, 14, "x", "d"), op(4, "insert_at", 0, 20, 20, "", "e"), op(5, "add_comment", 0, 0, 4, "x", "f")]
    ops = spark.createDataFrame(rows, OP).withColumn("dedup_key", F.col("op_index").cast("string"))
    votes = spark.createDataFrame([(1, "0", 3), (1, "1", 2), (1, "2", 2), (1, "3", 2), (1, "4", 2), (1, "5", 2)], "doc_id long, dedup_key string, votes long")
    got = {x.op_index: (x.outcome, x.type) for x in vote.settle(ops, votes).collect()}
    assert got == {0: ("kept", "replace_range"), 1: ("outvoted", "replace_range"), 2: ("tied", "add_comment"), 3: ("tied", "add_comment"), 4: ("kept", "insert_at"), 5: ("kept", "add_comment")}


def test_quotes(spark):
    text = "This sentence is for testing the judge reconciliation logic in practice."
    assert fuzzy.locate("This sentence is for [[testing]] the judge reconciliation logic.", text) == (21, 28)
    assert fuzzy.locate("word and [[word]] again", "😀 word and word again") == (12, 16)
    assert fuzzy.locate("one[[ ]] two", "say one two") == (7, 7) and fuzzy.locate("no markers", text) is None
    assert fuzzy.locate("caf[[é]] x", "un café x") == (6, 8)
    frame = spark.createDataFrame([("This sentence is for [[testing]] the judge reconciliation logic.", text), ("is [[for]] testing", text), ("zz[[qq]]", text)], "quoted_text string, accepted_text string")
    assert [(x.found_start, x.found_end) for x in fuzzy.derive_ranges(frame).collect()] == [(17, 20), (21, 28), (None, None)]
    row = spark.createDataFrame([("  a \n b  ", "0123456789abcdefghijXYZklmnopqrstuvwxyz")], "a string, b string")
    got = row.select(shorten(F.col("a"), 2).alias("s"), collapse(F.col("a")).alias("c"), quote(F.col("b"), F.lit(20), F.lit(23)).alias("q"), target_label(F.lit(" "), F.lit("p"), F.lit(None)).alias("l"), render("x{{A}}", {"A": F.col("s0") if False else F.lit("1")}).alias("r")).first()
    assert (got.s, got.c, got.q, got.l, got.r) == ("a…", " a b ", "56789abcdefghij[[XYZ]]klmnopqrstuvwxy", "?:p", "x1")


def test_json(spark):
    rows = ['{"a": 1}', 'text\n```json\n{"a": 2}\n```', 'so {"a": {"b": 3}} there', "{bad", "none"]
    got = [x.s for x in spark.createDataFrame([(r,) for r in rows], "t string").select(jsontext.salvage(F.col("t")).alias("s")).collect()]
    assert got == ['{"a": 1}', '{"a": 2}', '{"a": {"b": 3}}', None, None]
    line = '{"role":"assistant","content":[{"type":"text","text":"a"},{"type":"think","text":"x"},{"type":"text","text":"b"}]}'
    assert spark.createDataFrame([(line,)], "t string").select(jsontext.assistant_text(F.col("t")).alias("s")).first().s == "ab"


def test_headings(spark):
    html = "<h1>A<p>one<h2>B<p>two<h1>C<li>three<footer>end</footer>"
    got = sources.page_units(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")).orderBy("order_index").collect()
    assert [(x.accepted_text, x.heading_path) for x in got] == [("A", ["A"]), ("one", ["A"]), ("B", ["A", "B"]), ("two", ["A", "B"]), ("C", ["C"]), ("three", ["C"]), ("end", ["C"])]


def package(body):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
        z.writestr("word/footnotes.xml", f'<w:footnotes {w}><w:footnote w:id="1"><w:p><w:r><w:t>note</w:t></w:r></w:p></w:footnote></w:footnotes>')
    return out.getvalue()


PLAIN = '<w:p><w:r><w:rPr><w:b/></w:rPr><w:t xml:space="preserve">Alpha beta </w:t></w:r><w:r><w:t>gamma delta</w:t></w:r>{}<w:r><w:t>.</w:t></w:r></w:p>'


def docx_op(kind, start, end, snippet, payload="", **more):
    return {"type": kind, "part": BODY, "paragraph_index_in_part": 0, "range_start": start, "range_end": end, "snippet": snippet, "replacement": payload, "new_text": payload, "comment_text": payload, "accepted_text": "Alpha beta gamma delta."} | more


def test_docx(spark, tmp_path):
    data = package(PLAIN.format(""))
    (tmp_path / "a.docx").write_bytes(data)
    read = docx_source.read_docx(spark, str(tmp_path)).orderBy("order_index").collect()
    assert [(x.part_kind, x.accepted_text, x.order_index) for x in read] == [("body", "Alpha beta gamma delta.", 0), ("footnotes", "note", 1)]
    ops = [docx_op("replace_range", 6, 10, "beta", "BETA"), docx_op("insert_at", 16, 16, "", "++"), docx_op("delete_range", 17, 22, "delta"), docx_op("add_comment", 0, 5, "Alpha", "Check.")]
    out, log = docx_sink.annotate(data, ops, "a", "2026-01-01T00:00:00Z")
    assert [e["status"] for e in log] == ["applied"] * 4 and docx_sink.validate(out, log) == []
    assert [u[4] for u in docx_source.package_units(out)][0] == "Alpha BETA gamma++ ."
    wrong = docx_sink.annotate(data, [docx_op("replace_range", 6, 10, "WRONG", "x")], "a", "d")[1][0]
    assert (wrong["reason"], wrong["actual_snippet"]) == ("snippet_mismatch", "beta")
    hint = docx_sink.annotate(data, [docx_op("replace_range", 6, 10, "beta", "x", paragraph_index_in_part=None, path_hint=".//w:p[1]")], "a", "d")[1][0]
    assert hint["status"] == "applied" and hint["paragraph_index_in_part"] == 0
    noted = package(PLAIN.format('<w:r><w:footnoteReference w:id="1"/></w:r>'))
    out, log = docx_sink.annotate(noted, [docx_op("replace_range", 17, 23, "delta.", "x")], "a", "d")
    assert log[0]["reason"] == "range_intersects_preserved_inline_element"
    out, log = docx_sink.annotate(noted, [docx_op("add_comment", 6, 10, "beta", "c")], "a", "d")
    xml = zipfile.ZipFile(io.BytesIO(out)).read(BODY)
    assert log[0]["status"] == "applied" and b"footnoteReference" in xml
    field = package('<w:p><w:fldSimple w:instr="X"><w:r><w:t>Alpha beta gamma delta.</w:t></w:r></w:fldSimple></w:p>')
    for kind in ("replace_range", "add_comment"):
        out, log = docx_sink.annotate(field, [docx_op(kind, 6, 10, "beta", "x")], "a", "d")
        z = zipfile.ZipFile(io.BytesIO(out))
        assert log[0]["reason"] == "unsupported_paragraph_structure" and z.read(BODY) == zipfile.ZipFile(io.BytesIO(field)).read(BODY) and "word/comments.xml" not in z.namelist()


def test_docx_over_a_dataframe(spark):
    data = package(PLAIN.format(""))
    packages = spark.createDataFrame([("a", bytearray(data)), ("b", bytearray(data)), ("c", bytearray(data))], "path string, content binary")
    rows = [("a", 7, "replace_range", BODY, 0, 6, 10, "beta", "BETA", None, None), ("a", 8, "add_comment", BODY, 0, 0, 5, "Alpha", None, None, "Why?"), ("a", 9, "replace_range", BODY, 0, 0, 5, "Wrong", "x", None, None), ("b", 1, "insert_at", BODY, 4, 0, 0, "", None, "x", None)]
    ops = spark.createDataFrame(rows, "path string, op_index int, type string, part string, paragraph_index_in_part int, range_start int, range_end int, snippet string, replacement string, new_text string, comment_text string")
    out = {x.path: x for x in docx_sink.annotate_packages(packages, ops, "a", "2026-01-01T00:00:00Z").collect()}
    assert {e.op_index: (e.status, e.reason) for e in out["a"].log} == {7: ("applied", None), 8: ("applied", None), 9: ("skipped", "snippet_mismatch")} and out["a"].problems == []
    assert [u[4] for u in docx_source.package_units(bytes(out["a"].content))][0] == "Alpha BETA gamma delta."
    assert out["b"].log[0].reason == "target_not_found" and bytes(out["c"].content) == data and out["c"].log == []
    changes = spark.createDataFrame([(1, 1, "p:q", "old", "new"), (1, 0, "p:r", "was", ""), (2, 0, "p:q", "x", "y & z")], "doc_id long, patch_pos int, stable_location string, exact_snippet string, after_snippet string")
    made = {x.doc_id: bytes(x.content) for x in docx_sink.report_packages(changes).collect()}
    assert [u[4] for u in docx_source.package_units(made[1])] == ["#", "At", "Suggestion", "1", "p:r: was", "", "2", "p:q: old", "new", ""]
    assert b"<w:b" in zipfile.ZipFile(io.BytesIO(made[2])).read(BODY) or b":b " in zipfile.ZipFile(io.BytesIO(made[2])).read(BODY)


def test_artifacts_and_stream(spark, tmp_path):
    (tmp_path / "r").mkdir()
    for n, text in ((1, "A"), (2, "A"), (3, "B")):
        (tmp_path / "r" / f"chunk_000{n}_result.json").write_text(f'{{"chunk_id": "chunk_000{n}", "ops": [{{"type": "add_comment", "target": {{"part": "p", "para_id": "q", "unit_uid": "u"}}, "range": {{"start": 0, "end": 0}}, "comment_text": "{text}"}}]}}')
    ops = artifacts.read_results(spark, str(tmp_path / "r"), "ralph_0")
    assert ops.count() == 3 and artifacts.prefer(ops.union(ops.limit(1).withColumn("run", F.lit("judged")))).count() == 3
    query = results.first_ops(results.result_stream(spark, str(tmp_path / "r"))).writeStream.format("memory").queryName("ops").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("ops").count() == 2
    with pytest.raises(ValueError):
        artifacts.find_input(str(tmp_path))
    (tmp_path / "x.docx").write_bytes(b"")
    assert artifacts.find_input(str(tmp_path)).endswith("x.docx")


def test_pipeline_resumes(spark, tmp_path):
    docs = spark.createDataFrame([(1, "These seven words should certainly appear once.\nAnother distinct paragraph follows right behind."), (2, "short")], "doc_id long, text string")
    run = Pipeline(spark, str(tmp_path), Budget(120, 0.25, 40))
    first = run.run(sources.document_units(docs)).count()
    assert first > 0 and run.run(start="merge").count() == first and run.sanitized().count() > 0
    with pytest.raises(ValueError):
        run.run(start="extract")
    assert review.word_frequency(run.load("extract")).count() > 0


def test_entry_without_llm(tmp_path):
    """With the training-data folders gone the rest still loads; a fault inside them is not hidden."""
    import pathlib
    import shutil
    import subprocess
    import sys

    top = pathlib.Path(__file__).resolve().parent.parent
    shutil.copytree(top / "scriptorium", tmp_path / "scriptorium", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    ask = "import __spark_entry__ as e; q = e.queries(); assert 'search_literal' in q and not any(n.startswith('op') or n == 'pipeline' for n in q) and set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", ask], cwd=tmp_path, timeout=120).returncode == 0
    (tmp_path / "scriptorium" / "llm").mkdir()
    (tmp_path / "scriptorium" / "llm" / "__init__.py").write_text("")
    (tmp_path / "scriptorium" / "llm" / "queries.py").write_text("import no_such_module\n")
    assert subprocess.run([sys.executable, "-c", ask], cwd=tmp_path, timeout=120, stderr=subprocess.DEVNULL).returncode != 0
