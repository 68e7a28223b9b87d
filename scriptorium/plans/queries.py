"""The registered queries of the review engine over the driver's tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..conf import QUERY_BUDGET
from ..functions import fuzzy, jsontext
from ..functions.schema import schema_faults
from ..functions.offsets import utf16_length
from ..functions.text import quote
from ..operators import apply, chunk, fixes, merge, overrides, report, review, sanitize, search, vote
from ..sources import artifacts
from ..sources import units as sources
from ..streaming import results as streams
from ..tables import keep

LITERAL, REGEX = "the", "[Tt]h[ae]t?[a-z]{1,3}"
RUNS = 3


class Stages:
    """The stages over documents. A stage that others read several times is written once, as a
    table in the shared folder; the others are plans."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        self.units = sources.document_units(self.docs)

    @cached_property
    def plan(self) -> DataFrame:
        """The packed units, not written, for queries that read them once."""
        return chunk.pack(self.units, QUERY_BUDGET)

    @cached_property
    def packed(self) -> DataFrame:
        return keep(self.plan, "packed")[0]

    @property
    def members(self) -> DataFrame:
        return chunk.chunk_units(self.packed, QUERY_BUDGET)

    @property
    def raw(self) -> DataFrame:
        return review.disturbed(self.packed)

    @cached_property
    def ops(self) -> DataFrame:
        return keep(self.raw, "ops")[0]

    @property
    def owned(self) -> DataFrame:
        return merge.own(self.ops if "ops" in self.__dict__ else self.raw, self.members)

    @property
    def resolved(self) -> DataFrame:
        return merge.resolve(keep(self.owned, "owned")[0], self.packed)

    @property
    def deduped(self) -> DataFrame:
        return merge.dedup(self.resolved)

    @property
    def downgraded(self) -> DataFrame:
        return merge.downgrade(keep(self.deduped, "deduped")[0])

    @cached_property
    def patch(self) -> DataFrame:
        return keep(merge.order(self.downgraded), "patch")[0]

    @property
    def final(self) -> DataFrame:
        return overrides.apply_overrides(self.patch, self.actions(self.patch))

    @property
    def log(self) -> DataFrame:
        return apply.check(spoiled(self.patch), self.packed)

    @staticmethod
    def actions(patch: DataFrame) -> DataFrame:
        """Overrides made from positions: drop every seventh op, downgrade every fifth, and one
        action of each kind that has to be ignored."""
        pos = F.col("patch_pos")
        made = F.array_compact(F.array(
            F.when(pos % 7 == 0, F.struct(F.lit("drop_op").alias("action"), pos.alias("op_index"), F.lit(None).cast("string").alias("op_id"), F.lit(None).cast("string").alias("comment_text"))),
            F.when(pos % 5 == 0, F.struct(F.lit("downgrade_to_comment").alias("action"), F.lit(None).cast("int").alias("op_index"), F.col("dedup_key").alias("op_id"), F.lit("Checked by hand.").alias("comment_text"))),
            F.when(pos == 1, F.struct(F.lit("drop_op").alias("action"), F.lit(100000).alias("op_index"), F.lit(None).cast("string").alias("op_id"), F.lit(None).cast("string").alias("comment_text"))),
            F.when(pos == 2, F.struct(F.lit("downgrade_to_comment").alias("action"), pos.alias("op_index"), F.lit(None).cast("string").alias("op_id"), F.lit(" ").alias("comment_text"))),
            F.when(pos == 3, F.struct(F.lit("rewrite").alias("action"), pos.alias("op_index"), F.lit(None).cast("string").alias("op_id"), F.lit(None).cast("string").alias("comment_text"))),
        ))
        return patch.select("doc_id", F.col("patch_pos").alias("seq"), F.inline(made))


def spoiled(patch: DataFrame) -> DataFrame:
    """A patch in which every eleventh op expects another text, every thirteenth has no target and
    every seventeenth lies outside its unit, so that guards have something to catch."""
    pos = F.col("patch_pos")
    return patch.withColumns({
        "snippet": F.when((pos % 11 == 3) & (F.col("range_start") < F.col("range_end")), "WRONG").otherwise(F.col("snippet")),
        "para_id": F.when(pos % 13 == 5, "para_none").otherwise(F.col("para_id")),
        "range_end": F.when(pos % 17 == 7, F.col("range_end") + 100000).otherwise(F.col("range_end")),
    })


def _tables(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


UNIT = ("doc_id", "part", "part_kind", "paragraph_index_in_part", "accepted_text", "order_index", "para_id", "unit_uid")


def units_documents(spark, d):
    return Stages(spark, d).units.select(*UNIT)


def units_conversations(spark, d):
    return sources.conversation_units(_tables(spark, d, "conversations")).select(*UNIT)


def units_pages(spark, d):
    units = sources.page_units(_tables(spark, d, "pages"))
    return units.select(*UNIT, F.array_join("heading_path", " > ").alias("heading_path"))


def doc_struct(spark, d):
    return sources.doc_struct(sources.page_units(_tables(spark, d, "pages")))


def search_literal(spark, d):
    return search.search(Stages(spark, d).units, LITERAL)


def search_literal_ci(spark, d):
    return search.search(Stages(spark, d).units, "The", ignore_case=True)


def search_regex(spark, d):
    return search.search(Stages(spark, d).units, REGEX, regex=True)


def search_summary(spark, d):
    units = Stages(spark, d).units
    return search.summary(units, search.search(units, LITERAL))


def word_unique(spark, d):
    return review.word_frequency(Stages(spark, d).units)


def chunk_pack(spark, d):
    return Stages(spark, d).plan.select("doc_id", "order_index", "token_estimate", "chunk_index")


def chunk_context(spark, d):
    return Stages(spark, d).members.select("doc_id", "chunk_id", "role", "editable", "pos", "order_index", "token_estimate")


def chunk_manifest(spark, d):
    return chunk.manifest(Stages(spark, d).members, QUERY_BUDGET).drop("primary_tokens", "context_before_tokens", "context_after_tokens")


def chunk_tokens(spark, d):
    return chunk.manifest(Stages(spark, d).members, QUERY_BUDGET).select("doc_id", "chunk_id", "primary_tokens", "context_before_tokens", "context_after_tokens", "total_tokens")


def chunk_overflow(spark, d):
    return chunk.manifest(Stages(spark, d).members, QUERY_BUDGET).filter("allowed_overflow").select("doc_id", "chunk_id", "total_tokens", "primary_unit_count", "context_before_count", "context_after_count")


def _fixes(last: DataFrame) -> DataFrame:
    """Fixes made from the documents' numbers: shifts and merges that build on one another, and one
    of each kind of error. last(doc_id, last): the index of the last chunk."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("seq"), F.lit(kind).alias("type"), F.lit(f"chunk_{left:04d}").alias("left_chunk_id"), F.lit(f"chunk_{right:04d}").alias("right_chunk_id"), F.lit(move).alias("move"), F.lit(case).alias("case"))
        for case, fixes in enumerate(FIXES) for i, (kind, left, right, move) in enumerate(fixes)
    ])
    return last.filter("last >= 3").select("doc_id", F.explode(rows).alias("f")).select("doc_id", "f.*").filter(F.col("case") == F.col("doc_id") % len(FIXES)).drop("case")


#: Type, left and right chunk and move of the fixes of a document, by its number modulo their count.
FIXES = (
    (("shift_boundary", 1, 2, 1),),
    (("shift_boundary", 1, 2, -1), ("shift_boundary", 2, 3, -1)),
    (("merge_adjacent", 1, 2, 0), ("merge_adjacent", 1, 3, 0)),
    (("merge_adjacent", 2, 3, 0), ("shift_boundary", 2, 4, 1)),
    (("shift_boundary", 1, 2, 1), ("shift_boundary", 1, 2, 1000)),
    (("shift_boundary", 2, 3, -1000),),
    (("merge_adjacent", 1, 2, 0), ("shift_boundary", 2, 3, 1)),
    (("merge_adjacent", 1, 3, 0),),
    (("split", 1, 2, 0),),
)


def _fixed(spark, d):
    members, _ = keep(Stages(spark, d).members.select("doc_id", "chunk_id", "chunk_index", "role", "order_index"), "members")
    return fixes.apply_fixes(members, _fixes(members.groupBy("doc_id").agg(F.max("chunk_index").alias("last"))))


def chunk_fixes(spark, d):
    """The primary units of fixed documents, and the error where a fix could not be applied."""
    return _fixed(spark, d).filter("role = 'primary'").select("doc_id", "order_index", "chunk_id", "error")


def chunk_fix_context(spark, d):
    return _fixed(spark, d).filter("role <> 'primary' and error is null").select("doc_id", "chunk_id", "role", "order_index")


def chunk_invariants(spark, d):
    """Violations: a unit that is primary in other than one chunk, or primary and context in one."""
    members = Stages(spark, d).members
    twice = members.filter("role = 'primary'").groupBy("doc_id", "unit_uid").agg(F.count("*").alias("n")).filter("n <> 1").select("doc_id", "unit_uid", F.lit("primary_not_once").alias("rule"))
    both = members.groupBy("doc_id", "chunk_id", "unit_uid").agg(F.count_distinct("editable").alias("n")).filter("n > 1").select("doc_id", "unit_uid", F.lit("primary_and_context").alias("rule"))
    return twice.unionByName(both)


OP = ("doc_id", "chunk_id", "op_index", "type", "part", "para_id", "unit_uid", "quoted_text", "range_start", "range_end", "snippet", "replacement", "new_text", "comment_text")


def synth_ops(spark, d):
    return Stages(spark, d).raw.select(*OP)


def synth_first(spark, d):
    first = review.first_result(keep(review.dry_run(Stages(spark, d).plan), "proposals")[0])
    return first.select("doc_id", "chunk_index", "order_index", "k", "type", "snippet", "range_start")


def quoted_range_exact(spark, d):
    stages = Stages(spark, d)
    ops = stages.raw.filter("quoted_text is not null")
    return fuzzy.exact_ranges(ops.join(stages.packed.select("doc_id", "unit_uid", "accepted_text"), ["doc_id", "unit_uid"])).select("doc_id", "chunk_id", "op_index", F.col("found_start").alias("start_at"), F.col("found_end").alias("end_at"))


def quoted_range_fuzzy(spark, d):
    """Quotes with a letter changed and a doubled space, found again by similarity."""
    units = Stages(spark, d).units
    changed = F.concat(F.substring("accepted_text", 6, 14), F.lit("#"), F.substring("accepted_text", 21, 9), F.lit("[["), F.substring("accepted_text", 30, 6), F.lit("]]"), F.substring("accepted_text", 36, 12))
    return fuzzy.derive_ranges(units.withColumn("quoted_text", changed)).select("doc_id", "unit_uid", "found_start", "found_end")


def sanitize_reasons(spark, d):
    stages = Stages(spark, d)
    return sanitize.sanitize(stages.raw, stages.members).select("doc_id", "chunk_id", "op_index", "type", "part", "para_id", "reason")


def sanitize_log(spark, d):
    stages = Stages(spark, d)
    return sanitize.log(sanitize.sanitize(stages.raw, stages.members))


def ownership(spark, d):
    return Stages(spark, d).owned.select("doc_id", "chunk_id", "op_index", "owner_reason")


def uid_autofill(spark, d):
    return Stages(spark, d).owned.filter("autofilled").select("doc_id", "chunk_id", "op_index", "unit_uid")


def range_resolution(spark, d):
    return Stages(spark, d).resolved.filter("range_event is not null").select("doc_id", "chunk_id", "op_index", "range_event", "type", "range_start", "range_end", "comment_text")


def dedup_ops(spark, d):
    return Stages(spark, d).deduped.select("doc_id", "chunk_id", "op_index", "type", "dedup_key")


def conflict_pairs(spark, d):
    return merge.conflict_pairs(keep(Stages(spark, d).deduped, "deduped")[0])


def conflict_greedy(spark, d):
    return Stages(spark, d).downgraded.select("doc_id", "chunk_id", "op_index", "type", "downgraded", "comment_text")


def patch_order(spark, d):
    return Stages(spark, d).patch.select("doc_id", "patch_pos", "chunk_id", "op_index", "type", "range_start", "range_end")


def merge_stats(spark, d):
    stages = Stages(spark, d)
    ops = stages.ops
    owned, _ = keep(merge.own(ops, stages.members), "owned")
    resolved, _ = keep(merge.resolve(owned, stages.packed), "resolved")
    patch = merge.downgrade(keep(merge.dedup(resolved), "deduped")[0])
    return merge.stats(ops, owned, resolved, patch)


def merge_reasons(spark, d):
    stages = Stages(spark, d)
    owned, _ = keep(stages.owned, "owned")
    rejected = owned.filter("owner_reason is not null").select(F.col("owner_reason").alias("reason"))
    events = merge.resolve(owned, stages.packed).filter("range_event is not null").select(F.col("range_event").alias("reason"))
    return rejected.union(events).groupBy("reason").agg(F.count("*").alias("n"))


def qa_overrides(spark, d):
    stages = Stages(spark, d)
    return stages.final.select("doc_id", "patch_pos", "type", "comment_text")


def qa_override_report(spark, d):
    patch = Stages(spark, d).patch
    return overrides.override_report(patch, Stages.actions(patch))


def apply_guard(spark, d):
    return Stages(spark, d).log.select("doc_id", "patch_pos", "status", "reason", "actual_snippet")


def apply_text(spark, d):
    return apply.apply_text(Stages(spark, d).log).select("doc_id", "para_id", "edits", "before_text", "after_text")


def apply_stats(spark, d):
    return apply.stats(Stages(spark, d).log)


def skip_breakdown(spark, d):
    return apply.skip_breakdown(Stages(spark, d).log)


def reconcile_patch_log(spark, d):
    """Half of the documents lose the first entry of their log, so that there is something to find."""
    stages = Stages(spark, d)
    log = stages.log.filter("not (doc_id % 2 = 0 and patch_pos = 0)")
    return apply.reconcile(stages.patch, log)


def changes(spark, d):
    return report.changes(Stages(spark, d).log)


def failed_ops(spark, d):
    return report.failed(Stages(spark, d).log)


def disambiguation(spark, d):
    return report.disambiguation(Stages(spark, d).log)


def adjacent_merge(spark, d):
    return report.adjacent(Stages(spark, d).log)


def report_stats(spark, d):
    stages = Stages(spark, d)
    return report.stats(stages.patch, stages.log)


def _runs(stages):
    """Three runs, each without a third of the ops."""
    made = stages.deduped.select("doc_id", "chunk_id", "dedup_key", F.explode(F.array(*[F.lit(i) for i in range(RUNS)])).alias("run"))
    number = F.conv(F.substring(F.sha2(F.concat_ws("|", "dedup_key", "run"), 256), 1, 8), 16, 10).cast("long")
    return made.filter(number % 3 != 0)


def ensemble_vote(spark, d):
    return vote.vote(_runs(Stages(spark, d)), RUNS)


def ensemble_settled(spark, d):
    deduped, _ = keep(Stages(spark, d).deduped, "deduped")
    number = F.conv(F.substring("dedup_key", 1, 4), 16, 10).cast("long") % 2
    votes = deduped.select("doc_id", "dedup_key", (number + 2).alias("votes"))
    return vote.settle(deduped, votes).select("doc_id", "chunk_id", "op_index", "votes", "outcome", "type", "comment_text")


def report_suggestions(spark, d):
    return report.suggestions(keep(Stages(spark, d).log, "log")[0]).filter("merged_op_indices is not null").select("doc_id", "part", "para_id", "patch_pos", "exact_snippet", "after_snippet", "merged_op_indices")


def ensemble_missing(spark, d):
    stages = Stages(spark, d)
    return vote.missing(_runs(stages), stages.members.select("doc_id", "chunk_id").distinct(), RUNS)


def json_salvage(spark, d):
    """Answers with the object bare, fenced, inside prose or broken, and what is saved of them."""
    turns = _tables(spark, d, "conversations").select("conv_id", "turn", F.to_json(F.struct(F.lit("ok").alias("status"), F.col("role"), F.length("text").alias("size"))).alias("j"))
    shape = (F.col("conv_id") + F.col("turn")) % 4
    answer = F.when(shape == 0, F.col("j")).when(shape == 1, F.concat(F.lit("Here it is:\n```json\n"), "j", F.lit("\n```\nDone."))).when(shape == 2, F.concat(F.lit("I found "), "j", F.lit(" as asked."))).otherwise(F.substring("j", 1, 12))
    saved = jsontext.salvage(answer)
    return turns.select("conv_id", "turn", F.get_json_object(saved, "$.role").alias("role"), F.get_json_object(saved, "$.size").cast("long").alias("size"))


ANSWER = {
    "type": "object", "required": ["status", "ops"],
    "properties": {"status": {"type": "string"}, "score": {"type": "number"}, "done": {"type": "boolean"}, "ops": {"type": "array", "items": {"type": "object", "required": ["type"], "properties": {"type": {"type": "string"}, "at": {"type": "integer"}}}}},
}


def schema_check(spark, d):
    """Answers with one fault of each kind, and the messages."""
    turns = _tables(spark, d, "conversations")
    case = (F.col("conv_id") + F.col("turn")) % 8
    shapes = [
        '{"status": "ok", "ops": [{"type": "x", "at": 1}], "score": 1.5, "done": true, "more": 1}', '{"ops": []}', '{"status": 1, "ops": {}}', '{"status": "ok", "ops": [{"type": "x"}, {"at": true}]}',
        '{"status": "ok", "ops": [1], "score": false, "done": 0}', "[]", '{"status": null, "ops": [{"type": [], "at": 1.5}]}', "{broken",
    ]
    answer = F.coalesce(*[F.when(case == i, F.lit(t)) for i, t in enumerate(shapes)])
    return turns.select("conv_id", "turn", F.array_join(schema_faults(answer, ANSWER), "; ").alias("faults"))


def alternate_ops(spark, d):
    """The ops of chunks written by a reviewer that says patch_ops and target_unit_uid, in the usual shape."""
    stages = Stages(spark, d)
    ops = stages.raw.filter("type <> 'unknown_type'")
    op = F.struct(F.col("op_index").alias("i"), "type", F.col("unit_uid").alias("target_unit_uid"), F.struct(F.col("range_start").alias("start"), F.col("range_end").alias("end")).alias("range"), "comment_text")
    answers = ops.groupBy("doc_id", "chunk_id").agg(F.to_json(F.struct("chunk_id", F.array_sort(F.collect_list(op)).alias("patch_ops"))).alias("answer"))
    read = answers.select("doc_id", F.from_json("answer", artifacts.RESULT_DDL).alias("a")).select("doc_id", "a.*")
    return artifacts.full_targets(artifacts.flat_ops(read, "doc_id"), stages.members, "doc_id").select("doc_id", "chunk_id", "op_index", "type", "part", "para_id", "unit_uid", "range_start", "range_end")


def sanitize_conversions(spark, d):
    stages = Stages(spark, d)
    return sanitize.conversions(sanitize.sanitize(stages.raw, stages.members))


def review_totals(spark, d):
    stages = Stages(spark, d)
    return sanitize.totals(sanitize.log(sanitize.sanitize(stages.raw, stages.members)))


def review_summaries(spark, d):
    stages = Stages(spark, d)
    return sanitize.summaries(sanitize.log(sanitize.sanitize(stages.raw, stages.members)))


def failed_in_order(spark, d):
    """Failed ops in order; every third index is no number, so that there is something to put last."""
    lost = report.failed(Stages(spark, d).log)
    return report.failed_in_order(lost.withColumn("op_index", F.when(F.col("op_index") % 3 == 0, F.concat(F.lit("op "), F.col("op_index").cast("string"))).otherwise(F.col("op_index").cast("string")))).select("doc_id", "op_index", "skip_reason", "place")


def event_windows(spark, d):
    return streams.event_windows(_tables(spark, d, "events")).select("start_at", "end_at", "event_type", "n")


def event_sessions(spark, d):
    return streams.sessions(_tables(spark, d, "events"))


NAMES = (
    "schema_check", "ensemble_settled", "report_suggestions", "alternate_ops", "sanitize_conversions", "review_totals", "review_summaries", "failed_in_order", "event_windows", "event_sessions",
    "units_documents", "units_conversations", "units_pages", "doc_struct", "search_literal", "search_literal_ci", "search_regex", "search_summary", "word_unique",
    "chunk_pack", "chunk_manifest", "chunk_tokens", "chunk_context", "chunk_overflow", "chunk_fixes", "chunk_fix_context", "chunk_invariants",
    "synth_ops", "synth_first", "quoted_range_exact", "quoted_range_fuzzy", "sanitize_reasons", "sanitize_log", "ownership", "uid_autofill", "range_resolution",
    "dedup_ops", "conflict_pairs", "conflict_greedy", "patch_order", "merge_stats", "merge_reasons", "qa_overrides", "qa_override_report",
    "apply_guard", "apply_text", "apply_stats", "skip_breakdown", "reconcile_patch_log", "changes", "failed_ops", "disambiguation", "adjacent_merge", "report_stats",
    "ensemble_vote", "ensemble_missing", "json_salvage",
)
QUERIES = {name: globals()[name] for name in NAMES}
