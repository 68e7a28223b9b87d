"""Stage wiring: from units to report, with saved stage tables from which a run can resume."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..conf import Budget
from ..operators import apply, chunk, merge, overrides, report, review, sanitize

STAGES = ("extract", "chunk", "review", "sanitize", "merge", "final", "apply", "report")


@dataclass
class Pipeline:
    """Runs the stages over units and writes each one's table below folder. reviewer(packed) returns
    raw ops; the default is the deterministic dry run. Reviewers that call out are not repeatable,
    so their output is written before anything reads it. actions, if given, override the patch."""

    spark: SparkSession
    folder: str
    budget: Budget = field(default_factory=Budget)
    reviewer: object = None
    actions: DataFrame | None = None

    def path(self, stage: str) -> str:
        return f"{self.folder.rstrip('/')}/{stage}"

    def load(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(self.path(stage))

    def _save(self, stage: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(stage))
        return self.load(stage)

    def run(self, units: DataFrame | None = None, start: str = "extract", stop: str = "report") -> DataFrame:
        """Stages from start to stop; earlier ones are read from the folder. Returns the last table."""
        if start not in STAGES or stop not in STAGES or STAGES.index(start) > STAGES.index(stop):
            raise ValueError(f"stages run from {start} to {stop}")
        if start == "extract" and units is None:
            raise ValueError("units are needed to start from the beginning")
        out = None
        for stage in STAGES[STAGES.index(start) : STAGES.index(stop) + 1]:
            out = self._save(stage, getattr(self, f"_{stage}")(units))
        return out

    def _extract(self, units):
        return units

    def _chunk(self, _):
        return chunk.chunk_units(chunk.pack(self.load("extract"), self.budget), self.budget)

    def _review(self, _):
        packed = self.load("chunk").filter("role = 'primary'").drop("role", "editable", "pos", "chunk_id")
        raw = self.reviewer(packed) if self.reviewer else review.disturbed(packed)
        return raw.select(*raw.columns)

    def _sanitize(self, _):
        chunks = self.load("chunk")
        return sanitize.sanitize(sanitize.anchored(self.load("review"), chunks), chunks)

    def _merge(self, _):
        kept = self.load("sanitize").filter("reason is null").drop("reason")
        return merge.merge(kept, self.load("chunk"), self.load("extract"))

    def _final(self, _):
        patch = self.load("merge")
        return overrides.apply_overrides(patch, self.actions) if self.actions is not None else patch

    def _apply(self, _):
        return apply.check(self.load("final"), self.load("extract"))

    def _report(self, _):
        return report.changes(self.load("apply"))

    def sanitized(self) -> DataFrame:
        """Raw ops with the reason why one was dropped."""
        return self.load("sanitize")
