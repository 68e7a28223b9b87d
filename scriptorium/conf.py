"""Constants of the review engine and the decisions where behaviour was open."""

from __future__ import annotations

from dataclasses import dataclass

#: Operation kinds, the identity and schema names of the contract.
REVIEW_TYPES = ("add_comment", "replace_range", "insert_at")
MERGE_TYPES = ("add_comment", "replace_range", "insert_at", "delete_range")
EDIT_TYPES = ("replace_range", "insert_at", "delete_range")
WORD = "[A-Za-z][A-Za-z'-]{3,}"
BODY = "word/document.xml"
FUZZY_THRESHOLD, COLLAPSED_THRESHOLD = 0.80, 0.85
QUOTE_CONTEXT = 15
DRY_RUN_INSERT, DRY_RUN_COMMENT = " [DRY-RUN]", "Dry-run QA marker comment."

#: Separates fields in hashed identities and stands for null in them.
FIELD, NULL = "|", "~"


@dataclass(frozen=True)
class Budget:
    """Token budget of a chunk: the effective target is the smaller of the window's fraction and
    the hard maximum; before and after are context units on each side."""

    model_context_window: int = 128000
    target_fraction: float = 0.35
    hard_max_tokens: int = 2048
    overlap_before_units: int = 1
    overlap_after_units: int = 1

    @property
    def target(self) -> int:
        return min(int(self.model_context_window * self.target_fraction), self.hard_max_tokens)


#: The budget of the registered queries: small enough that documents have several chunks.
QUERY_BUDGET = Budget(model_context_window=512, target_fraction=0.5, hard_max_tokens=320)
#: Gaps of so many characters at most, without a sentence end, join two replacements in a report.
ADJACENT_GAP = 5
