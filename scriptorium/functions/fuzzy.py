"""Ranges of quotes whose target is marked: before[[target]]after."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..conf import COLLAPSED_THRESHOLD, FUZZY_THRESHOLD
from .offsets import utf16_offset

MARKED = r"(?s)^(.*?)\[\[(.*?)\]\](.*)$"


def marked(quoted: Column) -> Column:
    """Exactly one opening and one closing marker."""
    return (F.regexp_count(quoted, F.lit(r"\[\[")) == 1) & (F.regexp_count(quoted, F.lit(r"\]\]")) == 1) & quoted.rlike(MARKED)


def exact_ranges(df: DataFrame, quoted: str = "quoted_text", text: str = "accepted_text") -> DataFrame:
    """df with found_start and found_end in code units where the quote without its markers occurs
    in the text, else null. A target of white space alone is the point after the text before it."""
    q = F.col(quoted)
    part = lambda k: F.regexp_extract(q, MARKED, k)
    blank = ~part(2).rlike(r"\S")
    target = F.when(blank, "").otherwise(part(2))
    needle = F.concat(part(1), target, part(3))
    df = df.withColumns({"__needle": needle, "__ok": marked(q) & (F.length(needle) > 0)})
    at = F.expr(f"locate(__needle, `{text}`)")
    df = df.withColumn("__at", F.when(F.col("__ok") & (at > 0), at - 1 + F.length(part(1))))
    body = F.col(text)
    out = df.withColumns({"found_start": utf16_offset(body, F.col("__at")), "found_end": utf16_offset(body, F.col("__at") + F.length(target))})
    return out.drop("__needle", "__ok", "__at")


def derive_ranges(df: DataFrame, quoted: str = "quoted_text", text: str = "accepted_text") -> DataFrame:
    """As exact_ranges, and quotes that don't occur are found by similarity. Only those reach
    Python: the exact branch stays in the JVM."""
    found = exact_ranges(df, quoted, text)
    exact, missed = found.filter("found_start is not null"), found.filter("found_start is null").drop("found_start", "found_end")
    ranged = missed.withColumn("__r", similar(F.col(quoted), F.col(text)))
    return exact.unionByName(ranged.withColumns({"found_start": F.col("__r.start"), "found_end": F.col("__r.end")}).drop("__r"))


@F.pandas_udf(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
def similar(quoted: pd.Series, text: pd.Series) -> pd.DataFrame:
    pairs = [locate(q, t) or (None, None) for q, t in zip(quoted, text, strict=True)]
    return pd.DataFrame(pairs, columns=["start", "end"], dtype="Int32")


def locate(quoted: str | None, text: str | None) -> tuple[int, int] | None:
    """The target's range in code units of the text as it is given. The quote is compared in form C
    and, failing that, with white space collapsed; places are mapped back to the given text."""
    if not quoted or text is None or quoted.count("[[") != 1 or quoted.count("]]") != 1 or not (m := re.match(MARKED, quoted)):
        return None
    before, target, after = m.groups()
    if not target.strip():
        target = ""
    for collapse, threshold in ((False, FUZZY_THRESHOLD), (True, COLLAPSED_THRESHOLD)):
        body, back = _form(text, collapse)
        lead, mid, rest = (_form(x, collapse)[0] for x in (before, target, after))
        start = best_window(lead + mid + rest, body, threshold)
        if start is not None:
            a = min(start + len(lead), len(body))
            # the target may have moved a little inside a window that is only similar
            near = [p for p in range(max(0, a - 3), min(len(body), a + 3) + 1) if mid and body.startswith(mid, p)]
            a = min(near, key=lambda p: abs(p - a)) if near else a
            b = min(a + len(mid), len(body))
            units = lambda p: len(text[: back[p]].encode("utf-16-le", "surrogatepass")) // 2
            return units(a), units(b)
    return None


def _form(text: str, collapse: bool) -> tuple[str, list[int] | range]:
    """The text in form C, white space collapsed or not, and for each of its characters (and its
    end) the place in the given text."""
    if not collapse and unicodedata.is_normalized("NFC", text):
        return text, range(len(text) + 1)
    out, back, at = [], [], 0
    # a character and the marks that follow it are normalized together
    for piece in re.findall(r"(?s).[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯]*", text):
        for c in unicodedata.normalize("NFC", piece):
            if collapse and c.isspace():
                if out and out[-1] == " ":
                    continue
                c = " "
            out.append(c)
            back.append(at)
        at += len(piece)
    return "".join(out), [*back, len(text)]


def letter_bound(needle: str, text: str) -> np.ndarray:
    """For every window of the needle's length, an upper bound of its similarity: the letters that
    it has in common with the needle in any order, as a share. One running count for each letter."""
    n = len(needle)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    common = np.zeros(len(codes) - n + 1, np.int64)
    for letter, most in Counter(needle).items():
        upto = np.concatenate(([0], np.cumsum(codes == ord(letter))))
        common += np.minimum(upto[n:] - upto[:-n], most)
    return common / n


def best_window(needle: str, text: str, threshold: float) -> int | None:
    """The first place of the window of the needle's length that is most like it, if like enough.
    Needles of 100 characters or more are tried at every fifth place and then around the best.
    Windows are compared in the order of their upper bounds, until no other can be better."""
    n = len(needle)
    if not n or n > len(text):
        return None
    if (exact := text.find(needle)) >= 0:
        return exact
    bound = letter_bound(needle, text)

    def best_of(places: np.ndarray, best: float, at: int | None) -> tuple[float, int | None]:
        """The best of the places and of (best, at); of equals the first."""
        for p in places[np.argsort(-bound[places], kind="stable")].tolist():
            if bound[p] < best:
                break
            s = SequenceMatcher(None, needle, text[p : p + n], autojunk=True).ratio()
            if s > best or s == best and at is not None and p < at:
                best, at = s, p
        return best, at

    stride = 1 if n < 100 else 5
    places = np.arange(0, len(bound), stride)
    best, at = best_of(places[bound[places] >= threshold], 0.0, None)
    if at is None or best < threshold:
        return None
    if stride > 1:  # around the best one only a better one counts
        near = np.arange(max(0, at - stride), min(len(bound), at + stride + 1))
        better, place = best_of(near, best, None)
        at = place if better > best else at
    return at
