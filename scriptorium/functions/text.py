"""Small text helpers as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..conf import FIELD, NULL, QUOTE_CONTEXT


def strip(text: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", " ")


def shorten(text: Column, limit: int) -> Column:
    """One line of at most limit characters, with an ellipsis where it was cut."""
    one = strip(collapse(text))
    return F.when(F.length(one) > limit, F.concat(F.substring(one, 1, limit - 1), F.lit("…"))).otherwise(one)


def shout(word: Column) -> Column:
    """The word in upper case, or marked where it is in upper case already."""
    return F.when(F.upper(word) == word, F.concat(word, F.lit("_DRYRUN"))).otherwise(F.upper(word))


def render(template: str, values: dict[str, Column]) -> Column:
    """The template with every {{NAME}} replaced."""
    return reduce(lambda text, kv: F.replace(text, F.lit("{{" + kv[0] + "}}"), kv[1]), values.items(), F.lit(template))


def target_label(part: Column, para: Column, uid: Column) -> Column:
    """part:para[:uid], with ? for a blank part or paragraph."""
    known = lambda c: F.coalesce(F.nullif(strip(c), F.lit("")), F.lit("?"))
    return F.concat_ws(":", known(part), known(para), F.nullif(strip(uid), F.lit("")))


def identity(prefix: str, digits: int, *fields: Column) -> Column:
    """A stable id: the prefix and the first digits of the SHA-256 of the joined fields."""
    joined = F.concat_ws(FIELD, *[F.coalesce(f.cast("string"), F.lit(NULL)) for f in fields])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, digits))


def quote(text: Column, start: Column, end: Column) -> Column:
    """before[[target]]after with as much context as there is, up to 15 characters a side; offsets in code points."""
    low = F.greatest(F.lit(0), start - QUOTE_CONTEXT)
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    return F.concat(piece(low, start), F.lit("[["), piece(start, end), F.lit("]]"), piece(end, end + QUOTE_CONTEXT))
