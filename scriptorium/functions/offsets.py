"""Ranges in UTF-16 code units over Spark strings, which count code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf16(text: Column) -> Column:
    return F.encode(text, "UTF-16LE")


def utf16_length(text: Column) -> Column:
    return F.floor(F.octet_length(utf16(text)) / 2).cast("int")


def utf16_slice(text: Column, start: Column, end: Column) -> Column:
    """The characters from start to end (exclusive), both in code units."""
    return F.decode(F.substring(utf16(text), (2 * start + 1).cast("int"), (2 * (end - start)).cast("int")), "UTF-16LE")


def utf16_offset(text: Column, points: Column) -> Column:
    """The code unit offset of a code point offset."""
    return utf16_length(F.substring(text, F.lit(1), points.cast("int")))


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Do [a, b) and [c, d) collide? Two points collide if equal, a point and a span also at the
    span's ends, and two spans only if they share a unit (touching spans don't)."""
    left_point, right_point = a == b, c == d
    return (
        F.when(left_point & right_point, a == c)
        .when(left_point, (c <= a) & (a <= d))
        .when(right_point, (a <= c) & (c <= b))
        .otherwise(F.greatest(a, c) < F.least(b, d))
    )


def spans_meet(a: int, b: int, c: int, d: int) -> bool:
    """overlap() on plain numbers, for rules that follow an order."""
    if a == b:
        return a == c if c == d else c <= a <= d
    return a <= c <= b if c == d else max(a, c) < min(b, d)
