"""JSON objects out of answers that may wrap, fence or break them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _valid(text: Column) -> Column:
    return F.when(F.try_parse_json(text).isNotNull() & F.ltrim(text).startswith("{"), text)


def salvage(answer: Column) -> Column:
    """The answer itself if it is an object, else the longest fenced block that is one, else the
    longest of the stretches from an opening brace to the last closing one; null if none is."""
    fenced = F.regexp_extract_all(answer, F.lit(r"(?s)```(?:json)?\s*(\{.*?\})\s*```"), F.lit(1))
    opened = F.split(answer, r"(?=\{)", -1)
    last = F.length(answer) - F.length(F.substring_index(answer, "}", -1))
    stretch = F.transform(F.sequence(F.lit(1), F.size(opened)), lambda i: F.substring(answer, F.length(F.array_join(F.slice(opened, F.lit(1), i - 1), "")) + 1, last))
    trimmed = F.transform(stretch, lambda s: F.regexp_replace(s, r"(?s)\}[^}]*$", "}"))
    longest = lambda xs: F.element_at(F.array_sort(F.filter(xs, lambda s: _valid(s).isNotNull()), lambda a, b: F.length(b) - F.length(a)), 1)
    pick = lambda xs: F.when(F.size(F.filter(xs, lambda s: _valid(s).isNotNull())) > 0, longest(xs))
    return F.coalesce(_valid(answer), pick(fenced), pick(trimmed))


def assistant_text(line: Column) -> Column:
    """The text parts of an assistant's line of a JSON stream, joined; null for other lines."""
    role = F.coalesce(F.get_json_object(line, "$.role"), F.get_json_object(line, "$.message.role"))
    parts = F.from_json(F.coalesce(F.get_json_object(line, "$.content"), F.get_json_object(line, "$.message.content")), "array<struct<type: string, text: string>>")
    joined = F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: p["text"]), "")
    return F.when(role == "assistant", joined)


def unwrap(answer: Column) -> Column:
    """The structured output inside an envelope, or the answer itself."""
    return F.coalesce(F.get_json_object(answer, "$.structured_output"), answer)
