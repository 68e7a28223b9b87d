"""Checks of JSON answers against a schema, with a message for each fault."""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a value of each type is in Python; booleans are no numbers.
KINDS = {"object": dict, "array": list, "string": str, "integer": int, "number": (int, float), "boolean": bool}


def faults(value: Any, schema: Any, path: str = "root") -> list[str]:
    """Messages for wrong types and missing fields, parents before children. Of a schema type,
    required, properties and items are checked, and nothing else."""
    kind = schema.get("type") if isinstance(schema, dict) else None
    if kind not in KINDS:
        return []
    right = isinstance(value, KINDS[kind]) and not (kind in ("integer", "number") and isinstance(value, bool))
    if not right:
        return [f"Expected {kind} at {path}, got {type(value).__name__}"]
    out = []
    if kind == "object":
        out += [f"Missing required field: {path}.{name}" for name in schema.get("required", ()) if name not in value]
        parts = [(value[name], part, f"{path}.{name}") for name, part in schema.get("properties", {}).items() if name in value]
    else:
        parts = [(x, schema["items"], f"{path}[{i}]") for i, x in enumerate(value)] if kind == "array" and schema.get("items") else []
    for part in parts:
        out += faults(*part)
    return out


def schema_faults(answer: Column, schema: dict) -> Column:
    """The messages for a column of JSON texts; null for null, and one message for what isn't JSON."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def check(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            try:
                return faults(json.loads(t), schema)
            except ValueError:
                return ["Not JSON"]

        return texts.map(one)

    return check(answer)
