"""Arrow plumbing for operators that compute new columns of a row from some of its columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .words import trim


def add_columns(df: DataFrame, inputs: list[str], ddl: str, start: Callable[[], Callable[..., dict]], drop: tuple[str, ...] = ()) -> DataFrame:
    """All columns of df but those in drop, and the columns of ddl. They replace columns of the
    same names. start() runs once in a task and returns the function that makes the new columns
    from the inputs, given as Arrow arrays. Other columns are handed through unchanged."""
    new = StructType.fromDDL(ddl)
    names = {f.name.lower() for f in new}
    rest = [c for c in df.columns if c.lower() not in names and c not in drop]
    schema = StructType([df.schema[c] for c in rest] + list(new))
    types = list(to_arrow_schema(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            made = make(*[batch.column(batch.schema.get_field_index(c)) for c in inputs])
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            fields = [batch.schema.field(c) for c in rest]
            for t in types:
                value = made[t.name]
                arrays.append(value.cast(t.type) if isinstance(value, pa.Array) else pa.array(value, t.type))
                fields.append(pa.field(t.name, t.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))
            del arrays, batch
            trim()

    return df.select(*dict.fromkeys([*rest, *inputs])).mapInArrow(run, schema)
