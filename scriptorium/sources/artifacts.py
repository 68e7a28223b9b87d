"""Review artifacts as files: JSON documents, result folders, inputs and their order of preference."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OP_STRUCT = (
    "struct<type: string, target: struct<part: string, para_id: string, unit_uid: string>, target_unit_uid: string, quoted_text: string, range: struct<start: int, end: int>, "
    "expected: struct<snippet: string>, replacement: string, new_text: string, comment_text: string, category: string, dedup_key: string>"
)
RESULT_DDL = f"schema_version string, chunk_id string, status string, summary string, ops array<{OP_STRUCT}>, patch_ops array<{OP_STRUCT}>, suggestions array<string>"
UNIT_DDL = (
    "source_docx string, part_count int, unit_count int, units array<struct<part: string, part_kind: string, part_name: string, para_id: string, unit_uid: string, accepted_text: string, "
    "heading_path: array<string>, order_index: int, location: struct<part_index: int, paragraph_index_in_part: int, global_order_index: int, path_hint: string, in_table: boolean>>>"
)
#: Where results are looked for, best first.
PREFERENCE = ("judged", "ralph_0", "legacy")


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Whole JSON files with a given schema; the folder of a file is in _metadata.file_path."""
    return spark.read.schema(ddl).option("multiLine", True).json(path)


def read_units(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, UNIT_DDL).select("source_docx", F.inline("units"))


def read_results(spark: SparkSession, folder: str, run: str) -> DataFrame:
    """The ops of all chunk_*_result.json files of a folder, with run and op_index."""
    files = spark.read.schema(RESULT_DDL).option("multiLine", True).option("pathGlobFilter", "chunk_*_result.json").json(folder)
    return flat_ops(files.withColumn("run", F.lit(run)), "run")


def flat_ops(answers: DataFrame, *keys: str) -> DataFrame:
    """The ops of answers (with the columns of RESULT_DDL), one row each. Some reviewers say
    patch_ops for ops and target_unit_uid for a target; both become the usual shape, the target
    with its unit_uid alone."""
    ops = answers.select(*keys, "chunk_id", F.posexplode(F.coalesce("ops", "patch_ops")).alias("op_index", "o"))
    ops = ops.withColumn("o", F.col("o").withField("target", F.coalesce("o.target", F.when(F.col("o.target_unit_uid").isNotNull(), F.struct(F.lit(None).cast("string").alias("part"), F.lit(None).cast("string").alias("para_id"), F.trim("o.target_unit_uid").alias("unit_uid"))))))
    return ops.select(
        *keys, "chunk_id", "op_index", "o.type", F.col("o.target.part").alias("part"), F.col("o.target.para_id").alias("para_id"), F.col("o.target.unit_uid").alias("unit_uid"), "o.quoted_text",
        F.col("o.range.start").alias("range_start"), F.col("o.range.end").alias("range_end"), F.col("o.expected.snippet").alias("snippet"), "o.replacement", "o.new_text", "o.comment_text", "o.dedup_key",
    )


def full_targets(ops: DataFrame, members: DataFrame, *keys: str) -> DataFrame:
    """ops whose targets have a unit_uid alone get part and para_id from the chunk's primary unit."""
    own = members.filter("role = 'primary'").select(*keys, "chunk_id", "unit_uid", F.col("part").alias("__part"), F.col("para_id").alias("__para")).distinct()
    joined = ops.join(own, [*keys, "chunk_id", "unit_uid"], "left")
    bare = F.col("part").isNull() & F.col("para_id").isNull()
    return joined.withColumns({"part": F.when(bare, F.col("__part")).otherwise(F.col("part")), "para_id": F.when(bare, F.col("__para")).otherwise(F.col("para_id"))}).select(*ops.columns)


def prefer(results: DataFrame) -> DataFrame:
    """Of results(run, chunk_id, ...) those of the best run that a chunk has."""
    rank = F.coalesce(*[F.when(F.col("run") == name, F.lit(i)) for i, name in enumerate(PREFERENCE)], F.lit(len(PREFERENCE)))
    best = results.groupBy("chunk_id").agg(F.min(rank).alias("__best"))
    return results.join(best, "chunk_id").filter(rank == F.col("__best")).drop("__best")


def missing_chunks(manifest: DataFrame, chunks: DataFrame) -> DataFrame:
    """Manifest entries without a chunk."""
    return manifest.join(chunks.select("doc_id", "chunk_id"), ["doc_id", "chunk_id"], "left_anti")


def find_input(folder: str, explicit: str | None = None) -> str:
    """The document to review: the given one, or the only .docx of the folder."""
    if explicit:
        path = Path(explicit)
        if not path.is_file() or path.suffix.lower() != ".docx":
            raise FileNotFoundError(f"not a .docx file: {explicit}")
        return str(path)
    found = sorted(p.name for p in Path(folder).glob("*.docx"))
    if len(found) != 1:
        raise ValueError("no .docx file" if not found else f"several .docx files: {', '.join(found)}")
    return str(Path(folder) / found[0])


def find_artifacts(folder: str, name: str | None = None) -> str:
    """The artifact set to check: a subfolder with review_units.json; a name is needed if there are several."""
    found = sorted(p.parent.name for p in Path(folder).glob("*/review_units.json"))
    if name is not None:
        if name not in found:
            raise FileNotFoundError(f"no artifacts named {name}")
        return name
    if len(found) != 1:
        raise ValueError("no artifacts" if not found else f"several artifact sets: {', '.join(found)}")
    return found[0]
