"""DOCX packages as units. One file is one row; parts are read with the standard library."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import identity

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
PARTS = (("word/document.xml", "body"), ("word/header", "header"), ("word/footer", "footer"), ("word/footnotes.xml", "footnotes"), ("word/endnotes.xml", "endnotes"))
_DDL = "path string, part string, part_kind string, part_index int, paragraph_index_in_part int, accepted_text string, style string, in_table boolean, path_hint string"


def kind_of(name: str) -> str | None:
    return next((kind for prefix, kind in PARTS if name.startswith(prefix) and name.endswith(".xml")), None)


def visible_text(paragraph: ET.Element) -> str:
    """The text as it reads when all changes are accepted."""
    out: list[str] = []

    def walk(node: ET.Element) -> None:
        for child in node:
            if child.tag == f"{W}t":
                out.append(child.text or "")
            elif child.tag == f"{W}tab":
                out.append("\t")
            elif child.tag in (f"{W}br", f"{W}cr"):
                out.append("\n")
            elif child.tag not in (f"{W}del", f"{W}moveFrom", f"{W}pPr", f"{W}rPr"):
                walk(child)

    walk(paragraph)
    return "".join(out)


def package_units(data: bytes) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(data)) as package:
        names = sorted((n for n in package.namelist() if kind_of(n)), key=lambda n: ([k for _, k in PARTS].index(kind_of(n)), n))
        for part_index, name in enumerate(names):
            root = ET.fromstring(package.read(name))
            tabled = {id(p) for t in root.iter(f"{W}tbl") for p in t.iter(f"{W}p")}
            for i, p in enumerate(root.iter(f"{W}p")):
                style = p.find(f"{W}pPr/{W}pStyle")
                yield name, kind_of(name), part_index, i, visible_text(p), None if style is None else style.get(f"{W}val"), id(p) in tabled, f".//w:p[{i + 1}]"


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """Units of all packages under path, with order_index from 0 in each package and the level of
    headings. Packages are independent rows, so there is no shuffle but for the order."""
    from pyspark.sql import Window

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = [(p, *u) for p, c in zip(rows.path, rows.content, strict=True) for u in package_units(c)]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _DDL.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content")
    rows = files.mapInPandas(run, _DDL)
    order = F.row_number().over(Window.partitionBy("path").orderBy("part_index", "paragraph_index_in_part")) - 1
    place = (F.col("path"), F.col("part"), F.col("paragraph_index_in_part"))
    level = F.regexp_extract("style", r"(?i)^(?:heading|titre)\s*([1-6])$", 1)
    return rows.withColumns({"order_index": order, "para_id": identity("para_", 16, *place), "unit_uid": identity("unit_", 12, F.lit("unit"), *place), "heading_level": F.when(level != "", level.cast("int"))})


def paragraph_index(index: int | None, hint: str | None) -> int | None:
    """A paragraph's place: the index, or the hint's place counted from 1."""
    if index is not None:
        return index
    m = re.search(r"w:p\[(\d+)\]", hint or "")
    return int(m.group(1)) - 1 if m else None
