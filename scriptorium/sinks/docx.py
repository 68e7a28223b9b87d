"""Annotated DOCX packages: tracked changes and comments, and a check of what was written.

An op that can't be applied safely leaves its paragraph as it is; a part without changes is
written byte for byte as it was read.
"""

from __future__ import annotations

import copy
import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.docx import W, paragraph_index, visible_text

XML_SPACE = "{http://www.w3.org/XML/1998/namespace}space"
#: Fixed values of the package format.
CONTENT_TYPES, BODY_RELATIONS, COMMENTS = "[Content_Types].xml", "word/_rels/document.xml.rels", "word/comments.xml"
COMMENTS_TYPE = "application/vnd.openxmlformats-officedocument.wordprocessingml.comments+xml"
COMMENTS_RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships/comments"
RELATIONS = "http://schemas.openxmlformats.org/package/2006/relationships"
TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
NOTES = (f"{W}footnoteReference", f"{W}endnoteReference")


def _units(text: str) -> int:
    return len(text.encode("utf-16-le", "surrogatepass")) // 2


def _cut(text: str, at: int) -> tuple[str, str]:
    raw = text.encode("utf-16-le", "surrogatepass")
    return raw[: 2 * at].decode("utf-16-le", "surrogatepass"), raw[2 * at :].decode("utf-16-le", "surrogatepass")


def _run(like: ET.Element, tag: str, text: str) -> ET.Element:
    """A run with the formatting of another one."""
    run = ET.Element(f"{W}r")
    if (style := like.find(f"{W}rPr")) is not None:
        run.append(copy.deepcopy(style))
    t = ET.SubElement(run, f"{W}{tag}")
    t.text = text
    t.set(XML_SPACE, "preserve")
    return run


class Paragraph:
    """A paragraph of plain runs. Every child has a width in code units; others than text runs have none."""

    def __init__(self, node: ET.Element):
        self.node = node
        self.plain = all(c.tag in (f"{W}pPr", f"{W}r", f"{W}bookmarkStart", f"{W}bookmarkEnd", f"{W}proofErr") for c in node)

    def width(self, child: ET.Element) -> int:
        return _units("".join(t.text or "" for t in child.iter(f"{W}t"))) if child.tag == f"{W}r" else 0

    def split(self, at: int) -> int:
        """The place among the children at which so many units have passed; a run is cut there."""
        passed = 0
        for i, child in enumerate(list(self.node)):
            w = self.width(child)
            if passed >= at and child.tag != f"{W}pPr":
                return i
            if passed < at < passed + w:
                head, tail = _cut("".join(t.text or "" for t in child.iter(f"{W}t")), at - passed)
                self.node[i : i + 1] = [_run(child, "t", head), _run(child, "t", tail)]
                return i + 1
            passed += w
        return len(self.node)

    def notes(self) -> list[int]:
        """Offsets of note references."""
        out, passed = [], 0
        for child in self.node:
            out += [passed for n in child.iter() if n.tag in NOTES]
            passed += self.width(child)
        return out

    def formatted(self) -> ET.Element:
        return next((c for c in self.node if c.tag == f"{W}r"), ET.Element(f"{W}r"))


def annotate(data: bytes, ops: list[dict], author: str, date: str) -> tuple[bytes, list[dict]]:
    """The package with tracked changes and comments, and the apply log. ops have type, part,
    paragraph_index_in_part (or path_hint), range_start, range_end, snippet and payloads; within a
    paragraph they are applied from its end to its start."""
    with zipfile.ZipFile(io.BytesIO(data)) as package:
        files = {n: package.read(n) for n in package.namelist()}
    for prefix, uri in _namespaces(files):
        ET.register_namespace(prefix, uri)
    trees, changed, comments, log, originals = {}, set(), [], [], {}
    number = 1
    for index, op in sorted(enumerate(ops), key=lambda x: (x[1]["part"], -x[1]["range_start"], -x[1]["range_end"], x[0])):
        entry = {"op_index": index, "type": op["type"], "status": "skipped", "reason": None, "actual_snippet": None}
        log.append(entry)
        part = op["part"]
        if part in files and part not in trees:
            trees[part] = ET.fromstring(files[part])
        at = paragraph_index(op.get("paragraph_index_in_part"), op.get("path_hint"))
        found = list(trees[part].iter(f"{W}p")) if part in trees else []
        if at is None or not 0 <= at < len(found):
            entry["reason"] = "target_not_found"
            continue
        entry["paragraph_index_in_part"] = at
        paragraph = Paragraph(found[at])
        start, end = op["range_start"], op["range_end"]
        # what earlier ops of this paragraph put in lies behind this one, as they run from its end
        original = originals.setdefault((part, at), visible_text(found[at]))
        entry["actual_snippet"] = _cut(_cut(original, end)[0], start)[1]
        if (part, at) not in changed and not paragraph.plain:
            entry["reason"] = "unsupported_paragraph_structure"
        elif not 0 <= start <= end <= _units(original):
            entry["reason"] = "range_out_of_bounds"
        elif start < end and entry["actual_snippet"] != (op.get("snippet") or ""):
            entry["reason"] = "snippet_mismatch"
        elif op["type"] != "add_comment" and any(start < n < end for n in paragraph.notes()):
            entry["reason"] = "range_intersects_preserved_inline_element"
        if entry["reason"]:
            continue
        first = paragraph.split(start)
        last = max(first, paragraph.split(end)) if end > start else first
        stamp = {f"{W}id": str(number), f"{W}author": author, f"{W}date": date}
        number += 1
        node = paragraph.node
        if op["type"] == "add_comment":
            ref = ET.Element(f"{W}r")
            ET.SubElement(ref, f"{W}commentReference", {f"{W}id": stamp[f"{W}id"]})
            node.insert(last, ref)
            node.insert(last, ET.Element(f"{W}commentRangeEnd", {f"{W}id": stamp[f"{W}id"]}))
            node.insert(first, ET.Element(f"{W}commentRangeStart", {f"{W}id": stamp[f"{W}id"]}))
            comments.append((stamp, op.get("comment_text") or ""))
        else:
            like = node[first] if first < len(node) and node[first].tag == f"{W}r" else paragraph.formatted()
            gone = list(node[first:last])
            payload = op.get("replacement") if op["type"] == "replace_range" else op.get("new_text") if op["type"] == "insert_at" else None
            if payload:
                added = ET.Element(f"{W}ins", stamp | {f"{W}id": str(number)})
                number += 1
                added.append(_run(like, "t", payload))
                node.insert(last, added)
            if gone:
                removed = ET.Element(f"{W}del", stamp)
                for child in gone:
                    node.remove(child)
                    for t in child.iter(f"{W}t"):
                        t.tag = f"{W}delText"
                    removed.append(child)
                node.insert(first, removed)
        changed.add((part, at))
        entry["status"] = "applied"
    for part in {p for p, _ in changed}:
        files[part] = _xml(trees[part])
    if comments:
        _add_comments(files, comments)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
        for name, content in files.items():
            package.writestr(name, content)
    return out.getvalue(), sorted(log, key=lambda e: e["op_index"])


def _namespaces(files: dict[str, bytes]):
    for name, content in files.items():
        if name.endswith(".xml") or name.endswith(".rels"):
            for _, (prefix, uri) in ET.iterparse(io.BytesIO(content), events=["start-ns"]):
                if prefix and not prefix.startswith("ns"):
                    yield prefix, uri


def _xml(root: ET.Element) -> bytes:
    return ET.tostring(root, encoding="UTF-8", xml_declaration=True)


def _add_comments(files: dict[str, bytes], comments: list) -> None:
    root = ET.fromstring(files[COMMENTS]) if COMMENTS in files else ET.Element(f"{W}comments")
    for stamp, text in comments:
        comment = ET.SubElement(root, f"{W}comment", stamp)
        ET.SubElement(ET.SubElement(ET.SubElement(comment, f"{W}p"), f"{W}r"), f"{W}t").text = text
    files[COMMENTS] = _xml(root)
    types = ET.fromstring(files[CONTENT_TYPES])
    if not any(o.get("PartName") == f"/{COMMENTS}" for o in types):
        ET.SubElement(types, f"{{{TYPES}}}Override", {"PartName": f"/{COMMENTS}", "ContentType": COMMENTS_TYPE})
        files[CONTENT_TYPES] = _xml(types)
    relations = ET.fromstring(files.get(BODY_RELATIONS, f'<Relationships xmlns="{RELATIONS}"/>'.encode()))
    if not any(r.get("Type") == COMMENTS_RELATION for r in relations):
        ET.SubElement(relations, f"{{{RELATIONS}}}Relationship", {"Id": f"rIdReview{len(relations) + 1}", "Type": COMMENTS_RELATION, "Target": "comments.xml"})
        files[BODY_RELATIONS] = _xml(relations)


def validate(data: bytes, log: list[dict]) -> list[str]:
    """What is wrong with an annotated package: empty if nothing is."""
    problems = []
    with zipfile.ZipFile(io.BytesIO(data)) as package:
        if bad := package.testzip():
            return [f"damaged member {bad}"]
        names = set(package.namelist())
        xml = b"".join(package.read(n) for n in names if n.startswith("word/") and n.endswith(".xml"))
        kinds = {e["type"] for e in log if e["status"] == "applied"}
        if not kinds:
            problems.append("no op was applied")
        if kinds - {"add_comment"} and b":ins " not in xml and b":del " not in xml:
            problems.append("edits without tracked changes")
        if "add_comment" in kinds:
            if COMMENTS not in names:
                problems.append("no comments part")
            elif f"/{COMMENTS}".encode() not in package.read(CONTENT_TYPES) or b"comments.xml" not in package.read(BODY_RELATIONS):
                problems.append("comments part isn't declared")
            if xml.count(b"commentRangeStart") != xml.count(b"commentReference "):
                problems.append("comment markers don't match")
    return problems


LOG = "array<struct<op_index: int, type: string, status: string, reason: string, actual_snippet: string>>"


def annotate_packages(packages: DataFrame, ops: DataFrame, author: str, date: str) -> DataFrame:
    """packages(path, content) with their ops(path, ...; the fields of annotate()) as tracked changes
    and comments: path, content, log and problems (what validate() finds). A package is one row and
    one task's work; only its own ops come to it. Packages without ops stay as they are."""
    fields = ("type", "part", "paragraph_index_in_part", "range_start", "range_end", "snippet", "replacement", "new_text", "comment_text")
    mine = ops.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("op_index", *fields))).alias("ops"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, asked in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
                out, log = annotate(content, asked, author, date) if asked else (content, [])
                numbers = [op["op_index"] for op in asked or ()]
                done = [{k: numbers[e[k]] if k == "op_index" else e[k] for k in ("op_index", "type", "status", "reason", "actual_snippet")} for e in log]
                shape = pa.list_(pa.struct([("op_index", pa.int32()), *[(k, pa.string()) for k in ("type", "status", "reason", "actual_snippet")]]))
                columns = [pa.array([path]), pa.array([out], pa.binary()), pa.array([done], shape), pa.array([validate(out, log) if log else []], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "content", "log", "problems"])

    both = packages.select("path", "content").join(mine, "path", "left").select("path", "content", "ops")
    return both.mapInArrow(run, f"path string, content binary, log {LOG}, problems array<string>")


def report_package(rows: list[tuple[str, str, str]]) -> bytes:
    """A package with a table of changes: number, place with the text as it was, and as it is; both
    texts in bold. rows: place, text before, text after."""

    def cell(row: ET.Element, *runs: tuple[str, bool]) -> None:
        paragraph = ET.SubElement(ET.SubElement(row, f"{W}tc"), f"{W}p")
        for text, bold in runs:
            run = ET.SubElement(paragraph, f"{W}r")
            if bold:
                ET.SubElement(ET.SubElement(run, f"{W}rPr"), f"{W}b")
            ET.SubElement(run, f"{W}t", {XML_SPACE: "preserve"}).text = text

    root = ET.Element(f"{W}document")
    body = ET.SubElement(root, f"{W}body")
    table = ET.SubElement(body, f"{W}tbl")
    head = ET.SubElement(table, f"{W}tr")
    for title in ("#", "At", "Suggestion"):
        cell(head, (title, True))
    for number, (place, before, after) in enumerate(rows, 1):
        line = ET.SubElement(table, f"{W}tr")
        cell(line, (str(number), False))
        cell(line, (f"{place}: ", False), (before, True))
        cell(line, (after, True))
    ET.SubElement(body, f"{W}p")
    main = "application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"
    types = f'<Types xmlns="{TYPES}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="{main}"/></Types>'
    links = f'<Relationships xmlns="{RELATIONS}"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
        for name, data in ((CONTENT_TYPES, types.encode()), ("_rels/.rels", links.encode()), ("word/document.xml", _xml(root))):
            package.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), data)
    return out.getvalue()


def report_packages(changes: DataFrame) -> DataFrame:
    """One report package for each document with changes: doc_id and content."""
    rows = changes.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("patch_pos", "stable_location", "exact_snippet", "after_snippet"))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [report_package([(x["stable_location"], x["exact_snippet"] or "", x["after_snippet"] or "") for x in some]) for some in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["doc_id", "content"])

    return rows.mapInArrow(run, "doc_id long, content binary")
