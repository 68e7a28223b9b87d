"""Text units: one row per paragraph-like block of a document, in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..conf import BODY
from ..functions.text import identity

#: Blocks of a page that become units, and other tags that end one.
BLOCKS = "h[1-6]|p|li|footer"
EDGES = f"{BLOCKS}|ul|ol|dl|dt|dd|div|nav|header|main|section|article|aside|table|thead|tbody|tr|td|th|form|body|html|head|title|script|style"


def _identified(units: DataFrame) -> DataFrame:
    place = (F.col("doc_id"), F.col("part"), F.col("paragraph_index_in_part"))
    return units.withColumns({"para_id": identity("para_", 16, *place), "unit_uid": identity("unit_", 12, F.lit("unit"), *place)})


def document_units(docs: DataFrame) -> DataFrame:
    """Lines with a visible character, numbered from 0 in each document; the paragraph index
    counts blank lines too. The order comes with the line, so there is no shuffle."""
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda t, i: F.struct(i.alias("i"), t.alias("t"))), lambda x: x["t"].rlike(r"\S"))
    rows = docs.select("doc_id", F.posexplode(lines).alias("order_index", "line"))
    rows = rows.select("doc_id", F.lit(BODY).alias("part"), F.lit("body").alias("part_kind"), F.col("line.i").alias("paragraph_index_in_part"), F.col("line.t").alias("accepted_text"), "order_index")
    return _identified(rows)


def conversation_units(turns: DataFrame) -> DataFrame:
    """Turns in order; the role is the kind of part."""
    rows = turns.filter(F.col("text").rlike(r"\S")).select(
        F.col("conv_id").alias("doc_id"), F.concat(F.lit("conversation/"), F.coalesce("role", F.lit("?"))).alias("part"), F.col("role").alias("part_kind"),
        F.col("turn").cast("int").alias("paragraph_index_in_part"), F.col("text").alias("accepted_text"),
    )
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("paragraph_index_in_part", "part", "accepted_text")) - 1
    return _identified(rows.withColumn("order_index", order))


def page_units(pages: DataFrame) -> DataFrame:
    """Headings, paragraphs, list items and footers of pages in document order, with heading_path:
    the headings open at a unit, a heading itself included. A heading closes those of its level
    and deeper. Markup is often unclosed, so a block runs from its opening tag to the next tag of
    a block, opening or closing; inline tags inside it go, their text stays."""
    pieces = F.filter(F.split("html", rf"(?i)(?=</?(?:{EDGES})\b)"), lambda x: x.rlike(rf"(?i)^<(?:{BLOCKS})\b[^>]*>"))
    text = lambda x: F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", ""), r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    blocks = F.filter(F.transform(pieces, lambda x, i: F.struct(i.alias("i"), F.lower(F.regexp_extract(x, r"^<(\w+)", 1)).alias("tag"), text(x).alias("t"))), lambda x: x["t"] != "")
    rows = pages.select(F.col("page_id").alias("doc_id"), F.posexplode(blocks).alias("order_index", "b"))
    rows = rows.select("doc_id", F.when(F.col("b.tag") == "footer", "page/footer").otherwise("page/body").alias("part"), F.when(F.col("b.tag") == "footer", "footer").otherwise("body").alias("part_kind"), F.col("b.i").alias("paragraph_index_in_part"), F.col("b.tag").alias("tag"), F.col("b.t").alias("accepted_text"), "order_index")
    return _identified(rows.withColumn("heading_path", heading_path(F.when(F.col("tag").rlike("^h[1-6]$"), F.substring("tag", 2, 1).cast("int")), F.col("accepted_text"))))


def heading_path(level: Column, text: Column, doc: str = "doc_id", order: str = "order_index") -> Column:
    """The last heading of every level that no later one of a higher level has closed."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    place = F.col(order)
    entries = []
    for n in range(1, 7):
        own = F.last(F.when(level == n, F.struct(place.alias("at"), text.alias("t"))), ignorenulls=True).over(w)
        closed = F.last(F.when(level < n, place), ignorenulls=True).over(w)
        entries.append(F.when(own.isNotNull() & (closed.isNull() | (own["at"] > closed)), own["t"]))
    return F.array_compact(F.array(*entries))


def doc_struct(units: DataFrame) -> DataFrame:
    """The inventory of parts of each document."""
    return units.groupBy("doc_id", "part", "part_kind").agg(F.count("*").alias("unit_count"), F.min("order_index").alias("first_order_index"), F.max("order_index").alias("last_order_index"), F.sum(F.length("accepted_text")).alias("characters"))
