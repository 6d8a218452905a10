"""A read document as one record: metadata, elements with their sections, tables, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions import xml as X
from docframe.functions.text import normalize_text
from docframe.operators import markup
from docframe.operators.structure import cells, classify_paragraphs, element_stats, header_rows, paragraphs_with_cells, section_hierarchy, section_tree, table_stats
from docframe.sources.docx import metadata

_WHOLE = 1 << 20


def elements(docs: DataFrame, doc: str = "path") -> DataFrame:
    """doc, index, kind, level, section_id, list_run, text of the paragraphs with text outside of tables; index counts all paragraphs
    outside of tables."""
    body = paragraphs_with_cells(docs, doc).filter("table_index is null")
    numbered = body.withColumn("index", F.row_number().over(Window.partitionBy(doc).orderBy("index")) - 1)
    return section_hierarchy(classify_paragraphs(numbered.filter("text <> ''")), doc, "index").select(doc, "index", "kind", "level", "section_id", "list_run", "text")


def body_parts(docs: DataFrame, doc: str = "path") -> DataFrame:
    """doc, index, kind, level, text, table_index: the paragraphs with text outside of tables and the tables among them, in order."""
    whole = markup.elements(docs, doc, names=("tbl", "p")).filter("parent_table is null and (name = 'tbl' or (name = 'p' and table_index is null))")
    texts = classify_paragraphs(whole.withColumn("text", normalize_text(X.unescape(X.xml_text(F.col("xml"))))).withColumn("index", F.col("start")))
    kind = F.when(F.col("name") == "tbl", "table").otherwise(F.col("kind"))
    shown = texts.filter("name = 'tbl' or text <> ''")
    return shown.select(doc, "index", kind.alias("kind"), F.when(F.col("name") == "p", F.col("level")).alias("level"), "text", F.when(F.col("name") == "tbl", F.col("table_index")).alias("table_index"))


def extract(docs: DataFrame) -> DataFrame:
    """path, success, error, metadata, elements, sections, tables, stats: one row a document, with nulls but for the error where it could not
    be read. docs: path, xml, core, app, error; paths differ."""
    sound = docs.filter("error is null")
    parts = elements(sound)
    content = parts.groupBy("path").agg(F.array_sort(F.collect_list(F.struct(*[c for c in parts.columns if c != "path"]))).alias("elements"))
    flat = cells(sound, "path", text_limit=_WHOLE)
    heads = header_rows(flat, "path")
    joined = table_stats(flat, "path").join(heads, ["path", "table_index"], "left")
    tables = joined.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("table_index", "n_rows", "max_columns", "n_cells", "has_merged", "is_header", "texts"))).alias("tables"))
    counts = element_stats(parts, "path")
    stats = counts.select("path", F.struct(*[c for c in counts.columns if c != "path"]).alias("stats"))
    about = metadata(sound)
    meta = about.select("path", F.struct(*[c for c in about.columns if c != "path"]).alias("metadata"))
    tree = section_tree(body_parts(sound), "path", "index")
    out = docs.select("path", "error").join(meta, "path", "left").join(content, "path", "left").join(tree, "path", "left").join(tables, "path", "left").join(stats, "path", "left")
    return out.select("path", F.col("error").isNull().alias("success"), "error", "metadata", "elements", "sections", "tables", "stats")
