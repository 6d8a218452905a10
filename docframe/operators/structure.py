"""Generators and windows over documents: paragraphs, tables, cells, sections, labels, headings, lists, statistics.

Every generator gives an ordinal, and every choice of a first row is by that ordinal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions import xml as X
from docframe.functions.tags import distinct_tags, semantic_hint, tag_data_type, tag_type
from docframe.functions.text import TAG, clean_label, contains_letters, count_characters, count_words, has_tag, normalize_text, trim_all
from docframe.operators.markup import elements


def paragraphs(docs: DataFrame, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """doc, index, xml, text, xml_start, xml_end, section, has_tag: one row a paragraph, sections carried forward."""
    whole = docs.select(F.col(doc), F.regexp_extract_all(F.col(xml), F.lit(X.PARAGRAPH), F.lit(0)).alias("xml"), F.split(F.col(xml), X.PARAGRAPH).alias("gap"))
    rows = whole.select(doc, F.posexplode(F.arrays_zip("xml", "gap")).alias("index", "_p")).select(doc, "index", "_p.xml", "_p.gap").filter("xml is not null")
    # A paragraph ends after the paragraphs and gaps up to it.
    ends = F.sum(F.length("xml") + F.length("gap")).over(Window.partitionBy(doc).orderBy("index"))
    placed = rows.withColumn("xml_end", ends.cast("int")).withColumn("xml_start", (F.col("xml_end") - F.length("xml")).cast("int"))
    text = placed.withColumn("text", normalize_text(X.unescape(X.xml_text(F.col("xml")))))
    return carry_sections(text, doc, "index", "text").withColumn("has_tag", has_tag(F.col("text"))).drop("gap")


def carry_sections(lines: DataFrame, doc: str, order: str, text: str, out: str = "section") -> DataFrame:
    """The letter of the last section marker up to each line; empty before the first."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(out, F.coalesce(F.last(X.carried_letter(F.col(text)), True).over(w), F.lit("")))


def usable_label(text: Column) -> Column:
    t = trim_all(text)
    return (F.length(t) > 3) & ~has_tag(t) & contains_letters(t)


def label_lookback(lines: DataFrame, doc: str, order: str, text: str, back: int = 5, out: str = "label") -> DataFrame:
    """The nearest usable label among the lines before, cut at 150; empty if there is none."""
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(-back, -1)
    found = F.last(F.when(usable_label(F.col(text)), trim_all(F.col(text))), True).over(w)
    return lines.withColumn(out, F.coalesce(F.left(found, F.lit(150)), F.lit("")))


def cells(docs: DataFrame, doc: str = "doc_id", xml: str = "xml", text_limit: int = 100, header_limit: int = 80, headers: bool = True) -> DataFrame:
    """One row a cell: ordinals, text, is_empty, headers from the first row and the first column (not without `headers`), tags, colspan, and
    parent_table, parent_row and parent_column, the cell that holds its table (null outside of cells). A table inside of a cell is a table of its
    own, and its text is not that of the cell around it; tables are numbered in the order in which they open."""
    place = ("table_index", "row_index", "column_index", "parent_table", "parent_row", "parent_column")
    inside = elements(docs, doc, xml, ("tc",), (*place, "xml"), heads=headers).filter("column_index is not null")
    read = lambda c: X.unescape(X.cell_text(F.col(c)))
    flat = inside.withColumn("text", read("xml"))
    # The scanner names the cells that head the row and the column, so no row moves.
    heads = [
        F.left(F.coalesce(read("row_head"), "text"), F.lit(header_limit)).alias("row_header"),
        F.when(F.col("row_index") > 0, F.left(F.coalesce(read("column_head"), "text"), F.lit(header_limit))).otherwise("").alias("column_header"),
    ] if headers else []
    return flat.select(
        doc, "table_index", "row_index", "column_index",
        F.left("text", F.lit(text_limit)).alias("text"),
        (F.col("text") == "").alias("is_empty"),
        *heads,
        distinct_tags(F.col("text")).alias("tags"),
        X.colspan(F.col("xml")).alias("colspan"),
        "parent_table", "parent_row", "parent_column",
    )


#: What paragraphs need of their elements.
_PARAGRAPH_FIELDS = ("start", "end", "table_index", "row_index", "column_index", "paragraph_index", "xml")


def paragraphs_with_cells(docs: DataFrame, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """doc, index, xml, text, xml_start, xml_end, has_tag and the place of the innermost cell around each paragraph (table_index, row_index,
    column_index, null in the body), without a join."""
    return placed_paragraphs(elements(docs, doc, xml, ("p",), _PARAGRAPH_FIELDS), doc)


def placed_paragraphs(found: DataFrame, doc: str = "doc_id", *more: str) -> DataFrame:
    """paragraphs_with_cells of the elements that are paragraphs, with further columns of theirs."""
    text = normalize_text(X.unescape(X.xml_text(F.col("xml"))))
    placed = found.select(doc, F.col("paragraph_index").alias("index"), "xml", text.alias("text"), F.col("start").alias("xml_start"), F.col("end").alias("xml_end"), "table_index", "row_index", "column_index", *more)
    return placed.withColumn("has_tag", has_tag(F.col("text")))


def header_rows(cell_rows: DataFrame, doc: str = "doc_id", bold: str | None = None) -> DataFrame:
    """doc, table_index, is_header: whether the first row reads like a header: at least half of its cells short and at least half
    not numbers, or at least half bold."""
    t = trim_all(F.col("text"))
    filled = t != ""
    short, word = filled & (F.length(t) < 50), filled & ~t.rlike(r"^\d+([.,]\d+)?$")
    n = F.count("*")
    agg = cell_rows.filter("row_index = 0").groupBy(doc, "table_index").agg(
        n.alias("n"), F.count_if(short).alias("s"), F.count_if(word).alias("w"), F.count_if(F.col(bold) if bold else F.lit(False)).alias("b")
    )
    return agg.select(doc, "table_index", (((2 * F.col("s") >= F.col("n")) & (2 * F.col("w") >= F.col("n"))) | (2 * F.col("b") >= F.col("n"))).alias("is_header"))


def table_objects(cell_rows: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One map a row after the first: header -> cell; blank headers are column_i, of equal headers the last counts."""
    w = Window.partitionBy(doc, "table_index", "column_index").orderBy("row_index").rowsBetween(Window.unboundedPreceding, 0)
    # A table's cells meet once, for the heads and for the rows.
    keyed = cell_rows.select(doc, "table_index", "row_index", "column_index", "text").repartition(doc, "table_index").withColumn("head", F.first("text").over(w))
    key = F.when(trim_all(F.col("head")) == "", F.concat(F.lit("column_"), (F.col("column_index") + 1).cast("string"))).otherwise(F.col("head"))
    rows = keyed.filter("row_index > 0").groupBy(doc, "table_index", "row_index").agg(F.array_sort(F.collect_list(F.struct("column_index", key.alias("key"), "text"))).alias("c"))
    entries = F.transform("c", lambda x: F.struct(x["key"].alias("key"), x["text"].alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    return rows.select(doc, "table_index", "row_index", F.map_from_entries(last).alias("data"))


def spans_at(points: DataFrame, spans: DataFrame, doc: str, at: str, start: str, end: str) -> DataFrame:
    """points with the spans of their document that reach over their position `at` (start <= at <= end), a row for each.

    A span is filed by its size: spans of up to 2**k characters lie in at most two stretches of that length, and a point looks into the one
    stretch of each size that its document has. So a point meets spans of about its neighbourhood's size and not all of its
    document's, and the work grows with the document and not with its square. Both sides' columns must differ in name but for doc."""
    size = F.greatest(F.lit(10), F.length(F.bin(F.col(end) - F.col(start))))
    near = spans.withColumn("_k", size).withColumn("_b", F.explode(F.array_distinct(F.array(F.expr(f"shiftright(bigint({start}), _k)"), F.expr(f"shiftright(bigint({end}), _k)")))))
    sizes = near.groupBy(F.col(doc).alias("_sd")).agg(F.collect_set("_k").alias("_sizes"))  # at most 54 sizes
    looks = points.join(sizes, F.col(doc) == F.col("_sd")).withColumn("_pk", F.explode("_sizes")).withColumn("_pb", F.expr(f"shiftright(bigint({at}), _pk)"))
    met = (F.col(doc) == F.col("_d")) & (F.col("_pk") == F.col("_k")) & (F.col("_pb") == F.col("_b"))
    inside = (F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end))
    return looks.join(near.withColumnRenamed(doc, "_d"), met & inside).drop("_sd", "_sizes", "_pk", "_pb", "_d", "_k", "_b")


def paragraphs_in_cells(paras: DataFrame, boxes: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Each paragraph with the first cell that spans it, by offsets; null ordinals outside cells. paras: doc, index, xml_start, xml_end,
    an index once a document; boxes: doc, table_index, row_index, column_index, xml_start, xml_end."""
    b = boxes.select(doc, F.struct("table_index", "row_index", "column_index").alias("_at"), F.col("xml_start").alias("_s"), F.col("xml_end").alias("_e"))
    met = spans_at(paras.select(doc, F.col("index").alias("_i"), "xml_start", "xml_end"), b, doc, "xml_start", "_s", "_e").filter(F.col("xml_end") <= F.col("_e"))
    first = met.groupBy(F.col(doc).alias("_d"), "_i").agg(F.min("_at").alias("_at"))
    joined = paras.join(first, (F.col(doc) == F.col("_d")) & (F.col("index") == F.col("_i")), "left")
    return joined.select(*paras.columns, "_at.table_index", "_at.row_index", "_at.column_index")


def add_empty_cells(placed: DataFrame, cell_rows: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Rows for the cells that own no paragraph, numbered after the document's paragraphs."""
    key = [doc, "table_index", "row_index", "column_index"]
    missing = cell_rows.join(placed.filter("table_index is not null").select(*key).distinct(), key, "left_anti")
    sizes = placed.groupBy(doc).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(doc).orderBy("table_index", "row_index", "column_index")
    extra = missing.join(sizes, doc, "left").select(*key, "text", (F.coalesce("_n", F.lit(0)) + F.row_number().over(w) - 1).cast("int").alias("index"))
    return placed.select(*key, "text", "index").unionByName(extra)


def tag_rows(paras: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row a tag of a paragraph, with label before and after, type and hint."""
    labelled = label_lookback(paras, doc, "index", "text", out="_back")
    flat = labelled.select(doc, "index", "text", "section", "_back", F.posexplode(distinct_tags(F.col("text"))).alias("ord", "tag"))
    full = F.concat(F.lit("{{"), F.col("tag"), F.lit("}}"))
    at = F.expr("locate(concat('{{', tag, '}}'), text)")
    before = trim_all(F.expr("substring(text, 1, locate(concat('{{', tag, '}}'), text) - 1)"))
    after = trim_all(F.expr("substring(text, locate(concat('{{', tag, '}}'), text) + length(tag) + 4)"))
    own = (at > 1) & (F.length(before) > 2) & contains_letters(before)
    return flat.select(
        doc, "index", "ord", "tag", full.alias("full_tag"), "section",
        clean_label(F.when(own, before).otherwise(F.col("_back"))).alias("label_before"),
        F.when((after != "") & ~has_tag(after), F.left(after, F.lit(50))).otherwise("").alias("label_after"),
        tag_type(F.col("tag")).alias("type"), tag_data_type(F.col("tag")).alias("data_type"), semantic_hint(F.col("tag")).alias("hint"),
    )


def template_tags(docs: DataFrame, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """doc, ord, tag, data_type, context: one row a different tag of a document. The context is the text of the 200 characters of XML
    before its first place and the 100 behind, without the tag, cut at 100."""
    found = docs.select(doc, F.col(xml).alias("_x"), F.posexplode(distinct_tags(F.col(xml))).alias("ord", "tag"))
    placed = found.withColumn("_full", F.concat(F.lit("{{"), "tag", F.lit("}}"))).withColumn("_at", F.expr("locate(_full, _x)"))
    around = F.expr("substring(_x, greatest(_at - 200, 1), least(_at - 1, 200) + length(_full) + 100)")
    text = trim_all(F.expr("concat(substring(_t, 1, locate(_full, _t) - 1), substring(_t, locate(_full, _t) + length(_full)))"))
    read = placed.select(doc, "ord", "tag", "_full", X.xml_text(around).alias("_t"))
    bare = F.when(F.expr("locate(_full, _t) > 0"), text).otherwise(trim_all(F.col("_t")))
    return read.select(doc, "ord", "tag", tag_data_type(F.col("tag")).alias("data_type"), F.left(bare, F.lit(100)).alias("context"))


def found_tags(docs: DataFrame, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """doc, ord, tag, at, context, table_index, row_index, column_index: one row a place of a tag, repeats too. at: the character it starts at,
    from 0; context: the text of the 100 characters before and behind, markup as spaces; the innermost cell around it, null outside."""
    pieces = F.split(F.col(xml), TAG, -1)
    fulls = F.regexp_extract_all(F.col(xml), F.lit(TAG), F.lit(0))
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("ats"))
    step = lambda s, p: F.struct((s["end"] + p["n"] + p["m"]).alias("end"), F.concat(s["ats"], F.array(s["end"] + p["n"])).alias("ats"))
    sizes = F.zip_with(F.slice(pieces, F.lit(1), F.size(fulls)), fulls, lambda g, t: F.struct(F.length(g).alias("n"), F.length(t).alias("m")))
    ats = F.aggregate(sizes, start, step)["ats"]
    around = lambda t, at: F.substring(F.col(xml), F.greatest(at - 99, F.lit(1)), F.least(at, F.lit(100)) + F.length(t) + 100)
    rows = docs.select(doc, F.posexplode(F.zip_with(fulls, ats, lambda t, at: F.struct(t.alias("t"), at.alias("at"), X.cell_text(around(t, at)).alias("context")))).alias("ord", "_p"))
    found = rows.select(F.col(doc).alias("_fd"), "ord", F.translate("_p.t", "{}", "").alias("tag"), "_p.at", "_p.context")
    cells_ = elements(docs, doc, xml, ("tc",)).select(doc, F.struct("depth", "table_index", "row_index", "column_index").alias("_cell"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    met = spans_at(found.select(F.col("_fd").alias(doc), F.col("at").alias("_at")), cells_, doc, "_at", "_s", "_e").filter("_at < _e")
    inner = met.groupBy(F.col(doc).alias("_cd"), "_at").agg(F.max("_cell").alias("_cell"))
    joined = found.join(inner, (F.col("_fd") == F.col("_cd")) & (F.col("at") == F.col("_at")), "left")
    return joined.select(F.col("_fd").alias(doc), "ord", "tag", "at", "context", "_cell.table_index", "_cell.row_index", "_cell.column_index")


def paragraphs_with_headers(docs: DataFrame, doc: str = "doc_id", xml: str = "xml", header_limit: int = 80) -> DataFrame:
    """paragraphs_with_cells with row_header and column_header of their cell, empty outside of cells."""
    found = elements(docs, doc, xml, ("p",), _PARAGRAPH_FIELDS, heads=True)
    inside = F.col("table_index").isNotNull() & F.col("row_index").isNotNull() & F.col("column_index").isNotNull()
    read = lambda c: F.left(X.unescape(X.cell_text(F.col(c))), F.lit(header_limit))
    heads = {"row_header": F.when(inside, read("row_head")), "column_header": F.when(inside & (F.col("row_index") > 0), read("column_head"))}
    paras = placed_paragraphs(found, doc, "row_head", "column_head").withColumns({c: F.coalesce(h, F.lit("")) for c, h in heads.items()})
    return paras.drop("row_head", "column_head")


def classify_paragraphs(paras: DataFrame) -> DataFrame:
    """kind heading, list or paragraph, with level; a heading style beats list numbering."""
    level, item = X.heading_level(X.style_id(F.col("xml"))), X.list_item(F.col("xml"))
    kind = F.when(level.isNotNull(), "heading").when(item.isNotNull(), "list").otherwise("paragraph")
    return paras.withColumn("kind", kind).withColumn("level", F.coalesce(level, item["level"] + 1))


def section_hierarchy(parts: DataFrame, doc: str, order: str, kind: str = "kind", level: str = "level") -> DataFrame:
    """section_id: a heading of level 1, or the first heading, opens a section; what stands before is section 0.
    list_run: neighbouring list items share a number."""
    w = Window.partitionBy(doc).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    heading = F.col(kind) == "heading"
    first = heading & (F.sum(heading.cast("int")).over(upto) == 1)
    opens = (heading & (F.col(level) == 1)) | first
    starts = (F.col(kind) == "list") & (F.coalesce(F.lag(kind).over(w), F.lit("")) != "list")
    return parts.withColumn("_o", opens.cast("int")).withColumn("_l", starts.cast("int")).withColumns(
        {"section_id": F.sum("_o").over(upto).cast("int"), "list_run": F.when(F.col(kind) == "list", F.sum("_l").over(upto).cast("int"))}
    ).drop("_o", "_l")


def heading_parents(parts: DataFrame, doc: str, order: str, kind: str = "kind", level: str = "level") -> DataFrame:
    """parts with parent: the `order` of the heading above each element. A heading hangs on the nearest one before it of a lower level, as a
    stack of open headings gives it, any other element on the last heading; null at the top."""
    before = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # The top of the stack below level n is the latest of the last headings of the levels below n.
    last = [F.max(F.when((F.col(kind) == "heading") & (F.col(level) == n), F.col(order))).over(before) for n in range(1, 7)]
    marked = parts.withColumns({f"_h{n}": c for n, c in enumerate(last, 1)})
    of = F.when(F.col(kind) == "heading", F.greatest(F.col(level), F.lit(1))).otherwise(7)
    shown = [F.when(of > n, F.col(f"_h{n}")) for n in range(1, 7)]
    return marked.withColumn("parent", F.greatest(*shown)).drop(*[f"_h{n}" for n in range(1, 7)])


def section_tree(parts: DataFrame, doc: str, order: str) -> DataFrame:
    """doc, sections: one nested record a document. A section has id (from 1), title, level and content, in order: headings, paragraphs, lists
    with their items, and tables by their number. parts: doc, order, kind (heading, list, paragraph, table), level, text and, for
    tables, table_index.

    Sections open as in section_hierarchy. What stands before the first is the section Introduction; a list that stands there alone is
    the first content of the section after it, or of Introduction where none follows. Documents without elements give no row."""
    if "table_index" not in parts.columns:
        parts = parts.withColumn("table_index", F.lit(None).cast("int"))
    # Before the first heading nothing but lists: these go to the first section.
    lead = section_hierarchy(parts, doc, order)
    by = Window.partitionBy(doc)
    alone = F.min(F.when(F.col("section_id") == 0, (F.col("kind") == "list").cast("int"))).over(by) == 1
    first = F.min(F.when(F.col("section_id") > 0, F.col("section_id"))).over(by)
    placed = lead.withColumn("_s", F.when(alone & (F.col("section_id") == 0), F.coalesce(first, F.lit(0))).otherwise(F.col("section_id")))
    heads = placed.withColumn("_opens", (F.col("kind") == "heading") & (F.row_number().over(Window.partitionBy(doc, "section_id").orderBy(order)) == 1) & (F.col("section_id") > 0))
    item = F.struct(F.col(order).alias("at"), F.struct(F.coalesce(F.col("level") - 1, F.lit(0)).cast("int").alias("level"), "text").alias("item"))
    unit = F.when(F.col("kind") == "list", F.concat(F.lit("l"), F.col("list_run").cast("string"))).otherwise(F.concat(F.lit("e"), F.col(order).cast("string")))
    units = heads.groupBy(doc, "_s", unit.alias("_u"), "_opens", "kind").agg(
        F.min(order).alias("_at"), F.first("text").alias("text"), F.first("level").alias("level"), F.first("table_index").alias("table_index"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "list", item))).alias("_items"),
    )
    content = F.struct(
        "_at", F.struct("kind", F.when(F.col("kind") == "heading", F.col("level").cast("int")).alias("level"), F.when(F.col("kind").isin("heading", "paragraph"), F.col("text")).alias("text"),
        F.when(F.col("kind") == "list", F.transform("_items", lambda x: x["item"])).alias("items"), "table_index").alias("c"),
    )
    title = F.max(F.when(F.col("_opens"), F.col("text")))
    sections = units.groupBy(doc, "_s").agg(title.alias("title"), F.transform(F.array_sort(F.collect_list(F.when(~F.col("_opens"), content))), lambda x: x["c"]).alias("content"))
    nth = F.row_number().over(Window.partitionBy(doc).orderBy("_s"))
    named = sections.select(doc, F.struct(nth.alias("id"), F.coalesce("title", F.lit("Introduction")).alias("title"), F.lit(1).alias("level"), "content").alias("s"))
    return named.groupBy(doc).agg(F.array_sort(F.collect_list("s")).alias("sections"))


def element_stats(parts: DataFrame, doc: str, kind: str = "kind", text: str = "text") -> DataFrame:
    k = F.col(kind)
    return parts.groupBy(doc).agg(
        F.count_if(k == "heading").alias("headings"), F.count_if(k == "list").alias("list_items"), F.count_if(k == "paragraph").alias("paragraphs"), F.count("*").alias("elements"),
        F.sum(count_words(F.col(text))).alias("words"), F.sum(count_characters(F.col(text))).alias("characters"),
    )


def heading_counts(parts: DataFrame, doc: str, kind: str = "kind", level: str = "level") -> DataFrame:
    return parts.filter(F.col(kind) == "heading").groupBy(doc, level).agg(F.count("*").alias("n"))


def nth_occurrence(lines: DataFrame, doc: str, order: str, text: str, label: str, n: int) -> DataFrame:
    """The line of each document that holds the label for the nth time."""
    hits = lines.filter(F.col(text).contains(label))
    return hits.withColumn("_n", F.row_number().over(Window.partitionBy(doc).orderBy(order))).filter(F.col("_n") == n).drop("_n")


def relative_tables(rows: DataFrame, doc: str, section: str, table: str = "table_index", order: str = "index") -> DataFrame:
    """Table and paragraph numbers within a section, from 0."""
    by = Window.partitionBy(doc, section)
    return rows.withColumn("relative_table", F.dense_rank().over(by.orderBy(table)) - 1).withColumn("relative_index", F.row_number().over(by.orderBy(order)) - 1)


def table_stats(cells: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row a table: doc, table_index, n_cells, n_rows, max_columns, has_merged (a cell spans columns), texts (the trimmed texts of
    its cells that are not blank, in order). cells: doc, table_index, row_index, column_index, text, colspan."""
    text = trim_all(F.coalesce("text", F.lit("")))
    rows = cells.groupBy(doc, "table_index", "row_index").agg(F.count("*").alias("n"), F.bool_or(F.coalesce("colspan", F.lit(1)) > 1).alias("merged"), F.collect_list(F.struct("row_index", "column_index", text.alias("text"))).alias("texts"))
    tables = rows.groupBy(doc, "table_index").agg(F.sum("n").alias("n_cells"), F.count("*").alias("n_rows"), F.max("n").alias("max_columns"), F.bool_or("merged").alias("has_merged"), F.array_sort(F.flatten(F.collect_list("texts"))).alias("texts"))
    return tables.withColumn("texts", F.filter(F.transform("texts", lambda c: c["text"]), lambda x: x != ""))


def first_run_style(runs: Column, style: str, any_text: bool = False) -> Column:
    """The style field of the first run with text, of a paragraph; with any_text of the first run, as cells take it."""
    return F.get(runs if any_text else F.filter(runs, lambda r: trim_all(F.coalesce(r["text"], F.lit(""))) != ""), F.lit(0))[style]


def fields_by_kind(fields: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(text fields, checkbox fields) of rows with JSON values: booleans are checkboxes."""
    flag = F.coalesce(F.schema_of_variant(F.try_parse_json(F.col(value))) == "BOOLEAN", F.lit(False))
    return fields.filter(~flag), fields.filter(flag)
