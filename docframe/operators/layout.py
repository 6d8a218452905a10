"""Positioned page text: lines, gaps, empty zones, fields, tag places, label places, placements and their observation.

Boxes have doc_id, page, index, text, x, y, width, height; the origin is at the bottom left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions.geometry import field_type, fitting_font_size, fitting_size_measured, wrap_measured
from docframe.functions.text import trim_all, wrap
from docframe.session import small

LINE_TOLERANCE, WORD_GAP, EMPTY_ZONE, RIGHT_MARGIN, ZONE_START = 3.0, 5.0, 30.0, 50.0, 5.0
KEY = ["doc_id", "page"]


def group_lines(boxes: DataFrame) -> DataFrame:
    """Lines of each page from top to bottom: a box within LINE_TOLERANCE of a line's first box belongs to it. The fold keeps the
    line's first y, so a slow drift starts a new line. doc_id, page, line, x, y, width, height, text, boxes."""
    items = F.array_sort(F.collect_list(F.struct((-F.col("y")).alias("ny"), "x", "index", "y", "width", "height", "text")))
    pages = boxes.filter(trim_all(F.col("text")) != "").groupBy(*KEY).agg(items.alias("items"))
    empty = F.expr("cast(array() as array<struct<anchor:double,i:int>>)")

    def step(acc: Column, i: Column) -> Column:
        y = F.get(F.col("items"), i)["y"]
        anchor = F.element_at(acc, -1)["anchor"]
        near = (F.size(acc) > 0) & (F.abs(anchor - y) <= LINE_TOLERANCE)
        return F.concat(acc, F.array(F.struct(F.when(near, anchor).otherwise(y).alias("anchor"), i.alias("i"))))

    order = F.when(F.size("items") > 0, F.sequence(F.lit(0), F.size("items") - 1))
    anchored = pages.select(*KEY, "items", F.explode(F.aggregate(order, empty, step)).alias("a"))
    flat = anchored.select(*KEY, F.col("a.anchor").alias("anchor"), F.get(F.col("items"), F.col("a.i")).alias("b")).select(*KEY, "anchor", "b.*")
    lines = flat.groupBy(*KEY, "anchor").agg(
        F.min("x").alias("x"), F.avg("y").alias("y"), (F.max(F.col("x") + F.col("width")) - F.min("x")).alias("width"), F.max("height").alias("height"),
        F.array_sort(F.collect_list(F.struct("x", "index", "width", "text"))).alias("boxes"),
    )
    w = Window.partitionBy(*KEY).orderBy(F.desc("anchor"))
    return lines.select(*KEY, (F.row_number().over(w) - 1).alias("line"), "x", "y", "width", "height", join_words(F.col("boxes")).alias("text"), "boxes")


def join_words(boxes: Column) -> Column:
    """Texts of boxes from left to right, a space where the gap exceeds WORD_GAP."""
    start = F.struct(F.lit("").alias("text"), F.lit(None).cast("double").alias("end"))

    def step(acc: Column, b: Column) -> Column:
        gap = acc["end"].isNotNull() & (b["x"] - acc["end"] > WORD_GAP)
        return F.struct(F.concat(acc["text"], F.when(gap, " ").otherwise(""), b["text"]).alias("text"), (b["x"] + b["width"]).cast("double").alias("end"))

    return F.aggregate(boxes, start, step)["text"]


def gaps(boxes: DataFrame, line: str = "line", least: float = EMPTY_ZONE) -> DataFrame:
    """Gaps of at least `least` to the next box on the line."""
    w = Window.partitionBy(*KEY, line).orderBy("x", "index")
    gap = F.lead("x").over(w) - (F.col("x") + F.col("width"))
    return boxes.withColumn("gap", gap).filter(F.col("gap") >= least)


def empty_zones(lines: DataFrame, boxes: DataFrame, page_width: float, line: str = "line") -> DataFrame:
    """Zones after a colon up to the right margin, and gaps within lines. doc_id, page, line, kind, x, y, width, label."""
    end = F.col("x") + F.col("width")
    colon = lines.filter(F.rtrim("text").endswith(":") & (page_width - end - RIGHT_MARGIN >= EMPTY_ZONE))
    after = colon.select(*KEY, line, F.lit("after_colon").alias("kind"), (end + ZONE_START).alias("x"), "y", (page_width - end - RIGHT_MARGIN).alias("width"), F.col("text").alias("label"))
    inner = gaps(boxes, line).select(*KEY, line, F.lit("gap").alias("kind"), (F.col("x") + F.col("width") + ZONE_START).alias("x"), "y", (F.col("gap") - 2 * ZONE_START).alias("width"), F.col("text").alias("label"))
    return after.unionByName(inner)


def fields(zones: DataFrame, line: str = "line") -> DataFrame:
    """Fields of zones: those after a colon with a label of three letters, then gaps that none of them covers."""
    label = trim_all(F.regexp_replace("label", r":\s*$", ""))
    named = zones.withColumn("label", label).filter(F.length("label") >= 3)
    sure = named.filter("kind = 'after_colon'").withColumn("confidence", F.lit(0.9))
    s = sure.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("x").alias("_x"), F.col("y").alias("_y"))
    covered = (F.col("doc_id") == F.col("_doc_id")) & (F.col("page") == F.col("_page")) & (F.abs(F.col("x") - F.col("_x")) < 10) & (F.abs(F.col("y") - F.col("_y")) < LINE_TOLERANCE)
    maybe = named.filter("kind = 'gap'").join(s, covered, "left_anti").withColumn("confidence", F.lit(0.7))
    w = Window.partitionBy("doc_id").orderBy("page", F.desc("confidence"), line, "x")
    return sure.unionByName(maybe).withColumn("field_id", F.row_number().over(w)).withColumn("field_type", field_type(F.col("label")))


def tag_places(lines: DataFrame) -> DataFrame:
    """Tags of lines with x by the line's mean character width."""
    flat = lines.select(*KEY, "line", "x", "y", "width", "text", F.posexplode(F.regexp_extract_all("text", F.lit(r"\{\{[A-Z_0-9]+\}\}"), F.lit(0))).alias("ord", "full_tag"))
    before = F.expr("locate(full_tag, text) - 1")
    return flat.select(*KEY, "line", "ord", F.translate("full_tag", "{}", "").alias("tag"), (F.col("x") + before * F.col("width") / F.length("text")).alias("x"), "y")


#: Headings that tell which form a document of pages is.
FORM_HEADINGS = {"DC1": ["D-Présentation du candidat", "D - Présentation"], "DC2": ["C-Identification du candidat", "C - Identification"]}


def form_of_pages(lines: DataFrame) -> DataFrame:
    """doc_id, form: that of the first line, over all pages in order, which holds a heading of FORM_HEADINGS (of several on a line the
    first form counts); null for a document without one."""
    form = F.coalesce(*[F.when(F.greatest(*[F.col("text").contains(h) for h in heads]), F.lit(kind)) for kind, heads in FORM_HEADINGS.items()])
    first = F.min(F.when(form.isNotNull(), F.struct("page", "line", form.alias("form"))))
    return lines.groupBy("doc_id").agg(first.alias("_f")).select("doc_id", F.col("_f.form").alias("form"))


def lines_containing(lines: DataFrame, text: str, case_sensitive: bool = False, page: int | None = None) -> DataFrame:
    hit = F.col("text").contains(text) if case_sensitive else F.lower("text").contains(text.lower())
    return lines.filter(hit if page is None else hit & (F.col("page") == page))


def fields_near(field_rows: DataFrame, x: float, y: float, page: int, tolerance: float = 20.0) -> DataFrame:
    return field_rows.filter((F.col("page") == page) & (F.abs(F.col("x") - x) <= tolerance) & (F.abs(F.col("y") - y) <= tolerance))


def section_lines(lines: DataFrame, start: str, end: str | None) -> DataFrame:
    """Lines below the first line with the start marker, up to the first later one with the end marker; markers match without
    regard to white space and case."""
    bare = F.lower(F.regexp_replace("text", r"(?U)\s+", ""))
    squeeze = lambda s: "".join(s.split()).lower()
    at = F.struct("page", "line")
    marked = lines.withColumn("_at", at).withColumn("_bare", bare)
    first = marked.filter(F.col("_bare").contains(squeeze(start))).groupBy("doc_id").agg(F.min("_at").alias("_from"))
    below = marked.join(first, "doc_id").filter(F.col("_at") > F.col("_from"))
    if end is None:
        return below.drop("_at", "_bare", "_from")
    last = below.filter(F.col("_bare").contains(squeeze(end))).groupBy("doc_id").agg(F.min("_at").alias("_to"))
    return below.join(last, "doc_id", "left").filter(F.col("_to").isNull() | (F.col("_at") < F.col("_to"))).drop("_at", "_bare", "_from", "_to")


#: A line whose distance to the one above is below CONTINUES goes on with it; so many lines below a label are looked at. Text so
#: near to a place takes it, and text of so near a line belongs to it. Multiline places begin at LEFT.
CONTINUES, FOLLOWING, TAKEN, SAME_LINE, LEFT = 18.0, 5, 10.0, 5.0, 71.0


def label_places(lines: DataFrame, config: DataFrame, boxes: DataFrame, page: int = 1, section: tuple[int, float, int] | None = None) -> DataFrame:
    """One row for each document and configured field: doc_id, field, type, page, x, y; nulls where no place fits.

    Inline fields: behind the colon of the first box with one on the first line that holds one of the field's labels. Others: for
    each such line in turn, past the lines that go on with it, in the middle of the gap below, if it is at least min_gap (default
    0) and no text is near. Labels match as written. Pages: the given one and the next, or those of section (first page, y that
    lines must lie below on it, last page); the first page with a place counts.
    lines, boxes: doc_id, page, x, y, width, text; config: field, labels, type, min_gap, a small table."""
    first, last = (page, page + 1) if section is None else (section[0], section[2])
    scope = lambda df: df.filter(F.col("page").between(first, last))
    shown = scope(lines) if section is None else scope(lines).filter((F.col("page") != first) | (F.col("y") < section[1]))
    texts = shown.groupBy(*KEY).agg(F.reverse(F.array_sort(F.collect_list(F.struct("y", "text")))).alias("ls"))
    items = scope(boxes).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("x", "y", "width", "text"))).alias("els"))
    # A row a page and field: config has a row a field.
    pages = texts.join(items, [*KEY], "left").crossJoin(small(config.select("field", "labels", "type", F.coalesce("min_gap", F.lit(0.0)).alias("min_gap"))))
    at = lambda i: F.get("ls", i)
    n = F.size("ls")
    found = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.exists("labels", lambda label: F.contains(at(i)["text"], label)))
    label_y = at(F.get(found, F.lit(0)))["y"]
    colon = F.get(F.filter("els", lambda e: (F.abs(e["y"] - label_y) < SAME_LINE) & F.contains(e["text"], F.lit(":"))), F.lit(0))
    inline = F.when(colon.isNotNull(), F.struct((colon["x"] + F.locate(":", colon["text"]) * colon["width"] / F.greatest(F.length(colon["text"]), F.lit(1)) + 8).alias("x"), colon["y"].alias("y")))

    def below(i: Column) -> Column:
        ks = F.sequence(i + 1, F.least(i + FOLLOWING, n - 1))
        stop = F.get(F.filter(ks, lambda k: at(k - 1)["y"] - at(k)["y"] >= CONTINUES), F.lit(0))
        end = F.coalesce(stop - 1, F.least(i + FOLLOWING, n - 1))
        gap = at(end)["y"] - at(end + 1)["y"]
        y = at(end + 1)["y"] + gap / 2
        taken = F.coalesce(F.exists("els", lambda e: (F.abs(e["y"] - y) < TAKEN) & (F.trim(e["text"]) != "")), F.lit(False))
        return F.when((i + 1 < n) & (end + 1 < n) & (gap >= F.col("min_gap")) & ~taken, F.struct(F.lit(LEFT).alias("x"), y.alias("y")))

    multi = F.get(F.filter(F.transform(found, below), lambda p: p.isNotNull()), F.lit(0))
    place = F.when(F.size(found) > 0, F.when(F.col("type") == "inline", inline).otherwise(multi))
    best = pages.withColumn("place", place).groupBy("doc_id", "field", "type").agg(F.min(F.when(F.col("place").isNotNull(), F.struct("page", "place"))).alias("m"))
    whole = lambda c: F.floor(c + 0.5).cast("double")
    return best.select("doc_id", "field", "type", "m.page", whole(F.col("m.place.x")).alias("x"), whole(F.col("m.place.y")).alias("y"))


def placements(matches: DataFrame, size: float = 9.0, least: float = 6.0, step: float = 1.2, measured: bool = False) -> DataFrame:
    """One row a drawn line: the value in the largest size that fits its width, wrapped, lines going down. matches: doc_id, page,
    field, x, y, width, value; rows without a value are left out. Widths are estimated from the number of characters or, measured,
    summed from the standard font's glyphs."""
    c, limit = F.col("value"), F.col("width")
    fit = fitting_size_measured(c, limit, size, least) if measured else fitting_font_size(c, limit, size, least)
    sized = matches.filter(F.coalesce("value", F.lit("")) != "").withColumn("size", fit)
    lines = wrap_measured(c, limit, F.col("size")) if measured else wrap(c, limit, F.col("size") * 0.5)
    lined = sized.select("*", F.posexplode(lines).alias("nth", "line_text"))
    return lined.select("doc_id", "page", "field", "size", "nth", "line_text", "x", (F.col("y") - F.col("nth") * F.col("size") * step).alias("y"))


def checkbox_marks(lines: DataFrame, config: DataFrame) -> DataFrame:
    """An X beside the first line that holds one of a set field's labels. config: field, labels, checked."""
    flat = config.filter("checked").select("field", F.posexplode("labels").alias("label_ord", "label"))
    hits = lines.join(small(flat), F.lower("text").contains(F.lower("label")))
    w = Window.partitionBy("doc_id", "field").orderBy("page", "line", "label_ord")
    first = hits.withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    return first.select("doc_id", "page", "field", F.lit("X").alias("line_text"), F.lit(10.0).alias("size"), (F.col("x") - 12).alias("x"), (F.col("y") - 2).alias("y"))


def build_matches(positions: DataFrame, values: DataFrame, width: float = 300.0, height: float = 12.0, confidence: float = 0.95) -> DataFrame:
    """doc_id, field, page, x, y, width, height, confidence, value: what to draw of positions (doc_id, field, page, x, y, confidence) with a
    place and a value (doc_id, field, value) that is not empty; without a confidence of their own they have the given one."""
    given = values.filter(F.coalesce("value", F.lit("")) != "").select("doc_id", "field", "value")
    sure = F.coalesce(F.nullif(F.col("confidence"), F.lit(0.0)), F.lit(confidence))
    placed = positions.filter("x is not null and y is not null").join(given, ["doc_id", "field"])
    return placed.select("doc_id", "field", "page", "x", "y", F.lit(width).alias("width"), F.lit(height).alias("height"), sure.alias("confidence"), "value")


def observe(lines: DataFrame, values: DataFrame) -> DataFrame:
    """status of placed values: on each page the first line that holds the value's first 12 characters must carry it behind a
    colon (inline) or at its start (multiline); any page that does not is a collision; unseen values count as ok.
    values: doc_id, field, type, value."""
    head = F.left("value", F.lit(12))
    v = values.withColumn("_head", head)
    hits = v.join(lines.select("doc_id", "page", "line", F.col("text").alias("_t")), "doc_id").filter(F.col("_t").contains(F.col("_head")))
    w = Window.partitionBy("doc_id", "field", "page").orderBy("line")
    first = hits.withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    before = F.expr("rtrim(substring(_t, 1, locate(_head, _t) - 1))")
    fine = F.when(F.col("type") == "multiline", F.col("_t").startswith(F.col("_head"))).otherwise((before == "") | before.endswith(":"))
    seen = first.groupBy("doc_id", "field").agg(F.bool_and(fine).alias("fine"))
    status = F.when(F.coalesce(F.col("value"), F.lit("")) == "", "missing").when(F.coalesce("fine", F.lit(True)), "ok").otherwise("collision")
    return values.join(seen, ["doc_id", "field"], "left").select("doc_id", "field", status.alias("status"))


def merge_pages(documents: DataFrame) -> DataFrame:
    """Page rows (doc_id, doc_ord, page, ...) of several documents as one, renumbered; group column merge_id."""
    w = Window.partitionBy("merge_id").orderBy("doc_ord", "page")
    return documents.withColumn("page", F.row_number().over(w))


def extract_page(pages: DataFrame, n: int) -> DataFrame:
    """The rows of page n of each document, with a null error; a document without it gives a row of nulls and the error."""
    whole = pages.groupBy("doc_id").agg(F.max("page").alias("_last")).filter((F.lit(n) < 1) | (F.col("_last") < n))
    found = pages.filter(F.col("page") == n).withColumn("error", F.lit(None).cast("string"))
    bad = whole.select("doc_id", F.concat(F.lit(f"page {n} is not between 1 and "), F.col("_last").cast("string")).alias("error"))
    return found.unionByName(bad, allowMissingColumns=True)


def filled_values(values: DataFrame, value: str = "value") -> DataFrame:
    """Values to write: true, or text that is not blank."""
    c = F.col(value)
    return values.filter(c if dict(values.dtypes)[value] == "boolean" else trim_all(c) != "")


def placement_report(matches: DataFrame, values: DataFrame, pages: DataFrame) -> DataFrame:
    """matches (doc_id, field, page, ...) with value, warning and error: no_data where values (doc_id, field, value) has none,
    bad_page where pages (doc_id, page) lacks the page. Rows with neither can be placed."""
    given = values.groupBy("doc_id", "field").agg(F.first("value").alias("value"))
    known = pages.select("doc_id", "page").distinct().withColumn("_known", F.lit(True))
    joined = matches.join(given, ["doc_id", "field"], "left").join(known, ["doc_id", "page"], "left")
    missing = F.col("value").isNull()
    return joined.select(*matches.columns, "value", F.when(missing, "no_data").alias("warning"), F.when(~missing & F.col("_known").isNull(), "bad_page").alias("error"))
