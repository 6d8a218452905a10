"""Records that a run gives for each document: what a fill did, what a mapping placed, what a page holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.tags import default_json
from docframe.operators import layout
from docframe.session import materialize
from docframe.sinks.docx import output_name

#: Percent of expected tags that a mapping must place.
ENOUGH = 80
#: Status of a verified tag -> status in the checklist; all others failed.
GOOD = ("ok", "semantic_mismatch")


def fill_output(filled: DataFrame, path: str = "path", column: str = "filled", name: str | None = None, with_report: bool = True, out: str = "output") -> DataFrame:
    """filled with a struct `out`: success, filename, original_filename, error, report(tags_in_document, tags_replaced, tags_remaining,
    replaced_tags, remaining_tags). The file is named by the column `name`, where that is null or not given by the document's own name.
    An error of a validated fill, or a null fill, is no success; the report is null without with_report."""
    c = F.col(column)
    own = output_name(F.col(path))
    error = c["error"] if "error" in filled.schema[column].dataType.names else F.lit(None).cast("string")
    report = F.struct(
        (F.size(c["replaced"]) + F.size(c["remaining"])).alias("tags_in_document"), F.size(c["replaced"]).alias("tags_replaced"), F.size(c["remaining"]).alias("tags_remaining"),
        c["replaced"].alias("replaced_tags"), c["remaining"].alias("remaining_tags"),
    )
    return filled.withColumn(
        out,
        F.struct(
            (c["xml"].isNotNull() & error.isNull()).alias("success"), (F.coalesce(F.col(name), own) if name else own).alias("filename"), F.regexp_extract(F.col(path), "[^/]+$", 0).alias("original_filename"),
            error.alias("error"), F.when(F.lit(with_report) & c["xml"].isNotNull(), report).alias("report"),
        ),
    )


def checklist(tags: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, tag, ord, full_tag, location(type, table_index, row_index, column_index), status of each tag that a document's template
    expects: a tag that stands several times is expected once, at its first place, and is pending. tags: doc, tag, ord and the cell,
    null outside of tables."""
    cell = ["table_index", "row_index", "column_index"]
    first = tags.groupBy(doc, "tag").agg(F.min(F.struct("ord", *cell)).alias("_f"))
    kind = F.when(F.col("_f.table_index").isNotNull(), "table_cell").otherwise("text")
    place = F.struct(kind.alias("type"), *[F.col("_f")[c].alias(c) for c in cell])
    return first.select(doc, "tag", F.col("_f.ord").alias("ord"), F.concat(F.lit("{{"), "tag", F.lit("}}")).alias("full_tag"), place.alias("location"), F.lit("pending").alias("status"))


def settle(expected: DataFrame, verified: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The checklist with what matching.verify found (doc, tag, status): verified or failed; tags of which it says nothing stay."""
    seen = verified.groupBy(doc, "tag").agg(F.max(F.col("status").isin(*GOOD)).alias("_good"))
    status = F.when(F.col("_good"), "verified").when(~F.col("_good"), "failed").otherwise(F.col("status"))
    return expected.join(seen, [doc, "tag"], "left").withColumn("status", status).drop("_good")


def mapping_output(docs: DataFrame, expected: DataFrame, issues: DataFrame | None = None, checkboxes: DataFrame | None = None, doc: str = "doc_id", path: str = "path", enough: int = ENOUGH) -> DataFrame:
    """docs with a struct `output`: success, source_filename, output_filename, satisfaction, tags_expected, tags_applied, tags_failed, the
    arrays applied, failed and available_tags in the template's order, data_structure (JSON of each tag's empty value), issues and
    checkboxes. A mapping succeeds when `enough` percent of the tags are placed or verified; a document without tags does not.
    expected: a checklist; issues: doc, type, tag, description; checkboxes: doc, tag, checked (of equal tags one that is set). Every
    document of docs has its row, with empty arrays where the others say nothing of it."""
    done = F.col("status").isin("verified", "placed")
    listed = lambda c, condition=None: F.transform(F.array_sort(F.collect_list(F.struct("ord", "tag", c.alias("x")) if condition is None else F.when(condition, F.struct("ord", "tag", c.alias("x"))))), lambda s: s["x"])
    default = F.concat(F.to_json(F.array("tag")), F.lit(":"), default_json(F.col("tag")))
    pair = F.regexp_replace(default, r'^\[(".*")\]:', "$1:")
    counts = expected.groupBy(doc).agg(
        F.count("*").alias("_expected"), F.count_if(done).alias("_applied"), listed(F.col("tag"), done).alias("_done"), listed(F.col("tag"), ~done).alias("_failed"),
        listed(F.concat(F.lit("{{"), "tag", F.lit("}}"))).alias("_tags"), F.concat(F.lit("{"), F.array_join(listed(pair), ","), F.lit("}")).alias("_empty"),
    )
    rows = docs.join(counts, doc, "left")
    none: Column = F.array().cast("array<string>")
    extra = []
    if issues is not None:
        rows = rows.join(issues.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("type", "tag", "description"))).alias("_issues")), doc, "left")
        extra.append(F.coalesce("_issues", F.array().cast(rows.schema["_issues"].dataType)).alias("issues"))
    if checkboxes is not None:
        flat = checkboxes.groupBy(doc, "tag").agg(F.max("checked").alias("checked")).groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("tag", "checked"))).alias("_boxes"))
        rows = rows.join(flat, doc, "left")
        extra.append(F.coalesce("_boxes", F.array().cast(rows.schema["_boxes"].dataType)).alias("checkboxes"))
    total, applied = (F.coalesce(c, F.lit(0)) for c in ("_expected", "_applied"))
    percent = F.floor(100 * applied / F.greatest(total, F.lit(1)) + 0.5).cast("int")
    record = F.struct(
        (percent >= enough).alias("success"), F.regexp_extract(F.col(path), "[^/]+$", 0).alias("source_filename"), output_name(F.col(path), "_tagged").alias("output_filename"), percent.alias("satisfaction"),
        total.alias("tags_expected"), applied.alias("tags_applied"), (total - applied).alias("tags_failed"), *[F.coalesce(c, none).alias(n) for c, n in (("_done", "applied"), ("_failed", "failed"), ("_tags", "available_tags"))],
        F.coalesce("_empty", F.lit("{}")).alias("data_structure"), *extra,
    )
    return rows.withColumn("output", record).select(*docs.columns, "output")


def page_records(boxes: DataFrame, page_width: float, page_height: float, with_fields: bool = True) -> DataFrame:
    """doc_id, page, width, height, elements, lines, empty_zones, fields: all that layout finds on a page, as arrays in order; a page
    whose boxes are all blank has elements alone, and fields are empty without with_fields. Only a page's own rows are collected."""
    # Lines and zones are read several times each, so they are made and written once.
    lines = materialize(layout.group_lines(boxes), "record-lines")
    numbered = lines.select(*layout.KEY, F.posexplode("boxes").alias("_i", "_b"), "line", "y")
    on_line = numbered.select(*layout.KEY, "line", F.col("_b.index").alias("index"), F.col("_b.x").alias("x"), "y", F.col("_b.width").alias("width"), F.col("_b.text").alias("text"))
    zones = materialize(layout.empty_zones(lines, on_line, page_width), "record-zones")
    gathered = lambda df, name, *cols: df.groupBy(*layout.KEY).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    out = gathered(boxes, "elements", "index", "text", "x", "y", "width", "height")
    out = out.join(gathered(lines, "lines", "line", "x", "y", "width", "height", "text"), layout.KEY, "left")
    out = out.join(gathered(zones, "empty_zones", "line", "x", "y", "width", "kind", "label"), layout.KEY, "left")
    found = layout.fields(zones) if with_fields else layout.fields(zones.limit(0))
    out = out.join(gathered(found, "fields", "field_id", "label", "field_type", "x", "y", "width", "confidence"), layout.KEY, "left")
    empty = lambda c: F.coalesce(c, F.array().cast(out.schema[c].dataType)).alias(c)
    return out.select(*layout.KEY, F.lit(float(page_width)).alias("width"), F.lit(float(page_height)).alias("height"), "elements", *[empty(c) for c in ("lines", "empty_zones", "fields")])
