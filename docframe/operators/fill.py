"""Mail merge: loops, tags, report, validation. All local to a row: a fill never shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.tags import distinct_tags, flatten_json, restyle
from docframe.functions.text import ANY_CASE_TAG, escape_xml
from docframe.operators.markup import well_formed
from docframe.operators.templates import expand_loops
from docframe.session import ship_package


def expand_loop(template: Column, name: str, items: Column, keys: list[str]) -> Column:
    """Each block {#name}...{/name} once for each item, its tags replaced by the item's escaped values; the blocks go if there
    are no items. items: array of structs with string fields `keys`; null values are empty."""
    block = rf"(?is)\{{#{name}\}}(.*?)\{{/{name}\}}"

    def one(body: Column, item: Column) -> Column:
        for key in keys:
            body = F.replace(body, F.lit(f"{{{{{key.upper()}}}}}"), escape_xml(F.coalesce(item.getField(key).cast("string"), F.lit(""))))
        return body

    def expanded(body: Column) -> Column:
        return F.coalesce(F.array_join(F.transform(items, lambda item: one(body, item)), ""), F.lit(""))

    # The bodies are cut out once for each block, before the items are gone through.
    wholes = F.array_distinct(F.regexp_extract_all(template, F.lit(block), F.lit(0)))
    blocks = F.transform(wholes, lambda w: F.struct(w.alias("whole"), F.regexp_extract(w, block, 1).alias("body")))
    return F.aggregate(blocks, template, lambda text, b: F.replace(text, b["whole"], expanded(b["body"])))


def is_array_json(value: Column) -> Column:
    return value.startswith("[") & value.endswith("]") & F.try_parse_json(value).isNotNull()


def _value(tags: Column, name: Column) -> Column:
    return F.try_element_at(tags, name)


def fill_tags(template: Column, tags: Column, keep_empty: bool = False) -> Column:
    """Struct(xml, replaced, remaining). Tags are replaced one after the other in the order in which they first stand, so a
    value that holds a tag is filled by later ones. Names are looked up as written; arrays are left to loops. What is left
    over goes, unless keep_empty."""
    names = distinct_tags(template, any_case=True)
    has_value = lambda n: F.coalesce(_value(tags, n), F.lit("")) != ""
    usable = F.filter(names, lambda n: has_value(n) & ~F.coalesce(is_array_json(_value(tags, n)), F.lit(False)))
    filled = F.aggregate(usable, template, lambda acc, n: F.replace(acc, F.concat(F.lit("{{"), n, F.lit("}}")), escape_xml(_value(tags, n))))
    xml = filled if keep_empty else F.regexp_replace(filled, ANY_CASE_TAG, "")
    return F.struct(xml.alias("xml"), usable.alias("replaced"), F.filter(names, lambda n: ~has_value(n)).alias("remaining"))


def fill(df: DataFrame, template: str, tags: str, style: str = "unicode", keep_empty: bool = False, out: str = "filled", validate: bool = False) -> DataFrame:
    """df with a struct column of fill_tags over its template and tag-map columns; with validate it has a field error too, what keeps
    the filled text from being well formed, null where nothing does: the whole stack of its elements is checked."""
    filled = df.withColumn(out, fill_tags(F.col(template), restyle(F.col(tags), style), keep_empty))
    if not validate:
        return filled
    ship_package(df.sparkSession)
    return filled.withColumn("_error", well_formed(F.col(out)["xml"])).withColumn(out, F.col(out).withField("error", F.col("_error"))).drop("_error")


def merge(df: DataFrame, template: str, data: str, style: str = "unicode", keep_empty: bool = False, out: str = "filled") -> DataFrame:
    """A whole fill of documents from JSON: its blocks expanded, its values flattened to tags of any depth, the tags replaced and the
    result validated. df: columns of the template and of a JSON object; out: struct(xml, replaced, remaining, error)."""
    ship_package(df.sparkSession)
    rows = df.withColumns({"_template": expand_loops(F.col(template), F.col(data)), "_tags": flatten_json(F.col(data))})
    return fill(rows.withColumn("_tags", F.coalesce("_tags", F.create_map().cast("map<string,string>"))), "_template", "_tags", style, keep_empty, out, validate=True).drop("_template", "_tags")


def fill_report(filled: DataFrame, column: str = "filled") -> DataFrame:
    """Counts and names of replaced and remaining tags beside the other columns; of a validated fill its error too."""
    c = F.col(column)
    validated = "error" in filled.schema[column].dataType.names
    return filled.withColumns(
        {
            **({"error": c["error"]} if validated else {}),
            "n_replaced": F.size(c["replaced"]),
            "n_remaining": F.size(c["remaining"]),
            "replaced_names": F.array_join(c["replaced"], ","),
            "remaining_names": F.array_join(c["remaining"], ","),
        }
    )
