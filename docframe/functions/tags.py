"""Functions of tag names: types, hints, defaults, and flattening of nested values to tags."""

from __future__ import annotations

import json
import math
import re
from decimal import Decimal
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docframe.functions.text import ANY_CASE_TAG, TAG, checkbox_symbol, strip_braces

#: Hint of the first key that a tag name contains.
HINTS = [
    ("NOM_COMMERCIAL", "nom commercial dénomination sociale raison sociale"),
    ("DENOMINATION", "dénomination sociale"),
    ("ADRESSE", "adresse postale siège"),
    ("ADRESSE_SIEGE", "siège social adresse siège"),
    ("SIRET", "numéro SIRET SIREN identification"),
    ("EMAIL", "adresse électronique courriel email"),
    ("TELEPHONE", "téléphone numéro tel"),
    ("FORME_JURIDIQUE", "forme juridique statut entreprise"),
    ("CHECK_PME", "PME petite moyenne entreprise artisan"),
    ("CA_", "chiffre affaires exercice"),
    ("PART_CA", "part pourcentage chiffre affaires"),
]


def _boolean(c: Column) -> Column:
    return c.startswith("CHECK_") | c.startswith("EST_") | c.contains("_OUI") | c.contains("_NON")


def _date(c: Column) -> Column:
    return c.contains("DATE") | c.contains("_DEBUT") | c.contains("_FIN")


def tag_type(c: Column, in_cell: Column | None = None) -> Column:
    """checkbox, date, table_cell (a text tag inside a cell) or text."""
    plain = F.lit("text") if in_cell is None else F.when(in_cell, F.lit("table_cell")).otherwise(F.lit("text"))
    return F.when(_boolean(c), "checkbox").when(_date(c), "date").otherwise(plain)


def tag_data_type(c: Column) -> Column:
    number = c.contains("MONTANT") | c.contains("PRIX") | c.contains("CA_")
    return F.when(_boolean(c), "boolean").when(_date(c), "date").when(number, "number").otherwise("string")


def default_json(c: Column) -> Column:
    """The JSON of a tag's empty value."""
    kind = tag_data_type(c)
    return F.when(kind == "boolean", "false").when(kind == "number", "0").otherwise('""')


def semantic_hint(c: Column) -> Column:
    chain = F.when(c.contains(HINTS[0][0]), HINTS[0][1])
    for key, hint in HINTS[1:]:
        chain = chain.when(c.contains(key), hint)
    return chain.otherwise("")


def distinct_tags(c: Column, any_case: bool = False) -> Column:
    """Names of the tags of a text in the order in which they first stand."""
    found = F.regexp_extract_all(c, F.lit(ANY_CASE_TAG if any_case else TAG), F.lit(0))
    return F.array_distinct(F.transform(found, strip_braces))


def js_number(c: Column) -> Column:
    """Numbers as a script would write them: without an exponent from a millionth up to below 1e21, with one beyond, no trailing zeros."""
    size = F.abs(c.cast("double"))
    text = c.cast("string")
    bare = lambda t: F.regexp_replace(F.regexp_replace(t, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    plain = lambda digits: bare(text.try_cast(f"decimal(38,{digits})").cast("string"))
    far = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), "E-", "e-"), r"E(\d)", "e+$1")
    return F.when(size == 0, "0").when((size >= 1e-6) & (size < 1e12), plain(24)).when((size >= 1e12) & (size < 1e21), plain(16)).otherwise(far)


def _leaf(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return checkbox_symbol(c)
    if isinstance(kind, T.DoubleType | T.FloatType):
        return js_number(c)
    if isinstance(kind, T.DecimalType):
        return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return c.cast("string")


def _entries(c: Column, kind: T.DataType, prefix: Column) -> list[Column]:
    """Arrays of (tag, value) entries of one value; the shape comes from its type when the plan is made."""
    entry = lambda key, value: F.array(F.struct(F.upper(key).alias("key"), value.cast("string").alias("value")))
    if isinstance(kind, T.StructType):
        return [e for f in kind.fields for e in _entries(c.getField(f.name), f.dataType, F.concat(prefix, F.lit(f"_{f.name}")))]
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StructType):
            items = F.transform(c, lambda x, i: F.flatten(F.array(*_entries(x, kind.elementType, F.concat(prefix, F.lit("_"), i.cast("string"))))))
            whole = entry(prefix, F.when(F.size(c) > 0, F.to_json(c, {"ignoreNullFields": "false"})))
            return [F.coalesce(F.flatten(items), F.array().cast("array<struct<key:string,value:string>>")), whole]
        joined = F.array_join(F.transform(c, lambda x: _leaf(x, kind.elementType)), ", ", "null")
        return [entry(prefix, F.when(F.size(c) > 0, joined))]
    return [entry(prefix, _leaf(c, kind))]


def flatten_to_tags(columns: dict[str, tuple[Column, T.DataType]]) -> Column:
    """Map of upper-case tag to text from typed values: structs by path, arrays of structs by index and as JSON, other arrays
    joined by commas, booleans as boxes; nulls have no tag. Later keys win."""
    parts = [e for name, (c, kind) in columns.items() for e in _entries(c, kind, F.lit(name))]
    entries = F.filter(F.flatten(F.array(*parts)), lambda e: e["value"].isNotNull())
    keys = F.transform(entries, lambda e: e["key"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    return F.map_from_entries(F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(last))


def _number(value: float) -> str:
    """A number as a script would write it; whole numbers exactly, however long."""
    if isinstance(value, int):
        return str(value)
    if math.isnan(value) or math.isinf(value):
        return "NaN" if math.isnan(value) else "Infinity" if value > 0 else "-Infinity"
    if value == int(value) and abs(value) < 1e21:
        return str(int(value))
    digits = repr(value)
    if 1e-6 <= abs(value) < 1e21:
        return format(Decimal(digits), "f")
    return re.sub(r"e([+-])0*", r"e\1", digits)


def json_text(value: object) -> str:
    """A value as compact JSON, its numbers as a script would write them."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{json_text(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(json_text, value)) + "]"
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    return _number(value)


def json_value(value: object, boxes: bool = True) -> str:
    """A scalar as text: booleans as boxes or as words, numbers as a script would write them."""
    if isinstance(value, bool):
        return ("☑" if value else "☐") if boxes else ("true" if value else "false")
    return value if isinstance(value, str) else _number(value)


def flat_tags(data: object) -> dict[str, str]:
    """Upper-case tags of a JSON object at any depth: objects by their path; lists of objects by number, and as JSON; other lists joined
    by commas; booleans as boxes. Nulls and empty lists have no tag; of colliding tags the last in the object's order counts."""
    out: dict[str, str] = {}
    todo: list[tuple[str, object]] = [("", data)] if isinstance(data, dict) else []
    while todo:
        prefix, value = todo.pop()
        if isinstance(value, _Done):
            out[prefix] = value.text
        elif value is None or value == []:
            continue
        elif isinstance(value, dict):
            todo += reversed([((f"{prefix}_{k}" if prefix else k).upper(), v) for k, v in value.items()])
        elif isinstance(value, list) and isinstance(value[0], dict | list):
            # A list in a list counts as an object whose keys are numbers.
            items = [(f"{prefix}_{i}", v if isinstance(v, dict) else {str(j): x for j, x in enumerate(v)}) for i, v in enumerate(value) if isinstance(v, dict | list)]
            todo += reversed([*items, (prefix, _Done(json_text(value)))])
        elif isinstance(value, list):
            out[prefix] = ", ".join("null" if v is None else json_text(v) if isinstance(v, dict | list) else json_value(v, boxes=False) for v in value)
        else:
            out[prefix] = json_value(value)
    return out


class _Done(NamedTuple):
    """A text whose turn comes after others."""

    text: str


def flatten_json(data: Column) -> Column:
    """Map of tag to text (flat_tags) of JSON of any shape, which may differ from row to row. Null, text that is no JSON object, and
    JSON nested deeper than the parser goes (some thousand levels) give null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        found = []
        for text in texts:
            try:
                value = json.loads(text) if isinstance(text, str) else None
                found.append(json.dumps(flat_tags(value), ensure_ascii=False) if isinstance(value, dict) else None)
            except (ValueError, RecursionError):
                found.append(None)
        return pd.Series(found, dtype=object)

    return F.from_json(run(data), "map<string,string>")


def restyle(tags: Column, style: str) -> Column:
    """Boxes in another style; plain texts that are a box count as boxes."""
    if style == "unicode":
        return tags
    return F.transform_values(tags, lambda _, v: F.when(v == "☑", checkbox_symbol(F.lit(True), style)).when(v == "☐", checkbox_symbol(F.lit(False), style)).otherwise(v))
