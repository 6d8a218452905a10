"""Templates with blocks: parsed once into a tree of texts, tags and blocks, and expanded by the arrays of a JSON object.

A worker parses each different template once; the expansion is local to a row. Blocks with few levels below them are expanded once for
each different set of values that their tags get from around; those above walk the tree with a stack, so a template may have any number
of blocks at any depth. Values are texts: a block or a tag in a value is not one of the template.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docframe.functions.tags import json_text, json_value

_PART = re.compile(r"\{#(\w+)\}|\{/(\w+)\}|\{\{([^{}]*)\}\}")
_ESCAPES = str.maketrans({"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&apos;"})


class Text(NamedTuple):
    text: str


class Tag(NamedTuple):
    """A tag as it stands, and its name in lower case."""

    text: str
    name: str


class Block(NamedTuple):
    """A block, the number of levels of blocks from it down, and the names of all tags in it; of tall blocks the names are left out."""

    name: str
    parts: list
    height: int
    names: tuple[str, ...]


#: Most levels of a block that is expanded by recursion.
LOW = 8


def _block(name: str, parts: list) -> Block:
    inner = [p for p in parts if isinstance(p, Block)]
    height = 1 + max((b.height for b in inner), default=0)
    names = {p.name for p in parts if isinstance(p, Tag)}.union(*(b.names for b in inner)) if height <= LOW else ()
    return Block(name, parts, height, tuple(sorted(names)))


@lru_cache(maxsize=256)
def parse(template: str) -> list:
    """The parts of a template. An end without a begin is text; a begin without an end is text too, and what follows it stands beside
    it. Names of begin and end may differ in case."""
    top: list = []
    stack: list[tuple[str, str, list]] = []  # name, the begin as it stands, parts
    here, at = top, 0

    def undo() -> list:
        """Give the parts of the open block to the one around it."""
        _, begin, parts = stack.pop()
        outer = stack[-1][2] if stack else top
        outer += (Text(begin), *parts)
        return outer

    for m in _PART.finditer(template):
        if m.start() > at:
            here.append(Text(template[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            stack.append((m[1], m[0], []))
            here = stack[-1][2]
        elif m[3] is not None:
            here.append(Tag(m[0], m[3].lower()))
        elif any(name.lower() == m[2].lower() for name, _, _ in stack):
            while stack[-1][0].lower() != m[2].lower():
                here = undo()
            name, _, parts = stack.pop()
            here = stack[-1][2] if stack else top
            here.append(_block(name, parts))
        else:
            here.append(Text(m[0]))
    here.append(Text(template[at:]))
    while stack:
        undo()
    return top


def array_of(data: object, name: str) -> list | None:
    """The array that a block's name means in an object: the key as written, the key in lower case, or the path that the name gives
    when split at underscores, where keys match in any case."""
    if not isinstance(data, dict):
        return None
    for key in (name, name.lower()):
        if isinstance(data.get(key), list):
            return data[key]
    at: object = data
    for part in name.lower().split("_"):
        if not isinstance(at, dict):
            return None
        at = next((v for k, v in at.items() if k.lower() == part), None)
    return at if isinstance(at, list) else None


def shown(value: object) -> str:
    """A JSON value as text: booleans as boxes, lists of scalars joined, objects and lists that hold some as JSON, null empty."""
    if value is None:
        return ""
    if isinstance(value, list) and not any(isinstance(v, dict | list) for v in value):
        return ", ".join("" if v is None else json_value(v, boxes=False) for v in value)
    return json_text(value) if isinstance(value, dict | list) else json_value(value)


def _values(data: object, name: str) -> list[dict[str, str]]:
    """The escaped values of the items of a block's array, by key in lower case."""
    found = []
    for item in array_of(data, name) or []:
        values: dict[str, str] = {}
        for key, value in item.items() if isinstance(item, dict) else ():
            low = key.lower()
            if low not in values:
                values[low] = str(value) if type(value) is int else shown(value).translate(_ESCAPES)
        found.append(values)
    return found


def expand(template: str, data: object) -> str:
    """A template with its blocks expanded: once for each item of the block's array, gone without items. In a block the tags of an item's
    keys, in any case, are replaced by its values; a tag that the items around do not name stays. An inner block takes its array from
    the whole object, and an outer item's keys come before those of an inner one."""
    arrays: dict[str, list[dict[str, str]]] = {}
    texts: dict[tuple, str] = {}

    def items(name: str) -> list[dict[str, str]]:
        if name not in arrays:
            arrays[name] = _values(data, name)
        return arrays[name]

    def low(block: Block, scope: dict[str, str]) -> str:
        """The text of a block, made once for each different set of the values that it takes from around."""
        key = (id(block), *map(scope.get, block.names))
        if key not in texts:
            made: list[str] = []
            for values in items(block.name):
                inside = {**values, **scope} if scope else values
                for part in block.parts:
                    if isinstance(part, Text):
                        made.append(part.text)
                    elif isinstance(part, Tag):
                        made.append(inside.get(part.name, part.text))
                    else:
                        made.append(low(part, inside))
            texts[key] = "".join(made)
        return texts[key]

    out: list[str] = []
    todo: list[tuple] = [(iter(parse(template)), {})]
    while todo:
        parts, scope = todo.pop()
        for part in parts:
            if isinstance(part, Text):
                out.append(part.text)
            elif isinstance(part, Tag):
                out.append(scope.get(part.name, part.text))
            elif part.height <= LOW:
                out.append(low(part, scope))
            else:
                copies = [(iter(part.parts), {**values, **scope}) for values in items(part.name)]
                todo.append((parts, scope))  # what follows the block, after its copies
                todo += reversed(copies)
                break
    return "".join(out)


def _loaded(data: str | None) -> object:
    try:
        return json.loads(data) if isinstance(data, str) else None
    except (ValueError, RecursionError):
        return None


def expand_loops(template: Column, data: Column) -> Column:
    """All blocks {#NAME}...{/NAME} of a template, expanded by the arrays of a JSON object (expand). A null template gives null; data that
    is null or no object has no arrays, so all blocks go."""

    @F.pandas_udf("string")
    def run(templates: pd.Series, objects: pd.Series) -> pd.Series:
        return pd.Series([expand(t, _loaded(d)) if isinstance(t, str) else None for t, d in zip(templates, objects, strict=True)], dtype=object)

    return run(template, data)
