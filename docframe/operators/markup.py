"""The structure of document XML by its tags: tables, rows, cells and paragraphs with their depth, parents and places.

One pass over a document's tags with a stack pairs each element with its own end, so a table inside of a cell ends neither the
cell nor the table around it. The pass is local to a row: nothing is shuffled, whatever the length or the number of documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from docframe.session import ship_package

_TAG = re.compile(r"<(/?)w:(t(?:bl|r|c)|p)(?:>|(?=[\s/])[^>]*?(/?)>)")
#: What stands between two tags of _TAG, and a paragraph and a cell that hold none but paragraphs: these are read in one step each.
_PLAIN = r"[^<]*+(?:<(?!/?w:(?:t(?:bl|r|c)|p)[\s/>])[^<]*+)*+"
_SIMPLE = rf"<w:p(?:[\s/][^>]*+)?+>(?:(?<=/>)|{_PLAIN}</w:p>)"
_STEP = re.compile(rf"<w:tc(?:[\s/][^>]*+)?+>(?<!/>)({_PLAIN}(?:{_SIMPLE}{_PLAIN})*+)</w:tc>|({_SIMPLE})|{_TAG.pattern}")
_PARAGRAPH = re.compile(_SIMPLE)
_BEGINS = re.compile(r"<w:p[\s/>]")
_ANY = re.compile(r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<(/?)([A-Za-z_][\w:.-]*)((?:\s+[\w:.-]+\s*=\s*(?:\"[^\"<]*\"|'[^'<]*'))*)\s*(/?)>|<", re.S)
_SCHEMA = (
    "nth int, name string, depth int, start int, end int, sound boolean, table_index int, row_index int, column_index int, paragraph_index int, "
    "parent_table int, parent_row int, parent_column int, xml string"
)
_TYPES = [{"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}[c.split()[1]] for c in _SCHEMA.split(", ")]
#: Elements that are given out together.
_ROWS = 20_000


class Element(NamedTuple):
    """An element in the order in which elements open. Its place is that of the innermost cell around it, its own for a cell; a table and
    its rows have their table's number, and as parent the cell that holds the table."""

    nth: int
    name: str
    depth: int
    start: int
    end: int
    sound: bool
    table_index: int | None
    row_index: int | None
    column_index: int | None
    paragraph_index: int | None
    parent_table: int | None
    parent_row: int | None
    parent_column: int | None
    xml: str | None


class _Open:
    """An element whose end has not been read."""

    __slots__ = ("cells", "first", "gone", "holder", "inner", "name", "nth", "place", "rows", "start")

    def __init__(self, nth: int, name: str, start: int, inner: int, place: tuple, holder: tuple):
        self.nth, self.name, self.start, self.inner, self.place, self.holder = nth, name, start, inner, place, holder
        self.rows = self.cells = 0
        self.gone: list[tuple[int, int]] = []  # where tables stand in a cell


def _own(xml: str, start: int, end: int, gone: list[tuple[int, int]]) -> str:
    """A stretch without the tables in it."""
    if not gone:
        return xml[start:end]
    parts, at = [], start
    for a, b in gone:
        parts.append(xml[at:a])
        at = b
    return "".join([*parts, xml[at:end]])


def scan(xml: str | None, names: tuple[str, ...] = ("tbl", "tr", "tc", "p")) -> list[Element]:
    """The elements of one document, those of `names`. An end without a begin is passed over; an element without an end reaches to the end of
    the element around it and is not sound."""
    return [*map(Element._make, _scan(xml, names))]


def _scan(xml: str | None, names: tuple[str, ...]) -> list[tuple]:
    """The elements of scan, as plain tuples."""
    xml = xml or ""
    found: list[tuple | None] = []
    stack: list[_Open] = []
    opened: dict[str, list[_Open]] = {"tbl": [], "tr": [], "tc": [], "p": []}
    rows, cells, texts = opened["tr"], opened["tc"], "p" in names
    around: list[_Open] = []  # open tables and cells
    tables = paragraphs = 0
    nowhere = (None, None, None)

    def shut(end: int, after: int, sound: bool) -> None:
        e = stack.pop()
        name = e.name
        opened[name].pop()
        if name == "tbl" or name == "tc":
            around.pop()
        if name == "tbl" and cells:
            cells[-1].gone.append((e.start, after))
        if name in names:
            text = xml[e.start : after] if name == "p" else _own(xml, e.inner, end, e.gone) if name == "tc" else None
            found[e.nth] = (e.nth, name, len(stack), e.start, after, sound, *e.place, *e.holder, text)

    tags = _STEP.finditer(xml)
    wanted = "tc" in names
    m = next(tags, None)
    while m is not None:
        whole, paragraph, ends, name, alone = m.groups()
        start, inner = m.span()
        if whole is not None:
            # A cell that holds none of the elements but paragraphs is done with its paragraphs.
            if rows:
                row = rows[-1]
                here, holder = (*row.place[:2], row.cells), row.holder
                row.cells += 1
            elif cells:
                here, holder = (cells[-1].place[0], None, None), cells[-1].holder
            else:
                here = holder = nowhere
            depth = len(stack)
            found.append((len(found), "tc", depth, start, inner, True, *here, None, *holder, whole) if wanted else None)
            if texts:
                for p in _PARAGRAPH.finditer(xml, m.start(1), m.end(1)):
                    found.append((len(found), "p", depth + 1, *p.span(), True, *here, paragraphs, *holder, p[0]))
                    paragraphs += 1
            else:
                n = len(_BEGINS.findall(whole))
                found.extend([None] * n)
                paragraphs += n
            m = next(tags, None)
            continue
        m = next(tags, None)
        if paragraph is not None:
            here, holder = (cells[-1].place[:3], cells[-1].holder) if cells else (nowhere, nowhere)
            found.append((len(found), "p", len(stack), start, inner, True, *here, paragraphs, *holder, paragraph) if texts else None)
            paragraphs += 1
            continue
        if ends:
            if opened[name]:
                while stack[-1].name != name:
                    shut(start, start, sound=False)
                shut(start, inner, sound=True)
            continue
        cell = cells[-1] if cells else None
        here, holder = (cell.place[:3], cell.holder) if cell is not None else (nowhere, nowhere)
        if name == "p" and (alone or (m is not None and m[3] and m[4] == "p")):
            # A paragraph that holds none of the elements is done with its next tag.
            if not alone:
                inner = m.end()
                m = next(tags, None)
            nth = len(found)
            found.append((nth, name, len(stack), start, inner, True, *here, paragraphs, *holder, xml[start:inner]) if texts else None)
            paragraphs += 1
            continue
        if name == "tbl":
            place, holder = (tables, None, None, None), here
            tables += 1
        elif name == "tr":
            owner = around[-1] if around and around[-1].name == "tbl" else None
            place = (owner.place[0] if owner else here[0], owner.rows if owner else None, None, None)
            holder = owner.holder if owner else holder
            if owner:
                owner.rows += 1
        elif name == "tc":
            row = rows[-1] if rows else None
            place = (*(row.place[:2] if row is not None else (here[0], None)), row.cells if row is not None else None, None)
            holder = row.holder if row is not None else holder
            if row is not None:
                row.cells += 1
        else:
            place = (*here, paragraphs)
            paragraphs += 1
        found.append(None)
        new = _Open(len(found) - 1, name, start, inner, place, holder)
        stack.append(new)
        opened[name].append(new)
        if name == "tbl" or name == "tc":
            around.append(new)
        if alone:
            shut(inner, inner, sound=True)
    while stack:
        shut(len(xml), len(xml), sound=False)
    return [e for e in found if e is not None]


def _heads(found: list[tuple]) -> list[tuple[str | None, str | None]]:
    """Of each element the texts of the first cell of its row and of the first cell of its column, null where there is none, and for a cell
    that is the first itself. A cell of the first row heads its column, a null row counts as the first."""
    by_row: dict[tuple, tuple] = {}
    by_column: dict[tuple, tuple] = {}
    for e in found:
        if e[1] == "tc" and e[8] is not None:
            by_row.setdefault((e[6], e[7]), e)
            other = by_column.setdefault((e[6], e[8]), e)
            if other[7] is not None and (e[7] is None or e[7] < other[7]):
                by_column[e[6], e[8]] = e
    out: list[tuple[str | None, str | None]] = []
    for e in found:
        row, column = by_row.get((e[6], e[7])), by_column.get((e[6], e[8]))
        out.append((None if row is None or row is e else row[-1], None if column is None or column is e else column[-1]))
    return out


def elements(docs: DataFrame, doc: str = "doc_id", xml: str = "xml", names: tuple[str, ...] = ("tbl", "tr", "tc", "p"), fields: tuple[str, ...] = Element._fields, heads: bool = False) -> DataFrame:
    """One row an element: doc, nth, name (tbl, tr, tc or p), depth, start and end (characters), sound, table_index, row_index,
    column_index (of the innermost cell around it), paragraph_index, parent_table, parent_row, parent_column (the cell that holds its table)
    and xml: a paragraph's whole text, a cell's without the tables in it. Tables are numbered in the order in which they open.
    A null document has no elements; other columns are ignored. Of elements not in `names` no rows are made, and they are counted all the
    same: a caller that reads one kind, or some of the `fields`, should name them, as the others would only be sent to be dropped.
    heads: row_head and column_head too, the xml of the first cell of the row and of the column; null for that cell itself."""
    ship_package(docs.sparkSession)
    at = [Element._fields.index(f) for f in fields]
    scanned = tuple({*names, "tc"}) if heads else names
    extra = ["row_head", "column_head"] if heads else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            owners: list[int] = []
            rows: list[tuple] = []
            tops: list[tuple] = []
            for i, text in enumerate(texts):
                found = _scan(text, scanned)
                if heads:
                    known = [(e, h) for e, h in zip(found, _heads(found), strict=True) if e[1] in names]
                    found = [e for e, _ in known]
                    tops += [h for _, h in known]
                owners += [i] * len(found)
                rows += found
                if len(rows) >= _ROWS or (rows and i == len(texts) - 1):
                    values = [*zip(*rows, strict=True)]
                    columns = [pa.array(values[k], _TYPES[k]) for k in at] + [pa.array(v, pa.string()) for v in (zip(*tops, strict=True) if heads else ())]
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(owners, pa.int64())), *columns], names=["d", *fields, *extra])
                    owners, rows, tops = [], [], []

    kind = docs.schema[doc].dataType
    schema = StructType.fromDDL(_SCHEMA + ", row_head string, column_head string")
    return docs.select(F.col(doc).alias("d"), F.col(xml).alias("x")).mapInArrow(run, StructType([StructField("d", kind), *[schema[f] for f in (*fields, *extra)]])).withColumnRenamed("d", doc)


def nesting_error(xml: str | None, whole: bool = False) -> str | None:
    """What keeps a text from being well formed, as code and position: a bracket that begins no tag, an end that is not that of the open
    element, an element without an end, or, in a whole document, more than one root; null for sound or empty text."""
    if not xml:
        return None
    stack: list[str] = []
    roots = 0
    for m in _ANY.finditer(xml):
        name = m[2]
        if name is None:
            if len(m[0]) == 1:
                return f"bad_tag at {m.start()}"
            continue
        if m[1]:
            if not stack or stack.pop() != name:
                return f"unexpected_end {name} at {m.start()}"
        else:
            roots += not stack
            if whole and roots > 1:
                return f"second_root {name} at {m.start()}"
            if not m[4]:
                stack.append(name)
    return f"unclosed {stack[-1]}" if stack else None


def well_formed(xml: Column, whole: bool = False) -> Column:
    """The first error of each text's tags (nesting_error), null for a sound one: the whole stack of elements is checked."""

    @F.pandas_udf("string")
    def check(texts: pd.Series) -> pd.Series:
        return pd.Series([nesting_error(t, whole) if isinstance(t, str) else None for t in texts], dtype=object)

    return check(xml)
