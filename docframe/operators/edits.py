"""Edits of whole documents: rows that name a stretch and its new text, settled and applied in one ordered pass.

Operators that find places give edits; a document is rewritten once, however many there are, and offsets are those of the document
as it was. An edit that overlaps one of a smaller number is not applied, and the result says so.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterable, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.tags import distinct_tags
from docframe.operators.markup import scan
from docframe.operators.tagging import date_pair_xml, insert_tag, once
from docframe.session import ship_package, shuffled


def splice(text: str, edits: Iterable[Mapping]) -> tuple[str, list[int]]:
    """A text with its edits (nr, start, end, text) and the numbers of those that were not applied. Edits count by their number: one
    that overlaps an earlier one, or reaches beyond the text, is left out. Insertions (start = end) overlap nothing but the
    inside of a stretch; those of one place stand in the order of their numbers."""
    taken: list[tuple[int, int, int, str]] = []
    lost: list[int] = []
    for e in sorted(edits, key=lambda e: e["nr"]):
        a, b = e["start"], e["end"]
        new = (a, b, e["nr"], e["text"] or "")
        i = bisect.bisect(taken, new)
        before = max((t[1] for t in taken[max(0, i - 1) : i]), default=0)
        clash = not 0 <= a <= b <= len(text) or before > a or (i < len(taken) and taken[i][0] < b) or (i > 0 and a < b and taken[i - 1][:2] == (a, b))
        if clash:
            lost.append(e["nr"])
        else:
            taken.insert(i, new)
    parts, at = [], 0
    for a, b, _, new in taken:
        parts += (text[at:a], new)
        at = b
    return "".join([*parts, text[at:]]), lost


def spliced(text: Column, edits: Column) -> Column:
    """Struct(text, lost) of splice. edits: array of struct(nr int, start int, end int, text string)."""

    @F.pandas_udf("text string, lost array<int>")
    def run(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = [splice(t, e) if isinstance(t, str) and e is not None else (t, []) for t, e in zip(texts, lists, strict=True)]
        return pd.DataFrame(rows, columns=["text", "lost"])

    return run(text, edits)


def apply_edits(docs: DataFrame, edits: DataFrame, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """docs with their text edited, and lost_edits, the numbers of the edits that were not applied (empty where all were). edits: doc, nr,
    start, end, text, numbered within a document by their precedence. Documents without edits stay as they are; edits of no
    document are dropped with it. Rows of docs that share a key each take all its edits."""
    ship_package(docs.sparkSession)
    row = F.struct(F.col("nr").cast("int").alias("nr"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "text")
    lists = edits.filter("start is not null and end is not null").groupBy(F.col(doc).alias("_d")).agg(F.collect_list(row).alias("_edits"))
    joined = shuffled(docs).join(lists, F.col(doc) == F.col("_d"), "left")
    out = joined.withColumn("_new", F.when(F.col("_edits").isNotNull(), spliced(F.col(xml), F.col("_edits"))))
    new = {xml: F.when(F.col("_edits").isNotNull(), F.col("_new.text")).otherwise(F.col(xml))}
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns], F.coalesce("_new.lost", F.array().cast("array<int>")).alias("lost_edits"))


_STEP = "struct<a:string,b:string,point:string>"
_PLACE = f"struct<index:int,start:int,end:int,xml:string,in_cell:boolean,steps:array<{_STEP}>>"
_TOLD = "struct<tag:string,index:int,status:string>"
_TURNS = f"struct<gaps:array<string>,places:array<{_PLACE}>,nested:boolean,told:array<{_TOLD}>>"


def _tagged(xml: Column, steps: Column, in_cell: Column) -> Column:
    """Struct(xml, done) of a paragraph that takes one tag, or the two of a period, after the other; done: whether each found a place."""

    def step(state: Column, s: Column) -> Column:
        pair = date_pair_xml(state["xml"], s["a"], s["b"])
        tried = F.when(s["b"].isNotNull(), pair).otherwise(insert_tag(state["xml"], s["a"], s["point"], in_cell))
        return once(tried, lambda new: F.struct(F.coalesce(new, state["xml"]).alias("xml"), F.concat(state["done"], F.array(new.isNotNull())).alias("done")))

    return F.aggregate(steps, F.struct(xml.alias("xml"), F.array().cast("array<boolean>").alias("done")), step)


def turns(xml: str | None, held: Iterable[str] | None, asked: Iterable[tuple], several: bool = True) -> tuple[list[tuple], list[tuple]]:
    """(places, told) of one document: the paragraphs that take tags, as (index, start, end, xml, in_cell, steps) with the steps (a, b, point) in
    their order, and what is known of the other matches (tag, index, status). asked: (tag, index, point, ord); held: tags that the
    document holds already."""
    # Paragraphs by their number; those that no match names are only counted.
    named = {m[1] for m in asked}
    paras = {e.paragraph_index: e for e in scan(xml, ("p",)) if e.paragraph_index in named}
    held, seen = set(held or ()), set()
    by_ord = lambda o: (o is not None, o or 0)
    told = [(tag, index, "already_used" if tag in held else "no_paragraph") for tag, index, *_ in asked if tag in held or index not in paras]
    open_: dict[int, list[tuple]] = {}
    for m in sorted((m for m in asked if m[0] not in held and m[1] in paras), key=lambda m: (-m[1], by_ord(m[3]), m[2])):
        if m[0] in seen:
            told.append((*m[:2], "already_used"))
        else:
            seen.add(m[0])
            open_.setdefault(m[1], []).append(m)
    places = []
    for index in sorted(open_):
        by_tag = {m[0]: m for m in open_[index]}
        steps = []
        for tag, _, point, nth in open_[index]:
            base, _, side = (tag or "").rpartition("_")
            a, b = f"{base}_DEBUT", f"{base}_FIN"
            if side not in ("DEBUT", "FIN") or a not in by_tag or b not in by_tag:
                steps.append((1, by_ord(nth), tag or "", (tag, None, point)))
            elif side == "DEBUT":
                # A period is one step, named by its first tag's ord; it goes before all others.
                steps.append((0, min(by_ord(by_tag[t][3]) for t in (a, b)), base, (a, b, point)))
        steps.sort(key=lambda s: s[:3])
        skipped = [] if several else [s for s in steps[1:] if s[0]]
        told += [(s[3][0], index, "paragraph_changed") for s in skipped]
        e = paras[index]
        places.append((index, e.start, e.end, e.xml, e.table_index is not None, [s[3] for s in steps if s not in skipped]))
    return places, told


def _turns(xml: Column, held: Column, asked: Column, several: bool) -> Column:
    """Struct of turns: gaps, what stands before, between and behind the places; places; nested: whether a place holds another, so that
    gaps count for nothing; told. Null where nothing is asked."""

    @F.arrow_udf(_TURNS)
    def run(texts: pa.Array, tags: pa.Array, lists: pa.Array) -> pa.Array:
        matches = [*zip(*(lists.values.field(f).to_pylist() for f in ("tag", "index", "point", "ord")), strict=True)]
        rows = []
        for text, mine, lo, hi, some in zip(texts.to_pylist(), tags.to_pylist(), lists.offsets.to_pylist(), lists.offsets.to_pylist()[1:], lists.is_valid().to_pylist(), strict=False):
            if not some:
                rows.append(None)
                continue
            places, told = turns(text, mine, matches[lo:hi], several)
            gaps, at, nested = [], 0, False
            for p in places:
                nested = nested or p[1] < at
                gaps.append((text or "")[at : p[1]])
                at = max(at, p[2])
            rows.append(([*gaps, (text or "")[at:]], places, nested, told))
        return _turn_rows(rows)

    return run(xml, held, asked)


def _lists(rows: list[list], columns: list[tuple[str, pa.DataType]], inner: dict[str, pa.Array] | None = None) -> pa.ListArray:
    """Lists of structs from lists of tuples; `inner` are columns that come as they are."""
    flat = [*zip(*(x for r in rows for x in r), strict=True)] or [[] for _ in columns]
    fields = [inner[n] if inner and n in inner else pa.array(v, t) for (n, t), v in zip(columns, flat, strict=True)]
    ends = [0, *itertools.accumulate(map(len, rows))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, names=[n for n, _ in columns]))


def _turn_rows(rows: list[tuple | None]) -> pa.StructArray:
    full = [r or ([], [], False, []) for r in rows]
    text, whole, flag = pa.string(), pa.int32(), pa.bool_()
    steps = _lists([p[5] for r in full for p in r[1]], [("a", text), ("b", text), ("point", text)])
    places = _lists([r[1] for r in full], [("index", whole), ("start", whole), ("end", whole), ("xml", text), ("in_cell", flag), ("steps", steps.type)], {"steps": steps})
    told = _lists([r[3] for r in full], [("tag", text), ("index", whole), ("status", text)])
    columns = [pa.array([r[0] for r in full], pa.list_(text)), places, pa.array([r[2] for r in full], flag), told]
    return pa.StructArray.from_arrays(columns, names=["gaps", "places", "nested", "told"], mask=pa.array([r is None for r in rows], flag))


def tag_documents(docs: DataFrame, matches: DataFrame, doc: str = "doc_id", xml: str = "xml", several: bool = True) -> tuple[DataFrame, DataFrame]:
    """(docs with the tags of their matches put in, report: doc, tag, index, status of every match).

    matches: doc, tag, index (of a paragraph), insertion_point, ord. Of a paragraph the tags X_DEBUT and X_FIN of a period go in first and
    together, the others after them in their order; without `several` a paragraph takes one other tag, or none beside a period. A tag that
    the document holds already, or that a match of a later paragraph or a smaller ord takes, is not put in again. status:
    applied, already_used, paragraph_changed, no_paragraph or no_place (no text to take it). A document meets its matches in one shuffle
    and is read once; its paragraphs take their tags without leaving it. Rows of docs that share a key each take all its matches."""
    ship_package(docs.sparkSession)
    points = F.coalesce("insertion_point", F.lit("after_colon"))
    match = F.struct("tag", F.col("index").cast("int").alias("index"), points.alias("point"), F.col("ord").cast("int").alias("ord"))
    lists = matches.groupBy(F.col(doc).alias("_d")).agg(F.collect_list(match).alias("_asked"))
    met = shuffled(docs.withColumn("_here", F.lit(True))).join(lists, F.col(doc) == F.col("_d"), "full")
    read = met.withColumn("_turns", _turns(F.col(xml), distinct_tags(F.col(xml)), F.col("_asked"), several))
    done = read.withColumn("_new", F.transform("_turns.places", lambda p: _tagged(p["xml"], p["steps"], p["in_cell"])))
    behind = F.zip_with(F.transform("_new", lambda n: n["xml"]), F.slice("_turns.gaps", F.lit(2), F.size("_new")), lambda n, g: F.concat(n, g))
    joined = F.concat(F.get("_turns.gaps", F.lit(0)), F.array_join(behind, ""))
    # Where a place holds another the outer one counts, if it has taken a tag.
    edits = F.filter(F.zip_with("_turns.places", "_new", lambda p, n: F.when(F.exists(n["done"], lambda x: x), F.struct(p["index"].alias("nr"), p["start"].alias("start"), p["end"].alias("end"), n["xml"].alias("text")))), lambda e: e.isNotNull())
    nested = F.col("_turns.nested")
    put = F.when(nested, spliced(F.when(nested, F.col(xml)), F.when(nested, edits))["text"]).when(F.col("_asked").isNotNull() & F.col(xml).isNotNull(), joined).otherwise(F.col(xml))
    out = done.filter("_here").select(*[put.alias(c) if c == xml else F.col(c) for c in docs.columns])
    status = lambda p, n: F.zip_with(p["steps"], n["done"], lambda s, d: F.transform(F.array_compact(F.array(s["a"], s["b"])), lambda t: F.struct(t.alias("tag"), p["index"].alias("index"), F.when(d, "applied").otherwise("no_place").alias("status"))))
    rows = F.concat(F.flatten(F.flatten(F.zip_with("_turns.places", "_new", status))), "_turns.told")
    report = done.filter("_asked is not null").select(F.col("_d").alias(doc), F.explode(rows).alias("_r")).select(doc, "_r.*")
    return out, report
