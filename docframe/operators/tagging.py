"""Putting tags into paragraphs: strategies tried in order, of which the first that shows the tag counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions import xml as X
from docframe.functions.text import trim_all
from docframe.session import small

_LAST_TEXT = r"(?s)^(.*<w:t(?: [^>]*)?>)([^<]*)(</w:t>.*)$"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value being evaluated once however often it is used, inside of lambdas too."""
    return F.transform(F.array(value), use)[0]


def _full(tag: Column) -> Column:
    return F.concat(F.lit("{{"), tag, F.lit("}}"))


def _parts(xml: Column) -> Column:
    """What stands before the last text of a paragraph, the text, and what stands behind it; all empty without one."""
    return F.struct(*[F.regexp_extract(xml, _LAST_TEXT, i).alias(c) for i, c in enumerate(("head", "text", "tail"), 1)])


def _put(parts: Column, new: Column) -> Column:
    """The paragraph with a new last text; null without one."""
    return F.when(parts["head"] != "", F.concat(parts["head"], new, parts["tail"]))


def _after_colon(parts: Column, tag: Column) -> Column:
    text = parts["text"]
    at = F.length(text) - F.position(F.lit(":"), F.reverse(text)) + 1
    new = F.concat(F.substring(text, F.lit(1), at), F.lit(" "), _full(tag), F.substring(text, at + 1, F.length(text)))
    return F.when(text.contains(":"), _put(parts, new))


def _into_empty(xml: Column, parts: Column, tag: Column) -> Column:
    """A run for a paragraph of less than ten characters, in place of its text."""
    run = F.concat(F.lit("<w:r><w:t>"), _full(tag), F.lit("</w:t></w:r>"))
    bare = F.when(xml.rlike("</w:p>$"), F.concat(F.regexp_replace(xml, "</w:p>$", ""), run, F.lit("</w:p>")))
    return F.when(F.length(trim_all(X.xml_text(xml))) < 10, F.coalesce(_put(parts, _full(tag)), bare))


def _inline(parts: Column, tag: Column) -> Column:
    return _put(parts, F.concat(parts["text"], F.lit(" "), _full(tag)))


def _into_cell(xml: Column, parts: Column, tag: Column) -> Column:
    """Before a percent sign, in place of next to nothing, after a colon, in place of signs without a word, else at the end."""
    last = parts["text"]
    percent = _put(parts, F.replace(last, F.lit("%"), F.concat(_full(tag), F.lit(" %"))))
    short = lambda t: (F.length(t) < 3) | ((F.length(t) < 10) & ~t.rlike("[A-Za-zÀ-ÿ]{3}"))
    by_text = once(trim_all(X.xml_text(xml)), lambda t: F.when(t.endswith(":"), _after_colon(parts, tag)).when(short(t), _into_empty(xml, parts, tag)).otherwise(_inline(parts, tag)))
    return F.when(last.contains("%"), percent).otherwise(by_text)


def insert_tag(xml: Column, tag: Column, point: Column, in_cell: Column) -> Column:
    """The paragraph with its tag; null if no strategy places it."""

    def tried(parts: Column) -> Column:
        cell, colon, empty, end = _into_cell(xml, parts, tag), _after_colon(parts, tag), _into_empty(xml, parts, tag), _inline(parts, tag)
        asked = F.when(point == "after_colon", colon).when(point == "replace_empty", empty).when(point == "table_cell", cell).when(point.isin("inline", "checkbox"), end)
        return F.coalesce(*[once(t, lambda new: F.when(new.contains(_full(tag)), new)) for t in (F.when(in_cell, cell), asked, cell, colon, empty, end)])

    return once(_parts(xml), tried)


def date_pair(text: Column, start: Column, end: Column) -> Column:
    """ "du .... au ...." with tags in place of the dots; text without that form stays."""
    dots = r"[.…_\s]{2,}"
    both = F.regexp_replace(text, F.lit(rf"(?i)\bdu{dots}au{dots}"), F.concat(F.lit("du "), F.replace(_full(start), F.lit("$"), F.lit("\\$")), F.lit(" au "), _full(end), F.lit(" ")))
    return F.when(both != text, F.rtrim(both)).otherwise(text)


_DOTS = r"(?:[.…]+|\s{5,})"
_OPEN = r"<w:t(?: [^>]*)?>"


def date_pair_xml(xml: Column, start: Column, end: Column) -> Column:
    """A paragraph with the tags of a period: in place of the dots of "du .... au ....", in one text element or over several; behind
    du and au where nothing stands between them; else at the end of the text. Null if there is no text to take them."""
    a, b = (F.replace(_full(t), F.lit("$"), F.lit("\\$")) for t in (start, end))
    whole = F.regexp_replace(xml, F.lit(rf"(?iU)({_OPEN}[^<]*)(du\s*){_DOTS}(\s*au\s*){_DOTS}"), F.concat(F.lit("$1$2"), a, F.lit("$3"), b))
    bare = F.regexp_replace(xml, F.lit(rf"(?iU)({_OPEN}[^<]*du\s+)(au\s*)"), F.concat(F.lit("$1"), a, F.lit(" $2"), b))
    changed = lambda c: once(c, lambda new: F.when(new != xml, new))
    at_end = once(_parts(xml), lambda parts: _inline(parts, F.concat(start, F.lit("}} au {{"), end)))

    def by_text(text: Column) -> Column:
        behind = F.when(text.rlike(r"(?iU)du\s+au"), changed(bare))
        return F.when(text.rlike(rf"(?iU)du\s*{_DOTS}\s*au\s*{_DOTS}"), F.coalesce(changed(whole), changed(_over_runs(xml, a, b)))).otherwise(F.coalesce(behind, at_end))

    return once(X.xml_text(xml), by_text)


def _over_runs(xml: Column, a: Column, b: Column) -> Column:
    """The first text that ends with du and dots, or with dots, takes a; the first such after it, with au, takes b. A text of dots alone
    behind one that took a tag goes, for the dots are those of the same word."""
    state = F.struct(F.lit(False).alias("du"), F.lit(False).alias("au"), F.lit(False).alias("here"), F.array().cast("array<string>").alias("out"))
    word = lambda t, w, tag: F.regexp_replace(t, F.lit(rf"(?isU)^(.*?{w}\s*)[.…]*"), F.concat(F.lit("$1"), tag))
    dots = lambda t, tag: F.regexp_replace(t, F.lit(r"(?s)^(.*?)[.…]+"), F.concat(F.lit("$1"), tag))

    def step(s: Column, t: Column) -> Column:
        first, second = ~s["du"], s["du"] & ~s["au"]
        ends = lambda w: t.rlike(rf"(?iU){w}\s*[.…]*$")
        dotted = t.rlike("[.…]+$")
        more = s["here"] & t.rlike(r"(?U)^\s*[.…]+\s*$")
        new = F.when(more, F.lit("")).when(first & ends("du"), word(t, "du", a)).when(first & dotted, dots(t, a)).when(second & ends("au"), word(t, "au", b)).when(second & dotted, dots(t, b))
        return F.struct((s["du"] | (first & new.isNotNull())).alias("du"), (s["au"] | (second & ~more & new.isNotNull())).alias("au"), new.isNotNull().alias("here"), F.concat(s["out"], F.array(F.coalesce(new, t))).alias("out"))

    opens, gaps = F.regexp_extract_all(xml, F.lit(rf"({_OPEN})[^<]*</w:t>"), F.lit(1)), F.split(xml, X.RUN_TEXT, -1)
    texts = F.aggregate(X.run_texts(xml), state, step)["out"]
    filled = F.zip_with(opens, texts, lambda o, t: F.concat(o, t, F.lit("</w:t>")))
    return F.concat(F.get(gaps, F.lit(0)), F.array_join(F.zip_with(filled, F.slice(gaps, F.lit(2), F.size(opens)), lambda p, g: F.concat(p, g)), ""))


def date_pairs(matches: DataFrame, group: str, place: str) -> DataFrame:
    """Matches whose tags X_DEBUT and X_FIN share a place: group, place, base."""
    base = F.regexp_replace("tag", "_(DEBUT|FIN)$", "")
    side = F.regexp_extract("tag", "_(DEBUT|FIN)$", 1)
    both = matches.select(group, place, base.alias("base"), side.alias("side")).filter("side <> ''")
    return both.groupBy(group, place, "base").agg(F.count_distinct("side").alias("n")).filter("n = 2").select(group, place, "base")


def apply_matches(paras: DataFrame, matches: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Paragraphs with their first matched tag put in: matches doc, index, tag, insertion_point, ord. applied says whether."""
    w = Window.partitionBy(doc, "index").orderBy("ord")
    first = matches.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(doc, "index", "tag", "insertion_point")
    joined = paras.join(first, [doc, "index"], "left")
    in_cell = F.col("table_index").isNotNull() if "table_index" in paras.columns else F.lit(False)
    new = F.when(F.col("tag").isNotNull(), insert_tag(F.col("xml"), F.col("tag"), F.coalesce("insertion_point", F.lit("after_colon")), in_cell))
    return joined.withColumn("applied", new.isNotNull()).withColumn("xml", F.coalesce(new, "xml"))


def apply_rules(lines: DataFrame, rules: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, tag, index: where the nth line with a rule's label takes its tag: on the first empty line among the next four, else on
    itself. rules: label, tag, occurrence; a small table."""
    w = Window.partitionBy(doc).orderBy("index")
    nexts = F.collect_list(F.struct("index", trim_all(F.col("text")).alias("t"))).over(w.rowsBetween(1, 4))
    hits = lines.withColumn("_next", nexts).join(small(rules), F.col("text").contains(F.col("label")))
    nth = hits.withColumn("_n", F.row_number().over(Window.partitionBy(doc, "tag").orderBy("index"))).filter("_n = occurrence")
    empty = F.get(F.filter("_next", lambda x: x["t"] == ""), F.lit(0))["index"]
    return nth.select(doc, "tag", F.coalesce(empty, F.col("index")).alias("index"))
