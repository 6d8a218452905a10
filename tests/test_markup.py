"""The tag scanner, nested tables, lookups of spans."""

import time

import pytest
from pyspark.sql import functions as F

from docframe.functions.xml import xml_text
from docframe.operators import extract as E
from docframe.operators import markup as M
from docframe.operators import matching as J
from docframe.operators import structure as S

P = "<w:p><w:r><w:t>{}</w:t></w:r></w:p>".format
TC = lambda *x: f"<w:tc><w:tcPr/>{''.join(x)}</w:tc>"
TR = lambda *x: f"<w:tr>{''.join(x)}</w:tr>"
TBL = lambda *x: f"<w:tbl><w:tblPr/>{''.join(x)}</w:tbl>"
INNER = TBL(TR(TC(P("in"))))
NESTED = f"<w:body>{P('before')}{TBL(TR(TC(P('a')), TC(INNER, P('b'))), TR(TC(P('last1')), TC(P('last2'))))}{P('after')}</w:body>"


def frame(spark, *xmls):
    return spark.createDataFrame(list(enumerate(xmls)), "doc_id int, xml string")


def test_nested_tables_lose_nothing(spark):
    rows = S.cells(frame(spark, NESTED)).collect()
    got = {(r["table_index"], r["row_index"], r["column_index"], r["text"], r["parent_table"], r["parent_row"], r["parent_column"]) for r in rows}
    assert got == {(0, 0, 0, "a", None, None, None), (0, 0, 1, "b", None, None, None), (0, 1, 0, "last1", None, None, None), (0, 1, 1, "last2", None, None, None), (1, 0, 0, "in", 0, 0, 1)}


def test_body_of_nested_tables(spark):
    docs = frame(spark, NESTED, None, "").withColumnRenamed("doc_id", "path")
    assert [(r["index"], r["text"]) for r in E.elements(docs).orderBy("index").collect()] == [(0, "before"), (1, "after")]


def test_paragraphs_know_their_cells(spark):
    rows = S.paragraphs_with_cells(frame(spark, NESTED)).orderBy("index").collect()
    assert [(r["text"], r["table_index"], r["row_index"], r["column_index"]) for r in rows] == [
        ("before", None, None, None), ("a", 0, 0, 0), ("in", 1, 0, 0), ("b", 0, 0, 1), ("last1", 0, 1, 0), ("last2", 0, 1, 1), ("after", None, None, None)
    ]
    assert all(NESTED[r["xml_start"] : r["xml_end"]] == r["xml"] for r in rows)


@pytest.mark.parametrize(
    ("xml", "names"),
    [
        ("", []), (None, []), ("no tags", []), ("<w:pPr/><w:tblGrid/>", []), ("<w:p/>", [("p", 0, True)]), ("</w:p><w:p>x</w:p>", [("p", 0, True)]),
        ("<w:tbl><w:tr><w:tc><w:p>x</w:tc></w:tr></w:tbl>", [("tbl", 0, True), ("tr", 1, True), ("tc", 2, True), ("p", 3, False)]), ("<w:tc><w:p>x", [("tc", 0, False), ("p", 1, False)]),
        ("<w:p><w:txbxContent><w:p>in</w:p></w:txbxContent>x</w:p>", [("p", 0, True), ("p", 1, True)]), ("<w:tbl><w:tr/></w:tbl>", [("tbl", 0, True), ("tr", 1, True)]),
    ],
)
def test_scan_of_odd_markup(xml, names):
    assert [(e.name, e.depth, e.sound) for e in M.scan(xml)] == names


def test_scan_of_deep_tables():
    xml = P("x")
    for _ in range(60):
        xml = TBL(TR(TC(xml, P("y"))))
    found = M.scan(xml)
    assert sum(e.name == "tbl" for e in found) == 60
    assert all(e.sound for e in found)
    assert [e.table_index for e in found if e.name == "tbl"] == list(range(60))
    assert [e.parent_table for e in found if e.name == "tbl"] == [None, *range(59)]


@pytest.mark.parametrize(
    ("xml", "error"),
    [
        (None, None), ("", None), ("text", None), ("<a><b x='1'/><c>t</c></a>", None), ('<?xml version="1.0"?><!-- < --><a><![CDATA[ <x> ]]></a>', None), ("<a><b></a></b>", "unexpected_end a at 6"), ("<a>", "unclosed a"), ("</a>", "unexpected_end a at 0"),
        ("<a/><b/>", "second_root b at 4"), ("<a>1 < 2</a>", "bad_tag at 5"), ('<a x="<"/>', "bad_tag at 0"), ("<a x=1></a>", "bad_tag at 0"),
    ],
)
def test_nesting_error(spark, xml, error):
    assert M.nesting_error(xml, whole=True) == error
    assert spark.createDataFrame([(xml,)], "x string").select(M.well_formed(F.col("x"), whole=True)).first()[0] == error


def test_a_long_document_takes_linear_work(spark):
    """100,000 cells and as many paragraphs in one document: all pairs would be ten thousand million."""
    n = 100_000
    boxes = spark.range(n).select(F.lit(1).alias("doc_id"), F.lit(0).alias("table_index"), F.col("id").alias("row_index"), F.lit(0).alias("column_index"), (40 * F.col("id")).alias("xml_start"), (40 * F.col("id") + 40).alias("xml_end"))
    paras = spark.range(n).select(F.lit(1).alias("doc_id"), F.col("id").alias("index"), (40 * F.col("id") + 5).alias("xml_start"), (40 * F.col("id") + 30).alias("xml_end"))
    began = time.perf_counter()
    placed = S.paragraphs_in_cells(paras, boxes)
    assert placed.filter("row_index = index").count() == n
    tags = spark.range(n).select(F.lit(1).alias("doc_id"), F.col("id").alias("tag"), (40 * F.col("id") + 7).alias("at"), *[F.lit(None).cast("int").alias(c) for c in ("table_index", "row_index", "column_index")])
    spans = paras.select("doc_id", "index", F.col("xml_start").alias("start"), F.col("xml_end").alias("end"), *[F.lit(None).cast("int").alias(c) for c in ("table_index", "row_index", "column_index")])
    assert J.paragraph_of_tag(tags, spans).filter("paragraph_index = tag").count() == n
    assert time.perf_counter() - began < 90


def test_spans_of_all_sizes(spark):
    import random

    rnd = random.Random(1)
    boxes = [(rnd.randint(0, 2), 0, i, 0, s := rnd.randint(0, 5000), s + rnd.choice([3, 50, 1100, 4000, 10**6])) for i in range(120)]
    paras = [(rnd.randint(0, 3), i, s := rnd.randint(0, 9000), s + rnd.randint(0, 60)) for i in range(300)]
    got = S.paragraphs_in_cells(spark.createDataFrame(paras, "doc_id int, index int, xml_start int, xml_end int"), spark.createDataFrame(boxes, "doc_id int, table_index int, row_index int, column_index int, xml_start int, xml_end int"))
    want = {(d, i): min((b[2] for b in boxes if b[0] == d and b[4] <= s and e <= b[5]), default=None) for d, i, s, e in paras}
    assert {(r["doc_id"], r["index"]): r["row_index"] for r in got.collect()} == want


def test_sections_of_a_document(spark):
    head = lambda n, t: f'<w:p><w:pPr><w:pStyle w:val="Heading{n}"/></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>'
    item = lambda t: f"<w:p><w:pPr><w:numPr><w:ilvl w:val=\"1\"/></w:numPr></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>"
    xmls = [item("i1") + item("i2") + head(1, "One") + P("a") + NESTED + head(2, "Sub") + item("i3") + head(1, "Two"), item("only"), P("intro") + head(3, "First"), ""]
    docs = frame(spark, *xmls).withColumnRenamed("doc_id", "path").withColumns({c: F.lit(None).cast("string") for c in ("core", "app", "error")})
    got = {r["path"]: r["sections"] for r in E.extract(docs).collect()}
    shape = lambda ss: [(s["id"], s["title"], [(c["kind"], c["level"], c["text"], [i["text"] for i in c["items"] or []], c["table_index"]) for c in s["content"]]) for s in ss]
    assert shape(got[0]) == [
        (1, "One", [("list", None, None, ["i1", "i2"], None), ("paragraph", None, "a", [], None), ("paragraph", None, "before", [], None), ("table", None, None, [], 0), ("paragraph", None, "after", [], None), ("heading", 2, "Sub", [], None), ("list", None, None, ["i3"], None)]),
        (2, "Two", []),
    ]
    assert shape(got[1]) == [(1, "Introduction", [("list", None, None, ["only"], None)])]
    assert shape(got[2]) == [(1, "Introduction", [("paragraph", None, "intro", [], None)]), (2, "First", [])]
    assert got[3] is None
    assert got[0][0]["content"][0]["items"][0]["level"] == 1


def test_text_of_runs(spark):
    assert spark.createDataFrame([(NESTED,)], "x string").select(xml_text(F.col("x"))).first()[0] == "beforeainblast1last2after"


def test_headers_come_from_the_scan_without_moving_rows(spark):
    """Rows that do not move have no exchange in their plan; a row inside of a row heads no column before it."""
    cell = "<w:tc><w:p><w:r><w:t>{}</w:t></w:r></w:p></w:tc>".format
    nested = f"<w:tc><w:tbl><w:tr>{cell('i0')}{cell('i1')}</w:tr></w:tbl><w:p><w:t>out</w:t></w:p></w:tc>"
    xml = f"<w:tbl><w:tr>{cell('a')}{cell('b')}</w:tr><w:tr>{cell('c')}{nested}</w:tr></w:tbl><w:p><w:t>body</w:t></w:p>"
    odd = f"<w:tbl><w:tr>{cell('x')}<w:tr>{cell('y')}{cell('z')}</w:tr>{cell('w')}</w:tr></w:tbl>"
    docs = spark.createDataFrame([(1, xml), (2, odd), (3, None)], "doc_id int, xml string")
    found, paras = S.cells(docs), S.paragraphs_with_headers(docs)
    for df in (found, paras):
        shown = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in shown and "Window" not in shown and shown.count("MapInArrow") == 1
    want = {(1, "a"): ("a", ""), (1, "b"): ("a", ""), (1, "c"): ("c", "a"), (1, "out"): ("c", "b"), (1, "i0"): ("i0", ""), (1, "i1"): ("i0", ""), (2, "x"): ("x", ""), (2, "y"): ("y", "x"), (2, "z"): ("y", "w"), (2, "w"): ("x", "")}
    assert {(r["doc_id"], r["text"]): (r["row_header"], r["column_header"]) for r in found.collect()} == want
    assert {(r["doc_id"], r["text"]): (r["row_header"], r["column_header"]) for r in paras.collect()} == want | {(1, "body"): ("", "")}


def test_simple_cells_and_paragraphs_are_read_in_one_step(spark):
    """Cells of nothing but paragraphs and others give the same elements, whatever their tags look like."""
    for open_, close in (("<w:p>", "</w:p>"), ('<w:p w:a="/">', "</w:p>"), ("<w:p>", "</w:p >"), ("<w:p >", "</w:p>")):
        found = M.scan(f"<w:tbl><w:tr><w:tc>{open_}a{close}<w:p/><w:pPr/>b</w:tc></w:tr></w:tbl>{open_}c{close}")
        assert [(e.name, e.depth, e.column_index, e.paragraph_index, e.sound) for e in found] == [("tbl", 0, None, None, True), ("tr", 1, None, None, True), ("tc", 2, 0, None, True), ("p", 3, 0, 0, True), ("p", 3, 0, 1, True), ("p", 0, None, 2, True)]
    # A cell of paragraphs is one match and no longer four tags.
    assert len(M._STEP.findall("<w:tc><w:p>a</w:p><w:p/></w:tc>")) == 1
