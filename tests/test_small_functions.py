"""Small functions and filters on literal rows."""

import json

import pytest

from pyspark.sql import functions as F

from docframe.functions import geometry as geo
from docframe.functions import xml as X
from docframe.functions.text import keyword_score
from docframe.operators import checkbox, layout
from docframe.operators.segments import best_segments, relevant
from docframe.sources.boxes import from_items, page_info
from docframe.sources.pages import read_json


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_runs_and_lists(spark):
    x = F.col("x")
    assert values(spark, X.is_ordered(x), ["1. a", "b) c", "iv. d", "- e", "word a"]) == [True, True, True, False, False]
    assert values(spark, X.list_number(x), ["12. a", "b) c"]) == [12, None]
    assert values(spark, X.heading_style(x), [1, 6], "x int") == ["heading1", "heading6"]
    assert values(spark, X.is_underlined(x), ['<w:u w:val="single"/>', '<w:u w:val="none"/>', ""]) == [True, False, False]
    assert values(spark, X.font_size(x), ['<w:sz w:val="23"/>', ""]) == [11.5, None]
    assert values(spark, X.text_color(x), ['<w:color w:val="FF00aa"/>', '<w:color w:val="auto"/>']) == ["FF00aa", None]


def test_places_and_pages(spark):
    x = F.col("x")
    assert values(spark, geo.placement_type(x), ["Nom : ", "  ", "Nom"]) == ["after_colon", "replace", "inline"]
    area = spark.range(1).select(geo.content_area(*map(F.lit, (600.0, 800.0, 10.0, 20.0, 30.0, 40.0))).alias("a")).first()["a"]
    assert tuple(area) == (40.0, 30.0, 540.0, 760.0)
    assert values(spark, geo.fits_on_page(x, F.lit(20.0), F.lit(50.0)), [70.0, 69.9], "x double") == [True, False]
    assert values(spark, keyword_score(F.array(F.lit("nom"), F.lit("date")), x), ["Le NOM", "date et nom", "x", None]) == [3, 7, 0, 0]
    lines = spark.createDataFrame([(1, 1, 0, "Nom du candidat"), (1, 2, 0, "nom"), (1, 2, 1, "x")], "doc_id int, page int, line int, text string")
    assert layout.lines_containing(lines, "NOM").count() == 2
    assert layout.lines_containing(lines, "Nom", True).count() == 1
    assert layout.lines_containing(lines, "nom", page=2).count() == 1
    fields = spark.createDataFrame([(1, 10.0, 10.0), (1, 33.0, 10.0), (2, 10.0, 10.0)], "page int, x double, y double")
    assert layout.fields_near(fields, 12.0, 12.0, 1).count() == 1
    items = spark.createDataFrame([(1, 1, 0, " ", [1.0] * 6), (1, 1, 1, "a", [0.0, 0.0, 0.0, 0.0, 5.0, 7.0]), (1, 2, 0, "b", [0.0] * 6)], "doc_id int, page int, nth int, text string, transform array<double>")
    boxes = from_items(items.withColumns({"width": F.lit(1.0), "height": F.lit(2.0)}), 1).collect()
    assert [(r["index"], r["text"], r["x"], r["y"]) for r in boxes] == [(0, "a", 5.0, 7.0)]
    info = page_info(spark.createDataFrame([(1, 2, 3.0, 4.0), (1, 1, 1.0, 2.0)], "doc_id int, page int, width double, height double")).first()
    assert (info["pages"], [tuple(s) for s in info["sizes"]]) == (2, [(1.0, 2.0), (3.0, 4.0)])


def test_json_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"data": {"k": 1}, "list": [1]}))
    (tmp_path / "b.json").write_text("[1, 2")
    whole = {r["path"][-6:]: (r["json"], r["error"]) for r in read_json(spark, str(tmp_path)).collect()}
    assert json.loads(whole["a.json"][0])["data"] == {"k": 1}
    assert whole["b.json"] == (None, "not an object")
    part = {r["path"][-6:]: r["json"] for r in read_json(spark, str(tmp_path), "data").collect()}
    assert part == {"a.json": '{"k":1}', "b.json": None}
    assert {r["error"] for r in read_json(spark, str(tmp_path), "list").collect()} == {"not an object"}


def test_conflicting_neighbours(spark):
    rows = [(1, 0, 0, True, "Oui"), (1, 1, 0, True, "Non"), (1, 2, 0, True, "Non"), (1, 3, 0, False, "Oui"), (2, 0, 0, True, "Oui"), (2, 1, 0, False, "Non")]
    found = checkbox.consecutive_conflicts(spark.createDataFrame(rows, "doc int, index int, ord int, checked boolean, label string"), "doc")
    assert [(r["doc"], r["index"]) for r in found.collect()] == [(1, 0)]


def segments(spark, rows):
    flags = "struct<financial:boolean,contact:boolean,identification:boolean>"
    return spark.createDataFrame(rows, f"doc int, ord int, s struct<letter:string,flags:{flags},type:string,table_index:int,words:array<string>>")


def test_best_segments_over_blocks(spark):
    no, money, both = (False,) * 3, (True, False, False), (False, True, True)
    a = [(1, 0, ("A", no, "table", 0, ["alpha"])), (1, 1, (None, both, "section", None, [])), (1, 2, ("C", no, "section", None, ["beta"])), (1, 3, (None, money, "section", None, ["gamma", "delta"]))]
    b = [(1, 0, ("B", no, "table", 0, [])), (1, 1, ("A", money, "section", 0, ["alpha"])), (1, 2, (None, both, "table", 4, [])), (1, 3, (None, money, "table", 9, ["gamma"]))]
    want = {(0, 1, 60.0), (1, 2, 30.0), (3, 3, 30.0)}
    for least in (30, 20):
        got = {(r["template"], r["target"], r["score"]) for r in best_segments(segments(spark, a), segments(spark, b), "doc", least=least).collect()}
        assert got == want
    rows = spark.createDataFrame([(40, []), (10, ["T"]), (10, [])], "relevance int, tags array<string>")
    assert relevant(rows).count() == 2
    assert relevant(rows, only_with_tags=True).count() == 1


def test_measured_text(spark):
    from docframe.functions import geometry as G

    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(G.glyph_width(F.lit("Hi é€"), 10)) == pytest.approx((722 + 222 + 278 + 556 + 556) / 100)
    assert one(G.glyph_width(F.lit(""))) == 0
    assert one(G.glyph_width(F.lit("ÀÎîW"))) == pytest.approx((667 + 278 + 278 + 944) / 1000)
    assert one(G.wrap_measured(F.lit(" iiii  WWWW ii i"), 2.0, 1.0)) == ["iiii", "WWWW", "ii i"]
    assert one(G.wrap_measured(F.lit("  "), 2.0, 1.0)) == []
    assert one(G.fitting_size_measured(F.lit("WWWW"), 30.0, 9.0)) == 7.5
    assert one(G.fitting_size_measured(F.lit("WWWW"), 1.0, 9.0)) == 6.0
    assert one(G.fitting_size_measured(F.lit("W"), 1.0, 5.0)) == 6.0


def test_units_and_styles(spark):
    from docframe.functions import geometry as G
    from docframe.operators import segments as SG

    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(G.points_to_mm(F.lit(28.3465))) == pytest.approx(10)
    assert one(G.points_to_inches(F.lit(144.0))) == 2
    assert one(G.block_height(F.lit(3), F.lit(10.0))) == pytest.approx(36)
    for run, slanted, family in (("<w:i/>", True, None), ('<w:i w:val="on"/><w:rFonts w:hAnsi="a" w:ascii="Arial"/>', True, "Arial"), ('<w:i w:val="0"/>', False, None), ("", False, None)):
        assert one(X.is_italic(F.lit(run))) is slanted
        assert one(X.font_family(F.lit(run))) == family
    section = F.struct(F.lit("B").alias("letter"), F.lit("Objet").alias("title"))
    none = F.lit(None).cast("struct<letter:string,title:string>")
    long_line = "A line of text that is longer than sixty characters, as titles may be"
    assert one(SG.table_title(F.lit("x"), F.lit(0), section)) == "Section B - Objet"
    assert one(SG.table_title(F.lit("abc\n  Turnover of years \n"), F.lit(1), none)) == "Tableau 2: Turnover of years"
    assert one(SG.table_title(F.lit(long_line), F.lit(0), none)) == f"Tableau 1: {long_line[:60]}..."
    assert one(SG.table_title(F.lit("abc"), F.lit(4), none)) == "Tableau 5"


def test_pages_are_merged_in_order(spark):
    rows = [("m", "b", 1, 1), ("m", "a", 0, 2), ("m", "a", 0, 1), ("n", "c", 0, 5)]
    found = layout.merge_pages(spark.createDataFrame(rows, "merge_id string, doc_id string, doc_ord int, page int")).collect()
    assert sorted((r["merge_id"], r["page"], r["doc_id"]) for r in found) == [("m", 1, "a"), ("m", 2, "a"), ("m", 3, "b"), ("n", 1, "c")]


def test_sessions_and_streams(spark, tmp_path):
    """Documents that arrive are filled by the operators that fill tables."""
    from docframe.session import build_session
    from docframe.streaming.files import fill_stream

    assert build_session("again").sparkContext is spark.sparkContext
    rows = [(1, "Dear {{A}}", {"A": "x & y"}), (2, "{{B}}!", {})]
    schema = "id int, template string, tags map<string,string>"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    filled = fill_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "template", "tags")
    stream = filled.select("id", F.col("filled.xml").alias("xml")).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
    stream.awaitTermination(120)
    assert {r["id"]: r["xml"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: "Dear x &amp; y", 2: "!"}


def test_only_documents_are_accepted(spark):
    from docframe.sources.docx import accepted

    names = ["a.docx", "b.DOCX", "c.doc", "d.pdf", "~$e.docx", None]
    kept = {r["path"] for r in accepted(spark.createDataFrame([(n,) for n in names], "path string")).collect()}
    assert kept == {"a.docx", "b.DOCX", "c.doc", "~$e.docx"}
