"""Records of fills, mappings and pages."""

import json

from docframe.operators import layout, records
from docframe.operators.fill import fill

TAGS = "doc_id long, tag string, ord int, table_index int, row_index int, column_index int"


def test_fill_output_of_sound_and_broken_fills(spark):
    rows = [("a/x.docx", "<w:p>{{A}} {{B}}</w:p>", {"A": "1"}, None), ("y", "<w:p>{{A}}", {"A": "1"}, "z.docx"), (None, None, {}, None)]
    df = spark.createDataFrame(rows, "path string, template string, tags map<string,string>, name string")
    done = records.fill_output(fill(df, "template", "tags", validate=True), name="name").collect()
    one, two, three = (r["output"] for r in done)
    assert one["success"] and one["filename"] == "x_FILLED.docx" and one["original_filename"] == "x.docx" and one["error"] is None
    assert one["report"].asDict() == {"tags_in_document": 2, "tags_replaced": 1, "tags_remaining": 1, "replaced_tags": ["A"], "remaining_tags": ["B"]}
    assert not two["success"] and two["filename"] == "z.docx" and "w:p" in two["error"]
    assert not three["success"] and three["report"] is None
    assert records.fill_output(fill(df, "template", "tags"), with_report=False).first()["output"]["report"] is None


def test_checklist_counts_a_tag_once_at_its_first_place(spark):
    rows = [(1, "B", 4, None, None, None), (1, "A", 3, 0, 1, 2), (1, "A", 1, None, None, None), (1, "C", 9, 2, 0, 0)]
    got = {r["tag"]: (r["ord"], r["full_tag"], r["location"]["type"], r["location"]["table_index"], r["status"]) for r in records.checklist(spark.createDataFrame(rows, TAGS)).collect()}
    assert got == {"A": (1, "{{A}}", "text", None, "pending"), "B": (4, "{{B}}", "text", None, "pending"), "C": (9, "{{C}}", "table_cell", 2, "pending")}


def test_mapping_output_of_some_all_and_no_tags(spark):
    rows = [(1, "NOM", 1, None, None, None), (1, "DATE", 2, 0, 0, 0), (1, "MONTANT", 3, 0, 0, 1), (2, "NOM", 1, None, None, None)]
    expected = records.checklist(spark.createDataFrame(rows, TAGS))
    verified = spark.createDataFrame([(1, "NOM", "ok"), (1, "DATE", "missing"), (2, "NOM", "semantic_mismatch"), (2, "OTHER", "ok")], "doc_id long, tag string, status string")
    docs = spark.createDataFrame([(1, "in/a.docx", "x"), (2, "b.doc", "x"), (3, None, "x")], "doc_id long, path string, applied string")
    boxes = spark.createDataFrame([(2, "OUI", True), (2, "OUI", False)], "doc_id long, tag string, checked boolean")
    issues = spark.createDataFrame([(1, "missing_tag", "DATE", "no cell")], "doc_id long, type string, tag string, description string")
    got = {r["doc_id"]: r["output"] for r in records.mapping_output(docs, records.settle(expected, verified), issues, boxes).collect()}
    assert got[1]["applied"] == ["NOM"] and got[1]["failed"] == ["DATE", "MONTANT"] and got[1]["satisfaction"] == 33 and not got[1]["success"]
    assert json.loads(got[1]["data_structure"]) == {"NOM": "", "DATE": "", "MONTANT": 0} and [i["tag"] for i in got[1]["issues"]] == ["DATE"]
    assert got[2]["success"] and got[2]["output_filename"] == "b_tagged.docx" and [(b["tag"], b["checked"]) for b in got[2]["checkboxes"]] == [("OUI", True)]
    assert got[3]["available_tags"] == [] and got[3]["tags_expected"] == 0 and not got[3]["success"] and got[3]["data_structure"] == "{}"
    none = records.mapping_output(docs, records.settle(expected.limit(0), verified.limit(0))).collect()
    assert len(none) == 3 and not any(r["output"]["success"] for r in none)


def test_page_record_of_blank_and_labelled_pages(spark):
    rows = [(1, 1, 0, "Nom : ", 50.0, 700.0, 40.0, 10.0), (1, 1, 1, "Prénom", 50.0, 680.0, 40.0, 10.0), (1, 1, 2, "Age", 200.0, 680.0, 20.0, 10.0), (1, 2, 0, " ", 0.0, 10.0, 5.0, 5.0)]
    boxes = spark.createDataFrame(rows, "doc_id long, page int, index int, text string, x double, y double, width double, height double")
    one, two = records.page_records(boxes, 595.0, 842.0).orderBy("page").collect()
    assert [e["text"] for e in one["elements"]] == ["Nom : ", "Prénom", "Age"] and [x["text"] for x in one["lines"]] == ["Nom : ", "Prénom Age"]
    assert [(f["label"], f["confidence"]) for f in one["fields"]] == [("Nom", 0.9), ("Prénom", 0.7)] and len(one["empty_zones"]) == 2 and one["height"] == 842.0
    assert len(two["elements"]) == 1 and two["lines"] == two["empty_zones"] == two["fields"] == []
    assert records.page_records(boxes, 595.0, 842.0, with_fields=False).filter("size(fields) > 0").count() == 0
    assert records.page_records(boxes.limit(0), 595.0, 842.0).count() == 0


def test_form_of_the_first_heading_over_all_pages(spark):
    rows = [(1, 2, 0, "D - Présentation"), (1, 1, 9, "x C - Identification"), (2, 1, 0, "autre"), (3, 1, 0, "C-Identification du candidat D - Présentation"), (4, 1, 0, None)]
    lines = spark.createDataFrame(rows, "doc_id long, page int, line int, text string")
    assert {tuple(r) for r in layout.form_of_pages(lines).collect()} == {(1, "DC2"), (2, None), (3, "DC1"), (4, None)}
