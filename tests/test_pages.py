"""Page loop, transfer of tags, forms, prompts and reports on small rows."""

import json

import pytest
from pyspark.sql import functions as F

from docframe.operators import forms, layout
from docframe.operators.matching import keyword_fields
from docframe.operators.tagging import date_pair_xml
from docframe.plans import agent, pages
from docframe.session import small

BOX = "doc_id int, page int, index int, text string, x double, y double, width double, height double"
PLACE = "doc_id int, field string, type string, page int, x double, y double"


def page(spark):
    rows = [(1, 1, 0, "Nom :", 50.0, 700.0, 30.0, 10.0), (1, 1, 1, "Adresse", 50.0, 650.0, 40.0, 10.0), (1, 1, 2, "pied", 50.0, 500.0, 40.0, 10.0)]
    return spark.createDataFrame(rows, BOX)


def config(spark):
    return spark.createDataFrame([("nom", ["Nom"], "inline", None), ("adr", ["Adresse"], "multiline", 30.0), ("ca", ["Chiffre"], "inline", None)], "field string, labels array<string>, type string, min_gap double")


def values(spark, *rows):
    return spark.createDataFrame([(1, *r) for r in rows], "doc_id int, field string, value string")


def test_loop_places_by_labels_and_leaves_blank_values_out(spark):
    places, score = pages.fill_pages(page(spark), values(spark, ("nom", "ACME"), ("adr", "rue"), ("ca", "12"), ("x", " ")), config(spark))
    got = {r["field"]: (r["page"], r["x"], r["y"], r["value"]) for r in places.collect()}
    assert got == {"nom": (1, 88.0, 700.0, "ACME"), "adr": (1, 71.0, 575.0, "rue")}
    row = score.first()
    assert (row["expected"], row["verified"], row["percent"], row["success"]) == (3, 2, 67, False)


def test_loop_counts_set_boxes(spark):
    checks = spark.createDataFrame([("a", ["pied"], True), ("b", ["nowhere"], True), ("c", ["pied"], False)], "field string, labels array<string>, checked boolean")
    score = pages.fill_pages(page(spark), values(spark, ("nom", "ACME")), config(spark), checks=checks)[1].first()
    assert (score["expected"], score["verified"]) == (3, 2)


def test_loop_moves_what_collides_once(spark):
    on_text = lambda open_, lines: open_.filter("field = 'adr'").select("doc_id", "field", "type", F.lit(1).alias("page"), F.lit(95.0).alias("x"), F.lit(650.0).alias("y"))
    v = values(spark, ("adr", "rue longue"))
    assert pages.fill_pages(page(spark), v, config(spark), model=on_text)[0].first()["y"] == 632.0
    better = lambda bad, lines: bad.withColumns({"y": F.lit(600.0), "x": F.lit(71.0)})
    row = pages.fill_pages(page(spark), v, config(spark), model=on_text, correct=better)[0].first()
    assert (row["x"], row["y"]) == (71.0, 600.0)


def test_loop_without_values(spark):
    places, score = pages.fill_pages(page(spark), values(spark, ("nom", "")), config(spark))
    assert places.count() == 0
    assert score.count() == 0


def test_stages_and_equal_tags(spark):
    expected = spark.createDataFrame([(1, 0, "A", 1, 10.0, 10.0, "x"), (1, 1, "A", 1, 10.0, 10.0, "nom commercial"), (1, 2, "B", 1, 90.0, 90.0, "adresse siège"), (1, 3, "C", 1, 90.0, 90.0, "rien")], "doc_id int, ord int, tag string, page int, x double, y double, label string")
    fields = spark.createDataFrame([(1, 1, 1, 11.0, 10.0, "Nom commercial"), (1, 2, 2, 0.0, 0.0, "Adresse du siège")], "doc_id int, page int, fid int, x double, y double, label string")
    size = spark.createDataFrame([(1, 1, 100.0, 100.0)], "doc_id int, page int, width double, height double")
    model = lambda rest, f: rest.filter("tag = 'C'").select("doc_id", "ord", F.lit(2).alias("fid"), F.lit(0.6).alias("confidence"))
    matches, states, score = pages.match_fields(expected, fields, size, model)
    got = sorted((r["ord"], r["fid"], r["stage"], round(r["confidence"], 3)) for r in matches.collect())
    # The second A is pending, for the first of equal tags counts, and goes on to the next stage.
    assert got == [(0, 1, "position", 0.95), (1, 1, "position", 0.95), (1, 1, "semantic", 1.0), (2, 2, "semantic", 1.0), (3, 2, "model", 0.6)]
    assert {r["ord"]: (r["status"], r["issue"]) for r in states.collect()} == {0: ("matched", None), 1: ("pending", "no_match"), 2: ("matched", None), 3: ("matched", None)}
    assert score.first()["percent"] == 75


def test_keyword_fields_meet_on_parts_of_words(spark):
    words = ["nom", "nominal", "prenom", "commercial", "commerce", "adresse", "adresses", "ent", "entreprise", "siret"]
    labels = [f"{a} {b}" for i, a in enumerate(words) for b in words[i::3]] + ["", "le la"]
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate(labels)], "doc_id int, id int, label string")

    def alike(a, b):
        a, b = ([w for w in x.split() if len(w) > 2] for x in (a, b))
        return sum(any(x in y or y in x for y in b) for x in a) / max(len(a), len(b)) if a and b else 0

    want = {}
    for i, a in enumerate(labels):
        score, fid = max((alike(a, b), -j) for j, b in enumerate(labels))
        if score >= 0.7:
            want[i] = (-fid, score)
    got = {r["id"]: (r["fid"], r["score"]) for r in keyword_fields(rows, rows.withColumnRenamed("id", "fid")).collect()}
    assert got == want


def test_prompts_list_the_first_rows_only(spark):
    lines = spark.createDataFrame([(d, 1, i, 1.0, 2.0, f"l{i}") for d in (1, 2) for i in range(5)], "doc_id int, page int, line int, x double, y double, text string")
    bad = spark.createDataFrame([(1, "f", "inline", 1, 3.0, 4.0)], PLACE)
    asked = pages.correction_prompts(bad, lines, 2).collect()
    assert [r["doc_id"] for r in asked] == [1]
    head, listed = asked[0]["prompt"].split("\nLines: ")
    assert [x["text"] for x in json.loads(listed)] == ["l0", "l1"]
    assert json.loads(head.split("\nFields: ")[1]) == [{"field": "f", "type": "inline", "page": 1, "x": 3.0, "y": 4.0}]
    assert pages.position_prompts(bad.select("doc_id", "field", "type"), lines).count() == 1
    tags = spark.createDataFrame([(1, 0, "T", "nom")], "doc_id int, ord int, tag string, label string")
    fields = spark.createDataFrame([(2, 0, 1, "nom")], "doc_id int, fid int, page int, label string")
    assert pages.field_prompts(tags, fields).first()["prompt"].endswith("\nFields: []")


def test_answers_that_are_none(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "no JSON"), (4, "{broken"), (5, '{"matches": 1}')], "doc_id int, response string")
    for parse in (agent.parse_response, agent.parse_decisions, pages.parse_fields, pages.parse_positions):
        assert parse(rows).count() == 0


def test_date_pairs_over_runs(spark):
    text = lambda *runs: "<w:p>" + "".join(f'<w:r><w:t xml:space="preserve">{r}</w:t></w:r>' for r in runs) + "</w:p>"
    cases = [
        (text("du ..... au ....."), text("du {{A}} au {{B}}")),
        (text("du ....", " au ……", " fin"), text("du {{A}}", " au {{B}}", " fin")),
        (text("du ", "....", " au ", "....", "."), text("du {{A}}", "", " au {{B}}", "", "")),
        (text("du au"), text("du {{A}} au{{B}}")),
        (text("Exercice"), text("Exercice {{A}} au {{B}}")),
        ("<w:p/>", None),
        (None, None),
    ]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, x string")
    got = [r[0] for r in rows.orderBy("i").select(date_pair_xml(F.col("x"), F.lit("A"), F.lit("B"))).collect()]
    assert got == [c[1] for c in cases]


def test_forms_without_their_sections(spark):
    lines = spark.createDataFrame([(1, 0, "E - fin"), (1, 1, "D - Présentation"), (1, 2, "Adresse électronique :"), (1, 3, ""), (2, 0, "Numéro SIRET")], "doc_id int, index int, text string")
    got = [(r["doc_id"], r["index"], r["tags"]) for r in forms.label_tags(lines, "DC1").collect()]
    assert got == [(1, 3, ["EMAIL"])]
    assert forms.question_tags(lines).count() == 0
    assert forms.member_tags(spark.createDataFrame([(1, "<w:p/>"), (2, None)], "doc_id int, xml string")).count() == 0


def test_values_and_pages_to_place(spark):
    texts = spark.createDataFrame([("a",), (" \t",), (None,)], "value string")
    assert [r[0] for r in layout.filled_values(texts).collect()] == ["a"]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "value boolean")
    assert layout.filled_values(flags).count() == 1
    sheets = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "doc_id int, page int, text string")
    got = sorted((r["doc_id"], r["text"], r["error"]) for r in layout.extract_page(sheets, 2).collect())
    assert got == [(1, "b", None), (2, None, "page 2 is not between 1 and 1")]
    assert {r["error"] for r in layout.extract_page(sheets, 0).collect()} == {"page 0 is not between 1 and 2", "page 0 is not between 1 and 1"}


def test_tables_of_rules_are_bounded(spark):
    assert small(spark.range(3), 3).count() == 3
    with pytest.raises(ValueError, match="3 rows"):
        small(spark.range(4), 3)
