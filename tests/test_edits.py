"""Edit scripts, tags of whole documents, whole forms."""

import random

import pytest

from docframe.operators import edits as E
from docframe.operators import forms

COLUMNS = "doc_id int, nr int, start int, end int, text string"


@pytest.mark.parametrize(
    ("edits", "want", "lost"),
    [
        ([(0, 1, 3, "X")], "aXdef", []), ([(0, 1, 3, "X"), (1, 2, 4, "Y")], "aXdef", [1]), ([(1, 1, 3, "X"), (0, 2, 4, "Y")], "abYef", [1]), ([(0, 3, 3, "X"), (1, 3, 3, "Y")], "abcXYdef", []),
        ([(0, 1, 3, "X"), (1, 1, 1, "Y"), (2, 3, 3, "Z")], "aYXZdef", []), ([(0, 1, 4, ""), (1, 2, 2, "in")], "aef", [1]), ([(0, 2, 2, "in"), (1, 1, 4, "")], "abincdef", [1]), ([(0, 0, 6, None)], "", []), ([(0, 4, 9, "x"), (1, -1, 0, "y"), (2, 3, 2, "z")], "abcdef", [0, 1, 2]),
        ([(0, 1, 3, "X"), (1, 1, 3, "Y")], "aXdef", [1]), ([], "abcdef", []),
    ],
)
def test_splice(edits, want, lost):
    assert E.splice("abcdef", [dict(zip(("nr", "start", "end", "text"), e, strict=True)) for e in edits]) == (want, lost)


def test_splice_against_one_by_one():
    rnd = random.Random(3)
    for _ in range(200):
        text = "".join(rnd.choice("abcdefgh") for _ in range(30))
        edits = [{"nr": i, "start": (a := rnd.randint(0, 30)), "end": min(30, a + rnd.choice([0, 0, 1, 4])), "text": f"<{i}>"} for i in range(8)]
        got, lost = E.splice(text, edits)
        kept = [e for e in edits if e["nr"] not in lost]
        for a in kept:
            for b in kept:
                assert a is b or a["end"] <= b["start"] or b["end"] <= a["start"]
        want = text
        for e in sorted(kept, key=lambda e: (e["start"], e["end"], e["nr"]), reverse=True):
            want = want[: e["start"]] + e["text"] + want[e["end"] :]
        assert got == want


def test_apply_edits_keeps_other_rows(spark):
    docs = spark.createDataFrame([(1, "abc", "x"), (2, None, "y"), (3, "ghi", "z"), (1, "éà🎉", "w")], "doc_id int, xml string, nr string")
    edits = spark.createDataFrame([(1, 0, 1, 2, "-"), (2, 0, 0, 0, "t"), (9, 0, 0, 0, "u"), (1, 1, 1, 3, "+")], COLUMNS)
    got = sorted(((r["doc_id"], r["xml"], r["nr"], r["lost_edits"]) for r in E.apply_edits(docs, edits).collect()), key=str)
    assert got == [(1, "a-c", "x", [1]), (1, "é-🎉", "w", [1]), (2, None, "y", []), (3, "ghi", "z", [])]


def test_form_without_marks_stays(spark):
    docs = spark.createDataFrame([(1, "<w:p><w:t>Nom commercial</w:t></w:p>"), (2, None)], "doc_id int, xml string")
    for form in ("DC1", "DC2", "AE"):
        assert sorted((r["doc_id"], r["xml"], r["inserted"]) for r in forms.tag_form(docs, form).collect()) == [(1, "<w:p><w:t>Nom commercial</w:t></w:p>", []), (2, None, [])]


def test_member_table_is_filled(spark):
    line = "<w:p><w:r><w:t>{}</w:t></w:r></w:p>".format
    cell = "<w:tc><w:p><w:pPr><w:jc/></w:pPr>{}</w:p></w:tc>".format
    table = lambda *rows: "<w:tbl>" + "".join("<w:tr>" + "".join(map(cell, r)) + "</w:tr>" for r in rows) + "</w:tbl>"
    before = table(["<w:r><w:t>Nom commercial</w:t></w:r>", ""]) + line("Tableau à reproduire autant de fois") + line("Membre du groupement")
    rows = [["<w:r><w:t>Nom commercial</w:t></w:r>", ""], ["<w:r><w:t>Numéro SIRET</w:t></w:r>", "<w:r><w:rPr><w:i/></w:rPr><w:t>old</w:t></w:r>"]]
    docs = spark.createDataFrame([(1, before + table(*rows))], "doc_id int, xml string")
    done = forms.tag_form(docs, "AE").first()
    rows[0][1] = "<w:r><w:t>{{MEMBRE_NOM_COMMERCIAL}}</w:t><w:br/><w:t>{{MEMBRE_DENOMINATION}}</w:t></w:r>"
    rows[1][1] = "<w:r><w:rPr><w:i/></w:rPr><w:t>{{MEMBRE_SIRET}}</w:t></w:r>"
    assert done["xml"] == before + table(*rows)
    assert done["inserted"] == ["MEMBRE_NOM_COMMERCIAL", "MEMBRE_DENOMINATION", "MEMBRE_SIRET"]


def test_tags_of_odd_places(spark):
    docs = spark.createDataFrame([(1, "<w:p><w:r><w:t>{{OLD}} a:</w:t></w:r></w:p><w:p><w:pPr/></w:p><w:p/>"), (2, None)], "doc_id int, xml string")
    rows = [(1, "OLD", 0, "inline", 0), (1, "A", 0, None, 1), (1, "B", 1, "inline", 2), (1, "C", 2, "inline", 3), (1, "D", 7, "inline", 4), (2, "E", 0, "inline", 0), (1, "F", None, "inline", 5)]
    out, report = E.tag_documents(docs, spark.createDataFrame(rows, "doc_id int, tag string, index int, insertion_point string, ord int"))
    assert {r["doc_id"]: r["xml"] for r in out.collect()} == {1: "<w:p><w:r><w:t>{{OLD}} a: {{A}}</w:t></w:r></w:p><w:p><w:pPr/><w:r><w:t>{{B}}</w:t></w:r></w:p><w:p/>", 2: None}
    assert {(r["doc_id"], r["tag"]): r["status"] for r in report.collect()} == {
        (1, "OLD"): "already_used", (1, "A"): "applied", (1, "B"): "applied", (1, "C"): "no_place", (1, "D"): "no_paragraph", (2, "E"): "no_paragraph", (1, "F"): "no_paragraph"
    }
