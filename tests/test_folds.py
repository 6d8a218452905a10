"""Folds and scans over small fixtures, held against plain Python."""

import io
import math
import random
import zipfile

from pyspark.sql import functions as F

from docframe.operators import checkbox, layout
from docframe.operators.fill import expand_loop
from docframe.operators.templates import expand_loops
from docframe.sinks.docx import rezip
from docframe.sources.docx import unzip

BOXES = "doc_id long, index int, ord int, checked boolean, label string"


def plain_pairs(rows):
    """rows of one document: (index, kind, checked)."""
    used, out = set(), []
    for i, (index, kind, checked) in enumerate(rows):
        if i in used or kind is None:
            continue
        for j in range(i + 1, len(rows)):
            other, kind2, checked2 = rows[j]
            if other - index > 5:
                break
            if j not in used and kind2 is not None and kind2 != kind:
                oui, non = ((index, checked), (other, checked2)) if kind == "oui" else ((other, checked2), (index, checked))
                value = True if oui[1] and not non[1] else False if non[1] and not oui[1] else None
                out.append((min(index, other), oui[0], non[0], value))
                used |= {i, j}
                break
    return sorted(out, key=str)


def test_pairs_against_plain_loop(spark):
    rnd = random.Random(1)
    docs = {d: [(rnd.randint(0, 25), rnd.choice(["oui", "non", None]), rnd.random() < 0.5) for _ in range(rnd.randint(0, 14))] for d in range(60)}
    docs |= {100: [(0, "oui", True), (5, "non", False)], 101: [(0, "oui", True), (6, "non", False)], 102: [(0, "oui", True), (1, "oui", False), (2, "non", True), (3, "non", True)]}
    rows = [(d, i, n, c, {"oui": "Oui", "non": "Non", None: "autre chose"}[k]) for d, items in docs.items() for n, (i, k, c) in enumerate(sorted(items, key=lambda x: x[0]))]
    got = {}
    for r in checkbox.pairs(spark.createDataFrame(rows, BOXES)).collect():
        got.setdefault(r["doc_id"], []).append((r["index"], r["oui_index"], r["non_index"], r["value"]))
    assert {d: sorted(v, key=str) for d, v in got.items()} == {d: p for d, items in docs.items() if (p := plain_pairs(sorted(items, key=lambda x: x[0])))}


def plain_place(pages, labels, kind, least):
    """pages: (page, [(y, text)], [(x, y, width, text)]) in order."""
    for page, lines, boxes in pages:
        lines = sorted(lines, reverse=True)
        hits = [i for i, (_, text) in enumerate(lines) if any(label in text for label in labels)]
        if not hits:
            continue
        if kind == "inline":
            for x, y, width, text in sorted(boxes):
                if abs(y - lines[hits[0]][0]) < 5 and ":" in text:
                    return page, math.floor(x + (text.index(":") + 1) * width / len(text) + 8 + 0.5), math.floor(y + 0.5)
            continue
        for i in hits:
            end = i
            while end + 1 < len(lines) and end - i < 5 and lines[end][0] - lines[end + 1][0] < 18:
                end += 1
            if i + 1 < len(lines) and end + 1 < len(lines):
                gap = lines[end][0] - lines[end + 1][0]
                y = lines[end + 1][0] + gap / 2
                if gap >= least and not any(abs(b[1] - y) < 10 and b[3].strip() for b in boxes):
                    return page, 71, math.floor(y + 0.5)
    return None, None, None


def test_label_places_against_plain_scan(spark):
    rnd = random.Random(2)
    docs = {}
    for d in range(80):
        pages = []
        for page in (1, 2, 3):
            y, lines, boxes = 800.0, [], []
            for _ in range(rnd.randint(0, 9)):
                y -= rnd.choice([12, 17, 18, 25, 40, 60])
                text = rnd.choice(["Nom du candidat :", "name", "other text", "Adresse", "Nom", "x:"])
                lines.append((y, text))
                boxes.append((float(rnd.randint(40, 60)), y + rnd.choice([0, 4, 6]), 80.0, text))
            pages.append((page, lines, boxes))
        docs[d] = pages
    lines = spark.createDataFrame([(d, p, 50.0, y, 80.0, t) for d, pages in docs.items() for p, ls, _ in pages for y, t in ls], "doc_id long, page int, x double, y double, width double, text string")
    boxes = spark.createDataFrame([(d, p, x, y, w, t) for d, pages in docs.items() for p, _, bs in pages for x, y, w, t in bs], "doc_id long, page int, x double, y double, width double, text string")
    fields = [("who", ["Nom", "Name"], "inline", None), ("where", ["Adresse"], "multiline", 30.0), ("any", ["other", "Nom"], "multiline", None)]
    found = layout.label_places(lines, spark.createDataFrame(fields, "field string, labels array<string>, type string, min_gap double"), boxes)
    got = {(r["doc_id"], r["field"]): (r["page"], r["x"], r["y"]) for r in found.collect()}
    seen = {d for d, pages in docs.items() if any(ls for p, ls, _ in pages if p < 3)}
    want = {(d, f): plain_place([p for p in docs[d] if p[0] < 3], labels, kind, least or 0) for d in seen for f, labels, kind, least in fields}
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 40


def test_loops_end(spark):
    df = spark.range(1).select(F.lit('{"a": [{"v": "{#A}{{V}}{/A}"}, {"v": "$1 \\\\ <"}, 3, null], "b": [{"x.y": 1.5, "z": [1, null, "q"]}]}').alias("data"))
    # A value that holds its own block is text.
    assert df.select(expand_loops(F.lit("{#A}{{V}}{/A}"), F.col("data")).alias("x")).first()["x"] == "{#A}{{V}}{/A}$1 \\ &lt;{{V}}{{V}}"
    assert df.select(expand_loops(F.lit("{#B}{{X.Y}}|{{z}}{/B}-{#A}{{W}}{/A}-{#C}{/C}"), F.col("data")).alias("x")).first()["x"] == "1.5|1, , q-{{W}}{{W}}{{W}}{{W}}-"
    assert df.select(expand_loops(F.lit("{#A}x"), F.lit(None).cast("string")).alias("x")).first()["x"] == "{#A}x"
    items = spark.sql("select array(named_struct('k', 'a'), named_struct('k', null)) as items")
    assert items.select(expand_loop(F.lit("{#A}<x>{{K}}{/A}|{#A}<y>{/A}|{#B}{/B}"), "A", F.col("items"), ["k"]).alias("x")).first()["x"] == "<x>a<x>|<y><y>|{#B}{/B}"


def test_damaged_files_are_error_rows(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", "<w:document>" + "abc " * 500 + "</w:document>")
    good = buffer.getvalue()
    at = good.index(b"document.xml") + 14
    cut = good[:at] + bytes(255 - x for x in good[at : at + 30]) + good[at + 30 :]
    locked = bytearray(good)
    for mark, place in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
        locked[good.index(mark) + place] |= 1
    rows = [("good", good, "<w:document/>"), ("cut", cut, "<w:document/>"), ("locked", bytes(locked), "<w:document/>"), ("none", None, "<x/>"), ("text", b"no zip", None)]
    files = spark.createDataFrame(rows, "path string, content binary, xml string")
    read = {r["path"]: r["error"] for r in unzip(files.select("path", "content")).collect()}
    assert read["good"] is None
    assert all(read[k] for k in ("cut", "locked", "text"))
    written = {r["path"]: r for r in rezip(files).collect()}
    assert written["good"]["error"] is None
    assert written["text"]["content"] == b"no zip"
    assert written["none"]["content"] is None
