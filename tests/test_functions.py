import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from docframe.functions import tags as K
from docframe.functions import text as X
from docframe.functions import xml as M
from docframe.operators import fill as W
from docframe.operators import layout as L
from docframe.operators import matching as J
from docframe.operators import structure as S
from docframe.operators import tagging as T
from docframe.operators.segments import segment
from docframe.plans import agent as A
from docframe.sinks.docx import join_paragraphs, output_name, rezip
from docframe.sources import boxes as SB
from docframe.sources import docx as D


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("a  b", "a b"), (" \x07x\ty ", "xy"), ("é　ü", "é ü"), ("", ""), ("a\nb", "ab")],
)
def test_normalize_text(spark, raw, want):
    assert one(spark, X.normalize_text(F.lit(raw))) == want


def test_flatten_nested_values(spark):
    df = spark.sql("select named_struct('nom', 'A', 'ok', true, 'none', cast(null as string), 'sub', named_struct('x', 1.50D)) as d, array() as e, array(named_struct('q', 1)) as items, array('a', null) as l")
    tags = {c: (F.col(c), df.schema[c].dataType) for c in ("d", "items", "l")}
    got = df.select(K.flatten_to_tags(tags).alias("m")).first()["m"]
    assert got == {"D_NOM": "A", "D_OK": "☑", "D_SUB_X": "1.5", "ITEMS_0_Q": "1", "ITEMS": '[{"q":1}]', "L": "a, null"}


def test_fill_is_sequential_and_literal(spark):
    tags = F.create_map(*map(F.lit, ("A", "{{B}}", "B", "$1 & $&", "L", "[1,2]", "E", "")))
    got = one(spark, W.fill_tags(F.lit("{{A}}|{{B}}|{{L}}|{{E}}|{{b}}|{{Z}}"), tags))
    assert got["xml"] == "$1 &amp; $&amp;|$1 &amp; $&amp;||||"
    assert got["replaced"] == ["A", "B"]
    assert got["remaining"] == ["E", "b", "Z"]


def test_loop_without_items_goes(spark):
    df = spark.sql("select cast(null as array<struct<k:string>>) as n, array(named_struct('k', '<'), named_struct('k', null)) as i")
    row = df.select(W.expand_loop(F.lit("a{#X}[{{K}}]{/X}b"), "X", F.col("n"), ["k"]).alias("n"), W.expand_loop(F.lit("a{#x}[{{K}}]{/x}b"), "X", F.col("i"), ["k"]).alias("i")).first()
    assert tuple(row) == ("ab", "a[&lt;][]b")


def test_repair_leaves_sound_tags(spark):
    assert one(spark, M.repair(F.lit("<w:body>{{TAG}} {{OPEN x</w:body>"))) == "<w:body>{{TAG}} {{OPEN}} x</w:body>"


def test_wrap_keeps_all_words(spark):
    assert one(spark, X.wrap(F.lit("aaa bb  c dddddddd"), 5)) == ["aaa", "bb c", "dddddddd"]
    assert one(spark, X.wrap(F.lit("  "), 5)) == []


def docx(xml, **parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(D.BODY, xml)
        for name, body in parts.items():
            z.writestr(name.replace("__", "/") + ".xml", body)
    return bytearray(out.getvalue())


def test_docx_round_trip(spark, tmp_path):
    xml = "<w:body><w:p><w:r><w:t>Na</w:t><w:t>me: {{N}}</w:t></w:r></w:p></w:body>"
    (tmp_path / "a.docx").write_bytes(docx(xml, docProps__core="<dc:title>T</dc:title>", docProps__app="<Words>0</Words><Pages>3</Pages>"))
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    read = D.read(spark, str(tmp_path)).cache()
    good, bad = (read.filter(F.col("path").endswith(n)).first() for n in ("/a.docx", "bad.docx"))
    assert bad["error"]
    assert bad["xml"] is None
    assert '<w:t xml:space="preserve">Name: {{N}}</w:t>' in good["xml"]
    meta = D.metadata(read.filter("error is null")).first()
    assert (meta["title"], meta["pages"], meta["words"], meta["paragraphs"]) == ("T", 3, 2, 1)
    files = spark.read.format("binaryFile").load(str(tmp_path / "a.docx")).select("path", "content").withColumn("xml", F.lit("<new/>"))
    back = rezip(files)
    assert D.unzip(back).first()["xml"] == "<new/>"
    assert one(spark, output_name(F.lit("/x/y.docx"))) == "y_FILLED.docx"


def test_join_paragraphs_keeps_gaps(spark):
    args = (F.lit("<b>P1 gap P1 end</b>"), F.array(F.lit("P1"), F.lit("P1")), F.array(F.lit("new"), F.lit("$1")))
    assert one(spark, join_paragraphs(*args)) == "<b>new gap $1 end</b>"


@pytest.mark.parametrize(
    ("xml", "point", "cell", "want"),
    [
        ("<w:p><w:r><w:t>Name :</w:t></w:r></w:p>", "after_colon", False, "Name : {{T}}"),
        ("<w:p><w:r><w:t>ab</w:t></w:r></w:p>", "replace_empty", False, "{{T}}"),
        ("<w:p></w:p>", "after_colon", False, "{{T}}"),
        ("<w:p><w:r><w:t>Part % here</w:t></w:r></w:p>", "inline", True, "Part {{T}} % here"),
        ("<w:p><w:r><w:t>A long enough label</w:t></w:r></w:p>", "inline", False, "A long enough label {{T}}"),
    ],
)
def test_insert_tag(spark, xml, point, cell, want):
    assert one(spark, M.xml_text(T.insert_tag(F.lit(xml), F.lit("T"), F.lit(point), F.lit(cell)))) == want


def test_date_pair(spark):
    assert one(spark, T.date_pair(F.lit("Exercice du ...... au ......"), F.lit("D_DEBUT"), F.lit("D_FIN"))) == "Exercice du {{D_DEBUT}} au {{D_FIN}}"


def test_lines_keep_their_first_y(spark):
    rows = [("d", 1, i, f"w{i}", 10.0 * i, y, 5.0, 10.0) for i, y in enumerate((100.0, 98.0, 96.5, 93.0))]
    df = spark.createDataFrame(rows, "doc_id string, page int, index int, text string, x double, y double, width double, height double")
    texts = [len(r["boxes"]) for r in L.group_lines(df).orderBy("line").collect()]
    assert texts == [2, 1, 1]  # 96.5 is 3.5 from the anchor 100; 93 is 3.5 from 96.5


def test_boxes_from_items(spark):
    df = spark.createDataFrame([("d", 1, 1, "b", [1.0, 0.0, 0.0, 1.0, 7.0, 9.0], 1.0, 1.0), ("d", 1, 0, " ", [1.0] * 6, 1.0, 1.0)], "doc_id string, page int, nth int, text string, transform array<double>, width double, height double")
    r = SB.from_items(df).collect()
    assert [(x["index"], x["text"], x["x"], x["y"]) for x in r] == [(0, "b", 7.0, 9.0)]


def test_greedy_assignment_uses_a_place_once(spark):
    rows = [("g", "a", 0, 1, 9), ("g", "a", 0, 2, 9), ("g", "b", 1, 1, 20), ("g", "b", 1, 3, 5)]
    df = spark.createDataFrame(rows, "grp string, tag string, ord int, place int, score int")
    got = {r["tag"]: r["place"] for r in J.greedy_assignment(df, "grp").collect()}
    assert got == {"a": 1, "b": 3}


@pytest.mark.parametrize("block", [1, 3, 512])
def test_greedy_assignment_in_blocks_equals_one_pass(spark, block):
    rnd = random.Random(4)
    rows = [(g, f"t{t}", t, rnd.randrange(40), rnd.randint(1, 6)) for g in ("a", "b", None) for t in range(30) for _ in range(rnd.randint(1, 12))]
    rows = list({(g, t, p): (g, n, t, p, s) for g, n, t, p, s in rows}.values())
    used, want = set(), set()
    for g in ("a", "b", None):
        for t in range(30):
            mine = sorted((-s, p) for h, _, o, p, s in rows if h == g and o == t and (g, p) not in used)
            if mine:
                used.add((g, mine[0][1]))
                want.add((g, f"t{t}", mine[0][1]))
    df = spark.createDataFrame(rows, "grp string, tag string, ord int, place int, score int").repartition(3)
    assert {(r["grp"], r["tag"], r["place"]) for r in J.greedy_assignment(df, "grp", block).collect()} == want
    assert J.greedy_assignment(df.limit(0), "grp").count() == 0


def test_keywords_are_found_inside_of_words(spark):
    tags = spark.createDataFrame([("d", "ADRESSE", 0, ["adresse"]), ("d", "NOM", 1, ["nom"]), ("d", "NONE", 2, ["absent"]), ("d", "TWICE", 3, ["nom", "nom"])], "doc string, tag string, ord int, words array<string>")
    places = spark.createDataFrame([("d", 0, "Adresses postales :"), ("d", 1, "Dénomination"), ("d", 2, "Nom, prénom"), ("d", 3, None), ("e", 4, "adresse")], "doc string, place int, text string")
    got = {(r["tag"], r["place"], r["score"]) for r in J.keyword_candidates(tags, places, "doc", least=1).collect()}
    assert got == {("ADRESSE", 0, 12), ("NOM", 1, 3), ("NOM", 2, 3), ("TWICE", 1, 6), ("TWICE", 2, 6)}
    best = {r["tag"]: (r["place"], r["score"]) for r in J.keyword_best(tags, places, "doc", least=1).collect()}
    assert best == {"ADRESSE": (0, 12), "NOM": (1, 3), "TWICE": (1, 6)}


def test_section_matcher_stays_in_its_section(spark):
    from docframe.plans.agent import section_matcher

    cells = "table_index int, row_index int, column_index int"
    tags = spark.createDataFrame([("d", "A", "T1", 0, "", 0, 1, 1), ("d", "B", "T2", 1, "adresse postale", None, None, None), ("d", "C", "T3", 2, "", 0, 1, 1)], f"doc_id string, section string, tag string, ord int, label string, {cells}")
    places = spark.createDataFrame(
        [("d", "A", 0, "x", 0, 1, 1), ("d", "A", 1, "Adresse postale :", None, None, None), ("d", "B", 2, "Les adresses", None, None, None), ("d", "B", 3, "y", 0, 1, 1)], f"doc_id string, section string, place int, text string, {cells}"
    )
    assert {(r["tag"], r["place"], r["confidence"]) for r in section_matcher(tags, places).collect()} == {("T1", 0, 0.9), ("T2", 2, 0.75)}


def test_feedback_reaches_the_model(spark):
    """The client is told what was wrong with its last answer, and asked no more once it has none."""
    from docframe.plans import agent

    def client(prompt: str) -> str:
        wrong = '{"matches": [{"tag": "A", "paragraphIndex": 0}, {"tag": "B", "paragraphIndex": 0}]}'
        right = '{"matches": [{"tag": "A", "paragraphIndex": 0}, {"tag": "B", "paragraphIndex": 1}]}'
        return right if "duplicate_place" in prompt else wrong

    cells = "table_index int, row_index int, column_index int"
    tags = spark.createDataFrame([("d", "A", 0, "", 0, 0, 0), ("d", "B", 1, "", 0, 0, 1)], f"doc_id string, tag string, ord int, label string, {cells}")
    places = spark.createDataFrame([("d", 0, "x", 0, 0, 0), ("d", 1, "y", 0, 0, 1)], f"doc_id string, place int, text string, {cells}")
    matches, log = agent.mapping_loop(tags, places, agent.model_matcher(client))
    assert {(r["tag"], r["place"], r["mode"]) for r in matches.collect()} == {("A", 0, "answer"), ("B", 1, "answer")}
    assert sorted((r["round"], r["state"]) for r in log.collect()) == [(1, "again"), (2, "clean")]


def test_loops_of_empty_tables(spark):
    from docframe.plans import agent

    cells = "table_index int, row_index int, column_index int"
    tags = spark.createDataFrame([], f"doc_id string, section string, tag string, ord int, label string, {cells}")
    places = spark.createDataFrame([], f"doc_id string, section string, place int, text string, {cells}")
    for loop in (lambda: agent.mapping_loop(tags, places, lambda t, p, f: agent.semantic_matcher(t, p)), lambda: agent.section_loop(tags, places, agent.semantic_matcher)):
        matches, log = loop()
        assert matches.count() == log.count() == 0


def test_tag_rows_labels(spark):
    xml = "<w:body>" + "".join(f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>" for t in ("A - Candidat", "Nom commercial", "{{NOM_COMMERCIAL}} suite", "SIRET : {{SIRET}}")) + "</w:body>"
    paras = S.paragraphs(spark.createDataFrame([("d", xml)], "doc_id string, xml string"))
    got = {r["tag"]: r for r in S.tag_rows(paras).collect()}
    assert got["NOM_COMMERCIAL"]["label_before"] == "Nom commercial"
    assert got["NOM_COMMERCIAL"]["label_after"] == "suite"
    assert got["SIRET"]["label_before"] == "SIRET :"
    assert {r["section"] for r in got.values()} == {"A"}


def test_segment_falls_back_to_whole(spark):
    rows = [("t", "<w:tbl><w:tr><w:tc><w:p><w:t>" + "SIRET " * 20 + "{{A}}</w:t></w:p></w:tc></w:tr></w:tbl>"), ("w", "<w:p><w:t>short</w:t></w:p>")]
    got = {r["doc_id"]: r for r in segment(spark.createDataFrame(rows, "doc_id string, xml string")).collect()}
    assert (got["t"]["type"], got["t"]["tags"], got["t"]["relevance"]) == ("table", ["A"], 35)
    assert got["w"]["type"] == "paragraph_group"


def test_response_parsing(spark):
    texts = ['```json\n{"matches": [{"tag": "A", "paragraphIndex": 1, "confidence": 0}, {"tag": "B"}]}\n```', '[{"tag": "C", "targetParagraphIndex": 2, "confidence": 0.3}]', "no json", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, response string")
    got = [tuple(r) for r in A.parse_response(df).collect()]
    assert got == [(0, "A", 1, 0.8, "after_colon")]


def test_loop_ends_when_enough_is_verified(spark):
    tags = spark.createDataFrame([("d", "NOM", 0, "nom commercial", None, None, None), ("d", "CELL", 1, "x", 0, 1, 1)], "doc_id string, tag string, ord int, label string, table_index int, row_index int, column_index int")
    places = spark.createDataFrame([("d", 0, "Nom commercial :", None, None, None), ("d", 1, "", 0, 1, 1)], "doc_id string, place int, text string, table_index int, row_index int, column_index int")
    calls = []

    def matcher(t, p):
        calls.append(1)
        return A.semantic_matcher(t, p).limit(0)

    done, score = A.run_loop(tags, places, matcher, lambda m: m.select("doc_id", "tag", F.lit("ok").alias("status")))
    assert {(r["tag"], r["place"]) for r in done.collect()} == {("NOM", 0), ("CELL", 1)}
    assert score.first()["percent"] == 100
    assert len(calls) == 1


def test_model_client_answers_are_unwrapped(spark):
    tags = spark.createDataFrame([("d", "NOM", 0, "nom")], "doc_id string, tag string, ord int, label string")
    places = spark.createDataFrame([("d", 0, "Nom :")], "doc_id string, place int, text string")
    match = A.model_matcher(lambda prompt: {"content": '{"matches": [{"tag": "NOM", "paragraphIndex": 0, "confidence": 0.9}]}'})
    assert match(tags, places).first()["tag"] == "NOM"


def test_stream_reads_documents(spark, tmp_path):
    from docframe.streaming.files import read_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.docx").write_bytes(docx("<w:p><w:t>{{A}}</w:t></w:p>"))
    query = read_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("docs").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("docs").first()["xml"] == "<w:p><w:t>{{A}}</w:t></w:p>"
