"""Documents that take tags: read once, and the same as tag by tag."""

import random

from pyspark.sql import functions as F

from docframe.operators.edits import tag_documents

P = "<w:p><w:r><w:t>{}</w:t></w:r></w:p>".format
MATCH = "doc_id int, tag string, index int, insertion_point string, ord int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_read_once(spark):
    docs = spark.range(8).select(F.col("id").alias("doc_id"), F.lit(P("Line :")).alias("xml"))
    matches = spark.createDataFrame([(1, "T", 0, None, 0)], MATCH.replace("doc_id int", "doc_id long"))
    for df in tag_documents(docs, matches):
        assert plan(df).count("Range (") == 1
        assert plan(df).count("Exchange hashpartitioning") == 2


def _plain(paragraphs, asked, several):
    """Texts of the paragraphs with their tags, and the report."""
    texts, report, used, open_ = list(paragraphs), [], set(), {}
    for tag, index, nth in sorted(asked, key=lambda m: (-m[1], m[2])):
        if any(f"{{{{{tag}}}}}" in p for p in paragraphs):
            report.append((tag, index, "already_used"))
        elif index >= len(paragraphs):
            report.append((tag, index, "no_paragraph"))
        elif tag in used:
            report.append((tag, index, "already_used"))
        else:
            used.add(tag)
            open_.setdefault(index, {})[tag] = nth
    for index, tags in open_.items():
        bases = sorted({t[:-6] for t in tags if t.endswith("_DEBUT") and t[:-6] + "_FIN" in tags}, key=lambda b: (min(tags[b + "_DEBUT"], tags[b + "_FIN"]), b))
        paired = {b + side for b in bases for side in ("_DEBUT", "_FIN")}
        single = sorted(tags.keys() - paired, key=lambda t: (tags[t], t))
        kept = single if several else single[: 0 if bases else 1]
        texts[index] += "".join(f" {{{{{b}_DEBUT}}}} au {{{{{b}_FIN}}}}" for b in bases) + "".join(f" {{{{{t}}}}}" for t in kept)
        report += [(t, index, "applied" if t in paired or t in kept else "paragraph_changed") for t in tags]
    return "".join(map(P, texts)), sorted(report)


def test_documents_take_tags_as_one_by_one(spark):
    r = random.Random(7)
    names = ["A", "B", "C_D", "X_DEBUT", "X_FIN", "Y_Z_DEBUT", "Y_Z_FIN", "HELD"]
    docs = {d: [f"text number {i}" + (" {{HELD}}" if r.random() < 0.1 else "") for i in range(r.randrange(5))] for d in range(60)}
    asked = {d: [(t, i, r.randrange(3)) for t in names for i in r.sample(range(5), r.randrange(3))] for d in docs}
    rows = [(d, t, i, "inline", n) for d, ms in asked.items() for t, i, n in ms]
    table = spark.createDataFrame([(d, "".join(map(P, ps)), f"k{d}") for d, ps in docs.items()] + [(100, P("no match"), "k")], "doc_id int, xml string, kept string")
    for several in (True, False):
        out, report = tag_documents(table, spark.createDataFrame([*rows, (200, "A", 0, "inline", 0)], MATCH), several=several)
        want = {d: _plain(ps, asked[d], several) for d, ps in docs.items()}
        assert {r["doc_id"]: (r["xml"], r["kept"]) for r in out.collect()} == {d: (w[0], f"k{d}") for d, w in want.items()} | {100: (P("no match"), "k")}
        assert sorted(map(tuple, report.collect())) == sorted([(d, *x) for d, w in want.items() for x in w[1]] + [(200, "A", 0, "no_paragraph")])


def test_of_nested_paragraphs_the_outer_one_takes_its_tag(spark):
    xml = "<w:p><w:r><w:t>out</w:t></w:r><w:p><w:r><w:t>in</w:t></w:r></w:p></w:p>" + P("é last")
    docs = spark.createDataFrame([(1, xml), (2, xml), (3, "<w:p><w:p></w:p></w:body>" + P("x"))], "doc_id int, xml string")
    rows = [(1, "A", 0, "inline", 0), (1, "B", 1, "inline", 0), (1, "C", 2, "inline", 0), (2, "B", 1, "inline", 0), (3, "A", 0, "inline", 0), (3, "B", 1, "inline", 0)]
    out, report = tag_documents(docs, spark.createDataFrame(rows, MATCH))
    assert {r["doc_id"]: r["xml"] for r in out.collect() if r["doc_id"] < 3} == {1: xml.replace("in<", "in {{A}}<").replace("last", "last {{C}}"), 2: xml.replace("in<", "in {{B}}<")}
    assert {r["status"] for r in report.collect()} == {"applied"}
