"""Rules of known forms: which labels, cells and boxes of a form take which tags, as rows, and the edits that put them in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions.text import trim_all
from docframe.operators.edits import apply_edits
from docframe.operators.markup import elements
from docframe.operators.structure import cells, placed_paragraphs
from docframe.operators.tagging import apply_rules
from docframe.session import materialize, shuffled

#: Per form the markers around the section with the labels, and its labels as (label, tags, occurrence).
LABELS = {
    "DC1": ("D - Présentation", "E - ", [
        ("Nom commercial et dénomination sociale", ["NOM_COMMERCIAL", "DENOMINATION"], 1),
        ("Adresses postale et du siège", ["ADRESSE", "ADRESSE_SIEGE"], 1),
        ("Adresse électronique", ["EMAIL"], 1),
        ("Numéros de téléphone et de télécopie", ["TELEPHONE"], 1),
        ("Numéro SIRET", ["SIRET"], 1),
    ]),
    "DC2": ("C1 - Cas général", "C2", [
        ("Nom commercial", ["NOM_COMMERCIAL", "DENOMINATION"], 2),
        ("dresses postale", ["ADRESSE", "ADRESSE_SIEGE"], 1),
        ("dresse électronique", ["EMAIL"], 2),
        ("de téléphone", ["TELEPHONE"], 2),
        ("uméro SIRET", ["SIRET"], 2),
        ("Forme juridique", ["FORME_JURIDIQUE"], 1),
    ]),
}
#: The table of turnover by its number, tags by the number of the cell in the table.
TURNOVER_TABLE = 7
TURNOVER = {
    1: ["CA_N_DEBUT", "CA_N_FIN"], 2: ["CA_N1_DEBUT", "CA_N1_FIN"], 3: ["CA_N2_DEBUT", "CA_N2_FIN"],
    5: ["CA_N"], 6: ["CA_N1"], 7: ["CA_N2"],
    9: ["PART_CA_N"], 10: ["PART_CA_N1"], 11: ["PART_CA_N2"],
}
#: The markers before the table of a member, and its rows' labels.
MEMBER_MARKS = ("Tableau à reproduire autant de fois", "Membre du groupement")
MEMBER = [
    ("Nom commercial", ["MEMBRE_NOM_COMMERCIAL", "MEMBRE_DENOMINATION"]),
    ("Adresse de l'établissement", ["MEMBRE_ADRESSE"]),
    ("Adresse du siège social", ["MEMBRE_ADRESSE_SIEGE"]),
    ("Adresse électronique", ["MEMBRE_EMAIL"]),
    ("Téléphone", ["MEMBRE_TELEPHONE"]),
    ("Numéro SIRET", ["MEMBRE_SIRET"]),
]
#: The question whose boxes take tags, and the tags of yes and no.
QUESTION, YES, NO = "est-il une micro", "CHECK_PME_OUI", "CHECK_PME_NON"


def between(lines: DataFrame, start: str, end: str, doc: str = "doc_id") -> DataFrame:
    """Lines after the first with the start marker and before the next with the end marker, or to the end of the document."""
    by = Window.partitionBy(doc)
    first = lambda rows, mark, name: rows.withColumn(name, F.min(F.when(F.contains("text", F.lit(mark)), F.col("index"))).over(by))
    below = first(lines.filter(F.col(doc).isNotNull()), start, "_from").filter(F.col("index") > F.col("_from"))
    return first(below, end, "_to").filter(F.col("_to").isNull() | (F.col("index") < F.col("_to"))).select(*lines.columns)


def label_tags(lines: DataFrame, form: str, doc: str = "doc_id") -> DataFrame:
    """doc, index, tags of a form's labels; labels that its section does not hold give no row. lines: doc, index, text."""
    start, end, rules = LABELS[form]
    # A label may be a part of another line's label, so rules go by number and not by tag.
    table = lines.sparkSession.createDataFrame([(label, i, n) for i, (label, _, n) in enumerate(rules)], "label string, tag int, occurrence int")
    tags = F.array(*[F.array(*map(F.lit, t)) for _, t, _ in rules])
    return apply_rules(between(lines, start, end, doc), table, doc).select(doc, "index", F.get(tags, F.col("tag")).alias("tags"))


def question_tags(lines: DataFrame, doc: str = "doc_id", question: str = QUESTION, yes: str = YES, no: str = NO) -> DataFrame:
    """doc, index, tag: the first line after the question that holds Oui, and the first from there on that holds Non, the same one
    if it holds both. Documents without either give no row."""
    first = lambda word: F.min(F.when(F.contains("text", F.lit(word)), F.col("index"))).over(Window.partitionBy(doc))
    after = lines.filter(F.col(doc).isNotNull()).withColumn("_q", first(question)).filter(F.col("index") > F.col("_q"))
    non = after.withColumn("_y", first("Oui")).filter((F.col("index") >= F.col("_y")) & F.contains("text", F.lit("Non"))).groupBy(doc, "_y").agg(F.min("index").alias("_n"))
    both = F.array(F.struct(F.col("_y").alias("index"), F.lit(yes).alias("tag")), F.struct(F.col("_n").alias("index"), F.lit(no).alias("tag")))
    return non.select(doc, F.explode(both).alias("m")).select(doc, "m.index", "m.tag")


def turnover_tags(cell_rows: DataFrame, doc: str = "doc_id", table: int = TURNOVER_TABLE) -> DataFrame:
    """doc, table_index, row_index, column_index, tags of the cells of the turnover table, counted over its rows."""
    w = Window.partitionBy(doc).orderBy("row_index", "column_index")
    numbered = cell_rows.filter(F.col("table_index") == table).withColumn("_n", F.row_number().over(w) - 1)
    tags = F.create_map(*[c for n, t in TURNOVER.items() for c in (F.lit(n), F.array(*map(F.lit, t)))])
    return numbered.select(doc, "table_index", "row_index", "column_index", F.try_element_at(tags, F.col("_n")).alias("tags")).filter("tags is not null")


def member_tags(docs: DataFrame, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """doc, table_index, row_index, column_index, tags in the first table that opens after the member's markers: each label's first row
    takes its tags in the second cell, if it has one. Documents without markers or table give no row."""
    # The second marker counts from the first on.
    marked = docs.select(F.col(doc).alias("_m"), F.locate(MEMBER_MARKS[0], F.col(xml)).alias("_mark"), F.col(xml).alias("_x")).filter("_mark > 0")
    marked = marked.withColumn("_at", F.expr(f"locate('{MEMBER_MARKS[1]}', _x, _mark)")).filter("_at > 0").select("_m", "_at")
    tables = shuffled(elements(docs, doc, xml, ("tbl",))).join(marked, (F.col(doc) == F.col("_m")) & (F.col("start") >= F.col("_at")))
    first = tables.groupBy(F.col("_m")).agg(F.min("table_index").alias("_first"))
    inside = shuffled(cells(docs, doc, xml, text_limit=1 << 20)).join(first, (F.col(doc) == F.col("_m")) & (F.col("table_index") == F.col("_first")))
    rows = inside.groupBy(doc, "table_index", "row_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("column_index", "text"))), lambda c: c["text"]), " ").alias("text"), F.count("*").alias("n"))
    labels = F.array(*[F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, tags)).alias("tags")) for label, tags in MEMBER])
    hits = rows.select(doc, "table_index", "row_index", "n", "text", F.explode(labels).alias("r")).filter(F.contains("text", F.col("r.label")))
    best = hits.groupBy(doc, "r").agg(F.min_by(F.struct("table_index", "row_index", "n"), "row_index").alias("m")).filter("m.n >= 2")
    return best.select(doc, "m.table_index", "m.row_index", F.lit(1).alias("column_index"), "r.tags")


def _run(tags: Column, style: Column | None = None, between_tags: str = "</w:t><w:br/><w:t>") -> Column:
    """A run with tags, by default a line each."""
    texts = F.array_join(F.transform(tags, lambda t: F.concat(F.lit("{{"), t, F.lit("}}"))), between_tags)
    return F.concat(F.lit("<w:r>"), style if style is not None else F.lit(""), F.lit("<w:t>"), texts, F.lit("</w:t></w:r>"))


def _with_run(xml: Column, run: Column) -> Column:
    """A paragraph with its begin and its properties as they were, and one run."""
    begin = F.regexp_replace(F.regexp_extract(xml, r"^<w:p(?:\s[^>]*?)?/?>", 0), "/>$", ">")
    return F.concat(begin, F.regexp_extract(xml, r"(?s)<w:pPr>.*?</w:pPr>", 0), run, F.lit("</w:p>"))


#: Where a form's tags are put, in the order in which they count.
_KINDS = {"label": 0, "question": 1000, "cell": 2000}


def form_edits(docs: DataFrame, form: str, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """doc, nr, start, end, text, tags: the edits that tag a form, DC1, DC2 or AE. Tags of a label fill the empty paragraph behind it or, in
    DC2, stand in a new one after the label; those of the question follow the texts Oui and Non; those of cells take the place of
    the cell's first paragraph and keep its style."""
    # Documents are read once, and what is found is written: labels, question, cells and edits each look it up.
    # Forms are far larger than the rows they are made from, so these are dealt out first.
    dealt = docs.select(doc, xml).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), doc)
    found = materialize(elements(dealt, doc, xml, ("tc", "p")).withColumn("xml", F.when(F.col("name") == "p", F.col("xml"))), "form")
    paras = placed_paragraphs(found.filter("name = 'p'"), doc)
    boxes = found.filter("name = 'tc' and column_index is not null")
    lines = paras.select(doc, "index", "text")
    at = shuffled(paras).select(F.col(doc).alias("_d"), F.col("index").alias("_i"), F.col("xml").alias("_xml"), F.col("text").alias("_text"), "xml_start", "xml_end")
    here = (F.col(doc) == F.col("_d")) & (F.col("index") == F.col("_i"))
    out = []
    if form in LABELS:
        met = label_tags(lines, form, doc).join(at, here)
        empty = trim_all(F.col("_text")) == ""
        new = _with_run(F.col("_xml"), _run(F.col("tags")))
        met = met if form == "DC2" else met.filter(empty)
        out.append(met.select(doc, F.lit(_KINDS["label"]).alias("_k"), F.when(empty, F.col("xml_start")).otherwise(F.col("xml_end")).alias("start"), F.col("xml_end").alias("end"), new.alias("text"), "tags"))
    if form == "DC2":
        start, end, _ = LABELS[form]
        met = question_tags(between(lines, start, end, doc), doc).join(at, here)
        # Behind the run that holds the word: a run inside of a run would show nothing.
        word = F.when(F.col("tag") == YES, "Oui").otherwise("Non")
        upto = F.expr("coalesce(nullif(locate('</w:r>', _xml, locate(_word, _xml)), 0), locate('</w:t>', _xml, locate(_word, _xml)))")
        met = met.withColumn("_word", word).withColumn("_end", upto).filter("_end > 0")
        spot = F.col("xml_start") + F.col("_end") + 5
        run = F.concat(F.lit("<w:r><w:t> {{"), F.col("tag"), F.lit("}}</w:t></w:r>"))
        out.append(met.select(doc, F.lit(_KINDS["question"]).alias("_k"), spot.alias("start"), spot.alias("end"), run.alias("text"), F.array("tag").alias("tags")))
    places = {"DC2": lambda: turnover_tags(boxes, doc), "AE": lambda: member_tags(docs, doc, xml)}
    if form in places:
        cell = ["table_index", "row_index", "column_index"]
        first = paras.filter("table_index is not null").groupBy(F.col(doc).alias("_d"), *[F.col(c).alias(f"_{c}") for c in cell]).agg(F.min_by(F.struct("xml", "xml_start", "xml_end"), "index").alias("_first"))
        met = shuffled(places[form]()).join(first, (F.col(doc) == F.col("_d")) & (F.col("table_index") == F.col("_table_index")) & (F.col("row_index") == F.col("_row_index")) & (F.col("column_index") == F.col("_column_index")))
        style = F.regexp_extract("_first.xml", r"(?s)<w:rPr>.*?</w:rPr>", 0)
        out.append(met.select(doc, F.lit(_KINDS["cell"]).alias("_k"), F.col("_first.xml_start").alias("start"), F.col("_first.xml_end").alias("end"), _with_run(F.col("_first.xml"), _run(F.col("tags"), style, *[" au "] * (form == "DC2"))).alias("text"), "tags"))
    edits = reduce(DataFrame.unionByName, out)
    nr = F.row_number().over(Window.partitionBy(doc).orderBy("_k", "start", "text")) - 1
    return edits.withColumn("nr", nr).select(doc, "nr", "start", "end", "text", "tags")


def tag_form(docs: DataFrame, form: str, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """docs with a whole form tagged in one pass, and inserted, the tags that were put in, in the document's order. Documents that are no such
    form, or lack all of its marks, stay as they are."""
    edits = materialize(form_edits(docs, form, doc, xml), "form-edits")
    done = apply_edits(docs, edits.drop("tags"), doc, xml)
    tags = edits.groupBy(F.col(doc).alias("_t")).agg(F.array_sort(F.collect_list(F.struct("start", "nr", "tags"))).alias("_rows"))
    kept = F.filter("_rows", lambda r: ~F.array_contains("lost_edits", r["nr"]))
    inserted = F.coalesce(F.flatten(F.transform(kept, lambda r: r["tags"])), F.array().cast("array<string>"))
    return shuffled(done).join(tags, F.col(doc) == F.col("_t"), "left").select(*docs.columns, inserted.alias("inserted"))
