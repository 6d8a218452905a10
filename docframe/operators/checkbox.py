"""Checkboxes of documents: extraction, Oui/Non pairs, tags, matching and setting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions import xml as X
from docframe.functions.text import checkbox_label, collapse, fold_label, is_non, is_oui, sanitize_tag_name, trim_all
from docframe.operators.matching import contained_words

#: Signs of set and of empty boxes.
CHECKED, UNCHECKED = "☑✓✔☒■", "☐□○◯◻"
NEAR = 5
#: Least score of a match by words; FIND_SCORE is that of the looser search for one box.
MIN_SCORE, FIND_SCORE = 10, 4


def extract(paras: DataFrame, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """One row for each distinct sign of a paragraph, set ones first, and one for its form control: doc, index, ord, checked,
    type, label, section."""
    text = X.field_text(F.col(xml))
    signs = F.array(*[F.struct(F.lit(s).alias("sign"), F.lit(s in CHECKED).alias("checked")) for s in CHECKED + UNCHECKED])
    base = paras.select(doc, "index", text.alias("text"), F.col(xml).alias("_x"))
    boxes = F.filter(signs, lambda s: F.contains(F.col("text"), s["sign"]))
    section = F.nullif(F.regexp_extract("text", r"^([A-Z])\s*[-–—:.]", 1), F.lit(""))
    plain = F.left(trim_all(F.translate(F.col("text"), CHECKED + UNCHECKED, "")), F.lit(100))
    unicode_rows = base.select(doc, "index", section.alias("section"), plain.alias("label"), F.posexplode(boxes).alias("ord", "b")).select(doc, "index", "ord", "b.checked", F.lit("unicode").alias("type"), "label", "section")
    control = F.left(collapse(F.regexp_replace("text", "(?i)FORMCHECKBOX", "")), F.lit(100))
    form_rows = base.filter(F.col("_x").contains("FORMCHECKBOX")).select(
        doc, "index", F.lit(len(CHECKED + UNCHECKED)).alias("ord"), X.form_checked(F.col("_x")).alias("checked"), F.lit("formcontrol").alias("type"), control.alias("label"), section.alias("section")
    )
    return unicode_rows.unionByName(form_rows)


def question(label: Column, number: Column) -> Column:
    bare = collapse(F.regexp_replace(F.regexp_replace(label, "(?i)oui|non", ""), "[☐☑□■]", ""))
    return F.left(F.when(F.length(bare) < 10, F.concat(F.lit("Question_"), (number + 1).cast("string"))).otherwise(bare), F.lit(60))


def pairs(boxes: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Oui/Non boxes at most NEAR paragraphs apart, taken greedily in order; value is true, false, or null if the boxes agree."""
    w = Window.partitionBy(doc).orderBy("index", "ord")
    label = checkbox_label(F.col("label"))
    numbered = boxes.withColumn("n", F.row_number().over(w) - 1).withColumn("kind", F.when(is_oui(label), "oui").when(is_non(label), "non"))
    sides = numbered.filter("kind is not null").select(doc, "n", "index", "kind", "checked", question(F.col("label"), F.col("n")).alias("question"))

    # A fold over a document's boxes in order: one of the other kind that still waits, the first, goes with the next box near it.
    box = F.struct("n", "index", "kind", "checked", "question")
    row = "struct<question:string,index:int,oui_index:int,non_index:int,value:boolean>"
    waiting = "array<struct<n:int,index:int,kind:string,checked:boolean,question:string>>"
    start = F.struct(F.array().cast(waiting).alias("waiting"), F.array().cast(f"array<{row}>").alias("out"))

    def step(state: Column, b: Column) -> Column:
        near = F.filter(state["waiting"], lambda a: b["index"] - a["index"] <= NEAR)
        mate = F.get(F.filter(near, lambda a: a["kind"] != b["kind"]), F.lit(0))
        oui = lambda name: F.when(b["kind"] == "oui", b[name]).otherwise(mate[name])
        non = lambda name: F.when(b["kind"] == "oui", mate[name]).otherwise(b[name])
        value = F.when(oui("checked") & ~non("checked"), True).when(non("checked") & ~oui("checked"), False)
        made = F.struct(mate["question"].alias("question"), mate["index"].alias("index"), oui("index").alias("oui_index"), non("index").alias("non_index"), value.alias("value"))
        left = F.when(mate.isNull(), F.concat(near, F.array(b))).otherwise(F.filter(near, lambda a: a["n"] != mate["n"]))
        return F.struct(left.cast(waiting).alias("waiting"), F.when(mate.isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(made.cast(row)))).alias("out"))

    boxes_of = sides.groupBy(doc).agg(F.array_sort(F.collect_list(box.cast("struct<n:int,index:int,kind:string,checked:boolean,question:string>"))).alias("b"))
    return boxes_of.select(doc, F.explode(F.aggregate("b", start, step, lambda state: state["out"])).alias("m")).select(doc, "m.*")


def checkbox_tags(boxes: DataFrame, paired: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row a tag: pairs by their question, then boxes outside paired paragraphs by their label; the last counts."""
    p = paired.select(doc, sanitize_tag_name(F.col("question")).alias("tag"), F.coalesce("value", F.lit(False)).alias("checked"), F.lit("boolean_pair").alias("type"), F.struct(F.lit(0).alias("late"), F.col("index").alias("index"), F.lit(0).alias("ord")).alias("at"))
    used = paired.select(doc, F.explode(F.array("oui_index", "non_index")).alias("index")).distinct()
    label = F.when(F.col("label") == "", F.concat(F.lit("CHECKBOX_"), F.col("index").cast("string"))).otherwise(F.col("label"))
    s = boxes.join(used, [doc, "index"], "left_anti").select(doc, sanitize_tag_name(label).alias("tag"), "checked", F.lit("boolean_single").alias("type"), F.struct(F.lit(1).alias("late"), F.col("index").alias("index"), F.col("ord").alias("ord")).alias("at"))
    last = F.max_by(F.struct("checked", "type"), "at")
    return p.unionByName(s).groupBy(doc, "tag").agg(last.alias("m")).select(doc, "tag", "m.checked", "m.type")


def _ordinal_pairs(templates: DataFrame, targets: DataFrame, group: str) -> DataFrame:
    def numbered(rows: DataFrame, name: str) -> DataFrame:
        label = checkbox_label(F.col("label"))
        kind = F.when(is_oui(label), "oui").when(is_non(label), "non")
        w = Window.partitionBy(group, "kind").orderBy("index", "ord")
        return rows.withColumn("kind", kind).filter("kind is not null").withColumn("nth", F.row_number().over(w)).select(group, "kind", "nth", *[F.col(c).alias(f"{name}_{c}") for c in ("index", "ord", "checked")])

    return numbered(templates, "template").join(numbered(targets, "target"), [group, "kind", "nth"])


def match_by_ordinal(templates: DataFrame, targets: DataFrame, group: str) -> DataFrame:
    """The nth Oui (Non) box of a template goes with the nth of the target."""
    return _ordinal_pairs(templates, targets, group).drop("template_ord", "target_ord")


def match_by_score(templates: DataFrame, targets: DataFrame, group: str, least: int = MIN_SCORE, once: bool = False) -> DataFrame:
    """Each template box with the target box of its group that holds most of its words of three letters or more, by their length:
    group, template_index, template_ord, target_index, target_ord, score, checked (the template's). The first target counts on
    ties; a target may serve several templates, or with `once` (the semantic fallback) the first of them.

    Labels are compared, not boxes: of equal labels of a group's targets the first is the best, so a label that stands at very many
    boxes is one row, and only labels of which one holds a word of the other meet. Rows without a group match nothing."""
    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(group, F.col("index").alias(f"{name}_index"), F.col("ord").alias(f"{name}_ord"), "checked", fold_label(F.col("label")).alias(f"{name}_label"))

    boxes = side(templates, "template")
    first = side(targets, "target").groupBy(group, "target_label").agg(F.min(F.struct("target_index", "target_ord")).alias("_at"))
    asked = F.filter(F.split("template_label", " "), lambda w: F.length(w) >= 3)
    words = boxes.select(group, "template_label").distinct().select(group, "template_label", F.explode(asked).alias("word")).groupBy(group, "template_label", "word").agg(F.sum(F.length("word")).alias("_weight"))
    tokens = first.select(group, "target_label", F.explode(F.array_distinct(F.split("target_label", " "))).alias("token"))
    hits = words.join(contained_words(words, tokens), "word").join(tokens, [group, "token"]).select(group, "template_label", "target_label", "word", "_weight").distinct()
    scored = hits.groupBy(group, "template_label", "target_label").agg(F.sum("_weight").cast("int").alias("score")).filter(F.col("score") >= least)
    best = F.max_by(F.struct("_at", "score"), F.struct("score", -F.col("_at.target_index"), -F.col("_at.target_ord")))
    chosen = scored.join(first, [group, "target_label"]).groupBy(group, "template_label").agg(best.alias("_m"))
    top = boxes.join(chosen, [group, "template_label"]).select(group, "template_index", "template_ord", F.col("_m._at.target_index").alias("target_index"), F.col("_m._at.target_ord").alias("target_ord"), F.col("_m.score").alias("score"), "checked")
    if not once:
        return top
    kept = F.min_by(F.struct("template_index", "template_ord", "score", "checked"), F.struct("template_index", "template_ord"))
    return top.groupBy(group, "target_index", "target_ord").agg(kept.alias("_k")).select(group, "_k.template_index", "_k.template_ord", "target_index", "target_ord", "_k.score", "_k.checked")


def match_boxes(templates: DataFrame, targets: DataFrame, group: str, least: int = MIN_SCORE) -> DataFrame:
    """Oui and Non boxes by their ordinal, with score 100; the boxes that leaves over by their words."""
    by_ordinal = _ordinal_pairs(templates, targets, group)
    def rest(rows: DataFrame, name: str) -> DataFrame:
        used = by_ordinal.select(group, F.col(f"{name}_index").alias("index"), F.col(f"{name}_ord").alias("ord"))
        return rows.join(used, [group, "index", "ord"], "left_anti")

    sure = by_ordinal.select(group, "template_index", "template_ord", "target_index", "target_ord", F.lit(100).alias("score"), F.col("template_checked").alias("checked"))
    return sure.unionByName(match_by_score(rest(templates, "template"), rest(targets, "target"), group, least))


def set_sign(text: Column, checked: Column) -> Column:
    """The first sign of a text set or emptied."""
    return F.when(checked, F.regexp_replace(text, f"^([^{UNCHECKED}]*)[{UNCHECKED}]", "$1☑")).otherwise(F.regexp_replace(text, f"^([^{CHECKED}]*)[{CHECKED}]", "$1☐"))


def set_form(paragraph: Column, checked: Column) -> Column:
    value = F.when(checked, "1").otherwise("0")
    out = F.regexp_replace(paragraph, F.lit(r'(<w:default\s+w:val=")\d(")'), F.concat(F.lit("$1"), value, F.lit("$2")))
    return F.regexp_replace(out, F.lit(r'(w14:checked w14:val=")\d(")'), F.concat(F.lit("$1"), value, F.lit("$2")))


def apply_decisions(paras: DataFrame, decisions: DataFrame, doc: str = "doc_id", xml: str = "xml") -> DataFrame:
    """Paragraphs with the first decision for them carried out: decisions doc, index, ord, checked."""
    first = decisions.groupBy(doc, "index").agg(F.min_by("checked", "ord").alias("_c"))
    joined = paras.join(first, [doc, "index"], "left")
    done = F.when(F.col(xml).contains("FORMCHECKBOX"), set_form(F.col(xml), F.col("_c"))).otherwise(set_sign(F.col(xml), F.col("_c")))
    return joined.withColumn(xml, F.when(F.col("_c").isNull(), F.col(xml)).otherwise(done)).drop("_c")


def consecutive_conflicts(decisions: DataFrame, group: str) -> DataFrame:
    """Neighbouring Oui and Non decisions that are both set."""
    w = Window.partitionBy(group).orderBy("index", "ord")
    label = checkbox_label(F.col("label"))
    kind = F.when(is_oui(label), 1).when(is_non(label), -1).otherwise(0)
    rows = decisions.withColumn("_k", kind).withColumns({"_nk": F.lead("_k").over(w), "_nc": F.lead("checked").over(w)})
    return rows.filter((F.col("_k") * F.col("_nk") == -1) & F.col("checked") & F.col("_nc")).drop("_k", "_nk", "_nc")
