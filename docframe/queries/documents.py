"""Queries of whole-document operators: contexts, tagging, segmentation, metadata, answers of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions import geometry as G
from docframe.functions import text as X
from docframe.functions import xml as M
from docframe.operators import structure as S
from docframe.operators import tagging as T
from docframe.operators.segments import segment
from docframe.plans.agent import parse_response, unified_issues
from docframe.queries.registry import Tables, query
from docframe.queries.structure import _LINES, lines
from docframe.sources.docx import metadata


def _paragraph(text: Column) -> Column:
    return F.concat(F.lit("<w:p><w:r><w:t>"), X.escape_xml(text), F.lit("</w:t></w:r></w:p>"))


def _forms(t: Tables) -> DataFrame:
    texts = [F.lit("B - Candidat"), F.concat(F.lit("Libellé "), "n_name"), F.lit("{{NOM_COMMERCIAL}} suite"), F.concat("n_name", F.lit(" : {{DATE_FIN}}")), F.lit("{{CHECK_PME}}{{CA_1}}")]
    return t.nation.select(F.col("n_nationkey").alias("doc_id"), F.concat(F.lit("<w:body>"), *map(_paragraph, texts), F.lit("</w:body>")).alias("xml"))


@query(
    "tag_contexts",
    """select n_nationkey as doc_id, 2 as index, 'NOM_COMMERCIAL' as tag, 'B' as section, 'Libellé ' || n_name as label_before, 'suite' as label_after, 'text' as type, 'nom commercial dénomination sociale raison sociale' as hint from nation
       union all select n_nationkey, 3, 'DATE_FIN', 'B', n_name || ' :', '', 'date', '' from nation
       union all select n_nationkey, 4, 'CHECK_PME', 'B', 'Libellé ' || n_name, '', 'checkbox', 'PME petite moyenne entreprise artisan' from nation
       union all select n_nationkey, 4, 'CA_1', 'B', '', '', 'text', 'chiffre affaires exercice' from nation""",
)
def tag_contexts(t: Tables) -> DataFrame:
    return S.tag_rows(S.paragraphs(_forms(t))).select("doc_id", "index", "tag", "section", "label_before", "label_after", "type", "hint")


@query("target_paragraphs", "select n_nationkey as doc_id, i as index, case i when 0 then 'B - Candidat' when 1 then 'Libellé ' || n_name when 2 then '{{NOM_COMMERCIAL}} suite' when 3 then n_name || ' : {{DATE_FIN}}' else '{{CHECK_PME}}{{CA_1}}' end as text, 'B' as section, i >= 2 as has_tag from nation, range(5) r(i)")
def target_paragraphs(t: Tables) -> DataFrame:
    return S.paragraphs(_forms(t)).select("doc_id", F.col("index").cast("long").alias("index"), "text", "section", "has_tag")


@query("insert_tags", "select p_partkey, case p_size % 4 when 0 then p_brand || ' : {{T}}' when 1 then '{{T}}' when 2 then p_brand || ' label {{T}}' else '{{T}} %' end as text from part")
def insert_tags(t: Tables) -> DataFrame:
    k = F.col("p_size") % 4
    text = F.when(k == 0, F.concat("p_brand", F.lit(" :"))).when(k == 1, "").when(k == 2, F.concat("p_brand", F.lit(" label"))).otherwise("%")
    point = F.when(k == 0, "after_colon").when(k == 1, "replace_empty").otherwise("inline")
    return t.part.select("p_partkey", M.xml_text(T.insert_tag(_paragraph(text), F.lit("T"), point, k == 3)).alias("text"))


@query(
    "apply_matches",
    "select n_nationkey as doc_id, case when n_regionkey < 3 then n_name || ' : {{KEY}}' else n_name || ' :' end as text, n_regionkey < 3 as applied from nation",
)
def apply_matches(t: Tables) -> DataFrame:
    paras = t.nation.select(F.col("n_nationkey").alias("doc_id"), F.lit(0).alias("index"), _paragraph(F.concat("n_name", F.lit(" :"))).alias("xml"))
    matches = t.nation.filter("n_regionkey < 3").select(F.col("n_nationkey").alias("doc_id"), F.lit(0).alias("index"), F.lit("KEY").alias("tag"), F.lit("after_colon").alias("insertion_point"), F.lit(0).alias("ord"))
    return T.apply_matches(paras, matches).select("doc_id", M.xml_text(F.col("xml")).alias("text"), "applied")


@query(
    "rule_tagger",
    f"""with {_LINES}, h as (select user_id, event_id, tag, n, row_number() over (partition by user_id, tag order by event_id) as k from lines join (values ('click', 'FIRST', 1), ('A - ', 'SECOND', 2)) r(label, tag, n) on contains(text, label)),
        e as (select user_id, event_id, lead(event_id) over (partition by user_id order by event_id) as nxt from events) select user_id, tag, event_id as index from h where k = n""",
)
def rule_tagger(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([("click", "FIRST", 1), ("A - ", "SECOND", 2)], "label string, tag string, occurrence int")
    return T.apply_rules(lines(t).withColumnRenamed("event_id", "index"), rules, "user_id")


@query("date_pairs", "select l_orderkey as doc, 'P' || l_linenumber as base, l_partkey % 3 as place from lineitem group by all having count(distinct l_suppkey % 2) = 2")
def date_pairs(t: Tables) -> DataFrame:
    side = F.when(F.col("l_suppkey") % 2 == 0, "_DEBUT").otherwise("_FIN")
    rows = t.lineitem.select(F.col("l_orderkey").alias("doc"), (F.col("l_partkey") % 3).alias("place"), F.concat(F.lit("P"), F.col("l_linenumber").cast("string"), side).alias("tag"))
    return T.date_pairs(rows, "doc", "place").select("doc", "base", "place")


@query("date_ranges", "select n_nationkey, case when n_nationkey % 2 = 0 then 'Exercice du {{X_DEBUT}} au {{X_FIN}}' else 'Exercice ' || n_name end as text from nation")
def date_ranges(t: Tables) -> DataFrame:
    text = F.when(F.col("n_nationkey") % 2 == 0, "Exercice du ……… au ………").otherwise(F.concat(F.lit("Exercice "), "n_name"))
    return t.nation.select("n_nationkey", T.date_pair(text, F.lit("X_DEBUT"), F.lit("X_FIN")).alias("text"))


@query(
    "segment_documents",
    "select n_nationkey as doc_id, case when n_nationkey % 2 = 0 then 'table' else 'paragraph_group' end as type, case when n_nationkey % 2 = 0 then ['A'] else [] end[1] as tag, case when n_nationkey % 2 = 0 then 35 else 0 end as relevance from nation",
)
def segment_documents(t: Tables) -> DataFrame:
    table = "<w:tbl><w:tr><w:tc><w:p><w:t>" + "SIRET " * 20 + "{{A}}</w:t></w:p></w:tc></w:tr></w:tbl>"
    docs = t.nation.select(F.col("n_nationkey").alias("doc_id"), F.when(F.col("n_nationkey") % 2 == 0, table).otherwise("<w:p><w:t>short</w:t></w:p>").alias("xml"))
    return segment(docs).select("doc_id", "type", F.get("tags", F.lit(0)).alias("tag"), "relevance")


@query("document_metadata", "select n_name as path, n_name as title, case when n_nationkey % 2 = 0 then n_nationkey + 1 else 2 end as words, 1 as paragraphs, 3 as pages from nation")
def document_metadata(t: Tables) -> DataFrame:
    app = F.concat(F.lit("<Words>"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey") + 1).otherwise(0).cast("string"), F.lit("</Words><Pages>3</Pages>"))
    docs = t.nation.select(F.col("n_name").alias("path"), F.concat(F.lit("<dc:title>"), "n_name", F.lit("</dc:title>")).alias("core"), app.alias("app"), F.lit("<w:p><w:t>two</w:t><w:t>words</w:t></w:p>").alias("xml"))
    return metadata(docs).select("path", "title", "words", "paragraphs", "pages")


@query("model_answers", "select c_custkey as doc_id, 'T' || c_custkey as tag, c_custkey % 9 as place, case c_custkey % 3 when 0 then 0.8 when 1 then 0.9 end as confidence from customer where c_custkey % 3 < 2")
def model_answers(t: Tables) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    conf = F.when(F.col("c_custkey") % 3 == 0, "0").when(F.col("c_custkey") % 3 == 1, "0.9").otherwise("0.2")
    entry = F.concat(F.lit('{"tag": "T'), k, F.lit('", "paragraphIndex": '), (F.col("c_custkey") % 9).cast("string"), F.lit(', "confidence": '), conf, F.lit("}"))
    answer = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('Here:\n```json\n{"matches": ['), entry, F.lit("]}\n```"))).otherwise(F.concat(F.lit("["), entry, F.lit("]")))
    rows = t.customer.select(F.col("c_custkey").alias("doc_id"), answer.alias("response"))
    return parse_response(rows).select("doc_id", "tag", F.col("place").cast("long").alias("place"), "confidence")


@query(
    "mapping_issues",
    """with e as (select p_brand as doc_id, p_partkey as tag from part), m as (select * from e where tag % 3 = 0 and doc_id <> 'Brand#11'), n as (select doc_id, count(*) as n from e group by 1), l as (select doc_id, count(*) as l from e anti join m using (doc_id, tag) group by 1)
       select doc_id, 'missing_tags' as issue from n join l using (doc_id) where l > 0.3 * n""",
)
def mapping_issues(t: Tables) -> DataFrame:
    expected = t.part.select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("tag"))
    nothing = F.lit(None).cast("int")
    matches = expected.filter("tag % 3 = 0 and doc_id <> 'Brand#11'").select("*", F.col("tag").alias("place"), nothing.alias("table_index"), nothing.alias("row_index"), nothing.alias("column_index"))
    return unified_issues(matches, expected)


@query("image_types", "select n_nationkey, case n_nationkey % 5 when 0 then 'image/png' when 1 then 'image/jpeg' when 2 then 'image/gif' when 3 then 'image/bmp' end as kind from nation")
def image_types(t: Tables) -> DataFrame:
    k = F.col("n_nationkey") % 5
    head = F.unhex(F.when(k == 0, "89504E470D").when(k == 1, "FFD8FFE000").when(k == 2, "4749463839").when(k == 3, "424D000000").otherwise("0000000000"))
    return t.nation.select("n_nationkey", G.image_type(head).alias("kind"))


@query("option_checks", "select p_partkey, (p_size not between 6 and 72)::int + (p_size * 10 not between 0 and 200)::int as errors, regexp_matches('#' || left(md5(p_name), 6), '^#?[0-9A-Fa-f]{6}$') as colour from part")
def option_checks(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.size(G.option_errors(F.col("p_size"), F.col("p_size") * 10)).alias("errors"), G.is_hex_color(F.concat(F.lit("#"), F.left(F.md5("p_name"), F.lit(6)))).alias("colour"))


@query(
    "labels_match",
    """with w as (select p_partkey, list_filter(string_split(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: length(x) >= 3) as a, list_filter(string_split(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: length(x) >= 3) as b from part)
       select p_partkey, case when len(a) = 0 or len(b) = 0 then false else len(list_filter(a, lambda x: list_contains(b, x))) >= least(2, len(a), len(b)) end as same from w""",
)
def labels_match(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.labels_match(F.col("p_name"), F.col("p_type")).alias("same"))
