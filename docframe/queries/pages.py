"""Queries of page loops, transfer of tags to fields, forms and whole-document records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.functions import geometry as G
from docframe.functions import xml as X
from docframe.functions.text import STOP_FIELD
from docframe.operators import forms
from docframe.operators.edits import tag_documents
from docframe.operators import layout as L
from docframe.operators import matching as M
from docframe.operators import tagging as T
from docframe.operators.extract import extract
from docframe.plans import agent, pages
from docframe.queries.layout import _BOX_SQL, _FIRST_SQL, _TEXT_SQL, boxes
from docframe.queries.registry import Tables, query
from docframe.session import materialize

_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_FIELD) + "]"
_WORDS = f"list_filter(string_split(regexp_replace(lower({{0}}), '[^a-zà-ÿ]+', ' ', 'g'), ' '), lambda w: length(w) >= 3 and not list_contains({_STOP}, w))"
_ALIKE = "len(list_filter(a.w, lambda x: len(list_filter(b.w, lambda y: contains(x, y) or contains(y, x))) > 0)) / greatest(len(a.w), len(b.w))"

#: Tags and fields of an order are its lines, with the name of a part as label; every third line has the same tag.
_ORDER_SQL = f"""k as (select l_orderkey as doc_id, l_linenumber as ord, 'T' || (l_linenumber % 3) as tag, min(l_discount)::double as x, max(l_tax)::double as fx, min(l_partkey) as pk from lineitem group by all),
    e as (select k.*, {_WORDS.format("p_name || ' ' || p_type")} as w from k join part on pk = p_partkey)"""


def _order_tags(t: Tables) -> tuple[DataFrame, DataFrame]:
    k = t.lineitem.groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("ord")).agg(F.min("l_discount").cast("double").alias("x"), F.max("l_tax").cast("double").alias("fx"), F.min("l_partkey").alias("p_partkey"))
    e = k.join(t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("label")), "p_partkey").withColumn("tag", F.concat(F.lit("T"), (F.col("ord") % 3).cast("string")))
    zero, one = F.lit(0.0), F.lit(1)
    return e.select("doc_id", "ord", "tag", one.alias("page"), "x", zero.alias("y"), "label"), e.select("doc_id", one.alias("page"), F.col("ord").alias("fid"), F.col("fx").alias("x"), zero.alias("y"), "label")


@query("keyword_fields", f"with {_ORDER_SQL}, s as (select a.doc_id, a.ord as id, b.ord as fid, {_ALIKE} as score from e a join e b on a.doc_id = b.doc_id where len(a.w) > 0 and len(b.w) > 0), r as (select *, row_number() over (partition by doc_id, id order by score desc, fid) as n from s where score >= 0.7) select doc_id, id, fid, score from r where n = 1")
def keyword_fields(t: Tables) -> DataFrame:
    expected, fields = _order_tags(t)
    return M.keyword_fields(expected.select("doc_id", F.col("ord").alias("id"), "label"), fields.select("doc_id", "fid", "label"))


_MATCH_SQL = f"""{_ORDER_SQL}, firsts as (select doc_id, tag, min(ord) as ord from e group by all),
    s1 as (select a.doc_id, a.ord, a.tag, b.ord as fid, greatest(0.0, 1 - 5 * sqrt((a.x - b.fx) * (a.x - b.fx))) as score from e a join e b on a.doc_id = b.doc_id),
    m1 as (select * from (select *, row_number() over (partition by doc_id, ord order by score desc, fid) as n from s1 where score >= 0.8) where n = 1),
    d1 as (select doc_id, ord from firsts semi join m1 using (doc_id, tag)), o1 as (select * from e anti join d1 using (doc_id, ord)),
    s2 as (select a.doc_id, a.ord, a.tag, b.ord as fid, {_ALIKE} as score from o1 a join e b on a.doc_id = b.doc_id where len(a.w) > 0 and len(b.w) > 0),
    m2 as (select * from (select *, row_number() over (partition by doc_id, ord order by score desc, fid) as n from s2 where score >= 0.7) where n = 1),
    m as (select doc_id, ord, tag, fid, score as confidence, 'position' as stage from m1 union all select doc_id, ord, tag, fid, score, 'semantic' from m2)"""


def _matched(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    expected, fields = _order_tags(t)
    sizes = expected.select("doc_id", "page").distinct().select("*", F.lit(1.0).alias("width"), F.lit(1.0).alias("height"))
    return pages.match_fields(expected, fields, sizes)


@query("field_matches", f"with {_MATCH_SQL} select doc_id, ord, tag, fid, round(confidence, 9) as confidence, stage from m")
def field_matches(t: Tables) -> DataFrame:
    return _matched(t)[0].select("doc_id", "ord", "tag", "fid", F.round("confidence", 9).alias("confidence"), "stage")


@query("field_match_states", f"with {_MATCH_SQL}, d as (select doc_id, ord, true as done from firsts semi join m using (doc_id, tag)) select doc_id, ord, tag, case when done then 'matched' else 'pending' end as status, case when done is null then 'no_match' end as issue from e left join d using (doc_id, ord)")
def field_match_states(t: Tables) -> DataFrame:
    return _matched(t)[1].select("doc_id", "ord", "tag", "status", "issue")


@query("field_match_satisfaction", f"with {_MATCH_SQL}, d as (select doc_id, ord, 1 as done from firsts semi join m using (doc_id, tag)) select doc_id, count(*) as expected, count(done) as verified, floor(100 * count(done) / count(*) + 0.5)::int as percent from e left join d using (doc_id, ord) group by 1")
def field_match_satisfaction(t: Tables) -> DataFrame:
    return _matched(t)[2]


_FILL_SQL = f"""{_BOX_SQL}, {_TEXT_SQL}, ids as (select distinct doc_id from lines), hit as ({_FIRST_SQL}),
    a as (select doc_id, 'first' as field, floor(x + instr(text, ':') * width / length(text) + 8 + 0.5) as x, floor(y + 0.5) as y from hit where n = 1),
    ranked as (select *, lead(y) over (partition by doc_id order by y desc) as nexty from lines),
    b as (select doc_id, 'block' as field, 71.0 as x, floor(arg_max((y + nexty) / 2, y) + 0.5) as y from ranked where contains(text, 'w3') and nexty is not null and y - nexty >= 30 group by 1),
    p as (select * from a union all select * from b)"""


def _filled(t: Tables) -> tuple[DataFrame, DataFrame]:
    config = t.spark.createDataFrame([("first", ["w1", "w2"], "inline", None), ("block", ["w3"], "multiline", 30.0)], "field string, labels array<string>, type string, min_gap double")
    found = boxes(t)
    values = found.select("doc_id").distinct().select("doc_id", F.explode(F.array(F.lit("first"), F.lit("block"))).alias("field")).select("doc_id", "field", F.concat_ws(" ", "field", F.col("doc_id").cast("string")).alias("value"))
    return pages.fill_pages(found, values, config)


@query("page_fill_places", f"with {_FILL_SQL} select doc_id, field, x, y, field || ' ' || doc_id as value from p")
def page_fill_places(t: Tables) -> DataFrame:
    return _filled(t)[0].select("doc_id", "field", "x", "y", "value")


@query("page_fill_loop", f"with {_FILL_SQL} select ids.doc_id, 2 as expected, count(field) as verified, floor(50 * count(field) + 0.5)::int as percent, count(field) = 2 as success from ids left join p using (doc_id) group by 1")
def page_fill_loop(t: Tables) -> DataFrame:
    return _filled(t)[1]


@query("page_placement_report", "select o_orderkey as doc_id, 'f' as field, o_orderkey % 3 as page, case when o_orderstatus = 'F' then null else o_orderpriority end as value, case when o_orderstatus = 'F' then 'no_data' end as warning, case when o_orderstatus <> 'F' and o_orderkey % 3 = 0 then 'bad_page' end as error from orders")
def page_placement_report(t: Tables) -> DataFrame:
    """Documents of two pages: places on a page 0 are errors, places without data warnings."""
    matches = t.orders.select(F.col("o_orderkey").alias("doc_id"), F.lit("f").alias("field"), (F.col("o_orderkey") % 3).alias("page"))
    values = t.orders.filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("doc_id"), F.lit("f").alias("field"), F.col("o_orderpriority").alias("value"))
    sheets = t.orders.select(F.col("o_orderkey").alias("doc_id"), F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("page"))
    return L.placement_report(matches, values, sheets)


@query("page_extract", "select l_orderkey as doc_id, case when m >= 3 then 3 end as page, case when m < 3 then 'page 3 is not between 1 and ' || m end as error from (select l_orderkey, max(l_linenumber) as m, count(*) filter (l_linenumber = 3) as n from lineitem group by 1), range(greatest(n, 1)) where n > 0 or m < 3")
def page_extract(t: Tables) -> DataFrame:
    return L.extract_page(t.lineitem.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page")), 3)


_FORM_LINES = ["C1 - Cas général", "Nom commercial : rubrique", "Nom commercial :", "", "uméro SIRET", "uméro SIRET", "Le candidat est-il une micro, petite entreprise ?", "Oui", "Non", "C2 - Cas spécifiques", "Forme juridique"]


def _form_lines(t: Tables) -> DataFrame:
    """Every second nation's form has no empty line behind its name."""
    texts = F.array(*map(F.lit, _FORM_LINES))
    lines = t.nation.select(F.col("n_nationkey").alias("doc_id"), F.posexplode(texts).alias("index", "text"))
    return lines.withColumn("text", F.when((F.col("index") == 3) & (F.col("doc_id") % 2 == 1), "taken").otherwise(F.col("text")))


@query("form_label_tags", "select n_nationkey as doc_id, case when n_nationkey % 2 = 0 then 3 else 2 end as index, 'NOM_COMMERCIAL,DENOMINATION' as tags from nation union all select n_nationkey, 5, 'SIRET' from nation")
def form_label_tags(t: Tables) -> DataFrame:
    return forms.label_tags(_form_lines(t), "DC2").select("doc_id", "index", F.array_join("tags", ",").alias("tags"))


@query("form_question_tags", "select n_nationkey as doc_id, unnest([7, 8]) as index, unnest(['CHECK_PME_OUI', 'CHECK_PME_NON']) as tag from nation")
def form_question_tags(t: Tables) -> DataFrame:
    return forms.question_tags(_form_lines(t))


def _table(*rows: list) -> str:
    return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc><w:p><w:t>{c}</w:t></w:p></w:tc>" for c in r) + "</w:tr>" for r in rows) + "</w:tbl>"


@query("form_turnover_tags", "select n_nationkey as doc_id, r as row_index, c as column_index, ['CA_N_DEBUT,CA_N_FIN', 'CA_N1_DEBUT,CA_N1_FIN', 'CA_N2_DEBUT,CA_N2_FIN', 'CA_N', 'CA_N1', 'CA_N2', 'PART_CA_N', 'PART_CA_N1', 'PART_CA_N2'][(3 * r + c)::int] as tags from nation, range(3) a(r), range(1, 4) b(c)")
def form_turnover_tags(t: Tables) -> DataFrame:
    from docframe.operators.structure import cells

    xml = _table(["x"]) * forms.TURNOVER_TABLE + _table(*[["label", "", "", ""]] * 3)
    docs = t.nation.select(F.col("n_nationkey").alias("doc_id"), F.lit(xml).alias("xml"))
    return forms.turnover_tags(cells(docs)).select("doc_id", "row_index", "column_index", F.array_join("tags", ",").alias("tags"))


@query("form_member_tags", "select n_nationkey as doc_id, r as row_index, 1 as column_index, ['MEMBRE_NOM_COMMERCIAL,MEMBRE_DENOMINATION', 'MEMBRE_SIRET'][r::int] as tags from nation, range(1, 3) a(r) where n_nationkey % 2 = 0")
def form_member_tags(t: Tables) -> DataFrame:
    """Every second nation's form lacks the marker; a label without a second cell takes no tag."""
    tables = _table(["Nom commercial", ""]) + "<w:p><w:t>Membre du groupement</w:t></w:p>" + _table(["titre", ""], ["Nom commercial", ""], ["Numéro SIRET", "", ""], ["Téléphone"], ["Numéro SIRET", ""])
    mark = F.when(F.col("n_nationkey") % 2 == 0, "<w:p><w:t>[Tableau à reproduire autant de fois]</w:t></w:p>").otherwise("")
    docs = t.nation.select(F.col("n_nationkey").alias("doc_id"), F.concat(mark, F.lit(tables)).alias("xml"))
    return forms.member_tags(docs).select("doc_id", "row_index", "column_index", F.array_join("tags", ",").alias("tags"))


_EMPTY = '<w:p><w:pPr><w:jc w:val="left"/></w:pPr></w:p>'
_CELL = "<w:tc><w:tcPr/><w:p><w:r><w:rPr><w:b/></w:rPr><w:t>{}</w:t></w:r></w:p></w:tc>".format


def _line(text: str, more: str = "") -> str:
    return f"<w:p><w:r><w:t>{text}</w:t></w:r>{more}</w:p>"


#: A form in parts, each as it is and as it is tagged; # stands for the customer's name.
_DC2 = [
    *[(_line(x),) * 2 for x in ("Nom commercial", "C1 - Cas général", "Nom commercial : rubrique", "Nom commercial : #")],
    (_EMPTY, _EMPTY.replace("</w:p>", "<w:r><w:t>{{NOM_COMMERCIAL}}</w:t><w:br/><w:t>{{DENOMINATION}}</w:t></w:r></w:p>")),
    (_line("Adresses postale"), _line("Adresses postale") + "<w:p><w:r><w:t>{{ADRESSE}}</w:t><w:br/><w:t>{{ADRESSE_SIEGE}}</w:t></w:r></w:p>"),
    *[(_line(x),) * 2 for x in ("one", "two", "three", "#", "Le candidat est-il une micro, petite entreprise ?")],
    (_line("Oui"), _line("Oui", "<w:r><w:t> {{CHECK_PME_OUI}}</w:t></w:r>")),
    (_line("Non"), _line("Non", "<w:r><w:t> {{CHECK_PME_NON}}</w:t></w:r>")),
    *[(_line(x),) * 2 for x in ("C2 - Cas spécifiques", "Forme juridique")],
    *[(f"<w:tbl><w:tr>{_CELL(i)}</w:tr></w:tbl>",) * 2 for i in range(forms.TURNOVER_TABLE)],
    ("<w:tbl>", "<w:tbl>"),
    *[
        ("<w:tr>" + _CELL("#") + _CELL("") * 3 + "</w:tr>", "<w:tr>" + _CELL("#") + "".join(_CELL(x) for x in row) + "</w:tr>")
        for row in (["{{CA_N_DEBUT}} au {{CA_N_FIN}}", "{{CA_N1_DEBUT}} au {{CA_N1_FIN}}", "{{CA_N2_DEBUT}} au {{CA_N2_FIN}}"], ["{{CA_N}}", "{{CA_N1}}", "{{CA_N2}}"], ["{{PART_CA_N}}", "{{PART_CA_N1}}", "{{PART_CA_N2}}"])
    ],
    ("</w:tbl>", "</w:tbl>"),
]


def _form_sql(text: str) -> str:
    return "'" + text.replace("#", "' || c_name || '") + "'"


@query("form_tagged", f"select c_custkey as doc_id, {_form_sql(''.join(b for _, b in _DC2))} as xml, 18 as n from customer")
def form_tagged(t: Tables) -> DataFrame:
    """The whole XML of a form, tagged in one pass: labels, question and table of turnover."""
    parts = "".join(a for a, _ in _DC2).split("#")
    xml = F.concat(F.lit(parts[0]), *[c for p in parts[1:] for c in (F.col("c_name"), F.lit(p))])
    done = forms.tag_form(t.customer.select(F.col("c_custkey").alias("doc_id"), xml.alias("xml")), "DC2")
    return done.select("doc_id", "xml", F.size("inserted").alias("n"))


_ITEMS = "items as (select l_orderkey as doc_id, l_partkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as i from lineitem)"


def _tag_matches(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A document an order, a paragraph an item: one tag each, a second where 2 divides the part number, a period where 3 does. The first
    paragraph's tag is asked for a second time and so is one of a paragraph that is not there."""
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    grouped = t.lineitem.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_sort(F.collect_list(item)).alias("i"))
    # Documents and matches are made of the same items: these are sorted and written once.
    grouped = materialize(grouped.select("doc_id", F.transform("i", lambda x: x["l_partkey"]).alias("i")), "tag-items")
    text = lambda k, i: F.concat(F.lit("<w:p><w:r><w:t>Line "), i.cast("string"), F.when(k % 3 == 0, " du .... au ....").otherwise(" :"), F.lit("</w:t></w:r></w:p>"))
    docs = grouped.select("doc_id", F.concat(F.lit("<w:body>"), F.array_join(F.transform("i", text), ""), F.lit("</w:body>")).alias("xml"))
    rows = grouped.select("doc_id", F.posexplode("i").alias("index", "k"))
    name = F.col("index").cast("string")
    point = lambda p: F.lit(p).alias("insertion_point")
    period = rows.filter("k % 3 = 0").select("doc_id", "index", F.explode(F.array(F.concat(F.lit("P"), name, F.lit("_DEBUT")), F.concat(F.lit("P"), name, F.lit("_FIN")))).alias("tag"), F.lit(5).alias("ord"), point("after_colon"))
    first = rows.filter("k % 3 <> 0").select("doc_id", "index", F.concat(F.lit("T"), name).alias("tag"), F.lit(0).alias("ord"), point("after_colon"))
    second = rows.filter("k % 2 = 0").select("doc_id", "index", F.concat(F.lit("U"), name).alias("tag"), F.lit(1).alias("ord"), point("inline"))
    again = rows.filter("index = 0 and k % 3 <> 0").select("doc_id", "index", F.lit("T0").alias("tag"), F.lit(9).alias("ord"), point("inline"))
    away = rows.filter("index = 0").select("doc_id", F.lit(1000).alias("index"), F.lit("AWAY").alias("tag"), F.lit(0).alias("ord"), point("inline"))
    return docs, reduce(DataFrame.unionByName, [period, first, second, again, away])


@query(
    "tagged_documents",
    f"""with {_ITEMS} select doc_id, '<w:body>' || string_agg('<w:p><w:r><w:t>Line ' || i || case when l_partkey % 3 = 0 then ' du {{{{P' || i || '_DEBUT}}}} au {{{{P' || i || '_FIN}}}}' else ' : {{{{T' || i || '}}}}' end
        || case when l_partkey % 2 = 0 then ' {{{{U' || i || '}}}}' else '' end || '</w:t></w:r></w:p>', '' order by i) || '</w:body>' as xml from items group by doc_id""",
)
def tagged_documents(t: Tables) -> DataFrame:
    """Whole documents with several tags in a paragraph."""
    docs, matches = _tag_matches(t)
    return tag_documents(docs, matches)[0]


@query(
    "tagged_documents_report",
    f"""with {_ITEMS}, r as (
          select doc_id, 'applied' as status, i from items where l_partkey % 3 <> 0 union all select doc_id, 'applied', i from items where l_partkey % 3 = 0 union all select doc_id, 'applied', i from items where l_partkey % 3 = 0
          union all select doc_id, 'paragraph_changed', i from items where l_partkey % 2 = 0
          union all select doc_id, 'already_used', i from items where i = 0 and l_partkey % 3 <> 0 union all select doc_id, 'no_paragraph', i from items where i = 0)
        select doc_id, status, count(*) as n from r group by all""",
)
def tagged_documents_report(t: Tables) -> DataFrame:
    """What became of every match where a paragraph takes one tag, or a period."""
    docs, matches = _tag_matches(t)
    return tag_documents(docs, matches, several=False)[1].groupBy("doc_id", "status").agg(F.count("*").alias("n"))


@query("date_range_fallbacks", """select n_nationkey, n_name || case n_nationkey % 4 when 0 then ' du {{A}} au {{B}} fin' when 1 then ' du {{A}} au {{B}}' when 2 then ' du {{A}} au {{B}}fin' else ' {{A}} au {{B}}' end as text from nation""")
def date_range_fallbacks(t: Tables) -> DataFrame:
    """Dots in one text, dots over several texts, nothing between du and au, neither."""
    k = F.col("n_nationkey") % 4
    open_, close = F.lit("<w:p><w:r><w:t>"), F.lit("</w:t></w:r></w:p>")
    text = F.when(k == 0, " du ..... au …… fin").when(k == 1, " du </w:t></w:r><w:r><w:t>....</w:t></w:r><w:r><w:t> au ...").when(k == 2, " du au fin").otherwise("")
    return t.nation.select("n_nationkey", X.xml_text(T.date_pair_xml(F.concat(open_, F.col("n_name"), text, close), F.lit("A"), F.lit("B"))).alias("text"))


@query("extract_documents", """select n_name as path, n_regionkey < 4 as success, case when n_regionkey < 4 then 3 end as elements, case when n_regionkey < 4 then 'heading,paragraph,paragraph' end as kinds, case when n_regionkey < 4 then 1 end as tables,
    case when n_regionkey < 4 then 2 end as columns, case when n_regionkey < 4 then 'h1,h2,' || n_name || ',2' end as texts, case when n_regionkey < 4 then 1 end as headings, case when n_regionkey < 4 then n_name end as title from nation""")
def extract_documents(t: Tables) -> DataFrame:
    para = lambda text: F.concat(F.lit("<w:p><w:t>"), text, F.lit("</w:t></w:p>"))
    cell = lambda text: F.concat(F.lit("<w:tc>"), para(text), F.lit("</w:tc>"))
    row = lambda a, b: F.concat(F.lit("<w:tr>"), cell(a), cell(b), F.lit("</w:tr>"))
    xml = F.concat(F.lit('<w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:t>Title</w:t></w:p>'), para(F.col("n_name")), F.lit("<w:tbl>"), row(F.lit("h1"), F.lit("h2")), row(F.col("n_name"), F.lit("2")), F.lit("</w:tbl>"), para(F.lit("end")))
    sound = F.col("n_regionkey") < 4
    docs = t.nation.select(F.col("n_name").alias("path"), F.when(sound, xml).alias("xml"), F.when(sound, F.concat(F.lit("<dc:title>"), "n_name", F.lit("</dc:title>"))).alias("core"), F.lit(None).cast("string").alias("app"), F.when(~sound, "damaged").alias("error"))
    first = F.get("tables", F.lit(0))
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    return extract(docs).select("path", "success", size("elements").alias("elements"), F.array_join(F.transform("elements", lambda x: x["kind"]), ",").alias("kinds"), size("tables").alias("tables"), first["max_columns"].alias("columns"), F.array_join(first["texts"], ",").alias("texts"), F.col("stats.headings").alias("headings"), F.col("metadata.title").alias("title"))


@query("mapping_issues_all", """select n_nationkey as doc_id, 'unlike_place' as issue from nation where n_regionkey = 0 union all select n_nationkey, 'both_checked' from nation where n_regionkey = 1
    union all select n_nationkey, 'unlike_template' from nation where n_regionkey = 2 union all select n_nationkey, 'missing_tags' from nation where n_regionkey = 3""")
def mapping_issues_all(t: Tables) -> DataFrame:
    """Each region's documents show one issue."""
    n, r = F.col("n_nationkey").alias("doc_id"), F.col("n_regionkey")
    nothing = [F.lit(None).cast("int").alias(c) for c in ("table_index", "row_index", "column_index")]
    expected = t.nation.select(n, F.lit("T").alias("tag"), F.lit("nom commercial complet").alias("label"))
    matches = t.nation.filter(r != 3).select(n, F.lit("T").alias("tag"), F.lit(4).alias("place"), *nothing)
    paras = t.nation.select(n, F.lit(4).alias("place"), F.when(r == 0, "adresse").otherwise("Nom Commercial :").alias("text"), F.lit(False).alias("is_cell"))
    boxes_ = F.array(F.struct(F.lit(0).alias("ord"), F.lit(" Oui").alias("label"), (r <= 1).alias("checked")), F.struct(F.lit(1).alias("ord"), F.lit("non ").alias("label"), (r != 0).alias("checked")))
    decisions = t.nation.select(n, F.explode(boxes_).alias("b")).select("doc_id", "b.*")
    pairs = t.nation.select(n, F.when(r <= 1, True).when(r == 2, True).otherwise(False).alias("value"))
    return agent.unified_issues(matches, expected, paras=paras, decisions=decisions, pairs=pairs)


@query("answers_of_pages", """select c_custkey as doc_id, 'A' as field, 1 as page, case when c_custkey % 2 = 0 then 71.0 else 5.0 end as x, 7.0 as y, case when c_custkey % 2 = 0 then 'multiline' else 'inline' end as type, 0.8 as confidence from customer""")
def answers_of_pages(t: Tables) -> DataFrame:
    """Answers without x, fenced or bare; entries without y are left out."""
    full = '{"positions": [{"tag": "A", "page": 1, "x": 5, "y": 7, "type": "inline"}, {"tag": "B", "page": 1}]}'
    bare = 'So: ```json\n{"positions": [{"tag": "A", "page": 1, "y": 7, "type": "other", "confidence": 0}]}\n```'
    rows = t.customer.select(F.col("c_custkey").alias("doc_id"), F.when(F.col("c_custkey") % 2 == 0, bare).otherwise(full).alias("response"))
    return pages.parse_positions(rows)


@query("answers_of_fields", "select c_custkey as doc_id, 'A' as tag, 'f1' as fid, case c_custkey % 3 when 0 then 0.7 else 0.5 end as confidence from customer where c_custkey % 3 < 2")
def answers_of_fields(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 3
    entry = F.when(k == 0, "").when(k == 1, ', "confidence": 0.5').otherwise(', "confidence": 0.4')
    answer = F.concat(F.lit('{"matches": [{"tag": "B"}, {"tag": "A", "fieldId": "f1"'), entry, F.lit("}]}"))
    return pages.parse_fields(t.customer.select(F.col("c_custkey").alias("doc_id"), answer.alias("response")))


@query("answers_of_checkboxes", "select c_custkey as doc_id, c_custkey % 7 as target_index, 'Oui' as label, c_custkey % 2 = 0 as checked, 0.8 as confidence from customer")
def answers_of_checkboxes(t: Tables) -> DataFrame:
    """Both spellings; entries without a decision or of little confidence are left out."""
    even = F.col("c_custkey") % 2 == 0
    at = (F.col("c_custkey") % 7).cast("string")
    one = F.concat(F.lit('{"checkboxes": [{"targetIdx": '), at, F.lit(', "label": "Oui", "checked": true}, {"targetIdx": 1}]}'))
    two = F.concat(F.lit('{"checkboxDecisions": [{"idx": '), at, F.lit(', "label": "Oui", "shouldBeChecked": false}, {"idx": 1, "checked": true, "confidence": 0.6}]}'))
    rows = t.customer.select(F.col("c_custkey").alias("doc_id"), F.when(even, one).otherwise(two).alias("response"))
    return agent.parse_decisions(rows).withColumn("target_index", F.col("target_index").cast("long"))


@query("table_format_checks", "select p_partkey, p_size % 3 = 2 as bad from part")
def table_format_checks(t: Tables) -> DataFrame:
    kind = F.when(F.col("p_size") % 3 == 0, "array").when(F.col("p_size") % 3 == 1, "objects").otherwise("rows")
    return t.part.select("p_partkey", (F.size(G.table_format_errors(kind)) > 0).alias("bad"))
