"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.functions import geometry as G
from docframe.functions import tags as K
from docframe.functions import text as X
from docframe.functions import xml as M
from docframe.queries.registry import Tables, query

ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;')"
STOP = "[" + ", ".join(f"'{w}'" for w in X.STOP_BASE) + "]"


@query("escape_xml", f"select page_id, {ESC.format('url')} as url, length({ESC.format('html')}) as n from pages")
def escape_xml(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.escape_xml(F.col("url")).alias("url"), F.length(X.escape_xml(F.col("html"))).cast("long").alias("n"))


_NORMAL = "trim(regexp_replace(replace(regexp_replace(regexp_replace(text, '[\\x{E000}-\\x{F8FF}]', '', 'g'), '[\\x00-\\x1F]', '', 'g'), chr(160), ' '), '\\s+', ' ', 'g'))"


@query("normalize_text", f"select doc_id, {_NORMAL} as text from documents")
def normalize_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.normalize_text(F.col("text")).alias("text"))


@query("truncate_text", "select doc_id, case when length(text) > 100 then left(text, 100) || '...' else text end as text from documents")
def truncate_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.truncate(F.col("text")).alias("text"))


@query(
    "word_char_counts",
    "select doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) as words, length(regexp_replace(text, '\\s', '', 'g')) as characters from documents",
)
def word_char_counts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.count_words(F.col("text")).cast("long").alias("words"), X.count_characters(F.col("text")).cast("long").alias("characters"))


@query(
    "text_predicates",
    """select page_id, regexp_matches(html, '[a-zA-ZÀ-ÿ]') as letters, regexp_matches('{{ID_' || page_id || '}}', '\\{\\{[A-Z_0-9]+\\}\\}') as tag,
       '{{' || upper(left(md5(url), 5)) || '}}' as wrapped, upper(left(md5(url), 5)) as bare from pages""",
)
def text_predicates(t: Tables) -> DataFrame:
    code = F.upper(F.left(F.md5("url"), F.lit(5)))
    tag = X.wrap_braces(F.concat(F.lit("ID_"), F.col("page_id").cast("string")))
    return t.pages.select("page_id", X.contains_letters(F.col("html")).alias("letters"), X.has_tag(tag).alias("tag"), X.wrap_braces(code).alias("wrapped"), X.strip_braces(X.wrap_braces(code)).alias("bare"))


@query("sanitize_names", "select p_partkey, left(trim(regexp_replace(upper(p_name || ' é!'), '[^A-Z0-9É]+', '_', 'g'), '_'), 1000) as dummy, left(trim(regexp_replace(replace(upper(p_name || ' é!'), 'É', 'E'), '[^A-Z0-9]+', '_', 'g'), '_'), 40) as tag from part")
def sanitize_names(t: Tables) -> DataFrame:
    raw = F.concat("p_name", F.lit(" é!"))
    dummy = F.left(F.regexp_replace(F.regexp_replace(F.upper(raw), "[^A-Z0-9É]+", "_"), "^_+|_+$", ""), F.lit(1000))
    return t.part.select("p_partkey", dummy.alias("dummy"), X.sanitize_tag_name(raw).alias("tag"))


_NAME_SQL = "case p_size % 8 when 0 then 'CHECK_' when 1 then 'DATE_' when 2 then 'MONTANT_' when 3 then 'PART_CA_' when 4 then 'ADRESSE_SIEGE_' when 5 then 'SIRET_' when 6 then 'EST_' else 'NOM_' end || upper(p_brand) || case when p_size % 5 = 0 then '_OUI' when p_size % 5 = 1 then '_FIN' else '' end"


def _names(t: Tables) -> DataFrame:
    first = F.when(F.col("p_size") % 8 == 0, "CHECK_")
    for i, name in enumerate(("DATE_", "MONTANT_", "PART_CA_", "ADRESSE_SIEGE_", "SIRET_", "EST_"), 1):
        first = first.when(F.col("p_size") % 8 == i, name)
    last = F.when(F.col("p_size") % 5 == 0, "_OUI").when(F.col("p_size") % 5 == 1, "_FIN").otherwise("")
    return t.part.select("p_partkey", F.concat(first.otherwise("NOM_"), F.upper("p_brand"), last).alias("name"))


_KIND_SQL = """case when starts_with(name, 'CHECK_') or starts_with(name, 'EST_') or contains(name, '_OUI') or contains(name, '_NON') then 'boolean'
    when contains(name, 'DATE') or contains(name, '_DEBUT') or contains(name, '_FIN') then 'date'
    when contains(name, 'MONTANT') or contains(name, 'PRIX') or contains(name, 'CA_') then 'number' else 'string' end"""


@query(
    "infer_tag_types",
    f"with n as (select p_partkey, {_NAME_SQL} as name from part), k as (select *, {_KIND_SQL} as data_type from n) select p_partkey, name, data_type, case data_type when 'boolean' then 'checkbox' when 'date' then 'date' else 'text' end as tag_type from k",
)
def infer_tag_types(t: Tables) -> DataFrame:
    return _names(t).select("p_partkey", "name", K.tag_data_type(F.col("name")).alias("data_type"), K.tag_type(F.col("name")).alias("tag_type"))


@query(
    "data_structure_defaults",
    f"with n as (select distinct {_NAME_SQL} as name from part), k as (select *, {_KIND_SQL} as data_type from n) select name, data_type, case data_type when 'boolean' then 'false' when 'number' then '0' else '\"\"' end as default_json from k",
)
def data_structure_defaults(t: Tables) -> DataFrame:
    return _names(t).select("name").distinct().select("name", K.tag_data_type(F.col("name")).alias("data_type"), K.default_json(F.col("name")).alias("default_json"))


_HINT_SQL = "case " + " ".join(f"when contains(name, '{k}') then '{v}'" for k, v in K.HINTS) + " else '' end"


@query("semantic_hints", f"with n as (select p_partkey, {_NAME_SQL} as name from part) select p_partkey, {_HINT_SQL} as hint from n")
def semantic_hints(t: Tables) -> DataFrame:
    return _names(t).select("p_partkey", K.semantic_hint(F.col("name")).alias("hint"))


@query(
    "distinct_tags",
    """with x as (select n_nationkey, ['{{' || upper(n_name) || '}}', '{{KEY}}', '{{REGION_' || n_regionkey || '}}', '{{KEY}}'] as tags from nation), y as (select n_nationkey, unnest(tags) as tag from x)
       select distinct n_nationkey, trim(tag, '{}') as tag from y where regexp_matches(tag, '^\\{\\{[A-Z_0-9]+\\}\\}$')""",
)
def distinct_tags(t: Tables) -> DataFrame:
    text = F.concat(F.lit("{{"), F.upper("n_name"), F.lit("}} and {{KEY}} of {{REGION_"), F.col("n_regionkey").cast("string"), F.lit("}} or {{KEY}} {{low}} {{OPEN"))
    return t.nation.select("n_nationkey", F.explode(K.distinct_tags(text)).alias("tag"))


@query("keyword_extract", f"select item_id, len(k) as n, array_to_string(k, ' ') as words from (select item_id, list_filter(string_split(regexp_replace(lower(text), '[^a-zà-ÿ]+', ' ', 'g'), ' '), lambda w: length(w) >= 3 and not list_contains({STOP}, w)) as k from benchmark)")
def keyword_extract(t: Tables) -> DataFrame:
    k = X.keywords(F.col("text"))
    return t.benchmark.select("item_id", F.size(k).cast("long").alias("n"), F.array_join(k, " ").alias("words"))


@query(
    "keyword_similarity",
    """with k as (select p_partkey, string_split(lower(p_name), ' ') as a, string_split(lower(p_type), ' ') as b from part)
       select p_partkey, round(len(list_filter(a, lambda x: len(list_filter(b, lambda y: contains(x, y) or contains(y, x))) > 0)) / greatest(len(a), len(b)), 6) as score from k""",
)
def keyword_similarity(t: Tables) -> DataFrame:
    a, b = F.split(F.lower("p_name"), " "), F.split(F.lower("p_type"), " ")
    return t.part.select("p_partkey", F.round(X.keyword_similarity(a, b), 6).alias("score"))


@query(
    "xml_text",
    "select n_nationkey, n_name || ' of ' || n_regionkey as text, n_name || '| of |' || n_regionkey as joined from nation",
)
def xml_text(t: Tables) -> DataFrame:
    run = lambda c: F.concat(F.lit('<w:r><w:t xml:space="preserve">'), c, F.lit("</w:t></w:r>"))
    xml = F.concat(F.lit("<w:p><w:pPr><w:tab/></w:pPr>"), run(F.col("n_name")), run(F.lit(" of ")), run(F.col("n_regionkey").cast("string")), F.lit("</w:p>"))
    return t.nation.select("n_nationkey", M.xml_text(xml).alias("text"), M.xml_text(xml, "|").alias("joined"))


@query(
    "xml_validate",
    "select n_nationkey, case n_nationkey % 4 when 0 then 'bracket_in_attribute' when 1 then 'tag_in_attribute' when 2 then 'unbalanced_body' end as error, case when n_nationkey % 4 = 2 then 1 else 0 end as critical from nation",
)
def xml_validate(t: Tables) -> DataFrame:
    k = F.col("n_nationkey") % 4
    xml = F.when(k == 0, '<w:body><w:p w:x="a<b"></w:p></w:body>').when(k == 1, '<w:body><w:p w:x="{{A}}"></w:p></w:body>').when(k == 2, "<w:body><w:p></w:p>").otherwise("<w:body><w:p></w:p></w:body>")
    critical = F.size(F.filter(M.document_errors(xml), lambda e: e["critical"]))
    return t.nation.select("n_nationkey", M.xml_error(xml).alias("error"), critical.cast("int").alias("critical"))


@query("xml_repair", "select n_nationkey, '<w:t>{{' || upper(n_name) || '}} x {{OK}}</w:t>' as xml from nation where regexp_matches(upper(n_name), '^[A-Z_0-9]+$')")
def xml_repair(t: Tables) -> DataFrame:
    xml = F.concat(F.lit("<w:t>{{"), F.upper("n_name"), F.lit(" x {{OK}}</w:t>\x01"))
    return t.nation.select("n_nationkey", M.repair(xml).alias("xml"))


@query(
    "paragraph_styles",
    "select p_partkey, case p_size % 6 when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 2 end as heading, case p_size % 3 when 0 then 'center' when 1 then 'justify' else 'left' end as align, p_size / 2.0 as size, case when p_size % 2 = 0 then true else false end as bold, p_size % 4 as list_level from part",
)
def paragraph_styles(t: Tables) -> DataFrame:
    k = F.col("p_size")
    style = F.when(k % 6 == 0, "Titre").when(k % 6 == 1, "heading 2").when(k % 6 == 2, "Titre3").when(k % 6 == 3, "Sous-titre").otherwise("Normal")
    jc = F.when(k % 3 == 0, "center").when(k % 3 == 1, "both").otherwise("start")
    p = F.concat(F.lit('<w:p><w:pPr><w:pStyle w:val="'), style, F.lit('"/><w:numPr><w:ilvl w:val="'), (k % 4).cast("string"), F.lit('"/></w:numPr><w:jc w:val="'), jc, F.lit('"/></w:pPr></w:p>'))
    run = F.concat(F.lit("<w:r><w:rPr>"), F.when(k % 2 == 0, "<w:b/>").otherwise("<w:bCs/>"), F.lit('<w:sz w:val="'), k.cast("string"), F.lit('"/></w:rPr></w:r>'))
    return t.part.select("p_partkey", M.heading_level(M.style_id(p)).alias("heading"), M.alignment(p).alias("align"), M.font_size(run).cast("double").alias("size"), M.is_bold(run).alias("bold"), M.list_item(p)["level"].alias("list_level"))


@query(
    "section_titles",
    "select n_nationkey, case n_nationkey % 3 when 0 then 'B' when 1 then '1' else upper(n_name) end as id, case n_nationkey % 3 when 0 then n_name when 1 then '2 ' || n_name else 'x' end as title, case when n_nationkey % 3 = 1 then 2 else 1 end as level from nation where regexp_matches(n_name, '^\\w+$')",
)
def section_titles(t: Tables) -> DataFrame:
    k = F.col("n_nationkey") % 3
    text = F.when(k == 0, F.concat(F.lit("B. "), "n_name")).when(k == 1, F.concat(F.lit("1.2 "), "n_name")).otherwise(F.concat(F.lit("Section "), "n_name", F.lit(" x")))
    info = M.section_info(text)
    return t.nation.select("n_nationkey", info["id"].alias("id"), info["title"].alias("title"), info["level"].alias("level"))


@query("unit_conversions", "select p_partkey, round(p_size * 2.83465, 6) as mm, p_size * 72 as inch, p_size / 20.0 as twip, round(p_size / 12700.0, 9) as emu, p_size - 12.0 >= 20 as fits from part")
def unit_conversions(t: Tables) -> DataFrame:
    s = F.col("p_size")
    return t.part.select("p_partkey", F.round(G.mm_to_points(s), 6).alias("mm"), G.inches_to_points(s).alias("inch"), G.twips_to_points(s).alias("twip"), F.round(G.emu_to_points(s), 9).alias("emu"), G.fits_on_page(s, F.lit(20), F.lit(12.0)).alias("fits"))


@query(
    "hex_to_rgb",
    "select p_partkey, ('0x' || substr(h, 1, 2))::int / 255.0 as r, ('0x' || substr(h, 3, 2))::int / 255.0 as g, ('0x' || substr(h, 5, 2))::int / 255.0 as b from (select p_partkey, left(md5(p_name), 6) as h from part)",
)
def hex_to_rgb(t: Tables) -> DataFrame:
    c = G.hex_to_rgb(F.concat(F.lit("#"), F.left(F.md5("p_name"), F.lit(6))))
    return t.part.select("p_partkey", c["r"].alias("r"), c["g"].alias("g"), c["b"].alias("b"))


@query("scale_to_fit", "select p_partkey, round(p_size * least(20.0 / p_size, 1000.0 / p_retailprice, 1.0), 6) as width, round(p_retailprice * least(20.0 / p_size, 1000.0 / p_retailprice, 1.0), 6) as height from part")
def scale_to_fit(t: Tables) -> DataFrame:
    s = G.scale_to_fit(F.col("p_size"), F.col("p_retailprice"), F.lit(20.0), F.lit(1000.0))
    return t.part.select("p_partkey", F.round(s["width"], 6).alias("width"), F.round(s["height"], 6).alias("height"))


@query(
    "text_measures",
    "select p_partkey, length(p_name) * 0.5 * 9 as width, coalesce((select max(s) / 2.0 from range(12, 19) x(s) where length(p_name) * 0.5 * s / 2.0 <= 100), 6.0) as size from part",
)
def text_measures(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", G.text_width(F.col("p_name"), F.lit(9)).cast("double").alias("width"), G.fitting_font_size(F.col("p_name"), F.lit(100)).alias("size"))


@query(
    "wrap_text",
    """with w as (select item_id, string_split(list_reduce(list_filter(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' '), lambda w: w <> ''), lambda acc, w: case when length(string_split(acc, chr(10))[-1] || ' ' || w) <= 80 then acc || ' ' || w else acc || chr(10) || w end), chr(10)) as lines from benchmark)
       select item_id, i as line, lines[i + 1] as text from (select *, unnest(range(len(lines))) as i from w)""",
)
def wrap_text(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", F.posexplode(X.wrap(F.col("text"), 80)).alias("line", "text")).withColumn("line", F.col("line").cast("long"))


@query(
    "pdf_field_types",
    """select p_partkey, case when regexp_matches(l, 'date|le |du ') then 'date' when regexp_matches(l, 'oui|non|cochez') then 'checkbox' when regexp_matches(l, 'montant|prix|€|nombre|n°|siret') then 'number'
       when regexp_matches(l, 'adresse|description|observations') then 'multiline' else 'text' end as field_type
       from (select p_partkey, lower(case p_size % 6 when 0 then 'Date du jour' when 1 then 'Cochez ' when 2 then 'Prix HT ' when 3 then 'Adresse ' when 4 then 'Article ' else '' end || p_brand) as l from part)""",
)
def pdf_field_types(t: Tables) -> DataFrame:
    k = F.col("p_size") % 6
    label = F.concat(F.when(k == 0, "Date du jour").when(k == 1, "Cochez ").when(k == 2, "Prix HT ").when(k == 3, "Adresse ").when(k == 4, "Article ").otherwise(""), "p_brand")
    return t.part.select("p_partkey", G.field_type(label).alias("field_type"))


@query("position_scores", "select p_partkey, case when d < 10 then 1.0 when d > 40 then 0.0 else 1 - d / 40.0 end as similarity, greatest(0.0, 1 - 5 * d / 100.0) as relative from (select p_partkey, p_size * 1.0::double as d from part)")
def position_scores(t: Tables) -> DataFrame:
    d = F.col("p_size").cast("double")
    return t.part.select("p_partkey", G.position_similarity(d, 20).alias("similarity"), G.relative_score(d / 100.0).alias("relative"))
