"""Queries of generators, windows, tables and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions import xml as X
from docframe.functions.text import escape_xml
from docframe.operators import structure as S
from docframe.operators import segments as G
from docframe.operators.segments import MIN_SEGMENT, best_segments, buyer_name, content_flags, document_type, long_words, merge_small, relevance, section_of, strategy
from docframe.queries.registry import Tables, query
from docframe.session import shuffled
from docframe.sources.pages import html_elements

_LINE_SQL = "case event_id % 11 when 0 then chr(65 + (event_id % 7)::int) || ' - ' || event_type when 3 then '{{TAG}}' when 5 then 'ab' else event_type || ' ' || user_id end"
_LINES = f"lines as (select user_id, event_id, {_LINE_SQL} as text from events)"


def lines(t: Tables) -> DataFrame:
    k = F.col("event_id") % 11
    marker = F.concat(F.char((65 + F.col("event_id") % 7).cast("int")), F.lit(" - "), "event_type")
    text = F.when(k == 0, marker).when(k == 3, "{{TAG}}").when(k == 5, "ab").otherwise(F.concat("event_type", F.lit(" "), F.col("user_id").cast("string")))
    return t.events.select("user_id", "event_id", text.alias("text"))


@query(
    "detect_section_carry",
    f"with {_LINES} select user_id, event_id, coalesce(last_value(nullif(regexp_extract(text, '^([A-Z])\\s*[-–:]', 1), '') ignore nulls) over (partition by user_id order by event_id rows unbounded preceding), '') as section from lines",
)
def detect_section_carry(t: Tables) -> DataFrame:
    return S.carry_sections(lines(t), "user_id", "event_id", "text").select("user_id", "event_id", "section")


@query(
    "label_lookback",
    f"with {_LINES} select user_id, event_id, coalesce(left(last_value(case when length(trim(text)) > 3 and not regexp_matches(text, '\\{{\\{{[A-Z_0-9]+\\}}\\}}') and regexp_matches(text, '[a-zA-ZÀ-ÿ]') then trim(text) end ignore nulls) over (partition by user_id order by event_id rows between 5 preceding and 1 preceding), 150), '') as label from lines",
)
def label_lookback(t: Tables) -> DataFrame:
    return S.label_lookback(lines(t), "user_id", "event_id", "text").select("user_id", "event_id", "label")


for _tag, _name in (("h1", "html_headings"), ("p", "html_paragraphs"), ("li", "html_list_items")):

    @query(
        _name,
        f"""with x as (select page_id, regexp_extract_all(html, '(?s)<{_tag}(?: [^>]*)?>(.*?)</{_tag}>', 1) as a from pages), y as (select page_id, unnest(range(len(a))) as index, a from x)
            select page_id, index, trim(regexp_replace(a[index + 1], '<[^>]+>', '', 'g'), ' ') as text from y""",
    )
    def _elements(t: Tables, tag: str = _tag) -> DataFrame:
        return html_elements(t.pages, tag).select("page_id", F.col("index").cast("long").alias("index"), "text")


_ELEMENT_SQL = "elements as (select user_id, event_id, case event_id % 7 when 0 then 'heading' when 1 then 'list' when 2 then 'list' else 'paragraph' end as kind, case when event_id % 7 = 0 then 1 + event_id % 3 end as level, event_type || ' ' || value as text from events)"


def elements(t: Tables) -> DataFrame:
    k = F.col("event_id") % 7
    kind = F.when(k == 0, "heading").when(k.isin(1, 2), "list").otherwise("paragraph")
    return t.events.select("user_id", "event_id", kind.alias("kind"), F.when(k == 0, 1 + F.col("event_id") % 3).alias("level"), "event_type")


@query(
    "section_hierarchy",
    f"""with {_ELEMENT_SQL}, h as (select *, sum((kind = 'heading')::int) over (partition by user_id order by event_id rows unbounded preceding) as nh, lag(kind) over (partition by user_id order by event_id) as before from elements)
        select user_id, event_id, sum((kind = 'heading' and (level = 1 or nh = 1))::int) over w as section_id, case when kind = 'list' then sum((kind = 'list' and coalesce(before, '') <> 'list')::int) over w end as list_run from h
        window w as (partition by user_id order by event_id rows unbounded preceding)""",
)
def section_hierarchy(t: Tables) -> DataFrame:
    return S.section_hierarchy(elements(t), "user_id", "event_id").select("user_id", "event_id", F.col("section_id").cast("long").alias("section_id"), F.col("list_run").cast("long").alias("list_run"))


@query(
    "heading_parents",
    f"""with {_ELEMENT_SQL} select user_id, event_id, (select max(h.event_id) from elements h where h.user_id = e.user_id and h.kind = 'heading' and h.event_id < e.event_id and (e.kind <> 'heading' or h.level < e.level)) as parent from elements e""",
)
def heading_parents(t: Tables) -> DataFrame:
    return S.heading_parents(elements(t), "user_id", "event_id").select("user_id", "event_id", "parent")


@query(
    "section_tree",
    f"""with {_ELEMENT_SQL}, h as (select *, sum((kind = 'heading')::int) over (partition by user_id order by event_id rows unbounded preceding) as nh, lag(kind) over (partition by user_id order by event_id) as before from elements),
        r as (select *, sum((kind = 'heading' and (level = 1 or nh = 1))::int) over w as own, sum((kind = 'list' and coalesce(before, '') <> 'list')::int) over w as run from h window w as (partition by user_id order by event_id rows unbounded preceding)),
        m as (select *, case when own = 0 and bool_and(kind = 'list') over (partition by user_id, own) then coalesce(min(case when own > 0 then own end) over (partition by user_id), 0) else own end as section,
          own > 0 and row_number() over (partition by user_id, own order by event_id) = 1 as opens from r),
        u as (select user_id, section, opens, min(event_id) as pos, case kind when 'list' then 'list(' || string_agg(split_part(text, ' ', 1), ',' order by event_id) || ')' when 'heading' then 'h' || any_value(level) || ':' || any_value(split_part(text, ' ', 1)) else any_value(split_part(text, ' ', 1)) end as shown
          from m group by user_id, section, opens, kind, case when kind = 'list' then 'l' || run else 'e' || event_id end),
        s as (select user_id, section, coalesce(max(case when opens then split_part(shown, ':', 2) end), 'Introduction') as title, coalesce(string_agg(shown, ';' order by pos) filter (where not opens), '') as content from u group by all)
        select user_id, string_agg(title || '[' || content || ']', '|' order by section) as tree from s group by 1""",
)
def section_tree(t: Tables) -> DataFrame:
    """The nested sections of each user's events, written as text."""
    tree = S.section_tree(elements(t).withColumnRenamed("event_type", "text"), "user_id", "event_id")
    one = lambda c: F.when(c["kind"] == "list", F.concat(F.lit("list("), F.array_join(F.transform(c["items"], lambda i: i["text"]), ","), F.lit(")"))).when(c["kind"] == "heading", F.concat(F.lit("h"), c["level"].cast("string"), F.lit(":"), c["text"])).otherwise(c["text"])
    shown = F.transform("sections", lambda s: F.concat(s["title"], F.lit("["), F.array_join(F.transform(s["content"], one), ";"), F.lit("]")))
    return tree.select("user_id", F.array_join(shown, "|").alias("tree"))


@query("heading_levels", f"with {_ELEMENT_SQL} select user_id, level, count(*) as n from elements where kind = 'heading' group by all")
def heading_levels(t: Tables) -> DataFrame:
    return S.heading_counts(elements(t), "user_id")


@query(
    "page_stats",
    f"with {_ELEMENT_SQL} select user_id, count_if(kind = 'heading') as headings, count_if(kind = 'list') as list_items, count_if(kind = 'paragraph') as paragraphs, count(*) as elements, count(*) as words, sum(length(regexp_replace(e.event_type, '\\s', '', 'g'))) as characters from elements join (select event_id as ei, event_type from events) e on ei = event_id group by 1",
)
def page_stats(t: Tables) -> DataFrame:
    return S.element_stats(elements(t), "user_id", text="event_type")


def order_tables(t: Tables) -> DataFrame:
    """A table per order: a header row, then a row per item, ordered by all columns."""
    cell = lambda c: F.concat(F.lit("<w:tc><w:tcPr/><w:p><w:r><w:t>"), c.cast("string"), F.lit("</w:t></w:r></w:p></w:tc>"))
    row = lambda *c: F.concat(F.lit("<w:tr>"), *map(cell, c), F.lit("</w:tr>"))
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    grouped = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("i"))
    body = F.array_join(F.transform("i", lambda x: row(x["l_linenumber"], x["l_partkey"], F.when(x["l_linenumber"] % 3 == 0, "").otherwise(x["l_returnflag"]))), "")
    head = row(F.lit("Line"), F.lit("Part &amp; more"), F.lit("Flag"))
    return grouped.select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("<w:body><w:tbl><w:tblPr/>"), head, body, F.lit("</w:tbl></w:body>")).alias("xml"))


_CELLS = """items as (select l_orderkey as doc_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as row_index, l_linenumber, l_partkey, case when l_linenumber % 3 = 0 then '' else l_returnflag end as flag from lineitem),
    cells as (select doc_id, row_index, 0 as column_index, l_linenumber::varchar as text from items union all select doc_id, row_index, 1, l_partkey::varchar from items union all select doc_id, row_index, 2, flag from items
      union all select doc_id, 0, unnest([0, 1, 2]), unnest(['Line', 'Part & more', 'Flag']) from (select distinct doc_id from items))"""


@query(
    "table_cells",
    f"""with {_CELLS} select doc_id, row_index, column_index, text, text = '' as is_empty, first_value(text) over (partition by doc_id, row_index order by column_index) as row_header,
        case when row_index > 0 then first_value(text) over (partition by doc_id, column_index order by row_index) else '' end as column_header from cells""",
)
def table_cells(t: Tables) -> DataFrame:
    rows = S.cells(order_tables(t)).filter("table_index = 0")
    return rows.select("doc_id", F.col("row_index").cast("long").alias("row_index"), "column_index", "text", "is_empty", "row_header", "column_header")


@query("table_to_objects", f"with {_CELLS} select doc_id, row_index, max(case when column_index = 0 then text end) as line, max(case when column_index = 1 then text end) as part, max(case when column_index = 2 then text end) as flag from cells where row_index > 0 group by all")
def table_to_objects(t: Tables) -> DataFrame:
    rows = S.table_objects(S.cells(order_tables(t), headers=False))
    return rows.select("doc_id", F.col("row_index").cast("long").alias("row_index"), F.col("data")["Line"].alias("line"), F.col("data")["Part & more"].alias("part"), F.col("data")["Flag"].alias("flag"))


_NESTED_ITEMS = """items as (select o_orderkey as doc_id, l_partkey, l_suppkey, l_linestatus, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as i from orders join lineitem on l_orderkey = o_orderkey),
    numbered as (select *, sum((l_partkey % 3 = 0)::int) over (partition by doc_id order by i rows unbounded preceding) as inner_table from items)"""


def _nested(docs: DataFrame, deep: bool) -> DataFrame:
    """A table an order, a row an item of `i`; every item whose part number 3 divides has a table in its second cell, before the cell's own text,
    and, where deep, with a table in the first cell of that one. A value that is null is an empty cell."""
    text = lambda c: F.concat(F.lit("<w:p><w:r><w:t>"), F.coalesce(escape_xml(c.cast("string")), F.lit("")), F.lit("</w:t></w:r></w:p>"))
    cell = lambda *c: F.concat(F.lit("<w:tc>"), *c, F.lit("</w:tc>"))
    table = lambda *c: F.concat(F.lit("<w:tbl><w:tr>"), *c, F.lit("</w:tr></w:tbl>"))
    last = lambda x: [table(cell(text(x["l_linenumber"])))] if deep else []
    inner = lambda x: F.when(x["l_partkey"] % 3 == 0, table(cell(*last(x), text(x["l_suppkey"])), cell(text(F.lit("in"))))).otherwise("")
    row = lambda x: F.concat(F.lit("<w:tr>"), cell(text(x["l_partkey"])), cell(inner(x), text(x["l_linestatus"])), F.lit("</w:tr>"))
    rows = F.coalesce(F.array_join(F.transform("i", row), ""), F.lit(""))
    return docs.select("doc_id", F.concat(F.lit("<w:body>"), text(F.lit("first")), F.lit("<w:tbl>"), rows, F.lit("</w:tbl>"), text(F.lit("last")), F.lit("</w:body>")).alias("xml"))


_ITEM = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def nested_tables(t: Tables) -> DataFrame:
    """A document an order, of those without items and of those that are known by their items alone too, with tables three deep."""
    grouped = t.lineitem.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct(*_ITEM))).alias("i"))
    orders = t.orders.select(F.col("o_orderkey").alias("doc_id")).distinct()
    return _nested(shuffled(orders).join(grouped, "doc_id", "full"), deep=True)


def _nested_orders(t: Tables) -> DataFrame:
    """A document an order that has items, with tables two deep."""
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return _nested(joined.groupBy(F.col("o_orderkey").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct(*_ITEM))).alias("i")), deep=False)


@query(
    "nested_tables",
    """with items as (select l_orderkey as doc_id, l_linenumber, l_partkey, l_suppkey, l_linestatus, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as i from lineitem),
        numbered as (select *, 2 * sum((l_partkey % 3 = 0)::int) over (partition by doc_id order by i rows unbounded preceding) as deepest from items),
        c as (select doc_id, 0 as table_index, i as row_index, 0 as column_index, l_partkey::varchar as text, null::int as parent_table, null::bigint as parent_row, null::int as parent_column from items
          union all select doc_id, 0, i, 1, l_linestatus, null, null, null from items
          union all select doc_id, deepest - 1, 0, 0, l_suppkey::varchar, 0, i, 1 from numbered where l_partkey % 3 = 0
          union all select doc_id, deepest - 1, 0, 1, 'in', 0, i, 1 from numbered where l_partkey % 3 = 0
          union all select doc_id, deepest, 0, 0, l_linenumber::varchar, deepest - 1, 0, 0 from numbered where l_partkey % 3 = 0)
        select doc_id, table_index, row_index, column_index, coalesce(text, '') as text, parent_table, parent_row, parent_column from c""",
)
def nested_table_cells(t: Tables) -> DataFrame:
    """Every cell of every item's tables, whole, with the cell that holds its table."""
    rows = S.cells(nested_tables(t), headers=False, text_limit=2**31 - 1)
    return rows.select("doc_id", "table_index", "row_index", "column_index", "text", "parent_table", F.col("parent_row").cast("long").alias("parent_row"), "parent_column")


@query(
    "nested_paragraphs",
    f"""with {_NESTED_ITEMS}, n as (select *, sum(2 + 2 * (l_partkey % 3 = 0)::int) over (partition by doc_id order by i rows unbounded preceding) as upto from numbered),
        p as (select doc_id, upto - 2 * (l_partkey % 3 = 0)::int - 1 as index, l_partkey::varchar as text, 0 as table_index, i as row_index, 0 as column_index from n
          union all select doc_id, upto, l_linestatus, 0, i, 1 from n
          union all select doc_id, upto - 2, l_suppkey::varchar, inner_table, 0, 0 from n where l_partkey % 3 = 0
          union all select doc_id, upto - 1, 'in', inner_table, 0, 1 from n where l_partkey % 3 = 0
          union all select doc_id, 0, 'first', null, null, null from n group by 1
          union all select doc_id, max(upto) + 1, 'last', null, null, null from n group by 1)
        select doc_id, index::bigint as index, text, table_index, row_index, column_index from p""",
)
def nested_paragraphs(t: Tables) -> DataFrame:
    """Paragraphs with their cells, those of nested tables too."""
    return S.paragraphs_with_cells(_nested_orders(t)).select("doc_id", F.col("index").cast("long").alias("index"), "text", "table_index", "row_index", "column_index")


@query("header_row_detection", "select l_orderkey as doc_id, true as is_header from lineitem group by 1")
def header_row_detection(t: Tables) -> DataFrame:
    return S.header_rows(S.cells(order_tables(t), headers=False)).select("doc_id", "is_header")


_TAGGED_XML = "'<w:body><w:p><w:r><w:t>Nom du client ' || c_name || ' :</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>{{NOM_COMMERCIAL}} et {{DATE_FIN}}</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p><w:t>' || repeat('x', 60) || ' {{NOM_COMMERCIAL}}</w:t></w:p></w:body>'"


def _tagged_docs(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("doc_id"), F.expr(_TAGGED_XML).alias("xml"))


@query(
    "template_tags",
    f"""with x as (select c_custkey as doc_id, {_TAGGED_XML} as xml from customer), g as (select * from x, (values (0, 'NOM_COMMERCIAL', 'string'), (1, 'DATE_FIN', 'date')) v(ord, tag, data_type)),
        p as (select *, '{{{{' || tag || '}}}}' as full_tag, strpos(xml, '{{{{' || tag || '}}}}') as pos from g),
        c as (select *, substr(xml, greatest(pos - 200, 1), least(pos - 1, 200) + length(full_tag) + 100) as part from p)
        select doc_id, ord, tag, data_type, left(trim(replace(array_to_string(regexp_extract_all(part, '<w:t(?: [^>]*)?>([^<]*)</w:t>', 1), ''), full_tag, '')), 100) as context from c""",
)
def template_tags(t: Tables) -> DataFrame:
    return S.template_tags(_tagged_docs(t))


@query(
    "found_tags",
    f"""with x as (select c_custkey as doc_id, {_TAGGED_XML} as xml from customer), n as (select *, strpos(xml, '{{{{NOM') - 1 as a, strpos(xml, '{{{{DATE') - 1 as b from x), m as (select *, a + strpos(substr(xml, a + 2), '{{{{NOM') as c from n),
        p as (select doc_id, xml, 0 as ord, 'NOM_COMMERCIAL' as tag, a as at_, 0 as place from m union all select doc_id, xml, 1, 'DATE_FIN', b, 0 from m union all select doc_id, xml, 2, 'NOM_COMMERCIAL', c, null from m)
        select doc_id, ord, tag, at_ as "at", trim(regexp_replace(regexp_replace(substr(xml, greatest(at_ - 99, 1), least(at_, 100) + length(tag) + 104), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) as context,
          place as table_index, place as row_index, place as column_index from p""",
)
def found_tags(t: Tables) -> DataFrame:
    """Every place of a tag with its context and cell."""
    return S.found_tags(_tagged_docs(t)).withColumn("at", F.col("at").cast("long"))


@query(
    "paragraph_headers",
    f"with {_CELLS}, h as (select *, first_value(text) over (partition by doc_id, row_index order by column_index) as row_header, case when row_index > 0 then first_value(text) over (partition by doc_id, column_index order by row_index) else '' end as column_header from cells) select doc_id, row_index::bigint as row_index, column_index, text, row_header, column_header from h",
)
def paragraph_headers(t: Tables) -> DataFrame:
    """Paragraphs of cells with the headers of their cell."""
    return S.paragraphs_with_headers(order_tables(t)).select("doc_id", F.col("row_index").cast("long").alias("row_index"), "column_index", "text", "row_header", "column_header")


_BOXES = "boxes as (select l_orderkey as doc_id, l_linenumber as column_index, min(l_partkey % 500) as s, max(l_partkey % 500 + 40) as e from lineitem group by all), paras as (select l_orderkey as doc_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as index, l_suppkey % 500 as s from lineitem)"


def _boxes(t: Tables) -> DataFrame:
    start = F.col("l_partkey") % 500
    agg = t.lineitem.groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("column_index")).agg(F.min(start).alias("xml_start"), F.max(start + 40).alias("xml_end"))
    return agg.withColumns({"table_index": F.lit(0), "row_index": F.lit(0), "text": F.lit("")})


def _paras(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    s = F.col("l_suppkey") % 500
    return t.lineitem.select(F.col("l_orderkey").alias("doc_id"), (F.row_number().over(w) - 1).alias("index"), s.alias("xml_start"), (s + 5).alias("xml_end"), F.lit("p").alias("text"))


@query("paragraph_in_cell", f"with {_BOXES} select p.doc_id, p.index, min(b.column_index) as column_index from paras p left join boxes b on b.doc_id = p.doc_id and p.s >= b.s and p.s + 5 <= b.e group by all")
def paragraph_in_cell(t: Tables) -> DataFrame:
    return S.paragraphs_in_cells(_paras(t), _boxes(t)).select("doc_id", F.col("index").cast("long").alias("index"), "column_index")


@query(
    "empty_cells_added",
    f"""with {_BOXES}, placed as (select p.doc_id, p.index, min(b.column_index) as column_index from paras p left join boxes b on b.doc_id = p.doc_id and p.s >= b.s and p.s + 5 <= b.e group by all),
        missing as (select doc_id, column_index from boxes b where not exists (select 1 from placed p where p.doc_id = b.doc_id and p.column_index = b.column_index)), n as (select doc_id, count(*) as n from paras group by 1)
        select doc_id, column_index, index from placed union all select m.doc_id, m.column_index, n + row_number() over (partition by m.doc_id order by m.column_index) - 1 from missing m join n using (doc_id)""",
)
def empty_cells_added(t: Tables) -> DataFrame:
    placed = S.paragraphs_in_cells(_paras(t), _boxes(t))
    return S.add_empty_cells(placed, _boxes(t)).select("doc_id", "column_index", F.col("index").cast("long").alias("index"))


@query("nth_label_occurrence", "select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by event_id) as n from events where contains(event_type, 'c')) where n = 2")
def nth_label_occurrence(t: Tables) -> DataFrame:
    return S.nth_occurrence(t.events, "user_id", "event_id", "event_type", "c", 2).select("user_id", "event_id")


@query("relative_indices", "select o_custkey, o_orderkey, dense_rank() over (partition by o_custkey, o_orderstatus order by o_orderpriority) - 1 as relative_table, row_number() over (partition by o_custkey, o_orderstatus order by o_orderkey) - 1 as relative_index from orders")
def relative_indices(t: Tables) -> DataFrame:
    out = S.relative_tables(t.orders, "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey")
    return out.select("o_custkey", "o_orderkey", F.col("relative_table").cast("long").alias("relative_table"), F.col("relative_index").cast("long").alias("relative_index"))


@query("paragraph_offsets", "select n_nationkey, 0 as index, n_name as text, 8 as xml_start from nation union all select n_nationkey, 1, '', 8 + 34 + length(n_name) from nation union all select n_nationkey, 2, 'A - ' || n_name, 8 + 34 + length(n_name) + 6 + 3 from nation")
def paragraph_offsets(t: Tables) -> DataFrame:
    p = lambda c: F.concat(F.lit("<w:p ><w:r><w:t>"), c, F.lit("</w:t></w:r></w:p>"))
    xml = F.concat(F.lit("<w:body>"), p(F.col("n_name")), F.lit("<w:p/>"), F.lit("gap"), p(F.concat(F.lit("A - "), "n_name")), F.lit("</w:body>"))
    out = S.paragraphs(t.nation.select(F.col("n_nationkey").alias("doc_id"), xml.alias("xml")))
    return out.select(F.col("doc_id").alias("n_nationkey"), "index", "text", F.col("xml_start").cast("long").alias("xml_start"))


_TYPE_SQL = "p_name || ' ' || case p_size % 6 when 0 then 'lettre de candidature DC1 - ' when 1 then 'DC2 - capacité économique et financière' when 2 then 'acte d''engagement' when 3 then 'compte bancaire' when 4 then 'habilitation du mandataire compte à créditer' else '' end"


def _typed(t: Tables) -> DataFrame:
    k = F.col("p_size") % 6
    text = F.when(k == 0, "lettre de candidature DC1 - ").when(k == 1, "DC2 - capacité économique et financière").when(k == 2, "acte d'engagement").when(k == 3, "compte bancaire").when(k == 4, "habilitation du mandataire compte à créditer").otherwise("")
    return t.part.select("p_partkey", F.concat("p_name", F.lit(" "), text).alias("text"))


@query(
    "document_type_score",
    f"""with x as (select p_partkey, lower({_TYPE_SQL}) as t from part), s as (select p_partkey, 15 * regexp_matches(t, 'lettre\\s+de\\s+candidature')::int + 15 * regexp_matches(t, 'dc\\s*1\\s*[-–]')::int + 10 * contains(t, 'habilitation du mandataire')::int as a,
        15 * regexp_matches(t, 'déclaration\\s+du\\s+candidat\\s+individuel')::int + 15 * regexp_matches(t, 'dc\\s*2\\s*[-–]')::int + 8 * contains(t, 'capacité économique et financière')::int as b,
        15 * regexp_matches(t, 'acte\\s+d[''’]?\\s*engagement')::int + 10 * (contains(t, 'compte à créditer') or contains(t, 'compte bancaire'))::int as c from x)
        select p_partkey, case when greatest(a, b, c) < 5 then 'UNKNOWN' when a >= b and a >= c then 'DC1' when b >= c then 'DC2' else 'AE' end as kind from s""",
)
def document_type_score(t: Tables) -> DataFrame:
    return _typed(t).select("p_partkey", document_type(F.col("text")).alias("kind"))


@query("buyer_names", "select n_nationkey, 'Ville de ' || chr(65 + n_nationkey) || ' sur Seine' as buyer from nation")
def buyer_names(t: Tables) -> DataFrame:
    text = F.concat(F.lit("Pouvoir  adjudicateur : Ville de "), F.char(65 + F.col("n_nationkey")), F.lit(" sur Seine. Objet"))
    return t.nation.select("n_nationkey", buyer_name(text).alias("buyer"))


_SEGMENTS = f"with x as (select doc_id, unnest(string_split(text, chr(10))) as text from documents), s as (select doc_id, text from x where length(trim(text, ' ')) >= {MIN_SEGMENT})"


def _line_segments(t: Tables) -> DataFrame:
    """Documents whose lines are pages, cut at their breaks; what is shorter than a segment goes."""
    run = lambda x: F.concat(F.lit("<w:p><w:r><w:t>"), x, F.lit("</w:t></w:r></w:p>"))
    docs = t.documents.select("doc_id", F.array_join(F.transform(F.split("text", "\n"), run), '<w:br w:type="page"/>').alias("xml"))
    return G.by_pages(docs).filter(F.length(F.trim("text")) >= MIN_SEGMENT)


@query("segments_by_page", f"{_SEGMENTS} select doc_id, length(text) as n, md5(text) as digest from s")
def segments_by_page(t: Tables) -> DataFrame:
    return _line_segments(t).select("doc_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("digest"))


@query("segment_stats", f"{_SEGMENTS} select doc_id, count(*) as segments, count(*) as paragraphs, 0 as with_tags, 0 as tags, sum(length(text)) as characters, max(length(text)) as longest from s group by 1")
def segment_stats(t: Tables) -> DataFrame:
    found = _line_segments(t)
    sizes = found.groupBy("doc_id").agg(F.sum(F.length("text")).alias("characters"), F.max(F.length("text")).cast("long").alias("longest"))
    return G.segment_stats(found).join(sizes, "doc_id")


@query(
    "segment_merge_small",
    """with recursive l as (select doc_id, row_number() over (partition by doc_id order by i) as n, t from (select doc_id, unnest(string_split(text, chr(10))) as t, generate_subscripts(string_split(text, chr(10)), 1) as i from documents)),
       f as (select doc_id, n, t as cur, 1 as seg from l where n = 1 union all
         select f.doc_id, l.n, case when length(f.cur) < 100 or length(l.t) < 100 then f.cur || chr(10) || l.t else l.t end, case when length(f.cur) < 100 or length(l.t) < 100 then f.seg else f.seg + 1 end from f join l on l.doc_id = f.doc_id and l.n = f.n + 1)
       select doc_id, seg, arg_max(md5(cur), n) as digest from f group by all""",
)
def segment_merge_small(t: Tables) -> DataFrame:
    merged = merge_small(F.split("text", "\n"))
    return t.documents.select("doc_id", F.posexplode(merged).alias("seg", "x")).select("doc_id", (F.col("seg") + 1).alias("seg"), F.md5("x").alias("digest"))


@query(
    "segment_similarity_top1",
    """with p as (select p_partkey, p_brand, p_size, list_distinct(list_filter(string_split_regex(lower(p_name || ' ' || p_type), '\\s+'), lambda w: length(w) > 4)) as words from part),
       s as (select a.p_partkey as template, b.p_partkey as target, least(100.0, case when a.p_size % 8 = b.p_size % 8 then 40 else 0 end + case when a.p_size % 5 = b.p_size % 5 then 30 else 0 end
         + case when len(a.words) > 0 then least(20.0, len(list_intersect(a.words, b.words)) / len(a.words) * 20) else 0.0 end) as score from p a join p b on a.p_brand = b.p_brand),
       r as (select *, row_number() over (partition by template order by score desc, target) as n from s where score >= 30) select template, target, round(score, 6) as score from r where n = 1""",
)
def segment_similarity_top1(t: Tables) -> DataFrame:
    none = F.struct(*[F.lit(False).alias(n) for n in ("financial", "contact", "identification")])
    s = F.struct(
        F.char((65 + F.col("p_size") % 8).cast("int")).alias("letter"), none.alias("flags"), F.lit("table").alias("type"), (F.col("p_size") % 5).alias("table_index"),
        long_words(F.concat_ws(" ", "p_name", "p_type")).alias("words"),
    )
    rows = t.part.select("p_brand", F.col("p_partkey").alias("ord"), s.alias("s"))
    return best_segments(rows, rows, "p_brand").select("template", "target", F.round("score", 6).alias("score"))


_FLAG_SQL = "regexp_matches({0}, '(?i)chiffre\\s*d''affaires|CA\\s|exercice\\s*du|montant')"


@query(
    "segment_relevance",
    f"""with x as (select p_partkey, p_name || case p_size % 5 when 0 then ' montant' when 1 then ' email' when 2 then ' SIRET ' when 3 then ' capital' else '' end as t, p_size % 4 as n from part)
        select p_partkey, least(100, 20 * n + 15 * regexp_matches(t, '(?i)siret|siren|nom\\s*commercial|dénomination|raison\\s*sociale')::int + 10 * regexp_matches(t, '(?i)email|@|téléphone|télécopie|fax|adresse\\s*(électronique|postale)')::int
          + 15 * {_FLAG_SQL.format('t')}::int + 5 * regexp_matches(t, '(?i)forme\\s*juridique|rcs|capital|représentant')::int) as score from x""",
)
def segment_relevance(t: Tables) -> DataFrame:
    k = F.col("p_size") % 5
    text = F.concat("p_name", F.when(k == 0, " montant").when(k == 1, " email").when(k == 2, " SIRET ").when(k == 3, " capital").otherwise(""))
    rows = t.part.select("p_partkey", text.alias("t"), (F.col("p_size") % 4).alias("n")).withColumn("flags", content_flags(F.col("t")))
    return rows.select("p_partkey", relevance(F.col("n"), F.col("flags"), F.col("t"), F.lit(1)).alias("score"))


@query("segment_strategies", "select n_nationkey, case n_nationkey % 5 when 0 then 'hybrid' when 1 then 'tables' when 2 then 'pages' when 3 then 'sections' else 'hybrid' end as strategy, case when n_nationkey % 5 in (0, 3) then 'B' end as letter from nation")
def segment_strategies(t: Tables) -> DataFrame:
    k = F.col("n_nationkey") % 5
    mark = "<w:p><w:t>B - Identification du candidat</w:t></w:p>"
    xml = F.when(k == 0, mark + "<w:tbl></w:tbl>" * 5).when(k == 1, "<w:tbl></w:tbl>" * 8).when(k == 2, '<w:br w:type="page"/>' * 3).when(k == 3, mark).otherwise("<w:p/>")
    return t.nation.select("n_nationkey", strategy(xml).alias("strategy"), section_of(X.xml_text(xml))["letter"].alias("letter"))


@query("xml_readings", "select n_nationkey, n_name || ' x' as cell, n_name || 'FORMCHECKBOX x' as field from nation where not contains(n_name, ' ')")
def xml_readings(t: Tables) -> DataFrame:
    xml = F.concat(F.lit("<w:tc><w:t>"), "n_name", F.lit("</w:t><w:b/><w:t>x</w:t></w:tc>"))
    field = F.concat(F.lit("<w:t>"), "n_name", F.lit("</w:t><w:instrText>FORM</w:instrText><w:t>x</w:t>"))
    return t.nation.select("n_nationkey", X.cell_text(xml).alias("cell"), F.regexp_replace(X.field_text(field), " FORMCHECKBOX x$", "FORMCHECKBOX x").alias("field"))


@query(
    "table_stats",
    """with c as (select l_orderkey as doc_id, l_suppkey % 2 as table_index, l_linenumber as row_index, case when l_partkey % 3 = 0 then ' ' else ' p' || l_partkey || ' ' end as text, case when l_quantity > 45 then 2 else 1 end as colspan from lineitem),
       r as (select doc_id, table_index, row_index, count(*) as n, max(colspan) as m from c group by all),
       x as (select doc_id, table_index, string_agg(trim(text), ',' order by row_index, trim(text)) filter (trim(text) <> '') as texts from c group by all)
       select doc_id, table_index, sum(n) as n_cells, count(*) as n_rows, max(n) as max_columns, max(m) > 1 as has_merged, coalesce(any_value(texts), '') as texts from r join x using (doc_id, table_index) group by all""",
)
def table_stats(t: Tables) -> DataFrame:
    text = F.when(F.col("l_partkey") % 3 == 0, " ").otherwise(F.concat(F.lit(" p"), F.col("l_partkey").cast("string"), F.lit(" ")))
    cells = t.lineitem.select(F.col("l_orderkey").alias("doc_id"), (F.col("l_suppkey") % 2).alias("table_index"), F.col("l_linenumber").alias("row_index"), F.lit(0).alias("column_index"), text.alias("text"), F.when(F.col("l_quantity") > 45, 2).otherwise(1).alias("colspan"))
    return S.table_stats(cells).withColumn("texts", F.array_join("texts", ","))


@query("first_run_styles", "select n_nationkey, case when n_regionkey = 0 then 'second' when n_regionkey = 1 then null else 'first' end as paragraph_style, 'first' as cell_style from nation")
def first_run_styles(t: Tables) -> DataFrame:
    """The first run is blank in one region, all runs in another."""
    first = F.when(F.col("n_regionkey") < 2, " ").otherwise(F.col("n_name"))
    second = F.when(F.col("n_regionkey") == 1, "").otherwise(F.col("n_name"))
    runs = F.array(F.struct(first.alias("text"), F.lit("first").alias("style")), F.struct(second.alias("text"), F.lit("second").alias("style")))
    return t.nation.select("n_nationkey", S.first_run_style(runs, "style").alias("paragraph_style"), S.first_run_style(runs, "style", True).alias("cell_style"))


@query("fields_by_kind", "select event_id, case when event_id % 4 in (0, 1) then 'checkbox' else 'text' end as kind from events")
def fields_by_kind(t: Tables) -> DataFrame:
    k = F.col("event_id") % 4
    value = F.when(k == 0, "true").when(k == 1, "false").when(k == 2, '"true"').otherwise("{broken")
    texts, boxes = S.fields_by_kind(t.events.select("event_id", value.alias("value")))
    return texts.select("event_id", F.lit("text").alias("kind")).unionByName(boxes.select("event_id", F.lit("checkbox").alias("kind")))


_PIECE = "n_name || ' part ' || i || ' is long enough to be a segment of its own, {{T' || i || '}}'"


def _paged(t: Tables, n: int, sections: bool) -> DataFrame:
    """Documents of n pages of a paragraph each; with sections each announces one."""
    title = lambda i: F.lit(f"{chr(65 + i)} - Objet : ") if sections else F.lit("")
    page = lambda i: F.concat(F.lit("<w:p><w:r><w:t>"), title(i), F.col("n_name"), F.lit(f" part {i} is long enough to be a segment of its own, {{{{T{i}}}}}</w:t></w:r></w:p>"))
    return t.nation.select(F.col("n_nationkey").alias("doc_id"), F.concat_ws("" if sections else '<w:br w:type="page"/>', *map(page, range(n))).alias("xml"))


@query("segments_of_pages", f"select n_nationkey as doc_id, 'page' as type, i as ord, {_PIECE} as text, 'T' || i as tags, 20 as relevance from nation, (select unnest([0, 1, 2, 3]) as i)")
def segments_of_pages(t: Tables) -> DataFrame:
    return G.segment(_paged(t, 4, False)).select("doc_id", "type", "ord", F.trim("text").alias("text"), F.array_join("tags", ",").alias("tags"), "relevance")


@query("segments_of_sections", f"select n_nationkey as doc_id, 'section' as type, chr(65 + i::int) as letter, chr(65 + i::int) || ' - Objet : ' || {_PIECE} as text from nation, (select unnest([0, 1, 2]) as i)")
def segments_of_sections(t: Tables) -> DataFrame:
    return G.segment(_paged(t, 3, True)).select("doc_id", "type", F.col("section.letter").alias("letter"), F.trim("text").alias("text"))


@query("segment_totals", "select n_nationkey as doc_id, 4 as segments, 4 as with_tags, 4 as tags, 4 as paragraphs, 4 as relevant from nation")
def segment_totals(t: Tables) -> DataFrame:
    found = G.segment(_paged(t, 4, False))
    some = G.relevant(found, only_with_tags=True).groupBy("doc_id").agg(F.count("*").alias("relevant"))
    return G.segment_stats(found).join(some, "doc_id")


@query(
    "extracted_elements",
    """select n_nationkey as doc_id, case n_nationkey % 3 when 0 then 'heading' when 1 then 'list' else 'paragraph' end as kind, case n_nationkey % 3 when 0 then 1 + n_regionkey when 1 then 2 end as level, case when n_nationkey % 3 = 0 then 'heading' || (1 + n_regionkey) end as style,
       n_nationkey % 3 = 1 as ordered, case when n_nationkey % 3 = 1 then n_nationkey end as number from nation""",
)
def extracted_elements(t: Tables) -> DataFrame:
    """Paragraphs as headings, list items and plain ones, with their level and number."""
    k, key = F.col("n_nationkey") % 3, F.col("n_nationkey").cast("string")
    style = F.when(k == 0, F.concat(F.lit('<w:pPr><w:pStyle w:val="Heading'), (1 + F.col("n_regionkey")).cast("string"), F.lit('"/></w:pPr>'))).when(k == 1, '<w:pPr><w:numPr><w:ilvl w:val="1"/><w:numId w:val="3"/></w:numPr></w:pPr>').otherwise("")
    text = F.concat(F.when(k == 1, F.concat(key, F.lit(". "))).otherwise(""), F.col("n_name"))
    paras = t.nation.select(F.col("n_nationkey").alias("doc_id"), text.alias("text"), F.concat(F.lit("<w:p>"), style, F.lit("<w:r><w:t>"), text, F.lit("</w:t></w:r></w:p>")).alias("xml"))
    found = S.classify_paragraphs(paras)
    heading = F.when(F.col("kind") == "heading", X.heading_style(F.col("level")))
    return found.select("doc_id", "kind", "level", heading.alias("style"), X.is_ordered(F.col("text")).alias("ordered"), X.list_number(F.col("text")).alias("number"))
