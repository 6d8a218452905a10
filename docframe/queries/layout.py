"""Queries of positioned page text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.functions import geometry as G
from docframe.operators import layout as L
from docframe.operators import records as R
from docframe.queries.registry import Tables, query

PAGE_WIDTH = 595.0
#: A page per order and 50 lines; boxes of a line lie side by side, the last word of every second line ends with a colon.
_BOX_SQL = """boxes as (select l_orderkey as doc_id, 1 as page, i as index, l_linenumber as line, 800.0::double - 20 * l_linenumber as y, 50.0::double + 60 * k as x, 30.0::double + (l_partkey % 30) as width, 10.0::double as height,
    'w' || (l_partkey % 1000) || case when l_linenumber % 2 = 0 and k = m then ':' else '' end as text
    from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as i,
      row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as k,
      count(*) over (partition by l_orderkey, l_linenumber) - 1 as m from lineitem))"""


def boxes(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    cols = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    by_order, by_line = Window.partitionBy("l_orderkey"), Window.partitionBy("l_orderkey", "l_linenumber")
    k = F.row_number().over(by_line.orderBy(*cols)) - 1
    m = F.count("*").over(by_line) - 1
    rows = t.lineitem.withColumns({"i": F.row_number().over(by_order.orderBy("l_linenumber", *cols)) - 1, "k": k, "m": m})
    mark = F.when((F.col("l_linenumber") % 2 == 0) & (F.col("k") == F.col("m")), ":").otherwise("")
    return rows.select(
        F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), F.col("i").alias("index"), F.col("l_linenumber").alias("line"), (800.0 - 20 * F.col("l_linenumber")).alias("y"), (50.0 + 60 * F.col("k")).alias("x"),
        (30.0 + F.col("l_partkey") % 30).alias("width"), F.lit(10.0).alias("height"), F.concat(F.lit("w"), (F.col("l_partkey") % 1000).cast("string"), mark).alias("text"),
    )


_TEXT_SQL = """spaced as (select *, lag(x + width) over (partition by doc_id, line order by x, index) as before from boxes),
    lines as (select doc_id, page, line as nr, min(x) as x, avg(y) as y, max(x + width) - min(x) as width, max(height) as height, string_agg(case when before is not null and x - before > 5 then ' ' else '' end || text, '' order by x, index) as text from spaced group by all)"""


@query("pdf_lines", f"with {_BOX_SQL}, {_TEXT_SQL} select doc_id, page, row_number() over (partition by doc_id, page order by y desc) - 1 as line, x, y, width, height, text from lines")
def pdf_lines(t: Tables) -> DataFrame:
    return L.group_lines(boxes(t)).select("doc_id", "page", F.col("line").cast("long").alias("line"), "x", "y", "width", "height", "text")


@query("pdf_gaps", f"with {_BOX_SQL} select doc_id, page, index, gap from (select *, lead(x) over (partition by doc_id, page, line order by x, index) - (x + width) as gap from boxes) where gap >= 20")
def pdf_gaps(t: Tables) -> DataFrame:
    return L.gaps(boxes(t), least=20.0).select("doc_id", "page", F.col("index").cast("long").alias("index"), "gap")


_ZONE_SQL = f"""{_BOX_SQL}, {_TEXT_SQL}, zones as (select doc_id, page, nr as line, 'after_colon' as kind, x + width + 5 as x, y, {PAGE_WIDTH} - x - width - 50 as width, text as label from lines where text like '%:' and {PAGE_WIDTH} - x - width - 50 >= 30
    union all select doc_id, page, line, 'gap', x + width + 5, y, gap - 10, text from (select *, lead(x) over (partition by doc_id, page, line order by x, index) - (x + width) as gap from boxes) where gap >= 30)"""


def _zones(t: Tables) -> DataFrame:
    grouped = L.group_lines(boxes(t))
    numbered = grouped.withColumn("line", F.round((800.0 - F.col("y")) / 20).cast("int"))
    return L.empty_zones(numbered, boxes(t), PAGE_WIDTH)


@query("pdf_empty_zones", f"with {_ZONE_SQL} select doc_id, page, line, kind, x, y, width, label from zones")
def pdf_empty_zones(t: Tables) -> DataFrame:
    return _zones(t)


_FIELD_SQL = f"""{_ZONE_SQL}, named as (select * replace (trim(regexp_replace(label, ':\\s*$', '')) as label) from zones where length(trim(regexp_replace(label, ':\\s*$', ''))) >= 3),
    sure as (select *, 0.9 as confidence from named where kind = 'after_colon'),
    maybe as (select *, 0.7 as confidence from named n where kind = 'gap' and not exists (select 1 from sure s where s.doc_id = n.doc_id and s.page = n.page and abs(s.x - n.x) < 10 and abs(s.y - n.y) < 3)),
    fields as (select * from sure union all select * from maybe)"""


@query("pdf_fields", f"with {_FIELD_SQL} select doc_id, page, kind, x, y, label, confidence::double as confidence from fields")
def pdf_fields(t: Tables) -> DataFrame:
    return L.fields(_zones(t)).select("doc_id", "page", "kind", "x", "y", "label", "confidence")


@query(
    "page_records",
    f"""with {_FIELD_SQL}, e as (select doc_id, page, count(*) as elements from boxes group by all), l as (select doc_id, page, count(*) as lines, md5(string_agg(text, chr(10) order by y desc)) as digest from lines group by all),
        z as (select doc_id, page, count(*) as zones, round(sum(width), 3) as free from zones group by all), f as (select doc_id, page, count(*) as fields, string_agg(label, '|' order by confidence desc, line, x) as labels from fields group by all)
        select doc_id, page, elements, lines, digest, coalesce(zones, 0) as zones, coalesce(free, 0) as free, coalesce(fields, 0) as fields, coalesce(labels, '') as labels from e join l using (doc_id, page) left join z using (doc_id, page) left join f using (doc_id, page)""",
)
def page_records(t: Tables) -> DataFrame:
    """All that a page holds as one record, with the digest of its lines and the labels of its fields in order."""
    r = R.page_records(boxes(t), PAGE_WIDTH, 842.0)
    free = F.round(F.aggregate("empty_zones", F.lit(0.0), lambda n, z: n + z["width"]), 3)
    texts = lambda c, field: F.transform(c, lambda x: x[field])
    sizes = [F.size(c).alias(n) for c, n in (("elements", "elements"), ("lines", "lines"), ("empty_zones", "zones"), ("fields", "fields"))]
    return r.select("doc_id", "page", *sizes, F.md5(F.array_join(texts("lines", "text"), "\n")).alias("digest"), free.alias("free"), F.array_join(texts("fields", "label"), "|").alias("labels"))


_HEADINGS = "case when l_partkey % 11 = 3 then 'D - Présentation du candidat' when l_partkey % 11 = 5 then 'C-Identification du candidat (suite)' when l_partkey % 11 = 7 then 'D-Présentation du candidat, C - Identification' else 'B - Objet' end"


@query("form_of_pages", f"with l as (select l_orderkey as doc_id, (l_linenumber, l_suppkey) as spot, {_HEADINGS} as text from lineitem), k as (select doc_id, spot, case when text like 'D%' then 'DC1' when text like 'C%' then 'DC2' end as form from l) select doc_id, min_by(form, (spot, form)) filter (form is not null) as form from k group by 1")
def form_of_pages(t: Tables) -> DataFrame:
    """Each line number is a page, and its suppliers are the lines."""
    return L.form_of_pages(t.lineitem.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), F.col("l_suppkey").alias("line"), F.expr(_HEADINGS).alias("text")))



@query("section_bounds_lines", f"with {_BOX_SQL}, {_TEXT_SQL}, f as (select doc_id, min(nr) as f from lines where text like '%w1%' group by 1), e as (select l.doc_id, min(nr) as e from lines l join f using (doc_id) where nr > f and text like '%w9%' group by 1) select l.doc_id, l.text from lines l join f using (doc_id) left join e using (doc_id) where nr > f and (e is null or nr < e)")
def section_bounds_lines(t: Tables) -> DataFrame:
    return L.section_lines(L.group_lines(boxes(t)), "W 1", "w9").select("doc_id", "text")


@query("pdf_tag_places", "select n_nationkey as doc_id, upper(n_name) as tag, 10.0 + 3 * 100.0 / (3 + length(n_name) + 4) as x from nation where regexp_matches(upper(n_name), '^[A-Z_0-9]+$')")
def pdf_tag_places(t: Tables) -> DataFrame:
    lines = t.nation.select(F.col("n_nationkey").alias("doc_id"), F.lit(1).alias("page"), F.lit(0).alias("line"), F.lit(10.0).alias("x"), F.lit(5.0).alias("y"), F.lit(100.0).alias("width"), F.concat(F.lit("ab {{"), F.upper("n_name"), F.lit("}}")).alias("text"))
    return L.tag_places(lines).select("doc_id", "tag", "x")


_FIRST_SQL = "select doc_id, line, index, x, y, width, text, row_number() over (partition by doc_id order by line, x, index) as n from boxes where contains(text, ':') and line in (select min(nr) from lines l where l.doc_id = boxes.doc_id and (contains(l.text, 'w1') or contains(l.text, 'w2')))"


@query(
    "pdf_label_places",
    f"""with {_BOX_SQL}, {_TEXT_SQL}, ids as (select distinct doc_id from lines), hit as ({_FIRST_SQL}),
        a as (select i.doc_id, 'first' as field, 'inline' as type, case when x is not null then 1 end as page, floor(x + instr(text, ':') * width / length(text) + 8 + 0.5) as x, floor(y + 0.5) as y from ids i left join (select * from hit where n = 1) using (doc_id)),
        ranked as (select *, lead(y) over (partition by doc_id order by y desc) as nexty from lines),
        fits as (select doc_id, max(y) as y, arg_max((y + nexty) / 2, y) as mid from ranked where contains(text, 'w3') and nexty is not null and y - nexty >= 30 group by 1),
        b as (select i.doc_id, 'block' as field, 'multiline' as type, case when mid is not null then 1 end as page, case when mid is not null then 71.0 end as x, floor(mid + 0.5) as y from ids i left join fits using (doc_id))
        select * from a union all select * from b""",
)
def pdf_label_places(t: Tables) -> DataFrame:
    """Lines lie 20 apart, so none goes on with another; only where line numbers are left out is a gap of 30 or more."""
    config = t.spark.createDataFrame([("first", ["w1", "w2"], "inline", None), ("block", ["w3"], "multiline", 30.0)], "field string, labels array<string>, type string, min_gap double")
    found = boxes(t)
    return L.label_places(L.group_lines(found), config, found)


def _wrapped_sql(text: str, width: str) -> str:
    """Lines of a text, joined by line feeds, under a width of its last line with one more word; `width` holds {}."""
    longer = "(string_split(acc, chr(10))[-1] || ' ' || w)"
    return f"list_reduce(list_filter(string_split({text}, ' '), lambda w: w <> ''), lambda acc, w: case when {width.format(longer)} then acc || ' ' || w else acc || chr(10) || w end)"


_GLYPH_SQL = "map {" + ", ".join(f"{i}: {w}" for i, w in enumerate(G.glyph_table())) + "}"
_GLYPHS_OF = "list_sum(list_transform(string_split({}, ''), lambda ch: coalesce(glyphs[unicode(ch)], 556)))"


@query(
    "pdf_placements",
    f"""with v as (select p_partkey as doc_id, p_name || ' ' || p_type as value from part), s as (select *, coalesce((select max(k) / 2.0 from range(12, 19) r(k) where length(value) * 0.5 * k / 2.0 <= 60), 6.0)::double as size from v),
        w as (select *, string_split({_wrapped_sql('value', 'length({}) * size * 0.5 <= 60')}, chr(10)) as lines from s)
        select doc_id, 1 as page, 'name' as field, size, i as nth, lines[i + 1] as line_text, 50.0 as x, 700 - i * size * 1.2 as y from (select *, unnest(range(len(lines))) as i from w)""",
)
def pdf_placements(t: Tables) -> DataFrame:
    return L.placements(_values(t)).withColumn("nth", F.col("nth").cast("long"))


def _values(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("doc_id"), F.lit(1).alias("page"), F.lit("name").alias("field"), F.lit(50.0).alias("x"), F.lit(700.0).alias("y"), F.lit(60.0).alias("width"), F.concat_ws(" ", "p_name", "p_type").alias("value"))


@query(
    "pdf_placements_measured",
    f"""with v as (select p_partkey as doc_id, p_name || ' ' || p_type as value, {_GLYPH_SQL} as glyphs from part),
        s as (select *, coalesce((select max(k) / 2.0 from range(13, 19) r(k) where {_GLYPHS_OF.format('value')} / 1000.0 * k / 2.0 <= 60), 6.0)::double as size from v),
        w as (select *, string_split({_wrapped_sql('value', _GLYPHS_OF + ' / 1000.0 * size <= 60')}, chr(10)) as lines from s)
        select doc_id, size, i as nth, lines[i + 1] as line_text, 700 - i * size * 1.2 as y from (select *, unnest(range(len(lines))) as i from w)""",
)
def pdf_placements_measured(t: Tables) -> DataFrame:
    return L.placements(_values(t), measured=True).select("doc_id", "size", F.col("nth").cast("long").alias("nth"), "line_text", "y")


@query(
    "pdf_checkbox_marks",
    f"with {_BOX_SQL}, {_TEXT_SQL} select doc_id, 'any' as field, arg_min(x, nr) - 12 as x, arg_min(y, nr) - 2 as y from lines where contains(text, 'w5') group by 1",
)
def pdf_checkbox_marks(t: Tables) -> DataFrame:
    config = t.spark.createDataFrame([("any", ["W5"], True), ("none", ["w6"], False)], "field string, labels array<string>, checked boolean")
    return L.checkbox_marks(L.group_lines(boxes(t)), config).select("doc_id", "field", "x", "y")


@query("pdf_build_matches", "select c_custkey as doc_id, 'f' as field, 1 as page, c_acctbal as x, 5.0 as y, 300.0 as width, 12.0 as height, case c_custkey % 3 when 0 then 0.95 else 0.7 end as confidence, c_name as value from customer where c_custkey % 5 > 1")
def pdf_build_matches(t: Tables) -> DataFrame:
    """Positions without a place, and empty values, are not drawn; a missing confidence is the given one."""
    k = F.col("c_custkey")
    positions = t.customer.select(k.alias("doc_id"), F.lit("f").alias("field"), F.lit(1).alias("page"), F.when(k % 5 > 0, F.col("c_acctbal")).alias("x"), F.lit(5.0).alias("y"), F.when(k % 3 > 0, 0.7).otherwise(0.0).alias("confidence"))
    values = t.customer.select(k.alias("doc_id"), F.lit("f").alias("field"), F.when(k % 5 == 1, "").otherwise(F.col("c_name")).alias("value"))
    return L.build_matches(positions, values)


@query("pdf_observe", "select n_nationkey as doc_id, 'f' as field, case n_nationkey % 3 when 0 then 'ok' when 1 then 'collision' else 'ok' end as status from nation")
def pdf_observe(t: Tables) -> DataFrame:
    k = F.col("n_nationkey") % 3
    text = F.when(k == 0, F.concat(F.lit("Name : "), "n_name")).when(k == 1, F.concat(F.lit("other "), "n_name")).otherwise("nothing here")
    lines = t.nation.select(F.col("n_nationkey").alias("doc_id"), F.lit(1).alias("page"), F.lit(0).alias("line"), text.alias("text"))
    values = t.nation.select(F.col("n_nationkey").alias("doc_id"), F.lit("f").alias("field"), F.lit("inline").alias("type"), F.col("n_name").alias("value"))
    return L.observe(lines, values)
