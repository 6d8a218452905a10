"""Queries of mail merge and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.functions.tags import flatten_json, flatten_to_tags, restyle
from docframe.functions.text import checkbox_symbol, escape_xml
from docframe.operators import records as R
from docframe.operators.fill import expand_loop, fill, fill_report, merge
from docframe.operators.templates import expand_loops
from docframe.queries.registry import Tables, query
from docframe.session import dealt, shuffled

LETTER = "<w:p><w:t>Order {{ORDER}} of {{NAME}} ({{SEGMENT}}): {{TOTAL}} {{NOTE}}</w:t></w:p>{#ITEMS}<w:p>{{LINE}}. {{PART}} x {{QTY}}</w:p>{/ITEMS}"
_ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;')"
_MONEY = "cast(cast({0} as decimal(18,2)) as varchar)"


def orders_with_items(t: Tables) -> DataFrame:
    """Orders with their customer and sorted items; one shuffle each of orders and items, by order key."""
    item = F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_quantity").cast("decimal(18,2)").alias("qty"),
        F.col("l_suppkey").alias("s"), F.col("l_extendedprice").alias("e"), F.col("l_discount").alias("d"), F.col("l_tax").alias("x"),
    )
    items = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(customers, "o_custkey", "left")


def merged(t: Tables) -> DataFrame:
    tags = F.create_map(
        F.lit("ORDER"), F.col("o_orderkey").cast("string"), F.lit("NAME"), F.col("c_name"), F.lit("SEGMENT"), F.col("c_mktsegment"),
        F.lit("TOTAL"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
    )
    body = expand_loop(F.lit(LETTER), "ITEMS", F.col("items"), ["line", "part", "qty"])
    return fill(orders_with_items(t).withColumns({"template": body, "tags": tags}), "template", "tags")


_HEAD_SQL = f"'<w:p><w:t>Order ' || o_orderkey || ' of ' || {_ESC.format('c_name')} || ' (' || {_ESC.format('c_mktsegment')} || '): ' || {_MONEY.format('o_totalprice')} || ' </w:t></w:p>'"
_ITEM_SQL = f"'<w:p>' || l_linenumber || '. ' || l_partkey || ' x ' || {_MONEY.format('l_quantity')} || '</w:p>'"


@query(
    "mail_merge_orders",
    f"""select o_orderkey, {_HEAD_SQL} || coalesce(items, '') as xml from orders join customer on c_custkey = o_custkey
        left join (select l_orderkey, string_agg({_ITEM_SQL}, '' order by l_linenumber, l_partkey, cast(l_quantity as decimal(18,2)), l_suppkey, l_extendedprice, l_discount, l_tax) as items from lineitem group by 1) on l_orderkey = o_orderkey""",
)
def mail_merge_orders(t: Tables) -> DataFrame:
    return merged(t).select("o_orderkey", F.col("filled")["xml"].alias("xml"))


@query("fill_report", "select o_orderkey, 4 as n_replaced, 1 as n_remaining, 'ORDER,NAME,SEGMENT,TOTAL' as replaced_names, 'NOTE' as remaining_names from orders")
def report(t: Tables) -> DataFrame:
    return fill_report(merged(t)).select("o_orderkey", "n_replaced", "n_remaining", "replaced_names", "remaining_names")


@query("fill_keep_empty", f"select c_custkey, 'Dear ' || {_ESC.format('c_name')} || ', {{{{MISSING}}}} {{{{lower}}}}' as xml from customer")
def fill_keep_empty(t: Tables) -> DataFrame:
    rows = t.customer.withColumns({"template": F.lit("Dear {{NAME}}, {{MISSING}} {{lower}}"), "tags": F.create_map(F.lit("NAME"), F.col("c_name"))})
    return fill(rows, "template", "tags", keep_empty=True).select("c_custkey", F.col("filled")["xml"].alias("xml"))


@query("fill_sequential_values", f"select p_partkey, 'A: ' || {_ESC.format('p_name')} || ' B: ' || {_ESC.format('p_name')} || ' C: ' as xml from part")
def fill_sequential_values(t: Tables) -> DataFrame:
    """A value that holds a later tag is filled in turn; one that holds an unknown tag loses it."""
    tags = F.create_map(F.lit("A"), F.lit("{{B}}"), F.lit("B"), F.col("p_name"), F.lit("C"), F.lit("{{NOWHERE}}"), F.lit("LIST"), F.lit("[1]"))
    rows = t.part.withColumns({"template": F.lit("A: {{A}} B: {{B}} C: {{C}}{{LIST}}"), "tags": tags})
    return fill(rows, "template", "tags").select("p_partkey", F.col("filled")["xml"].alias("xml"))


@query("loop_missing_array_removed", "select c_custkey, 'Orders:' || coalesce(string_agg('<o>' || o_orderkey || '</o>', '' order by o_orderkey), '') || '.' as xml from customer left join orders on o_custkey = c_custkey group by 1")
def loop_missing_array_removed(t: Tables) -> DataFrame:
    items = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("key")))).alias("items"))
    rows = t.customer.join(items, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", expand_loop(F.lit("Orders:{#ORDERS}<o>{{KEY}}</o>{/ORDERS}."), "ORDERS", F.col("items"), ["key"]).alias("xml"))


@query("flatten_json_props", "select event_id, 'PROPS_K' as tag, json_extract_string(props, '$.k') as value from events where json_extract_string(props, '$.k') is not null")
def flatten_json_props(t: Tables) -> DataFrame:
    rows = t.events.withColumn("p", F.from_json("props", "k string"))
    tags = flatten_to_tags({"props": (F.col("p"), rows.schema["p"].dataType)})
    return rows.select("event_id", F.explode(tags).alias("tag", "value"))


def nested_rows(t: Tables) -> DataFrame:
    """Orders as records: a struct, a boolean, a list of structs and one of scalars."""
    key = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    items = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(key)).alias("i"))
    return t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("status"), F.struct(F.col("o_custkey").alias("id")).alias("customer")).alias("order"),
        (F.col("o_orderstatus") == "O").alias("open"),
        F.transform("i", lambda x: F.struct(x["l_partkey"].alias("part"))).alias("items"),
        F.transform("i", lambda x: x["l_partkey"]).alias("parts"),
    )


_NESTED_SQL = """with o as (select o_orderkey, o_orderstatus, o_custkey from orders), l as (select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) - 1 as i, l_partkey from lineitem)
       select o_orderkey, 'ORDER_STATUS' as tag, o_orderstatus as value from o union all select o_orderkey, 'ORDER_CUSTOMER_ID', o_custkey::varchar from o
       union all select o_orderkey, 'OPEN', case when o_orderstatus = 'O' then '☑' else '☐' end from o
       union all select l_orderkey, 'ITEMS_' || i || '_PART', l_partkey::varchar from l join o on o_orderkey = l_orderkey
       union all select l_orderkey, 'ITEMS', '[' || string_agg('{"part":' || l_partkey || '}', ',' order by i) || ']' from l join o on o_orderkey = l_orderkey group by 1
       union all select l_orderkey, 'PARTS', string_agg(l_partkey::varchar, ', ' order by i) from l join o on o_orderkey = l_orderkey group by 1"""


@query("flatten_nested_struct", _NESTED_SQL)
def flatten_nested_struct(t: Tables) -> DataFrame:
    rows = nested_rows(t)
    tags = flatten_to_tags({c: (F.col(c), rows.schema[c].dataType) for c in ("order", "open", "items", "parts")})
    return rows.select("o_orderkey", F.explode(tags).alias("tag", "value"))


@query("flatten_json_any", _NESTED_SQL)
def flatten_json_any(t: Tables) -> DataFrame:
    """The same records as JSON text, whose shape is read from each row."""
    rows = nested_rows(t).select("o_orderkey", F.to_json(F.struct("order", "open", "items", "parts")).alias("data"))
    return rows.select("o_orderkey", F.explode(flatten_json(F.col("data"))).alias("tag", "value"))


@query("flatten_json_events", "select event_id, 'K' as tag, json_extract_string(props, '$.k') as value from events where json_extract_string(props, '$.k') is not null")
def flatten_json_events(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.explode(flatten_json(F.col("props"))).alias("tag", "value"))


@query(
    "fill_validated",
    "select c_custkey, case when count(o_orderkey) = 0 then 'unclosed w:tbl' end as error, '<w:body><w:p>' || any_value(c_name) || '</w:p><w:tbl>' || coalesce(string_agg('<w:tr>' || o_orderkey || '</w:tr>', '' order by o_orderkey), '') || case when count(o_orderkey) > 0 then '</w:tbl></w:body>' else '' end as xml from customer left join orders on o_custkey = c_custkey group by 1",
)
def fill_validated(t: Tables) -> DataFrame:
    """The end of the table stands in a block that goes where a customer has no orders: such a fill is an error row."""
    # Orders take few bytes and their fills much time: dealt by rows, they are filled by all tasks and not by one.
    n = t.orders.count()
    orders = dealt(t.orders.select("o_custkey", "o_orderkey"), n, "o_custkey").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("key")))).alias("rows"))
    joined = shuffled(dealt(t.customer.select("c_custkey", "c_name"), n, "c_custkey")).join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    ends = F.when(F.col("rows").isNotNull(), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    data = F.to_json(F.struct(F.struct(F.col("c_name").alias("name")).alias("customer"), F.coalesce("rows", F.array().cast("array<struct<key:bigint>>")).alias("rows"), ends.alias("ends")))
    template = "<w:body><w:p>{{CUSTOMER_NAME}}</w:p><w:tbl>{#ROWS}<w:tr>{{KEY}}</w:tr>{/ROWS}{#ENDS}</w:tbl></w:body>{/ENDS}"
    done = fill_report(merge(joined.select("c_custkey", F.lit(template).alias("template"), data.alias("data")), "template", "data"))
    return done.select("c_custkey", "error", F.col("filled")["xml"].alias("xml"))


_OPEN = "p_size % 5 = 0"


@query(
    "fill_output",
    f"""with k as (select *, p_size % 2 = 0 as a, p_size % 3 = 0 as b from part) select p_partkey, not ({_OPEN}) as success, case when p_size % 7 = 0 then 'own.docx' else 'offer ' || p_partkey || '_FILLED.docx' end as filename,
        'offer ' || p_partkey || case p_size % 4 when 0 then '.docx' when 1 then '.doc' else '' end as original_filename, ({_OPEN}) as failed, 3 as tags_in_document, 1 + a::int + b::int as tags_replaced, 2 - a::int - b::int as tags_remaining,
        concat_ws(',', case when a then 'NAME' end, case when b then 'TYPE' end, 'BRAND') as replaced, concat_ws(',', case when not a then 'NAME' end, case when not b then 'TYPE' end) as remaining from k""",
)
def fill_output(t: Tables) -> DataFrame:
    """Offers whose name and type are not always given; the template of each fifth size is not closed."""
    template = F.concat(F.lit("<w:p>{{NAME}}, {{TYPE}}: {{BRAND}}"), F.when(F.expr(_OPEN), "").otherwise("</w:p>"))
    tags = F.create_map(F.lit("NAME"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")), F.lit("TYPE"), F.when(F.col("p_size") % 3 == 0, F.col("p_type")), F.lit("BRAND"), F.col("p_brand"))
    ending = F.when(F.col("p_size") % 4 == 0, ".docx").when(F.col("p_size") % 4 == 1, ".doc").otherwise("")
    path = F.concat(F.lit("in/offer "), F.col("p_partkey").cast("string"), ending)
    rows = t.part.select("p_partkey", path.alias("path"), F.when(F.col("p_size") % 7 == 0, "own.docx").alias("wanted"), template.alias("template"), tags.alias("tags"))
    out = R.fill_output(fill(rows, "template", "tags", validate=True), name="wanted").select("p_partkey", "output.*")
    report = F.col("report")
    counts = [report[c].alias(c) for c in ("tags_in_document", "tags_replaced", "tags_remaining")]
    return out.select("p_partkey", "success", "filename", "original_filename", F.col("error").isNotNull().alias("failed"), *counts, F.array_join(report["replaced_tags"], ",").alias("replaced"), F.array_join(report["remaining_tags"], ",").alias("remaining"))


@query("loop_deep_blocks", "select l_orderkey, string_agg('<' || l_partkey || '[akk][bkk]>', '' order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) as xml from lineitem join orders on o_orderkey = l_orderkey group by 1")
def loop_deep_blocks(t: Tables) -> DataFrame:
    """Three levels of blocks in each order's letter."""
    rows = nested_rows(t).filter("items is not null")
    data = F.to_json(F.struct("items", F.array(F.struct(F.lit("a").alias("t")), F.struct(F.lit("b").alias("t"))).alias("tags"), F.array(F.lit(1), F.lit(2)).alias("keys")))
    return rows.select(F.col("o_orderkey").alias("l_orderkey"), expand_loops(F.lit("{#ITEMS}<{{PART}}{#TAGS}[{{T}}{#KEYS}k{/KEYS}]{/TAGS}>{/ITEMS}"), data).alias("xml"))


@query("checkbox_style_text", "select doc_id, case when toxic = 1 then 'X' else ' ' end as toxic, case when quality = 1 then 'X' else ' ' end as quality from labels")
def checkbox_style_text(t: Tables) -> DataFrame:
    tags = F.create_map(F.lit("T"), checkbox_symbol(F.col("toxic") == 1), F.lit("Q"), checkbox_symbol(F.col("quality") == 1))
    return t.labels.select("doc_id", restyle(tags, "text")["T"].alias("toxic"), restyle(tags, "text")["Q"].alias("quality"))


@query("checkbox_style_boolean", "select doc_id, case when toxic = 1 then 'true' else 'false' end as toxic, 'plain' as other from labels")
def checkbox_style_boolean(t: Tables) -> DataFrame:
    tags = restyle(F.create_map(F.lit("T"), checkbox_symbol(F.col("toxic") == 1), F.lit("O"), F.lit("plain")), "boolean")
    return t.labels.select("doc_id", tags["T"].alias("toxic"), tags["O"].alias("other"))


@query("config_merge", "select coalesce(o.k, d.k) as k, coalesce(o.v, d.v) as v from (select n_nationkey as k, n_name as v from nation where n_nationkey < 15) d full join (select n_nationkey as k, upper(n_name) || '!' as v from nation where n_nationkey >= 10) o on o.k = d.k")
def config_merge(t: Tables) -> DataFrame:
    from docframe.operators.matching import merge_config

    base = t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"))
    return merge_config(base.filter("k < 15"), base.filter("k >= 10").withColumn("v", F.concat(F.upper("v"), F.lit("!"))), "k", "v")


@query("escape_values", f"select n_nationkey, {_ESC.format(chr(39) + 'a&b<c>' + chr(39) + ' || n_name')} as v from nation")
def escape_values(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", escape_xml(F.concat(F.lit("a&b<c>"), "n_name")).alias("v"))


@query(
    "loop_repeated_block",
    "select c_custkey, 'A:' || coalesce(string_agg('<o>' || o_orderkey || '</o>', '' order by o_orderkey), '') || ' B:' || coalesce(string_agg('<i>' || o_orderkey || '</i>', '' order by o_orderkey), '') || ' C:' || coalesce(string_agg('<o>' || o_orderkey || '</o>', '' order by o_orderkey), '') as xml from customer left join orders on o_custkey = c_custkey group by 1",
)
def loop_repeated_block(t: Tables) -> DataFrame:
    """Several blocks of one name, two of them alike."""
    items = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("key")))).alias("items"))
    rows = t.customer.join(items, F.col("c_custkey") == F.col("o_custkey"), "left")
    template = F.lit("A:{#ORDERS}<o>{{KEY}}</o>{/ORDERS} B:{#orders}<i>{{KEY}}</i>{/orders} C:{#ORDERS}<o>{{KEY}}</o>{/ORDERS}")
    return rows.select("c_custkey", expand_loop(template, "ORDERS", F.col("items"), ["key"]).alias("xml"))


def _nation_data(t: Tables) -> DataFrame:
    """Nations with a JSON object of arrays at several depths, under keys of several cases."""
    listed = F.array(*[F.struct(F.concat(F.lit(f"n{i} & "), F.col("n_name")).alias("Name"), (F.col("n_nationkey") % 2 == i).alias("ok")) for i in range(2)])
    data = F.struct(
        listed.alias("ITEMS"), F.array("n_nationkey").alias("keys"), F.array().cast("array<string>").alias("none"), F.struct(F.struct(listed.alias("lines")).alias("Order")).alias("Shop"), F.lit("[1]").alias("text"), F.col("n_name").alias("name")
    )
    return t.nation.select("n_nationkey", "n_name", F.to_json(data).alias("data"))


_LISTED = "'n0 &amp; ' || n_name || '=' || case when n_nationkey % 2 = 0 then '☑' else '☐' end || ';n1 &amp; ' || n_name || '=' || case when n_nationkey % 2 = 1 then '☑' else '☐' end || ';'"


@query("loop_lookup_paths", f"select n_nationkey, 'a ' || {_LISTED} || ' b k;' || ' c ' || {_LISTED} || ' d  e  f ' as xml from nation")
def loop_lookup_paths(t: Tables) -> DataFrame:
    """Arrays by the key as written, in lower case, by a path in any case; an empty array, a missing one and a text that looks
    like one."""
    line = "{{NAME}}={{ok}};"
    template = f"a {{#ITEMS}}{line}{{/ITEMS}} b {{#KEYS}}k;{{/KEYS}} c {{#SHOP_ORDER_LINES}}{line}{{/SHOP_ORDER_LINES}} d {{#NONE}}x{{/NONE}} e {{#MISSING_ONE}}x{{/MISSING_ONE}} f {{#TEXT}}x{{/TEXT}}"
    return _nation_data(t).select("n_nationkey", expand_loops(F.lit(template), F.col("data")).alias("xml"))


@query("loop_nested", "select n_nationkey, '<n0 &amp; ' || n_name || ':k;>' || '<n1 &amp; ' || n_name || ':k;>' as xml from nation")
def loop_nested(t: Tables) -> DataFrame:
    """An inner block takes its array from the whole object, not from the outer item."""
    return _nation_data(t).select("n_nationkey", expand_loops(F.lit("{#ITEMS}<{{NAME}}:{#KEYS}k;{/KEYS}>{/ITEMS}"), F.col("data")).alias("xml"))
