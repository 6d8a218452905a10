"""Block trees of templates, validated fills, JSON flattened without a schema."""

import json
import random

import pytest
from pyspark.sql import functions as F

from docframe.functions import tags as T
from docframe.operators import fill as W
from docframe.operators import templates as B


def test_a_thousand_blocks_at_three_levels(spark):
    """No block is left, and none is lost."""
    template = "".join(f"{{#A}}<{{{{N}}}}:{{#B}}[{{#C}}{{{{M}}}}{{/C}}]{{/B}}>{{/A}}{i};" for i in range(1000))
    data = json.dumps({"a": [{"n": 1}, {"n": 2}], "b": [0, 0], "c": [{"m": "x"}, {"m": "y"}]})
    df = spark.createDataFrame([(template, data)], "t string, d string")
    got = df.select(B.expand_loops(F.col("t"), F.col("d")).alias("x")).first()["x"]
    assert got == "".join(f"<1:[xy][xy]><2:[xy][xy]>{i};" for i in range(1000))


@pytest.mark.parametrize(
    ("template", "want"),
    [
        ("a{#X}b", "a{#X}b"), ("a{/X}b", "a{/X}b"), ("{#A}1{#X}2{/A}3", "1{#X}21{#X}23"), ("{#A}{#A}x{/A}{/A}", "xxxx"), ("{#a}{{K}}{/A}", "vw&lt;"), ("{#A}{{k}}{{Other}}{/A}", "v{{Other}}w&lt;{{Other}}"), ("{#NONE}x{/NONE}.", "."),
        ("{#DEEP_LIST}{{Z}}{/DEEP_LIST}", "1e+30"), ("{{K}}", "{{K}}"), ("", ""), ("{#A}{#B}{{K}}{{J}}{/B}{/A}", "vjw&lt;j"), ("{#B}{{S}}{/B}", "{#A}x{/A}"), ("{#B}{{L}}|{{O}}{/B}", "1, , true|[1,{&quot;a&quot;:2.5}]"),
    ],
)
def test_expand(template, want):
    data = {"a": [{"k": "v"}, {"k": "w<"}], "Deep": {"LIST": [{"z": 1e30}]}, "none": [], "b": [{"k": "inner", "j": "j", "s": "{#A}x{/A}", "l": [1, None, True], "o": [1, {"a": 2.5}]}]}
    assert B.expand(template, data) == want


def test_inner_arrays_are_read_once_for_a_document(monkeypatch):
    seen = []
    shown = B.shown
    monkeypatch.setattr(B, "shown", lambda v: seen.append(v) or shown(v))
    data = {"a": [{"k": f"k{i}"} for i in range(50)], "b": [{"m": "<"} for _ in range(40)], "c": [{"k": "c"}, {}]}
    got = B.expand("{#A}{{K}}{#B}{{M}}{#C}{{K}}{/C}{/B};{/A}", data)
    assert got == "".join(f"k{i}" + f"&lt;k{i}k{i}" * 40 + ";" for i in range(50))
    assert len(seen) == 50 + 40 + 1


@pytest.mark.parametrize("low", [1, 4, 8, 20])
def test_levels_above_and_below_the_low_ones(monkeypatch, low):
    """Blocks of ten levels, of which some are expanded by the stack and the others once for each set of values."""
    monkeypatch.setattr(B, "LOW", low)
    B.parse.cache_clear()
    template = "".join(f"{{#A}}{i}{{{{K}}}}" for i in range(10)) + "{/A}" * 10
    want = lambda i, k: "" if i == 10 else "".join(f"{i}{k or x}{want(i + 1, k or x)}" for x in "vw")
    assert B.expand(template, {"a": [{"k": "v"}, {"K": "w"}]}) == want(0, "")
    B.parse.cache_clear()


def test_expand_of_no_object(spark):
    df = spark.createDataFrame([("a{#X}b{/X}c", None), ("a{#X}b{/X}c", "no json"), ("a{#X}b{/X}c", "[1]"), (None, "{}")], "t string, d string")
    assert [r[0] for r in df.select(B.expand_loops(F.col("t"), F.col("d"))).collect()] == ["ac", "ac", "ac", None]


def test_merge_validates(spark):
    rows = [
        ('<w:p>{{A_B}}{#L}<w:r>{{X}}</w:r>{/L}</w:p>', '{"a": {"b": "x & y"}, "l": [{"x": 1.0}]}', "<w:p>x &amp; y<w:r>1</w:r></w:p>", None),
        ("<w:tbl>{#L}<w:tr/></w:tbl>{/L}", "{}", "<w:tbl>", "unclosed w:tbl"), ("<w:p>{{A}} < 1</w:p>", '{"a": true}', "<w:p>☑ < 1</w:p>", "bad_tag at 7"), ("<w:p>{{A}}</w:p>", None, "<w:p></w:p>", None),
    ]
    df = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "i int, t string, d string")
    out = W.fill_report(W.merge(df, "t", "d")).orderBy("i").collect()
    assert [(r["filled"]["xml"], r["error"]) for r in out] == [r[2:] for r in rows]
    assert [r["n_replaced"] for r in out] == [1, 0, 1, 0]


def plain_flat(value, prefix=""):
    """The rule, by recursion."""
    out = {}
    for key, v in value.items():
        tag = f"{prefix}_{key}".upper() if prefix else key.upper()
        if v is None:
            continue
        if isinstance(v, dict):
            out.update(plain_flat(v, tag))
        elif isinstance(v, list) and v and isinstance(v[0], dict):
            for i, item in enumerate(v):
                if isinstance(item, dict):
                    out.update(plain_flat(item, f"{tag}_{i}"))
            out[tag] = json.dumps(v, separators=(",", ":"), ensure_ascii=False)
        elif isinstance(v, list):
            if v:
                out[tag] = ", ".join({True: "true", False: "false", None: "null"}[x] if x is None or isinstance(x, bool) else str(x) for x in v)
        else:
            out[tag] = ("☑" if v else "☐") if isinstance(v, bool) else str(v)
    return out


def test_flatten_against_the_plain_rule(spark):
    rnd = random.Random(8)

    def some(depth):
        kind = rnd.choice("oolsbni" if depth < 5 else "sbni")
        if kind == "o":
            return {rnd.choice(["a", "b", "A", "a_b", "é", "x y"]): some(depth + 1) for _ in range(rnd.randint(0, 4))}
        if kind == "l":
            return [some(5) for _ in range(rnd.randint(0, 3))] if rnd.random() < 0.5 else [{"k": some(depth + 1)}, 3, {"m": "x"}]
        return {"s": 'text "q"', "b": rnd.random() < 0.5, "n": None, "i": rnd.randint(-9, 10**12)}[kind]

    objects = [{f"k{i}": some(0) for i in range(3)} for _ in range(150)]
    df = spark.createDataFrame([(i, json.dumps(o)) for i, o in enumerate(objects)], "i int, d string")
    got = {r["i"]: r["t"] for r in df.select("i", T.flatten_json(F.col("d")).alias("t")).collect()}
    assert all(got[i] == plain_flat(o) for i, o in enumerate(objects))


@pytest.mark.parametrize(
    ("data", "want"),
    [
        (None, None), ("", None), ("[1]", None), ("3", None), ("{", None), ("{}", {}), ('{"a": {}, "b": [], "c": null, "d": [null, 1.50]}', {"D": "null, 1.5"}), ('{"a_b": 1, "A": {"B": 2}}', {"A_B": "2"}), ('{"A": {"b": 2}, "a_B": 1}', {"A_B": "1"}),
        ('{"n": [1e30, 1e-12, 1e-6, 123456789012345680, 0.1, -0.0, 1e21, 1.5e20]}', {"N": "1e+30, 1e-12, 0.000001, 123456789012345680, 0.1, 0, 1e+21, 150000000000000000000"}),
        ('{"m": [[1, 2], [3]]}', {"M_0_0": "1", "M_0_1": "2", "M_1_0": "3", "M": "[[1,2],[3]]"}), ('{"a": ' * 300 + "1" + "}" * 300, {"_".join(["A"] * 300): "1"}), ("{" + '"a":[' * 100_000, None),
    ],
)
def test_flatten_odd_json(spark, data, want):
    assert spark.createDataFrame([(data,)], "d string").select(T.flatten_json(F.col("d"))).first()[0] == want


def test_typed_flattening_of_odd_numbers_and_keys(spark):
    spark.conf.unset("spark.sql.mapKeyDedupPolicy")
    df = spark.sql("select named_struct('b', 1) as a, 2 as a_b, 1e30D as big, 1e-12D as tiny, 1234567.5D as mid, 0.1D as tenth, 1e21D as edge, -2.5e-7D as low, double('NaN') as nan, 100D as whole, cast(2.50 as decimal(5,2)) as dec, 123456789012345680D as long, 0.0D as zero, 0.000001234567890123D as fine")
    tags = T.flatten_to_tags({f.name: (F.col(f.name), f.dataType) for f in df.schema.fields})
    assert df.select(tags).first()[0] == {
        "A_B": "2", "BIG": "1e+30", "TINY": "1e-12", "MID": "1234567.5", "TENTH": "0.1", "EDGE": "1e+21", "LOW": "-2.5e-7", "NAN": "NaN", "WHOLE": "100", "DEC": "2.5", "LONG": "123456789012345680", "ZERO": "0", "FINE": "0.000001234567890123"
    }
