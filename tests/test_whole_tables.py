"""Queries over all rows of small tables, held against brute force."""

import time

import pytest
from pyspark.sql import functions as F

from docframe.operators import matching as M
from docframe.queries import QUERIES

COLOURS = "almond azure beige coral ivory khaki linen olive".split()


def part_dir(spark, tmp_path):
    rows = [(i, f"{COLOURS[i % 8]} {COLOURS[(i // 3 + 1) % 8]}", f"Brand#{i % 2}", f"LARGE {COLOURS[i * 5 % 8].upper()}", i % 7) for i in range(1, 41)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    return rows


def brute_scores(rows):
    """(brand, tag) -> [(score, place)], best first."""
    out = {}
    for tag, name, brand, _, _ in rows:
        scored = []
        for place, other, b, kind, size in rows:
            length = sum(len(w) for w in name.split() if w in f"{kind} {other}".lower())
            if b == brand and length:
                scored.append((length + 5 * (size % 2 == 0), place))
        out[brand, tag] = sorted((s for s in scored if s[0] >= 5), key=lambda s: (-s[0], s[1]))
    return out


def test_best_candidate_over_all_parts(spark, tmp_path):
    rows = part_dir(spark, tmp_path)
    want = {(b, t, s[0][1], s[0][0]) for (b, t), s in brute_scores(rows).items() if s}
    got = {tuple(r) for r in QUERIES["keyword_best_candidate"](spark, str(tmp_path)).select("brand", "tag", "place", "score").collect()}
    assert got == want
    assert any(rows[g[2] - 1][4] % 4 >= 2 for g in got)


def test_greedy_assignment_over_all_parts(spark, tmp_path):
    rows = part_dir(spark, tmp_path)
    used, want = set(), set()
    for (brand, tag), scored in sorted(brute_scores(rows).items()):
        free = [s for s in scored if s[1] not in used]
        if free:
            used.add(free[0][1])
            want.add((brand, tag, free[0][1], free[0][0]))
    got = {(r["brand"], r["tag"], r["place"], r["score"]) for r in QUERIES["keyword_greedy_assignment"](spark, str(tmp_path)).collect()}
    assert got == want
    assert {r[4] % 4 for r in rows if r[0] in used} == {0, 1, 2, 3}


def test_nations_with_spaces_and_signs(spark, tmp_path):
    names = ["FRANCE", "SAUDI ARABIA", "CÔTE D'IVOIRE", "GUINEA-BISSAU", "NEW FORMOSA"]
    spark.createDataFrame(list(enumerate(names)), "n_nationkey long, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    # A word is of ASCII letters, as in the surveyed patterns, so it ends before an accent.
    rows = lambda q: [tuple(r)[1:] for r in QUERIES[q](spark, str(tmp_path)).orderBy("n_nationkey").collect()]
    assert rows("section_titles") == [("B", "FRANCE", 1), ("1", "2 SAUDI ARABIA", 2), ("C", "ÔTE D'IVOIRE x", 1), ("B", "GUINEA-BISSAU", 1), ("1", "2 NEW FORMOSA", 2)]
    tags = ["{{FRANCE}}", "{{SAUDI}} ARABIA", "{{C}}ÔTE D'IVOIRE", "{{GUINEA}}-BISSAU", "{{NEW}} FORMOSA"]
    assert rows("xml_repair") == [(f"<w:t>{x} x {{{{OK}}}}</w:t>",) for x in tags]
    assert rows("xml_readings") == [(f"{n} x", f"{n}FORMCHECKBOX x") for n in names]


@pytest.mark.parametrize("block", [7, 16, None])
def test_assignment_by_texts_equals_one_pass(spark, block):
    """Tags and places of few texts, equal scores among them: blocks of any size give what the candidates taken one by one give."""
    names = ["cold ring", "cold bolt", "hot ring", "coldest bolt", "none"]
    tags = [(g, 7 * i % 40, names[(i * i + g) % 5].split()) for g in (1, 2) for i in range(40)]
    places = [(g, 100 + 11 * i % 30, names[(i + i // 5) % 5] + ":" * (i % 3 == 0)) for g in (1, 2) for i in range(30)]
    want = set()
    for g in (1, 2):
        free = {p: text for h, p, text in places if h == g}
        for _, ord_, words in sorted((t for t in tags if t[0] == g), key=lambda t: t[1]):
            scores = {p: sum(len(w) for w in words if w in text) for p, text in free.items()}
            found = [(-(n + 5 * free[p].endswith(":")), p) for p, n in scores.items() if n and n + 5 * free[p].endswith(":") >= 5]
            if found:
                n, p = min(found)
                want.add((g, ord_, p, -n))
                del free[p]
    t = spark.createDataFrame([(g, f"T{o}", o, w) for g, o, w in tags], "grp int, tag string, ord int, words array<string>")
    p = spark.createDataFrame(places, "grp int, place int, text string")
    out = M.keyword_assignment(t, p, "grp", block=block)
    assert dict(out.dtypes)["place"] == "int"
    assert {(r["grp"], r["ord"], r["place"], r["score"]) for r in out.collect()} == want
    assert M.keyword_assignment(t, p.limit(0), "grp").count() == 0


def test_equal_texts_are_counted_and_assigned_without_pairs(spark):
    """30,000 tags and places of one text would be 900 million candidates."""
    n = 30_000
    tags = spark.range(n).select(F.lit(1).alias("grp"), F.col("id").alias("tag"), F.col("id").alias("ord"), F.array(F.lit("ring")).alias("words"))
    places = spark.range(n).select(F.lit(1).alias("grp"), F.col("id").alias("place"), F.lit("a ring:").alias("text"))
    began = time.perf_counter()
    assert M.keyword_counts(tags, places, "grp").filter(f"n = {n} and total = {9 * n}").count() == n
    assert M.keyword_assignment(tags, places, "grp").filter("tag = place and score = 9").count() == n
    assert time.perf_counter() - began < 60
