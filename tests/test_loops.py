"""The loop over sections: what a round hands on, and its results beside a plain version."""

import random

from pyspark.sql import functions as F

from docframe.plans import agent

_CELL = "table_index int, row_index int, column_index int"


def _tables(spark, tags, places):
    t = spark.createDataFrame([(d, s, t, o, "", 0, 0, o) for d, s, t, o in tags], f"doc_id long, section string, tag string, ord int, label string, {_CELL}")
    return t, spark.createDataFrame([(d, s, p, "", 0, 0, p) for d, s, p in places], f"doc_id long, section string, place int, text string, {_CELL}")


def test_fallback_reads_only_the_sections_that_are_left_to_it(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("no tag is left for keywords")

    monkeypatch.setattr(agent, "keyword_candidates", fail)
    seen = []

    def matcher(mine, free):
        return mine.filter("doc_id.doc_id = 1").select("doc_id", "tag", F.col("ord").alias("place"), F.lit(0.8).alias("confidence"), F.lit("inline").alias("insertion_point"))

    def fallback(left, free):
        seen.extend(sorted({r[0] for r in df.select("doc_id.doc_id").collect()}) for df in (left, free))
        return agent.semantic_matcher(left, free)

    t, p = _tables(spark, [(1, "S", "A", 0), (2, "S", "A", 0)], [(1, "S", 0), (1, "S", 1), (2, "S", 0), (2, None, 1)])
    matches, log = agent.section_loop(t, p, matcher, fallback)
    assert seen == [[2], [2]]
    assert sorted(map(tuple, matches.select("doc_id", "section", "tag", "place", "mode").collect())) == [(1, "S", "A", 0, "answer"), (2, "S", "A", 0, "fallback")]
    agent.section_loop(*(df.filter("doc_id = 1") for df in (t, p)), matcher, fallback)
    assert len(seen) == 2 and log.count() == 2


def _plain(tags, places, answers, rounds):
    """Matches and log, section by section; the fallback places nothing."""
    matches, log = set(), set()
    for key in sorted({(d, s or "") for d, s, *_ in tags}):
        mine = [(t, o) for d, s, t, o in tags if (d, s or "") == key]
        spots = {p for d, s, p in places if (d, s or "") == key}
        order = {t: min(o for u, o in mine if u == t) for t, _ in mine}
        used: dict = {}
        for n in range(1, rounds + 1):
            left = [(t, o) for t, o in mine if t not in used]
            if not left:
                break
            gone, wants = {used[t][0] for t in used}, {}
            for t in {t for t, _ in left}:
                own = [a for a in answers if a[0] == key and a[1] == t and a[2] in spots - gone]
                if own:
                    wants[t] = min(own, key=lambda a: (-a[3], a[2]))
            won: dict = {}
            for t in sorted(wants, key=lambda t: (order[t], t)):
                won.setdefault(wants[t][2], t)
            log.add((*key, n, len(left), len(won)))
            used |= {t: (p, wants[t][3]) for p, t in won.items()}
        matches |= {(*key, t, *used[t]) for t in used}
    return sorted(matches), sorted(log)


def test_sections_are_settled_as_one_by_one(spark):
    r = random.Random(4)
    tags, places, answers = [], [], []
    for d in range(60):
        for s in (None, "B"):
            tags += [(d, s, f"T{r.randrange(6)}", r.randrange(4)) for _ in range(r.randrange(6))]
            places += [(d, s, p) for p in range(r.randrange(6))]
            answers += [((d, s or ""), f"T{r.randrange(8)}", r.randrange(7), r.choice([0.6, 0.8, 0.9])) for _ in range(r.randrange(12))]
    t, p = _tables(spark, tags, places)
    given = spark.createDataFrame([(*k, tag, place, c, "inline") for k, tag, place, c in answers] + [(1, "B", None, 1, 0.9, "inline"), (1, "B", "T1", None, 0.9, "inline")], "d long, s string, tag string, place int, confidence double, insertion_point string")
    given = given.select(F.struct(F.col("d").alias("doc_id"), F.col("s").alias("section")).alias("doc_id"), "tag", "place", "confidence", "insertion_point")
    matches, log = agent.section_loop(t, p, lambda mine, free: given, lambda left, free: given.limit(0))
    got = sorted(map(tuple, matches.select("doc_id", "section", "tag", "place", "confidence").collect())), sorted(map(tuple, log.collect()))
    assert got == _plain(tags, places, answers, agent.MAX_ROUNDS)
    assert {x[2] for x in got[1]} == {1, 2, 3}
