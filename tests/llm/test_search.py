import random

import pytest

from docframe.llm import search
from docframe.llm.queries import op11_search, oracle_sql
from tests.llm.helpers import DOCS, clashing, odd_docs
from tests.oracle import compare


def test_query_equals_its_sql(spark, sf):
    compare(op11_search(spark, sf), oracle_sql()["op11_search"], sf)


def plain(docs, items, top):
    import math
    from collections import Counter

    sets = [(i, Counter(search.terms((t or "").encode()))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in sets), sum(c.total() for _, c in sets)
    df = Counter(t for _, c in sets for t in c)
    out = []
    for name, text in items:
        found = []
        for i, c in sets:
            m = 75 + (25 * c.total() * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in search.terms((text or "").encode()) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(name, rank + 1, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_odd_rows(spark, block):
    docs = clashing(odd_docs(spark, extra=[(100 + i, "tie alpha1 beta2", "en", "a", 1) for i in range(40)]))
    items = [(1, "alpha1 ALPHA1 beta2, tie!"), (2, None), (3, ""), (4, "no such terms zzz"), (5, "日本語テキスト copy"), (1, "word"), (None, "É é same")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((tuple(r) for r in search.search(docs, table, top=7, block_bytes=block).collect()), key=str)
    assert found == plain([(r["doc_id"], r["text"]) for r in docs.collect()], items, 7)


def test_empty_tables(spark):
    docs, items = odd_docs(spark), spark.createDataFrame([(1, "alpha1")], "item_id long, text string")
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(docs, items.limit(0)).count() == 0


def test_every_chunk_size_gives_the_same(spark, monkeypatch):
    rnd = random.Random(3)
    say = lambda n: " ".join(f"w{int(rnd.paretovariate(0.7)) % 60}" for _ in range(n))
    docs = [(i, say(rnd.randint(0, 90)), "en", "s", 1) for i in range(300)]
    items = [(i, say(9)) for i in range(12)]
    frames = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id long, text string")
    found = sorted((tuple(r) for r in search.search(*frames, top=5).collect()), key=str)
    assert found == plain([d[:2] for d in docs], items, 5)


def test_bounds_hold():
    import numpy as np

    tf, m = np.array([1, 2, 50, 100_000]), np.array([75, 100, 5000, 10**8])
    g = search.impact(tf, m)
    q = -(-g // search.STEP)
    assert (q <= 255).all()
    assert (g <= q * search.STEP).all()
    assert (g > (q - 1) * search.STEP).all()
