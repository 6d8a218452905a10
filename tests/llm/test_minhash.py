import random

import numpy as np
import pytest

from docframe.llm import minhash
from docframe.llm.queries import op13_minhash
from tests.llm.helpers import DOCS, clashing, odd_docs


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def plain(rows):
    sets = {r["doc_id"]: plain_set(r["text"]) for r in rows}
    label = minhash.brute_components(sets)
    return {i: (len(s), label[i], label[i] == i) for i, s in sets.items()}


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found(op13_minhash(spark, sf)) == plain(docs.collect())


def near_copies(n, seed=5):
    """Groups whose texts differ in some words, around the threshold."""
    rnd = random.Random(seed)
    rows = []
    while len(rows) < n:
        words = [f"w{rnd.randint(0, 10**6)}" for _ in range(rnd.randint(5, 120))]
        for _ in range(rnd.randint(1, 12)):
            own = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 25))):
                own[rnd.randrange(len(own))] = f"x{rnd.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(own), "en", "s", 1))
    return rows


@pytest.mark.parametrize("limits", [{}, {"tile": 4, "set_tile": 3, "set_shingles": 200}])
def test_near_copies(spark, limits):
    docs = spark.createDataFrame(near_copies(250), DOCS).repartition(4)
    assert found(minhash.minhash_components(docs, **limits)) == plain(docs.collect())


def test_dense_regions(spark):
    """Far more near copies than a region or a tile may hold: the regions go deeper, the rest is tiled."""
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        own = list(words)
        own[rnd.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(own), "en", "s", 1))
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert found(minhash.minhash_components(docs, tile=10, set_tile=20)) == plain(docs.collect())


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = minhash.minhash_components(clashing(docs)).collect()
    assert len(rows) == docs.count()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], r["text"])
    expected = plain([{"doc_id": i, "text": t} for i, t in texts.items() if i is not None])
    assert all((r["n_shingles"], r["component_id"], r["kept"]) == expected[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(1, None, True)]
    assert minhash.minhash_components(docs.limit(0)).count() == 0


def test_exact_links_span_the_components():
    rnd = random.Random(2)
    sets = [np.unique(np.array([rnd.randrange(40) for _ in range(rnd.randint(1, 30))], np.uint64)) for _ in range(200)]
    label = list(range(200))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in minhash.exact_links(sets):
        label[max(top(i), top(j))] = min(top(i), top(j))
    assert {i: top(i) for i in range(200)} == minhash.brute_components({i: set(s.tolist()) for i, s in enumerate(sets)})
