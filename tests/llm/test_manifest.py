import hashlib
import random
import zlib

import pytest

from docframe.llm import merkle
from docframe.llm.queries import op12_merkle
from tests.llm.helpers import DOCS, clashing, odd_docs

H = lambda *p: hashlib.sha256("".join(p).encode()).hexdigest()


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, i, fanout):
    out = []
    for nodes in levels[:-1]:
        a = i // fanout * fanout
        out.append((nodes[a:i], nodes[i + 1 : a + fanout]))
        i //= fanout
    return out


def plain(rows, fanout):
    """Sorted (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), by hand."""
    leaf = lambda r: H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])
    fields = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in rows]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by = {}
    for f in fields:
        by.setdefault(f[1], []).append(f)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda f: (f[0] is not None, f[0] or 0, leaf(f)))
        trees[s] = tree([leaf(f) for f in by[s]], fanout)
    top = tree([trees[s][-1][0] for s in order], fanout)
    out = []
    for n, s in enumerate(order):
        for i, f in enumerate(by[s]):
            steps = path(trees[s], i, fanout) + path(top, n, fanout)
            hit = f[0] is not None and zlib.crc32(str(f[0]).encode()) % 5 == 0
            node = leaf((*f[:4], f[4].translate(low) if f[4] is not None else None)) if hit else leaf(f)
            for a, b in steps:
                node = H(*a, node, *b)
            out.append((f[0], leaf(f), trees[s][-1][0], top[-1][0], H(*[x for a, b in steps for x in a + b]), node, node == top[-1][0]))
    return sorted(out, key=str)



def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    df = op12_merkle(spark, sf)
    assert rows_of(df) == plain([r.asDict() for r in docs.collect()], 16)
    assert df.filter("not verified").count() > 0


@pytest.mark.parametrize(("n", "sources", "fanout", "levels"), [(1, 1, 2, 1), (17, 1, 2, 2), (65, 3, 4, 1), (300, 40, 3, 2), (129, 1, 2, 3)])
def test_trees_of_any_depth(spark, n, sources, fanout, levels):
    rnd = random.Random(n)
    rows = [(i, f"Text {rnd.random()}", None if i % 7 == 0 else "en", None if i % sources == 1 else f"é{i % sources}", i) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert rows_of(merkle.tampering_check(docs, fanout, levels)) == plain([r.asDict() for r in docs.collect()], fanout)


def test_odd_rows(spark):
    docs = odd_docs(spark, extra=[(None, None, None, None, None), (None, None, None, None, None), (9_007_199_254_740_993, "Big", "en", "", 3)])
    found = rows_of(merkle.tampering_check(clashing(docs)))
    assert found == plain([r.asDict() for r in docs.collect()], 16)
    assert merkle.tampering_check(docs.limit(0)).count() == 0


def test_a_changed_row_changes_the_root(spark):
    rows = [(i, f"t{i}", "en", "s", 1) for i in range(50)]
    one = merkle.tampering_check(spark.createDataFrame(rows, DOCS)).select("root").distinct().collect()
    rows[31] = (31, "other", "en", "s", 1)
    two = merkle.tampering_check(spark.createDataFrame(rows, DOCS)).select("root").distinct().collect()
    assert len(one) == len(two) == 1
    assert one != two
